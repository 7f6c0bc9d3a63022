"""Hand-made complaint rows."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from plaintide.schemas import BRONZE

DEFAULTS = {
    "product": "Loan",
    "complaint_what_happened": "text",
    "date_sent_to_company": "2026-01-05T00:00:00.000Z",
    "issue": "Fees",
    "sub_product": "Auto",
    "zip_code": "10001",
    "tags": None,
    "has_narrative": True,
    "complaint_id": 1,
    "timely": "Yes",
    "company_response": "Closed",
    "submitted_via": "Web",
    "company": "Acme",
    "date_received": "2026-01-01T00:00:00.000Z",
    "state": "NY",
    "company_public_response": None,
    "sub_issue": "Late",
    "extracted_at": "2026-01-10T00:00:00.000Z",
}


def instant(text):
    return None if text is None else datetime.fromisoformat(text.replace("Z", "+00:00")).astimezone(timezone.utc)


def complaint(**changes):
    return {**DEFAULTS, **changes}


def bronze(spark, rows):
    """Typed rows; times given as ISO text."""
    times = {"date_sent_to_company", "date_received", "extracted_at"}
    values = [tuple(instant(r[f.name]) if f.name in times else r[f.name] for f in BRONZE) for r in rows]
    return spark.createDataFrame(values, BRONZE)


def by_key(df):
    """Rows as dictionaries by complaint id, times as microseconds."""
    times = ["date_sent_to_company", "date_received", "extracted_at"]
    plain = df.withColumns({c: F.unix_micros(c) for c in times})
    found = [r.asDict() for r in plain.collect()]
    keyed = {r["complaint_id"]: r for r in found}
    assert len(keyed) == len(found), "duplicate keys"
    return keyed
