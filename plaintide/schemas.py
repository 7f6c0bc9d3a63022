"""Declared record schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names, order and types of a complaint record.
BRONZE = T.StructType(
    [
        T.StructField("product", T.StringType()),
        T.StructField("complaint_what_happened", T.StringType()),
        T.StructField("date_sent_to_company", T.TimestampType()),
        T.StructField("issue", T.StringType()),
        T.StructField("sub_product", T.StringType()),
        T.StructField("zip_code", T.StringType()),
        T.StructField("tags", T.StringType()),
        T.StructField("has_narrative", T.BooleanType()),
        T.StructField("complaint_id", T.LongType()),
        T.StructField("timely", T.StringType()),
        T.StructField("company_response", T.StringType()),
        T.StructField("submitted_via", T.StringType()),
        T.StructField("company", T.StringType()),
        T.StructField("date_received", T.TimestampType()),
        T.StructField("state", T.StringType()),
        T.StructField("company_public_response", T.StringType()),
        T.StructField("sub_issue", T.StringType()),
        T.StructField("extracted_at", T.TimestampType()),
    ]
)

KEY = "complaint_id"
REQUIRED = ["complaint_id", "company", "product", "issue", "date_received"]

# Raw JSON is read with every field as text: `"12"` and `12` both arrive, and a bad value is caught by
# the strict cast in `operators.normalize` instead of turning into NULL in the JSON reader.
RAW = T.StructType([T.StructField(f.name, T.StringType()) for f in BRONZE])

# `_source` stays JSON text, so the raw layer keeps fields the declared schema does not know.
# `search_after` is what a fetch may add: the cursor that a page was asked for with.
ENVELOPE = T.StructType(
    [
        T.StructField("search_after", T.StringType()),
        T.StructField(
            "hits",
            T.StructType(
                [
                    T.StructField("total", T.StructType([T.StructField("value", T.LongType())])),
                    T.StructField(
                        "hits",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField("_source", T.StringType()),
                                    T.StructField("sort", T.ArrayType(T.StringType())),
                                ]
                            )
                        ),
                    ),
                ]
            ),
        )
    ]
)
