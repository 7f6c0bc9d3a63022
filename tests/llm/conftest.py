from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Rows with the columns of documents, and a few that clash with names used inside the operators."""

    def make(texts):
        pairs = texts.items() if isinstance(texts, dict) else texts
        rows = [(i, t, "en", None, None if t is None else len(t)) for i, t in pairs]
        frame = spark.createDataFrame(rows, SCHEMA)
        return frame.withColumns({n: F.lit(7) for n in ("id", "h", "row", "score", "sha", "slice", "mark", "bucket", "n")})

    return make
