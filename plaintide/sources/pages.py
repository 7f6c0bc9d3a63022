"""Response pages as a search service returns them, landed as JSON files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaintide.functions.scalar import instant, strict_cast, utc_wall
from plaintide.schemas import ENVELOPE, RAW

STRICT = {"mode": "FAILFAST"}
RUN_TIME = re.compile(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{1,6})?Z")


def fetch_folder(root: str, run_ts: str) -> str:
    """The folder of one fetch: a run lands its pages there and reads no others."""
    return f"{root.rstrip('/')}/run={re.sub('[^0-9TZ]', '', checked_time(run_ts))}"


def checked_time(run_ts: str) -> str:
    if not RUN_TIME.fullmatch(run_ts):
        raise ValueError(f"not a UTC time such as 2026-07-11T02:00:00.000Z: {run_ts}")
    return run_ts


def read_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Pages under `path`: one per line, or one per file with `multi_line`. A broken page fails the read."""
    return spark.read.schema(ENVELOPE).options(**STRICT).option("multiLine", multi_line).json(path)


def flatten_pages(pages: DataFrame) -> DataFrame:
    """One row per hit: the record as JSON text, `{}` where the hit carries none."""
    hits = pages.select(F.explode("hits.hits").alias("hit"))
    return hits.select(F.coalesce("hit._source", F.lit("{}")).alias("record"))


def parse_records(records: DataFrame) -> DataFrame:
    """The declared fields of each record as text; the other columns stay in front."""
    others = [c for c in records.columns if c != "record"]
    parsed = records.withColumn("record", F.from_json("record", RAW, STRICT))
    return parsed.select(*others, "record.*")


def json_field(name: str) -> Column:
    """One field of the record text."""
    schema = T.StructType([T.StructField(name, T.StringType())])
    return F.from_json("record", schema, STRICT)[name]


def reconcile_counts(pages: DataFrame) -> DataFrame:
    """Records of one fetch against the total that its first page announces; a difference is reported, not raised."""
    first = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    counts = pages.select(
        F.col("hits.total.value").alias("total"),
        first.alias("position"),
        F.coalesce(F.array_size("hits.hits"), F.lit(0)).cast("long").alias("records"),
    ).agg(
        F.coalesce(F.min_by("total", "position"), F.lit(0).cast("long")).alias("expected"),
        F.coalesce(F.sum("records"), F.lit(0).cast("long")).alias("actual"),
    )
    return counts.withColumn("is_complete", F.col("expected") == F.col("actual"))


def with_process_date(records: DataFrame, undated: str) -> DataFrame:
    """Add the UTC day each record was received; a record without one belongs to the day `undated`.

    No record is lost that way: one without a key then fails the upsert instead of vanishing here.
    """
    received = strict_cast(instant(json_field("date_received")), T.TimestampType(), "date_received")
    day = F.coalesce(utc_wall(received).cast("date"), F.lit(undated).cast("date"))
    return records.withColumn("process_date", day)


def stamp_extracted_at(records: DataFrame, run_ts: str) -> DataFrame:
    """Add one run's UTC extraction time to every record.

    The time is a parameter, so replaying a run gives the same rows. It goes last into the JSON text,
    where it also wins over a field of that name.
    """
    text = F.trim("record")
    # Cut by octets: the text of a whole record is not walked through for its last character.
    cut = F.substring(text.cast("binary"), F.lit(1), F.octet_length(text) - 1).cast("string")
    body = F.rtrim(F.when(F.endswith(text, F.lit("}")), cut).otherwise(text.substr(F.lit(1), F.length(text) - 1)))
    comma = F.when(body == "{", F.lit("")).otherwise(F.lit(","))
    stamped = F.concat(body, comma, F.lit(f'"extracted_at":"{checked_time(run_ts)}"}}'))
    return records.withColumn("record", stamped)
