"""Warehouse layers as catalog databases with tables below one root folder."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaintide.operators.upsert import RANGE, finished_loads, point_partitions, upsert_by_key
from plaintide.schemas import BRONZE
from plaintide.sources.versions import Manifest

DEFAULT_LAYER = "main"
COMPLAINTS = "complaints"


def schema_for_layer(layer: str | None = None) -> str:
    """A layer's database name is the layer itself, without a target prefix; `main` if there is none."""
    return layer.strip() if layer is not None else DEFAULT_LAYER


@dataclass(frozen=True)
class Warehouse:
    """Databases `raw`, `staging`, `intermediate` and `marts`; `prefix` keeps several apart in one catalog."""

    spark: SparkSession
    root: str
    prefix: str = ""

    def database(self, layer: str | None) -> str:
        return self.prefix + schema_for_layer(layer)

    def name(self, layer: str | None, model: str) -> str:
        return f"{self.database(layer)}.{model}"

    def path(self, layer: str | None, model: str) -> str:
        return f"{self.root.rstrip('/')}/{self.database(layer)}/{model}"

    def table_exists(self, layer: str | None, model: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, model))

    def create_database(self, layer: str | None) -> None:
        location = f"{self.root.rstrip('/')}/{self.database(layer)}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database(layer)}` LOCATION '{location}'")

    def create_if_absent(self) -> None:
        """Database and empty keyed table, unless they exist. Data of an earlier session is picked up."""
        if self.table_exists("raw", COMPLAINTS):
            return
        self.create_database("raw")
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in BRONZE)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name('raw', COMPLAINTS)} ({fields}, `{RANGE}` bigint) USING parquet "
            f"PARTITIONED BY (`{RANGE}`) LOCATION '{self.path('raw', COMPLAINTS)}'"
        )
        location = self.path("raw", COMPLAINTS)
        point_partitions(self.spark, self.name("raw", COMPLAINTS), location, finished_loads(self.spark, location))

    def source_table(self) -> DataFrame:
        """The keyed complaint table that staging reads, as last written by any session."""
        self.spark.catalog.refreshTable(self.name("raw", COMPLAINTS))
        return self.spark.table(self.name("raw", COMPLAINTS)).drop(RANGE)

    def ranges(self) -> dict[str, str]:
        """The key ranges of the table and the load that each was last written by."""
        latest = {}
        for load, content in finished_loads(self.spark, self.path("raw", COMPLAINTS)).items():
            latest |= {part.split("=")[1]: load for part in content if part.startswith(f"{RANGE}=")}
        return latest

    def range_rows(self, ranges: list[str]) -> DataFrame:
        """The rows of some key ranges; the scan reads their partitions alone."""
        self.spark.catalog.refreshTable(self.name("raw", COMPLAINTS))
        rows = self.spark.table(self.name("raw", COMPLAINTS))
        return rows.filter(F.col(RANGE).isin([int(r) for r in ranges])).drop(RANGE)

    def point_marts(self, manifest: Manifest, marts: list[str], fact: str) -> None:
        """Let the catalog's tables of the marts layer be those of a version.

        Table by table: a reader who needs several of one version takes them from the manifest.
        """
        self.create_database("marts")
        for mart in marts:
            self._external("marts", mart, self.spark.read.parquet(manifest.tables[mart]).schema, manifest.tables[mart])
        parts = {r: p[fact] for r, p in manifest.parts.items() if fact in p}
        name = self.name("marts", fact)
        if parts:
            schema = self.spark.read.parquet(next(iter(parts.values()))).schema
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}, `{RANGE}` bigint) USING parquet PARTITIONED BY (`{RANGE}`) LOCATION '{self.path('marts', fact)}'")
        if not self.table_exists("marts", fact):
            return
        known = {row[0].split("=")[1] for row in self.spark.sql(f"SHOW PARTITIONS {name}").collect()}
        for r in known - set(parts):
            self.spark.sql(f"ALTER TABLE {name} DROP PARTITION ({RANGE} = {r})")
        new = [f"PARTITION ({RANGE} = {r}) LOCATION '{p}'" for r, p in parts.items() if r not in known]
        if new:
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(new)}")
        for r in known & set(parts):
            self.spark.sql(f"ALTER TABLE {name} PARTITION ({RANGE} = {r}) SET LOCATION '{parts[r]}'")
        self.spark.catalog.refreshTable(name)

    def _external(self, layer: str, model: str, schema: T.StructType, path: str) -> None:
        name = self.name(layer, model)
        if self.table_exists(layer, model):
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        else:
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet LOCATION '{path}'")
        self.spark.catalog.refreshTable(name)

    def upsert(self, batch: DataFrame, batch_of: tuple[str, int] | None = None) -> int:
        """Rows of the batch, after they are in the table; `batch_of` is a stream and its batch number."""
        self.create_if_absent()
        location = self.path("raw", COMPLAINTS)
        return upsert_by_key(self.spark, batch, self.name("raw", COMPLAINTS), location, batch_of=batch_of)

    def load_summary(self, processed: int) -> DataFrame:
        """One row of values: rows of the batch, rows of the table now, status of a load that returned."""
        total = self.source_table().count()
        columns = "records_processed long, total_records_in_table long, status string"
        return self.spark.createDataFrame([(processed, total, "success")], columns)

    def materialize(self, layer: str, model: str, df: DataFrame) -> DataFrame:
        """Store a model as a table of its layer."""
        self.create_database(layer)
        df.write.mode("overwrite").option("path", self.path(layer, model)).saveAsTable(self.name(layer, model))
        return self.spark.table(self.name(layer, model))

    def create_view(self, layer: str, model: str, columns: dict[str, str], source: str) -> DataFrame:
        """Define a model as a view of its layer over `source`; it runs when it is read."""
        self.create_database(layer)
        fields = ", ".join(f"{expression} AS `{name}`" for name, expression in columns.items())
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(layer, model)} AS SELECT {fields} FROM {source}")
        return self.spark.table(self.name(layer, model))

    def table(self, layer: str, model: str) -> DataFrame:
        return self.spark.table(self.name(layer, model))
