"""Typed access to the driver tables (SRC3) and the shared table registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None,
               fmt: str = "parquet") -> DataFrame:
    """SRC3: typed scan of a stored table. With a schema, no inference runs and
    Parquet still gets column pruning and filter pushdown."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


class Tables:
    """Lazy handles on the driver tables under one root folder.

    Each attribute is a plain ``spark.read.parquet`` DataFrame; nothing is read
    until an action runs, so Catalyst prunes columns and pushes filters into
    every scan a query actually needs.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.path(name))
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            return self.table(name)
        raise AttributeError(name)


def tables(spark: SparkSession, root: str) -> Tables:
    """Fresh handles: a long session sees files that were added since."""
    return Tables(spark, root)
