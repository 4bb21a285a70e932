"""File listing, typed sinks and table lifecycle (SRC1, SRC2, SRC4, SNK1-SNK5).

Tables are Parquet folders. ``replace_table`` is the CREATE OR REPLACE ... AS
SELECT of the reference; ``append_rows`` is INSERT with a column list
(missing columns take the declared default or NULL); ``create_if_absent``
writes an empty typed table only when the folder is missing.
"""

from __future__ import annotations

import os
from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas

# Document types the upload accepts.
ACCEPTED_TYPES = ["pdf", "png", "jpg", "jpeg"]


def list_files(spark: SparkSession, root: str, glob: str = "*", file_type: str = "PDF",
               recursive: bool = True) -> DataFrame:
    """SRC1: directory listing -> registry rows. Only metadata columns are
    selected, so the ``binaryFile`` source never reads file contents."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", str(recursive).lower()).load(root))
    return registry_rows(df, root, file_type)


def registry_rows(listing: DataFrame, root: str, file_type: str = "PDF") -> DataFrame:
    """POD_FILES rows from a binaryFile listing (batch or stream)."""
    prefix = root.rstrip("/") + "/"
    rel = F.regexp_replace(F.col("path"), r"^.*?" + _re_escape(prefix.split("://")[-1]), "")
    return listing.select(
        rel.alias("file_name"), rel.alias("file_relative_path"),
        F.lit(file_type).alias("file_type"), F.col("length").alias("file_size"),
        F.col("modificationTime").cast("timestamp_ntz").alias("load_ts"),
        F.lit(False).alias("processed"))


def _re_escape(s: str) -> str:
    import re
    return re.escape(s)


def file_extension(path: Column) -> Column:
    """STR8: lower-cased extension after the last dot ('' when none)."""
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))


def base_name(path: Column) -> Column:
    """STR9: last path segment."""
    return F.element_at(F.split(path, "/"), -1)


def accepted_uploads(df: DataFrame, path_col: str = "file_name",
                     types: Iterable[str] = ACCEPTED_TYPES) -> DataFrame:
    """SRC2: keep only files of an accepted document type."""
    return df.where(file_extension(F.col(path_col)).isin(*list(types)))


def inline_table(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """SRC4: literal rows with a fixed schema."""
    return spark.createDataFrame(rows, schema)


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """SNK1: CREATE OR REPLACE TABLE ... AS SELECT."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def conform(df: DataFrame, schema: StructType, defaults: dict[str, Column] | None = None) -> DataFrame:
    """Columns in table order; missing ones take their default or NULL (typed)."""
    defaults = defaults or {}
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name in defaults:
            cols.append(defaults[f.name].cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def append_rows(df: DataFrame, path: str, schema: StructType,
                defaults: dict[str, Column] | None = None) -> None:
    """SNK2: INSERT with a column list (by name, defaults for the rest)."""
    conform(df, schema, defaults).write.mode("append").parquet(path)


def append_positional(df: DataFrame, path: str, schema: StructType) -> None:
    """SNK3: INSERT ... SELECT * / VALUES by position."""
    if len(df.columns) != len(schema.fields):
        raise ValueError(f"{len(df.columns)} values for {len(schema.fields)} columns")
    append_rows(df.toDF(*[f.name for f in schema.fields]), path, schema)


def create_if_absent(spark: SparkSession, path: str, schema: StructType) -> bool:
    """SNK5: create an empty typed table when missing. Returns True if created."""
    if _exists(spark, path):
        return False
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return True


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.getFileStatus(p).isDirectory()


def materialize(df: DataFrame, spark: SparkSession, name: str,
                partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a table in a fresh folder of the shared folder and read it
    back: a CTAS that also cuts the lineage (lost executors re-read files). The write's
    shuffle files go with it."""
    from ..session import scratch_path, scratch_writes
    path = scratch_path(spark, name)
    with scratch_writes(df.sparkSession):
        replace_table(df, path, partition_by)
    return spark.read.parquet(path)


def pod_fact_defaults() -> dict[str, Column]:
    """Declared column defaults of POD_FACT (BOOLEAN DEFAULT ..., CURRENT_TIMESTAMP)."""
    return {"exception_flag": F.lit(False), "signature_present": F.lit(True),
            "damage_reported": F.lit(False), "partial_delivery": F.lit(False),
            "processed_at": F.current_timestamp().cast("timestamp_ntz")}


__all__ = ["list_files", "registry_rows", "accepted_uploads", "inline_table", "replace_table",
           "append_rows", "append_positional", "create_if_absent", "materialize", "conform",
           "file_extension", "base_name", "pod_fact_defaults", "schemas"]
