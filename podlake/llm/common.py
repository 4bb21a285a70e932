"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import hashlib
import io
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, scratch_writes

#: ASCII white space of the text contracts: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, once per session: they import it by name,
    in whatever folder they start. The archive is written to the shared folder;
    its name holds its digest."""
    root, held = Path(__file__).resolve().parents[1], io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.writestr(zipfile.ZipInfo(str(f.relative_to(root.parent))), f.read_bytes())
    name = f"{root.name}-{hashlib.sha256(held.getvalue()).hexdigest()[:16]}.zip"
    sc = spark.sparkContext
    if name in sc._python_includes:
        return
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark, 'package')}/{name}")
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(held.getvalue()))
    out.close()
    sc.addPyFile(path.toString())


def in_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """``mapInArrow`` on workers that hold this package."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a fresh place in the shared folder and read it
    back: cuts the lineage, survives lost executors. Nothing reads the write's
    shuffles again, so they are removed with it."""
    path = scratch_path(df.sparkSession, name)
    with scratch_writes(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. ``lower`` is the fast path where every character is
    ASCII (there the two agree); other text goes through ``translate``."""
    return (F.when(F.octet_length(c) == F.char_length(c), F.lower(c))
            .otherwise(F.translate(c, UPPER, LOWER)))


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text in order; null or blank: no words."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_RUN))


def fingerprint(text: Column) -> Column:
    """Tells rows that share a doc_id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))
