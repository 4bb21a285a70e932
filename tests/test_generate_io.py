"""Literal dims (SRC4) and table sinks (SNK1-SNK5)."""

import os

from settings import SF_SMALL
from podlake import schemas
from podlake.session import scratch_path
from podlake.sources import io, literals

def test_literal_dims(spark):
    assert literals.literal_carriers(spark).count() == 8
    c = literals.literal_customers(spark)
    assert c.count() == 10 and dict(c.dtypes)["created_at"] == "timestamp_ntz"


def test_list_files_and_accepted_types(spark):
    reg = io.list_files(spark, SF_SMALL, glob="*.parquet", file_type="PARQUET")
    names = {r.file_name for r in reg.collect()}
    assert "lineitem.parquet" in names and len(names) == 14
    df = spark.createDataFrame([("a.PDF",), ("b.png",), ("c.txt",), ("d",)], "file_name string")
    assert [r[0] for r in io.accepted_uploads(df).collect()] == ["a.PDF", "b.png"]


def test_append_rows_defaults_and_create_if_absent(spark):
    path = scratch_path(spark, "podfact")
    assert io.create_if_absent(spark, path, schemas.POD_FACT)
    assert not io.create_if_absent(spark, path, schemas.POD_FACT)
    rows = spark.createDataFrame([("P1", "Delivered - Clean")], "pod_id string, pod_status string")
    io.append_rows(rows, path, schemas.POD_FACT, io.pod_fact_defaults())
    r = spark.read.parquet(path).collect()
    assert len(r) == 1 and r[0].signature_present is True and r[0].exception_flag is False
    assert r[0].processed_at is not None and r[0].shipment_id is None


def test_shared_folder_comes_from_session(spark):
    d = spark.conf.get("spark.checkpoint.dir")
    assert d and scratch_path(spark, "x").startswith(d.rstrip("/"))
    assert os.path.isdir(d.replace("file:", ""))


def test_initial_partitions_only_on_clusters(spark):
    """AQE's starting partition count scales with the cluster and is never set
    on a local session (nor over a value the session already has)."""
    from podlake.session import INITIAL_PARTITIONS_KEY, initial_partitions, set_initial_partitions
    assert initial_partitions(8) == 2048
    assert initial_partitions(8000) == 64000
    before = spark.conf.get(INITIAL_PARTITIONS_KEY, None)
    set_initial_partitions(spark)
    assert spark.conf.get(INITIAL_PARTITIONS_KEY, None) == before


def test_append_positional(spark):
    """SNK3: values by position; a wrong number of columns is refused."""
    import pytest
    path = scratch_path(spark, "positional")
    rows = spark.createDataFrame([("CAR1", "Name", "Express", "North", 0.9, True)], "a string, b string, c string, d string, e double, f boolean")
    io.append_positional(rows, path, schemas.DIM_CARRIERS)
    r = spark.read.parquet(path).collect()
    assert len(r) == 1 and r[0].carrier_name == "Name" and r[0].active_flag
    with pytest.raises(ValueError):
        io.append_positional(rows.drop("f"), path, schemas.DIM_CARRIERS)


def test_binary_parser_hook(spark):
    """DOC1 for other formats: a parser over pandas frames."""
    from podlake.operators import documents as doc

    def parser(frames):
        for f in frames:
            f["text"] = f["content"].map(lambda b: bytes(b).decode()[::-1])
            yield f[["id", "text"]]

    df = spark.createDataFrame([(1, bytearray(b"abc"))], "id int, content binary")
    assert [tuple(r) for r in doc.parse_with(df, parser, "id int, text string").collect()] == [(1, "cba")]


def test_model_columns_exist_in_their_sources(spark, t_small):
    """SM1: the model is held against the real columns of its tables."""
    import pytest
    from podlake.plans.logistics_model import logistics_model
    from podlake.plans.semantic import ModelError
    model = logistics_model().check_sources(t_small)
    model.tables["ORDERS"].facts.append("no_such_column")
    with pytest.raises(ModelError):
        model.check_sources(t_small)


def test_filter_on_a_fact_column_needs_no_listing(spark, t_small):
    """SM2: the fact columns that a filter names are kept, and it runs first."""
    from pyspark.sql import functions as F
    from podlake.plans.logistics_model import logistics_model
    from podlake.plans.semantic import metric_query
    from podlake.sources import fixtures as fx
    q = metric_query(logistics_model(), t_small, ["TOTAL_SHIPMENTS"], ["carrier_name"], where=F.col("status") == "Returned")
    want = fx.fact_shipments(t_small, ["status"]).where("status = 'Returned'").count()
    assert sum(r.total_shipments for r in q.collect()) == want > 0


def test_scratch_writes_leave_no_shuffles(spark):
    """A table for the next step is packed by zstd and its write's shuffle files are gone; settings are as before."""
    import glob

    from pyspark.sql import functions as F

    from podlake import session
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    shuffles = lambda: {s for d in dirs for s in glob.glob(f"{d}/*/shuffle_*.data")}
    before, held = shuffles(), [spark.conf.get(k, None) for k in session.SCRATCH_CONF]
    made = io.materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().repartition(5, "k"), spark, "scratch-test")
    assert not shuffles() - before
    assert made.count() == 7
    assert all(f.endswith(".zstd.parquet") for f in made.inputFiles())
    assert [spark.conf.get(k, None) for k in session.SCRATCH_CONF] == held
