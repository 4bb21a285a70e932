"""Streams: incremental arrivals in k files equal the batch result; re-runs add nothing."""

import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from settings import SF_SMALL
from podlake import schemas
from podlake.operators import documents as doc
from podlake.oracle.compare import compare, duck
from podlake.session import scratch_path
from podlake.sources import fixtures as fx
from podlake.sources import io
from podlake.sources.tables import tables
from podlake.streaming import pipeline as P

import __spark_entry__ as entry


def _land(src: str, dst_dir: str, name: str, parts: int, upto: int):
    """Write the first ``upto`` of ``parts`` row slices of a driver table as files."""
    t = pq.read_table(f"{src}/{name}.parquet")
    n = t.num_rows
    os.makedirs(dst_dir, exist_ok=True)
    for i in range(upto):
        path = f"{dst_dir}/{name}-{i}.parquet"
        if not os.path.exists(path):
            pq.write_table(t.slice(i * n // parts, (i + 1) * n // parts - i * n // parts), path)


def test_chained_pipeline_incremental(spark):
    """ST1-ST4: lineitem arrives in 3 files over 3 runs; the final POD_FACT equals
    the batch extraction, and a 4th run with no new file adds no rows."""
    t = tables(spark, SF_SMALL)
    land = scratch_path(spark, "landing")
    work = scratch_path(spark, "pipeline")
    schema = t.lineitem.schema
    for upto in (1, 2, 3, 3):
        _land(SF_SMALL, land, "lineitem", 3, upto)
        li = spark.readStream.schema(schema).parquet(land)
        pods = fx.pod_fact(t, doc.POD_TEXT_INPUTS, lineitem=li)
        src = io.conform(doc.render_pod_text(pods, fx.dim_carriers(t)),
                         schemas.POD_EXTRACTED)
        _, fact = P.run_pipeline(src, work)
    out = spark.read.parquet(fact)
    cols = [c for c in entry.queries()["pod_extract_typed"](spark, SF_SMALL).columns]
    ok, msg = compare(out.select(*cols), duck(SF_SMALL), entry.oracle_sql()["pod_extract_typed"])
    assert ok, msg


def test_watch_files_registry(spark):
    """ST1: the binaryFile stream lists new files once; contents are not read."""
    land = scratch_path(spark, "files")
    os.makedirs(land)
    for i in range(3):
        with open(f"{land}/pod_{i}.pdf", "wb") as fh:
            fh.write(b"x" * (i + 1))
    with open(f"{land}/notes.txt", "w") as fh:
        fh.write("skip")
    out, chk = scratch_path(spark, "reg"), scratch_path(spark, "reg-chk")
    P.run(P.watch_files(spark, land, glob="*.pdf"), out, chk)
    P.run(P.watch_files(spark, land, glob="*.pdf"), out, chk)  # nothing new: no duplicates
    rows = spark.read.parquet(out).orderBy("file_name").collect()
    assert [r.file_name for r in rows] == ["pod_0.pdf", "pod_1.pdf", "pod_2.pdf"]
    assert [r.file_size for r in rows] == [1, 2, 3] and not any(r.processed for r in rows)


def _layouts(tmp_path):
    """The same events as one file, as 6 files in time order and as 6 shuffled ones."""
    import numpy as np
    t = pq.read_table(f"{SF_SMALL}/events.parquet")
    n = t.num_rows
    orders = {"one": (np.arange(n), 1), "ordered": (np.argsort(t["ts"].to_numpy(), kind="stable"), 6),
              "shuffled": (np.random.default_rng(0).permutation(n), 6)}
    for name, (order, parts) in orders.items():
        folder = f"{tmp_path}/{name}/events.parquet"
        os.makedirs(folder)
        for k, rows in enumerate(np.array_split(order, parts)):
            pq.write_table(t.take(rows), f"{folder}/part-{k}.parquet")
        yield f"{tmp_path}/{name}"


def test_windows_do_not_depend_on_file_layout(spark, tmp_path):
    """ST8: every event counts in its window, one file per micro-batch or not; what
    came late is reported."""
    results, late = [], {}
    for root in _layouts(tmp_path):
        w = P.windowed_counts(P.table_stream(spark, root, "events", max_files_per_trigger=1), P.workdir(spark, "win"))
        rows = w.collect()
        results.append(sorted((r.window_start, r.window_end, r.events, r.errors) for r in rows))
        late[os.path.basename(root)] = sum(r.late for r in rows)
    assert results[0] == results[1] == results[2]
    assert sum(r[2] for r in results[0]) == tables(spark, SF_SMALL).events.count()
    assert late["one"] == late["ordered"] == 0 < late["shuffled"]


def test_distinct_keys_do_not_depend_on_file_layout(spark, tmp_path):
    """ST7: the same keys as DISTINCT over the whole table."""
    want = sorted(map(tuple, tables(spark, SF_SMALL).events.select("user_id", "event_type").distinct().collect()))
    for root in _layouts(tmp_path):
        keys = P.distinct_keys(P.table_stream(spark, root, "events", max_files_per_trigger=1),
                               ["user_id", "event_type"], P.workdir(spark, "keys"))
        assert sorted(map(tuple, keys.collect())) == want


def test_single_file_tables_stream(spark):
    assert P.distinct_keys(P.table_stream(spark, SF_SMALL, "events"), ["event_type"], P.workdir(spark, "k")).count() > 0


def test_quarantined_rows_are_kept(spark, tmp_path):
    """T9: rows of the two routes add up; only good ones become facts."""
    rows = [("a.html", "/a.html", "<p>POD Reference: P1</p>"), ("b.html", "/b.html", ""), ("c.html", "/c.html", None)]
    spark.createDataFrame(rows, "file_name string, file_relative_path string, content string").write.parquet(f"{tmp_path}/in")
    feed = spark.readStream.schema("file_name string, file_relative_path string, content string").parquet(f"{tmp_path}/in")
    extracted, fact = P.run_pipeline(P.parse_stream(feed), P.workdir(spark, "quarantine"))
    routes = {r.file_name: r.route for r in spark.read.parquet(extracted).collect()}
    assert routes == {"a.html": "ok", "b.html": "quarantine", "c.html": "quarantine"}
    assert [r.pod_id for r in spark.read.parquet(fact).collect()] == ["P1"]


def test_queries_run_from_another_folder(tmp_path):
    """Workers need nothing but Spark: no dependence on the folder of the start."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (f"import sys; sys.path.insert(0, {root!r})\n"
            "from podlake.session import get_spark\nimport __spark_entry__ as e\n"
            "spark = get_spark('local[2]', shuffle_partitions=4)\n"
            f"print('ROWS', *[e.queries()[n](spark, {SF_SMALL!r}).count() for n in ('postings', 'stream_corpus')])")
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
    assert all(int(n) > 0 for n in out.stdout.split("ROWS")[1].split())


def test_idempotent_append_replaces_retried_batch(spark):
    path = scratch_path(spark, "idem")
    df = spark.range(5).withColumnRenamed("id", "v")
    P.idempotent_append(df, 0, path)
    P.idempotent_append(df, 0, path)  # retry of batch 0
    P.idempotent_append(df.limit(2), 1, path)
    assert spark.read.parquet(path).count() == 7


def test_live_index_matches_batch_index(spark):
    """SE8: the index a stream keeps over 2 arriving files (postings and lengths
    per micro-batch) scores exactly like an index built in batch over the same corpus."""
    from podlake.operators import search
    t = tables(spark, SF_SMALL)
    land = scratch_path(spark, "landing-live")
    work = scratch_path(spark, "live")
    schema = t.lineitem.schema
    for upto in (1, 2):
        _land(SF_SMALL, land, "lineitem", 2, upto)
        li = spark.readStream.schema(schema).parquet(land)
        P.refresh_corpus_stream(fx.pod_fact(t, lineitem=li), fx.dim_customers(t),
                                fx.dim_carriers(t), work)
    corpus = spark.read.parquet(f"{work}/corpus").drop("batch_id")
    q = spark.createDataFrame([(1, "damage"), (2, "missing signature")],
                              "query_id int, text string")
    live = search.search(P.live_index(spark, work), q, k=5)
    batch = search.search(search.build_index(corpus, "pod_id", "search_text"), q, k=5)
    cols = ["query_id", "rank", "id", "score"]
    assert sorted(live.select(*cols).collect()) == sorted(batch.select(*cols).collect())
    assert live.count() == 10


def test_files_registered_twice_are_processed_once(spark, tmp_path):
    """ST7 within a delay, and ST8's progress rows."""
    rows = [("a.pdf", "/a.pdf", "2024-01-01 00:00:00"), ("a.pdf", "/a.pdf", "2024-01-01 00:10:00"), ("b.pdf", "/b.pdf", "2024-01-01 00:20:00")]
    schema = "file_name string, file_relative_path string, load_ts string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/reg")
    feed = spark.readStream.schema(schema).parquet(f"{tmp_path}/reg").withColumn("load_ts", F.col("load_ts").cast("timestamp"))
    out = scratch_path(spark, "dedup-files")
    q = P.run(P.dedup_files(feed), f"{out}/o", f"{out}/c")
    assert sorted(r.file_relative_path for r in spark.read.parquet(f"{out}/o").collect()) == ["/a.pdf", "/b.pdf"]
    assert sum(r.input_rows for r in P.progress_rows(spark, q).collect()) == 3
