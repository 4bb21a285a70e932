import base64
import gzip
import hashlib
import random

from samples import SF
from podlake.llm import warc_index as w
from podlake.session import scratch_path

PAGE = "page_id long, url string, captured string, payload string, archive string, sha string"
DAY = "2024-01-01T00:00:00Z"


def index(spark, rows, **limits):
    path = scratch_path(spark, "warc-test")
    w.write_archives(spark.createDataFrame(rows, PAGE), path)
    return path, w.merged_index(w.read_archives(spark, path)).collect()


def pages(n, seed=0):
    r = random.Random(seed)
    return [(i, f"http://www.host{r.randrange(5)}.example.com/p/{r.randrange(20)}?q={r.randrange(3)}#f", DAY,
             r.choice(["same", "other", f"own {i} é🙂\r\n\r\nWARC/1.1\r\n"]), "a", "s") for i in range(n)]


def check(rows, got):
    owner = {}
    for i, _, _, p, *_ in rows:
        k = p or ""
        if k not in owner or (owner[k] is None) or (i is not None and i > owner[k]):
            owner[k] = i
    want = []
    for i, u, c, p, *_ in rows:
        data = (p or "").encode()
        mine = owner[p or ""]
        kind = "response" if i == mine else "revisit"
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), kind,
                     mine if kind == "revisit" else None, w.url_key(w.safe_url(u or "")), c))
    have = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["url_key"],
             r["captured"]) for r in got]
    assert sorted(map(str, have)) == sorted(map(str, want))
    placed = sorted(got, key=lambda r: (r["range_no"], r["position"]))
    keys = [(r["url_key"], r["captured"], r["page_id"] is not None, r["page_id"] or 0) for r in placed]
    assert keys == sorted(keys)


def test_round_trip_and_order(spark, monkeypatch):
    monkeypatch.setattr(w, "RANGE_ROWS", 40)
    rows = pages(200)
    _, got = index(spark, rows)
    check(rows, got)
    assert len({r["range_no"] for r in got}) > 1


def test_archives_are_gzip_members(spark):
    rows = pages(30, 1)
    path, got = index(spark, rows)
    files = {r["path"].split("archive=")[1].split("/")[0]: r["content"] for r in
             spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).collect()}
    for r in got:
        part = bytes(files[r["archive"]])[r["record_offset"]:r["record_offset"] + r["record_length"]]
        record = gzip.decompress(part)
        assert record.startswith(b"WARC/1.1\r\nWARC-Type: " + r["record_type"].encode())
        assert f"urn:page:{r['page_id']}>".encode() in record
    for data in files.values():
        assert gzip.decompress(bytes(data)).count(b"WARC/1.1\r\nWARC-Type") >= 1


def test_long_records_span_members(monkeypatch):
    monkeypatch.setattr(w, "MEMBER_BYTES", 100)
    payload = b"".join(b"%d," % i for i in range(500))
    data = w.members(w.record(1, "http://a/", DAY, payload, 1, False)) + w.members(
        w.record(2, "http://b/", DAY, payload, 1, True))
    assert data[-1] == 0
    found = list(w.read_records(data))
    assert [x[4] for x in found] == [payload, b""] and found[1][0] == found[0][1]
    assert found[1][3]["Content-Length"] == str(len(payload))


def test_edges(spark):
    rows = [(1, None, DAY, None, "a", "s"), (2, "", DAY, "", "a", "s"), (None, "http://x/ y\n", DAY, "p", "a", "s"),
            (None, "http://x/", DAY, "p", "a", "s"), (3, "no scheme", DAY, "L" * 1_000_000, "a", "s"),
            (4, "http://H.com:80/A#f", DAY, "dup", "a", "s"), (4, "http://H.com:80/A#f", DAY, "dup", "a", "s")]
    _, got = index(spark, rows)
    check(rows, got)


def test_minimum_size_of_revisits(spark):
    path = scratch_path(spark, "warc-test")
    rows = [(1, "http://a/", DAY, "tiny", "a", "s"), (2, "http://a/", DAY, "tiny", "a", "s"),
            (3, "http://a/", DAY, "long enough", "a", "s"), (4, "http://a/", DAY, "long enough", "a", "s")]
    w.write_archives(spark.createDataFrame(rows, PAGE), path, min_revisit_bytes=5)
    kinds = {r["page_id"]: r["record_type"] for r in w.read_archives(spark, path).collect()}
    assert kinds == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_loser_tree():
    for seed in range(50):
        r = random.Random(seed)
        runs = [sorted(r.randrange(30) for _ in range(r.randrange(0, 12))) for _ in range(r.randrange(0, 9))]
        assert list(w.LoserTree(runs, lambda x: x)) == sorted(x for run in runs for x in run)
        flat = [x for run in runs for x in run]
        assert sorted(x for run in w.ascending_runs(flat, lambda x: x) for x in run) == sorted(flat)


def test_url_keys():
    assert w.url_key("https://www2.B.example.com:443/P?x=1#f") == "com,example,b)/p?x=1"
    assert w.url_key("http://u:p@host") == "host)/"
    assert w.url_key("mailto:x") == "mailto:x"


def test_query_on_tables(spark, tmp_path):
    got = w.op2_warc_index(spark, SF).collect()
    rows = [(r["page_id"], r["url"], None, r["html"], 0, 0) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert len(got) == len(rows)
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert w.op2_warc_index(spark, str(tmp_path)).collect() == []
