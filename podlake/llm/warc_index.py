"""WARC archives and a globally ordered capture index (operator 2).

Pages become WARC/1.1 records, one gzip member each, in archives of about
``ARCHIVE_BYTES``. Of pages with equal payloads the one with the largest page_id
is stored as response, the others as revisit records that refer to it. The
archives are read back record by record; each gives a run of index entries,
sorted by URL key (host labels reversed, then path) and capture time, as long as
the archive is. Runs are dealt out by ranges of (URL key, time, page_id, place),
so a URL with a third of all captures spreads over ranges, and in each range the
sorted pieces are merged by a loser tree into one ordered history. The order of
all captures is (range_no, position).

Scale: a task holds one archive or one range; ranges are as many as keep about
``RANGE_ROWS`` entries in each. Spark reads and writes every file, so the folder
may be in any store that Spark knows: a text writer puts bytes as they are, and
the zero byte that ends each gzip member (the high byte of its length, which is
under 16 MB) is the writer's line separator.

Defined results: a null payload is empty; a null url is the empty one; a null
page_id stays null and sorts before all others, both in the index and when the
response is chosen (rows with equal payload and the same largest page_id are all
responses); control characters and spaces in a url are percent-encoded; an empty
table gives no archive and no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import in_arrow, stored

ARCHIVE_BYTES = 16 << 20
MEMBER_BYTES = 8 << 20  # uncompressed bytes of a gzip member, under 16 MB
RANGE_ROWS = 100_000
MIN_REVISIT_BYTES = 0
OUT_BYTES = 4 << 20

ENTRY = ("url_key string, captured string, page_id long, archive string, record_offset long, "
         "record_length long, payload_bytes long, payload_digest string, record_type string, refers_to long")
ENTRY_NAMES = [c.split()[0] for c in ENTRY.split(", ")]


# --- records ---------------------------------------------------------------

def safe_url(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def url_key(url: str) -> str:
    """Host labels reversed, then path and query, in lower case; no scheme, user,
    default port, leading www or fragment."""
    m = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^#]*)", url)
    if not m:
        return url.partition("#")[0].lower()
    host = m[1].rpartition("@")[2].lower()
    host = re.sub(r"^www\d*\.", "", re.sub(r":(80|443)?$", "", host))
    return ",".join(reversed(host.split("."))) + ")" + (m[2].lower() or "/")


def record(page_id: int | None, url: str, captured: str, payload: bytes, owner: int | None, revisit: bool) -> bytes:
    name = "" if page_id is None else str(page_id)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {captured}",
            f"WARC-Target-URI: {safe_url(url)}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{owner}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def members(data: bytes) -> bytes:
    """``data`` as gzip members of at most MEMBER_BYTES each; ends with a zero."""
    out = []
    for at in range(0, len(data), MEMBER_BYTES):
        z = zlib.compressobj(3, zlib.DEFLATED, 31)
        out.append(z.compress(data[at:at + MEMBER_BYTES]) + z.flush())
    return b"".join(out)


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, archive, size = TaskContext.get().partitionId(), 0, 0
    names, rows, held = [], [], 0

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(rows, pa.binary())],
                                          names=["archive", "record"])

    for batch in batches:
        for r in batch.to_pylist():
            owner = r["owner"]
            revisit = owner is not None and r["page_id"] != owner
            data = members(record(r["page_id"], r["url"], r["captured"], r["payload"].encode(), owner, revisit))
            if size and size + len(data) > ARCHIVE_BYTES:
                archive, size = archive + 1, 0
            size += len(data)
            names.append(f"w{task:06d}-{archive:05d}")
            rows.append(data[:-1])  # its last byte, zero, is the line separator
            held += len(data)
            if held > OUT_BYTES:
                yield flush()
                names, rows, held = [], [], 0
    if rows:
        yield flush()


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write ``pages`` (page_id, url, captured, payload) as archives under ``path``."""
    p = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), "captured",
                     F.coalesce("payload", F.lit("")).alias("payload"))
    p = p.withColumn("sha", F.unhex(F.sha1("payload")))
    owners = (p.where(F.octet_length("payload") >= min_revisit_bytes)
              .groupBy("sha").agg(F.max("page_id").alias("owner")))
    told = p.join(owners.hint("shuffle_hash"), "sha", "left").drop("sha")
    records = told.transform(in_arrow, _write, "archive string, record binary")
    (records.select("archive", F.col("record").cast("string").alias("value"))
     .write.partitionBy("archive").option("lineSep", "\x00").text(path))


# --- reading back ------------------------------------------------------------

def _unzipped(data: memoryview) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of every gzip member."""
    at, step = 0, 1 << 16
    while at < len(data):
        z, parts, fed = zlib.decompressobj(31), [], at
        while not z.eof:
            if fed >= len(data):
                raise ValueError("archive ends inside a record")
            parts.append(z.decompress(data[fed:fed + step]))
            fed += step
        end = min(fed, len(data)) - len(z.unused_data)
        yield at, end - at, b"".join(parts)
        at = end


def _headers(block: bytes) -> tuple[dict[str, str], int]:
    end = block.index(b"\r\n\r\n")
    lines = block[:end].decode().split("\r\n")[1:]
    return {k: v for k, _, v in (x.partition(": ") for x in lines)}, end + 4


def read_records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], dict[str, str], bytes]]:
    """(offset, length, WARC headers, HTTP headers, payload) of every record."""
    start, size, content = 0, 0, b""
    for at, length, part in _unzipped(memoryview(data)):
        if not content:
            start, size = at, 0
        content, size = content + part if content else part, size + length
        head, body = _headers(content) if b"\r\n\r\n" in content else ({}, 0)
        want = body + int(head.get("Content-Length", -1)) + 4
        if not head or len(content) < want:
            continue  # a record of several members
        http, cut = _headers(content[body:])
        yield start, size, head, http, content[body + cut:want - 4]
        content = b""


def _page(name: str) -> int | None:
    value = name.removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value else None


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted run of each archive."""
    for batch in batches:
        for i in range(batch.num_rows):
            archive, rows = batch.column("archive")[i].as_py(), []
            for offset, length, head, http, payload in read_records(batch.column("content")[i].as_buffer()):
                revisit = head["WARC-Type"] == "revisit"
                digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                if not revisit and digest != base64.b32encode(hashlib.sha1(payload).digest()).decode():
                    raise ValueError(f"payload of {head['WARC-Record-ID']} differs from its digest")
                rows.append((url_key(head["WARC-Target-URI"]), head["WARC-Date"], _page(head["WARC-Record-ID"]),
                             archive, offset, length, int(http["Content-Length"]), digest, head["WARC-Type"],
                             _page(head["WARC-Refers-To"]) if revisit else None))
            rows.sort(key=_order)
            yield _batch(rows)


def _order(r: tuple) -> tuple:
    return r[0], r[1], r[2] is not None, r[2] or 0, r[3], r[4]


def _batch(rows: list[tuple], more: tuple = ()) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 3, pa.string(), pa.string(), pa.int64()]
    cols = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
    return pa.RecordBatch.from_arrays(cols + list(more), names=ENTRY_NAMES + ["range_no", "position"][:len(more)])


def read_archives(spark, path: str) -> DataFrame:
    """Index entries of all archives, one sorted run per archive."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    name = F.regexp_extract("path", r"archive=([^/]+)/[^/]*$", 1)
    return files.select(name.alias("archive"), "content").transform(in_arrow, _entries, ENTRY)


# --- merging ---------------------------------------------------------------

class LoserTree:
    """k-way merge: a tournament whose inner nodes keep the loser; after the
    winner's run moves on, only the path from its leaf to the root is replayed."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key, self.k = runs, key, len(runs)
        self.at = [0] * self.k
        self.keys = [key(r[0]) if r else None for r in runs]
        self.losers = [-1] * max(1, self.k)
        for leaf in range(self.k - 1, -1, -1):
            self._enter(leaf)

    def _before(self, a: int, b: int) -> bool:
        ka, kb = self.keys[a], self.keys[b]
        if ka is None or kb is None:
            return kb is None and ka is not None
        return ka < kb

    def _enter(self, leaf: int) -> None:
        """First round: wait at the first empty node, or go on as the winner."""
        node, win = (leaf + self.k) // 2, leaf
        while node:
            if self.losers[node] < 0:
                self.losers[node] = win
                return
            if self._before(self.losers[node], win):
                win, self.losers[node] = self.losers[node], win
            node //= 2
        self.losers[0] = win

    def __iter__(self):
        while self.k:
            win = self.losers[0]
            if self.keys[win] is None:
                return
            run = self.runs[win]
            yield run[self.at[win]]
            self.at[win] += 1
            self.keys[win] = self.key(run[self.at[win]]) if self.at[win] < len(run) else None
            node = (win + self.k) // 2
            while node:
                if self._before(self.losers[node], win):
                    win, self.losers[node] = self.losers[node], win
                node //= 2
            self.losers[0] = win


def ascending_runs(rows: list, key) -> list[list]:
    """``rows`` cut wherever the order falls: the sorted pieces they came in."""
    runs: list[list] = []
    last = None
    for r in rows:
        k = key(r)
        if last is None or k < last:
            runs.append([])
        runs[-1].append(r)
        last = k
    return runs


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, rows = TaskContext.get().partitionId(), []
    for batch in batches:
        rows += zip(*[batch.column(c).to_pylist() for c in ENTRY_NAMES], strict=True)
    merged = list(LoserTree(ascending_runs(rows, _order), _order))
    for at in range(0, len(merged), 10_000):
        part = merged[at:at + 10_000]
        yield _batch(part, (pa.array([task] * len(part), pa.int32()),
                            pa.array(range(at, at + len(part)), pa.int64())))


def merged_index(runs: DataFrame) -> DataFrame:
    """The operator: all entries of ``runs`` (a written table) plus range_no and
    position; (range_no, position) is their global order."""
    ranges = max(1, -(-runs.count() // RANGE_ROWS))
    dealt = runs.repartitionByRange(ranges, F.col("url_key"), F.col("captured"),
                                    F.col("page_id").asc_nulls_first(), F.col("archive"), F.col("record_offset"))
    return dealt.transform(in_arrow, _merge, ENTRY + ", range_no int, position long")


def op2_warc_index(spark, sf_dir: str) -> DataFrame:
    """The pages table has no capture time; one is derived from page_id."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    seconds = F.lit(1704067200) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(100_000_000))
    captured = F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    path = scratch_path(spark, "warc")
    write_archives(pages.select("page_id", "url", captured.alias("captured"), F.col("html").alias("payload")), path)
    if pages.isEmpty():
        return spark.createDataFrame([], ENTRY + ", range_no int, position long")
    out = merged_index(stored(read_archives(spark, path), "warc-runs"))
    first = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return out.select(*first, *[c for c in out.columns if c not in first])
