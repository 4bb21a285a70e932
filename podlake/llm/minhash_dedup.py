"""MinHash near-dedup (operator 8).

A document's set is its distinct five-word shingles (A-Z folded). Documents of
equal sets become one class, named by its smallest doc_id. Each class gets a
one-permutation MinHash: a shingle's hash names one of ``BANDS * ROWS`` bins and
its rank there, so one hash per shingle is enough; empty bins are filled by
optimal densification (each takes the value of a bin drawn by its own hash
sequence, the same for all documents). Bins form bands, bands form buckets.

Candidates are stars: in each bucket every class is paired with one hub, the
class whose buckets are the most populated, so a bucket of m classes gives m - 1
pairs and the same hub comes up in most bands. Every pair is confirmed on the
full sets: 100 * intersection >= similarity * union.

A star may miss a link between two classes that don't link to the hub. So, for
exactness, buckets that still hold more than one component are compared in full
in blocks of ``BLOCK`` classes: a task gets two blocks, counts all their
intersections at once and returns confirmed links only, at most one per class
and component. Nothing is capped or sampled, no pairs are emitted. Two linked
classes that share no bucket are missed; at the similarity of 85 that has a
probability of (1 - 0.85 ** 6) ** 32, about 3e-7 a pair.

Defined results: a null or blank text has the empty set, links with nothing and
is kept; a row without doc_id links with nothing, has a null component_id and is
kept; repeated rows (same doc_id and text) are one document and share its
verdict; rows that share a doc_id only are linked by their own texts; an empty
table gives an empty table. Other columns
pass through ``kept_documents``; inner names start with ``__m_``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fingerprint, in_arrow, ship, stored
from .links import components
from .tokens import column_shingles, splitmix, steps

BANDS = 32
ROWS = 6
BINS = BANDS * ROWS
SIMILARITY = 85
BLOCK = 512
#: Classes that meet their hub in one task.
STAR = 256
#: Set elements of one task's side, where sets are large.
ITEMS = 1 << 20

EDGES = (np.arange(BINS, dtype=np.float64) * (2.0 ** 64 / BINS)).astype(np.uint64)
TRIES = 256


def _draws(round_no: int) -> np.ndarray:
    """Bins that each empty bin tries in its round ``round_no``, in order."""
    seed = np.arange(BINS * TRIES, dtype=np.uint64) + np.uint64((round_no + 1) << 32)
    return (splitmix(seed) % np.uint64(BINS)).astype(np.int64).reshape(BINS, TRIES)


FIRST_DRAWS = _draws(0)


def signature(distinct: np.ndarray) -> np.ndarray:
    """One-permutation MinHash of sorted distinct hashes (one at least)."""
    at = np.searchsorted(distinct, EDGES)
    found = np.minimum(at, len(distinct) - 1)
    values = distinct[found]
    full = np.empty(BINS, dtype=bool)
    full[:-1] = (at[:-1] < len(distinct)) & (values[:-1] < EDGES[1:])
    full[-1] = at[-1] < len(distinct)
    empty, out, round_no = np.flatnonzero(~full), values.copy(), 0
    while len(empty):
        draws = (FIRST_DRAWS if not round_no else _draws(round_no))[empty]
        hit = full[draws]
        pick = hit.argmax(axis=1)
        ok = hit[np.arange(len(empty)), pick]
        out[empty[ok]] = values[draws[np.arange(len(empty)), pick][ok]]
        empty, round_no = empty[~ok], round_no + 1
    return out


def bands_of(sig: np.ndarray) -> np.ndarray:
    mixed = splitmix(sig.reshape(BANDS, ROWS) + np.arange(ROWS, dtype=np.uint64))
    weights = splitmix(np.arange(ROWS, dtype=np.uint64)) | np.uint64(1)
    return splitmix((mixed * weights).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def set_key(distinct: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set, whatever the order of its elements."""
    a = splitmix(distinct ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    b = splitmix(distinct ^ np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def _sets(column: pa.Array) -> Iterator[np.ndarray]:
    for lo, hi in steps(column):
        hashes, first = column_shingles(column.slice(lo, hi - lo))
        for i in range(hi - lo):
            yield np.unique(hashes[first[i]:first[i + 1]])


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, ka, kb, bands, at = [], [], [], [], [0]
        for s in _sets(batch.column("text")):
            n.append(len(s))
            a, b = set_key(s)
            ka.append(a)
            kb.append(b)
            if len(s):
                bands.append(bands_of(signature(s)).view(np.int64))
            at.append(at[-1] + (BANDS if len(s) else 0))
        flat = np.concatenate(bands) if bands else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("fp"), pa.array(n, pa.int64()), pa.array(ka, pa.int64()),
             pa.array(kb, pa.int64()),
             pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int64()))],
            names=["doc_id", "fp", "n", "ka", "kb", "bands"])


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, fp (of the text), n (set size), ka, kb (name of the set), bands (bucket ids)."""
    rows = docs.select(F.col("doc_id").cast("long"), "text", fingerprint(F.col("text")).alias("fp"))
    return in_arrow(rows, _signatures, "doc_id long, fp long, n long, ka long, kb long, bands array<long>")


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("text")
        wanted = batch.column("ka").to_numpy()
        nodes = batch.column("node").to_numpy()
        keep, sets = [], []
        for i, s in enumerate(_sets(column)):
            if set_key(s)[0] == wanted[i]:
                keep.append(i)
                sets.append(s.astype("<u8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(nodes[keep], pa.int64()), pa.array(sets, pa.binary())],
                                         names=["node", "items"])


def linked(left: list[np.ndarray], right: list[np.ndarray], similarity: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sets that link. Common items are counted as a product of
    incidence matrices, over a bounded number of distinct items at a time."""
    la, lb = np.array([len(s) for s in left]), np.array([len(s) for s in right])
    rows_a, rows_b = np.repeat(np.arange(len(left)), la), np.repeat(np.arange(len(right)), lb)
    items_a, items_b = np.concatenate(left), np.concatenate(right)
    common = np.intersect1d(items_a, items_b)
    both = np.zeros((len(left), len(right)), np.float32)
    at_a, at_b = np.searchsorted(common, items_a), np.searchsorted(common, items_b)
    if len(common):
        in_a = common[np.minimum(at_a, len(common) - 1)] == items_a
        in_b = common[np.minimum(at_b, len(common) - 1)] == items_b
        rows_a, at_a, rows_b, at_b = rows_a[in_a], at_a[in_a], rows_b[in_b], at_b[in_b]
        for lo in range(0, len(common), 4096):
            size = min(4096, len(common) - lo)
            pick_a, pick_b = (at_a >= lo) & (at_a < lo + size), (at_b >= lo) & (at_b < lo + size)
            ma, mb = np.zeros((len(left), size), np.float32), np.zeros((len(right), size), np.float32)
            ma[rows_a[pick_a], at_a[pick_a] - lo] = 1
            mb[rows_b[pick_b], at_b[pick_b] - lo] = 1
            both += ma @ mb.T
    both = both.astype(np.int64)
    union = la[:, None] + lb[None, :] - both
    return np.nonzero(100 * both >= similarity * union)


def _confirm(similarity: int):
    """Per task (unit): rows of side 0 against rows of side 1; returns confirmed
    links between different components, one per row and component of the other
    side (a link more between the same two adds nothing)."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        side = rows["side"].to_numpy()
        nodes, comps = rows["node"].to_numpy(), rows["component"].to_numpy()
        sets = [np.frombuffer(x, dtype="<u8") for x in rows["items"]]
        ia = np.flatnonzero(side == 0)
        ib = np.flatnonzero(side == 1)
        if not len(ib):  # a block against itself
            ib = ia
        if not len(ia):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        x, y = linked([sets[i] for i in ia], [sets[i] for i in ib], similarity)
        found = pd.DataFrame({"a": nodes[ia[x]], "b": nodes[ib[y]], "ca": comps[ia[x]], "cb": comps[ib[y]]})
        found = found[found["ca"] != found["cb"]]
        return found.drop_duplicates(["a", "cb"])[["a", "b"]].astype("int64")

    return run


def _parts(most: int):
    """Parts that hold about ``most`` classes and ITEMS set elements each."""
    return F.ceil(F.greatest(F.count(F.lit(1)) / most, F.sum("n") / ITEMS)).cast("int")


def star_rows(members: DataFrame) -> DataFrame:
    """(unit, side, node) of all stars: the hub (side 0) and up to about STAR of
    its spokes (side 1) per unit."""
    central = members.groupBy("node").agg(F.sum("size").alias("crowd"))
    hubs = (members.join(central, "node").groupBy("bucket")
            .agg(F.min(F.struct(-F.col("crowd"), "node"))["node"].alias("hub")))
    spokes = stored(members.join(hubs, "bucket").where("node <> hub")
                    .select("hub", "node", "n").distinct(), "minhash-stars")
    fan = spokes.groupBy("hub").agg(_parts(STAR).alias("units"))
    unit = F.struct("hub", "part").alias("unit")
    tips = (spokes.join(fan, "hub")
            .withColumn("part", F.pmod(F.xxhash64("node"), F.col("units")).cast("int"))
            .select(unit, F.lit(1).alias("side"), "node"))
    middles = (fan.select("hub", F.explode(F.sequence(F.lit(0), F.col("units") - 1)).alias("part"))
               .select(unit, F.lit(0).alias("side"), F.col("hub").alias("node")))
    return tips.unionByName(middles)


def block_rows(members: DataFrame) -> DataFrame:
    """(unit, side, node) of all pairs of blocks of buckets that hold more than
    one component: blocks i <= j of a bucket are one unit."""
    mixed = (members.groupBy("bucket")
             .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), _parts(BLOCK).alias("blocks"))
             .where("lo <> hi"))
    own = members.join(mixed, "bucket").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    spread = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return spread.select(
        F.struct("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).alias("unit"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "node")


def confirmed(units: DataFrame, sets: DataFrame, labels: DataFrame, similarity: int) -> DataFrame:
    rows = units.join(sets, "node").join(labels, "node").select("unit", "side", "node", "component", "items")
    ship(rows.sparkSession)
    return rows.groupBy("unit").applyInPandas(_confirm(similarity), "a long, b long")


def classes(docs: DataFrame, similarity: int = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(signatures, components): all documents with n, ka, kb; and (node,
    component) of the classes that link with another one."""
    sigs = stored(signatures(docs), "minhash-signatures")
    reps = stored(sigs.where("n > 0 AND doc_id IS NOT NULL").groupBy("ka", "kb", "n")
                  .agg(F.min("doc_id").alias("node"), F.min("bands").alias("bands")), "minhash-classes")
    buckets = reps.select("node", "ka", "n", F.explode("bands").alias("bucket"))
    crowded = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = stored(buckets.join(crowded, "bucket"), "minhash-buckets")
    wanted = members.select("node", "ka").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text")
    sets = stored(texts.join(wanted.hint("shuffle_hash"), "node")
                  .transform(in_arrow, _set_rows, "node long, items binary"), "minhash-sets")
    alone = members.select("node", F.col("node").alias("component")).distinct()
    edges = stored(confirmed(star_rows(members), sets, alone, similarity), "minhash-links")
    found = components(edges)
    labels = stored(alone.select("node").join(found, "node", "left")
                    .select("node", F.coalesce("component", "node").alias("component")), "minhash-labels")
    more = confirmed(block_rows(members.join(labels, "node")), sets, labels, similarity)
    more = stored(more.distinct(), "minhash-links")
    if not more.isEmpty():
        found = components(edges.unionByName(more))
    return sigs, found


def near_duplicates(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """The operator: doc_id, n_shingles, ka, kb (name of the set), component_id,
    kept, fp (tells rows that share a doc_id apart); one row per row of ``docs`` (which needs doc_id and text)."""
    sigs, found = classes(docs, similarity)
    reps = (sigs.where("n > 0 AND doc_id IS NOT NULL").groupBy("ka", "kb", "n")
            .agg(F.min("doc_id").alias("node")))
    named = reps.join(found, "node", "left").select(
        "ka", "kb", "n", F.coalesce("component", "node").alias("component"))
    out = sigs.join(named, ["ka", "kb", "n"], "left")
    own = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    own = F.when(F.col("doc_id").isNotNull(), own)
    return out.select("doc_id", F.col("n").alias("n_shingles"), "ka", "kb", own.alias("component_id"),
                      F.col("doc_id").eqNullSafe(own).alias("kept"), "fp")


def kept_documents(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Rows and columns of ``docs``: one document of each component stays. Verdicts are
    per row, so of rows that share a doc_id only those go whose own text is a copy."""
    gone = near_duplicates(docs, similarity).where("NOT kept").select(F.col("doc_id").alias("__m_id"), F.col("fp").alias("__m_fp")).distinct()
    same = (docs["doc_id"].cast("long") == gone["__m_id"]) & (fingerprint(docs["text"]) == gone["__m_fp"])
    return docs.join(gone.hint("shuffle_hash"), same, "left_anti")


def op8_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")
