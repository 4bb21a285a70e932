"""Quality rules (operator 10): fixed rules, then robust multivariate outliers.

Every document gets statistics of its whole text. Documents that fail a fixed
rule go at once. The others become a vector of four transformed statistics, and
per language and source a minimum-covariance-determinant (MCD) estimate of
centre and covariance is made by concentration steps: start from medians and
median deviations, take the ``SUPPORT`` share of vectors with the smallest
Mahalanobis distances, estimate again from those, repeat ``STEPS`` times. A
document is rejected when its squared distance exceeds ``CUTOFF``.

Scale: the text is read once and reduced to a few numbers a document. A step is
one sum of products per group (partial aggregates, so a group with a third of
all documents costs no more than others) and one histogram of binned distances
per group for the threshold. Sums are exact decimals of fixed-point values and
thresholds come from counts, so results don't depend on partitioning. Groups of
fewer than ``MIN_GROUP`` documents use the estimate of their language, then of
the whole table; below that nothing is rejected.

All steps are built-in functions. Defined results: null or blank texts have no
words and fail the base rule; a null language or source counts as the empty
string; repeated rows are judged alike; an empty table gives an empty table.
Other columns pass through; inner names start with ``__q_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fingerprint, stored, words_of

MIN_WORDS = 20
REPEAT_WINDOW = 8
SUPPORT = 0.75
STEPS = 4
MIN_GROUP = 50
CUTOFF = 60.0
#: Smoothing: words added to a text's count before ratios are taken, so that
#: short texts vary no more than long ones.
SMOOTH = 50
#: Standard deviation added to each statistic's own (mean word length as log;
#: square roots of symbols per word, of repeated words, of repeated lines).
FLOORS = (0.06, 0.06, 0.12, 0.12)
SCALE = 1000
#: Shares that a group's vectors are split into for joins with its model.
SALTS = 64
DIMS = len(FLOORS)
CHI2_MEDIAN = 3.357  # median of chi squared with four degrees of freedom


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` plus __q_n_words, __q_word_chars, __q_n_symbols, __q_n_dup_lines,
    __q_n_repeat_words, __q_lines (lines with a word), __q_base_failed."""
    text = F.coalesce("text", F.lit(""))
    d = docs.withColumn("__q_w", words_of(F.col("text")))
    d = d.withColumn("__q_n_words", F.size("__q_w").cast("long"))
    k = REPEAT_WINDOW
    d = d.withColumn("__q_h", F.when(F.col("__q_n_words") >= k, F.transform(
        F.sequence(F.lit(1), F.col("__q_n_words").cast("int") - (k - 1)),
        lambda i: F.xxhash64(F.slice("__q_w", i, F.lit(k))))))
    # Only texts that hold an equal pair of windows pay for the sort.
    d = d.withColumn("__q_s", F.when(
        F.size(F.array_distinct("__q_h")) < F.size("__q_h"),
        F.array_sort(F.transform("__q_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col("__q_s")
    twice = F.filter(s, lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]))
    d = d.withColumn("__q_p", F.array_sort(F.transform(twice, lambda x: x["i"])))
    covered = F.transform("__q_p", lambda p, j: F.least(
        F.lit(k), F.coalesce(F.get("__q_p", j + 1) - p, F.lit(k))))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    d = d.withColumns({
        "__q_word_chars": (F.char_length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]"))).cast("long"),
        "__q_n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
        "__q_l": lines,
        "__q_n_repeat_words": F.coalesce(
            F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long"),
    })
    d = d.withColumns({
        "__q_lines": F.size("__q_l").cast("long"),
        "__q_n_dup_lines": (F.size("__q_l") - F.size(F.array_distinct("__q_l"))).cast("long")})
    failed = ((F.col("__q_n_words") < MIN_WORDS)
              | (100 * F.col("__q_n_repeat_words") > 30 * F.col("__q_n_words")))
    return (d.withColumn("__q_base_failed", failed)
            .drop("__q_w", "__q_h", "__q_s", "__q_p", "__q_l"))


def vector() -> list[Column]:
    """The transformed statistics, as fixed-point whole numbers."""
    n = F.col("__q_n_words") + SMOOTH
    parts = (
        F.log((F.col("__q_word_chars") + 5 * SMOOTH) / n),
        F.sqrt(F.col("__q_n_symbols") / n),
        F.sqrt(F.col("__q_n_repeat_words") / n),
        F.sqrt(F.col("__q_n_dup_lines") / (F.col("__q_lines") + 5)),
    )
    return [F.round(p * SCALE).cast("long").alias(f"x{j}") for j, p in enumerate(parts)]


def levels(vectors: DataFrame) -> DataFrame:
    """Each vector once per level (its language and source, its language, all)
    with a salt that splits its group."""
    key = F.array(F.struct(F.lit(0).alias("level"), "lang", "source"),
                  F.struct(F.lit(1).alias("level"), "lang", F.lit("").alias("source")),
                  F.struct(F.lit(2).alias("level"), F.lit("").alias("lang"), F.lit("").alias("source")))
    return vectors.select(F.explode(key).alias("g"), "salt", *[f"x{j}" for j in range(DIMS)])


def joined(rows: DataFrame, few: DataFrame) -> DataFrame:
    """``rows`` with the one row that ``few`` has for their group. The small side
    is repeated for every salt, so a group with most of the rows is split."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    return rows.join(few.select("*", salts), ["g", "salt"])


def quantile(rows: DataFrame, value: str, share: float, name: str) -> DataFrame:
    """Per group the smallest value that at least ``share`` of the rows don't
    exceed: exact, from counts per distinct value."""
    counts = rows.groupBy("g", value).agg(F.count(F.lit(1)).alias("c"))
    up = W.partitionBy("g").orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    total = W.partitionBy("g")
    return (counts.withColumns({"upto": F.sum("c").over(up), "n": F.sum("c").over(total)})
            .where(F.col("upto") >= share * F.col("n"))
            .groupBy("g").agg(F.min(value).alias(name)))


def distance(x: list[Column], m: list[Column], chol: dict) -> Column:
    """Squared Mahalanobis distance: forward substitution with the Cholesky factor."""
    y: list[Column] = []
    for i in range(DIMS):
        r = x[i] - m[i]
        for j in range(i):
            r = r - chol[i, j] * y[j]
        y.append(r / chol[i, i])
    total = y[0] * y[0]
    for v in y[1:]:
        total = total + v * v
    return total


def factor(estimate: DataFrame) -> DataFrame:
    """Adds the Cholesky factor l{i}{j} of the covariance c{i}{j}."""
    for i in range(DIMS):
        for j in range(i + 1):
            v = F.col(f"c{i}{j}")
            for k in range(j):
                v = v - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            v = F.sqrt(F.greatest(v, F.lit(1e-9))) if i == j else v / F.col(f"l{j}{j}")
            estimate = estimate.withColumn(f"l{i}{j}", v)
    return estimate


MODEL = ["g"] + [f"m{j}" for j in range(DIMS)] + [f"l{i}{j}" for i in range(DIMS) for j in range(i + 1)]


def measured(rows: DataFrame, model: DataFrame) -> DataFrame:
    """Rows of groups with a model, plus their squared distance d2."""
    d2 = distance([F.col(f"x{j}") / SCALE for j in range(DIMS)], [F.col(f"m{j}") for j in range(DIMS)],
                  {(i, j): F.col(f"l{i}{j}") for i in range(DIMS) for j in range(i + 1)})
    return joined(rows, model).withColumn("d2", d2)


def start(rows: DataFrame) -> DataFrame:
    """Coordinate-wise medians and median absolute deviations, no correlation."""
    out = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_GROUP)
    for j in range(DIMS):
        med = quantile(rows, f"x{j}", 0.5, f"med{j}")
        off = joined(rows, med).select("g", F.abs(F.col(f"x{j}") - F.col(f"med{j}")).alias("off"))
        out = out.join(med, "g").join(quantile(off, "off", 0.5, f"mad{j}"), "g")
    cols = {f"m{j}": F.col(f"med{j}") / SCALE for j in range(DIMS)}
    for i in range(DIMS):
        for j in range(i + 1):
            cols[f"c{i}{j}"] = (F.pow(1.4826 * F.col(f"mad{j}") / SCALE, F.lit(2)) + FLOORS[j] ** 2
                                if i == j else F.lit(0.0))
    return factor(out.withColumns(cols)).select(*MODEL)


def concentrated(rows: DataFrame, model: DataFrame) -> DataFrame:
    """One concentration step: the model of the SUPPORT share nearest to ``model``,
    widened so that the median distance is that of a normal sample."""
    binned = measured(rows, model).withColumn("bin", F.floor(F.log1p("d2") * 1000))
    near = joined(binned, quantile(binned, "bin", SUPPORT, "limit")).where("bin <= limit")
    exact = [F.sum(F.col(f"x{j}").cast("decimal(20,0)")).alias(f"s{j}") for j in range(DIMS)]
    exact += [F.sum((F.col(f"x{i}") * F.col(f"x{j}")).cast("decimal(20,0)")).alias(f"s{i}{j}")
              for i in range(DIMS) for j in range(i + 1)]
    sums = near.groupBy("g").agg(F.count(F.lit(1)).alias("n"), *exact)
    mean = {j: F.col(f"s{j}").cast("double") / F.col("n") / SCALE for j in range(DIMS)}
    cols = {f"m{j}": mean[j] for j in range(DIMS)}
    widen = F.greatest(F.lit(1.0), F.expm1(F.col("mid") / 1000) / CHI2_MEDIAN)
    for i in range(DIMS):
        for j in range(i + 1):
            c = F.col(f"s{i}{j}").cast("double") / F.col("n") / SCALE ** 2 - mean[i] * mean[j]
            cols[f"c{i}{j}"] = c * widen + (FLOORS[i] ** 2 if i == j else 0.0)
    return factor(sums.join(quantile(binned, "bin", 0.5, "mid"), "g").withColumns(cols)).select(*MODEL)


def estimates(vectors: DataFrame) -> DataFrame:
    """The MCD model of every group on every level that has enough documents."""
    rows = stored(levels(vectors), "quality-levels")
    model = stored(start(rows), "quality-model")
    for _ in range(STEPS):
        model = stored(concentrated(rows, model), "quality-model")
    return model


def judged(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """The operator: one row per document with doc_id, __q_fp (tells rows that
    share a doc_id apart), its statistics, __q_d2 (null where no group is large
    enough or the base rule failed) and __q_kept."""
    few = with_statistics(docs.select("doc_id", "text", "lang", "source"))
    few = few.withColumns({"__q_fp": fingerprint(F.col("text")), "lang": F.coalesce("lang", F.lit("")),
                           "source": F.coalesce("source", F.lit(""))}).drop("text")
    stats = stored(few, "quality-statistics")
    vectors = stats.select("*", *vector())
    model = estimates(vectors.where(~F.col("__q_base_failed")).select(
        "lang", "source", F.pmod("__q_fp", F.lit(SALTS)).cast("int").alias("salt"), *[f"x{j}" for j in range(DIMS)]))
    model = model.select(F.struct(*[F.col(c) for c in MODEL[1:]]).alias("model"), "g.*")
    own = model.where("level = 0").select("lang", "source", F.col("model").alias("own"))
    tongue = model.where("level = 1").select("lang", F.col("model").alias("tongue"))
    whole = model.where("level = 2").agg(F.first("model").alias("whole"))
    best = vectors.join(own, ["lang", "source"], "left").join(tongue, "lang", "left").join(
        whole, how="left").withColumn("model", F.coalesce("own", "tongue", "whole"))
    d2 = distance([F.col(f"x{j}") / SCALE for j in range(DIMS)],
                  [F.col(f"model.m{j}") for j in range(DIMS)],
                  {(i, j): F.col(f"model.l{i}{j}") for i in range(DIMS) for j in range(i + 1)})
    best = best.withColumn("__q_d2", F.when(~F.col("__q_base_failed"), d2))
    return best.withColumn("__q_kept", ~F.col("__q_base_failed")
                           & F.coalesce(F.col("__q_d2") <= cutoff, F.lit(True))).drop(
        "own", "tongue", "whole", "model", *[f"x{j}" for j in range(DIMS)])


def kept_documents(docs: DataFrame) -> DataFrame:
    """Rows and columns of ``docs`` that the rules keep."""
    gone = judged(docs).where(~F.col("__q_kept")).select(
        F.col("doc_id").alias("__q_id"), F.col("__q_fp").alias("__q_fp2")).distinct()
    left = docs.withColumn("__q_fp", fingerprint(F.col("text")))
    on = left["doc_id"].eqNullSafe(gone["__q_id"]) & (left["__q_fp"] == gone["__q_fp2"])
    return left.join(gone.hint("shuffle_hash"), on, "left_anti").select(*docs.columns)


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged(docs).select("doc_id", *[F.col(f"__q_{c}").alias(c) for c in names],
                               F.round("__q_d2", 4).alias("distance"))
