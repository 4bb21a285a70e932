import hashlib
import re

from samples import DOC_SCHEMA, doc, prose
from podlake.llm import line_dedup


def fold(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def brute(rows):
    """(doc_id, text) -> (lines, dropped, kept text)."""
    def key(line):
        return fold(line.strip(" \t\n\x0b\x0c\r"))
    rank = lambda i: (i is None, i)
    first = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = key(line)
            if len(k) >= 10 and (k not in first or rank(i) < rank(first[k])):
                first[k] = i
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or first[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def result(df):
    got = line_dedup.dedup_lines(df)
    return sorted(((r["doc_id"], len((r["text"] or "").split("\n")), r["__ld_n_dropped"], r["__ld_kept"])
                   for r in got.collect()), key=str)


def test_matches_brute_force(spark):
    shared = [prose(s, 5) for s in range(6)]
    rows = [(i, "\n".join([shared[i % 6], prose(100 + i, 4), "short", f"  {shared[(i * 5) % 6].upper()} \t", ""]))
            for i in range(40)]
    rows += [(3, shared[1] + "\nother line here"), (None, shared[2]), (100, None), (101, ""),
             (102, "\n".join(["repeated line"] * 3)), (103, "repeated line\nREPEATED LINE\x0b")]
    df = spark.createDataFrame([doc(*r) for r in rows], DOC_SCHEMA)
    assert result(df) == brute(rows)


def test_edge_rows_and_columns(edge_docs, edge_rows):
    assert result(edge_docs) == brute([(r[0], r[1]) for r in edge_rows])
    got = line_dedup.dedup_lines(edge_docs)
    assert got.columns == [*edge_docs.columns, "__ld_kept", "__ld_n_dropped"]


def test_long_documents_use_several_bitmap_words(spark):
    lines = [f"line number {i} of many" for i in range(300)]
    rows = [(1, "\n".join(lines[::3])), (2, "\n".join(lines))]
    df = spark.createDataFrame([doc(*r) for r in rows], DOC_SCHEMA)
    assert result(df) == brute(rows)
    maps = line_dedup.keep_bitmaps(df).collect()
    assert len(maps) == 1 and sorted(maps[0]["keep"]) == [0, 1, 2, 3, 4] and maps[0]["n_dropped"] == 100


def test_empty_table(no_docs):
    assert line_dedup.dedup_lines(no_docs).collect() == []


def test_plan_is_native(spark):
    from samples import SF
    plan = line_dedup.op5_line_dedup(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_digest(spark, edge_docs):
    row = [r for r in line_dedup.dedup_lines(edge_docs).collect() if r["doc_id"] == 4][0]
    assert hashlib.sha256(row["__ld_kept"].encode()).hexdigest() == hashlib.sha256(b"").hexdigest()
