import pytest
from samples import SF

import __spark_entry__ as entry
from podlake.llm.queries import ORACLE_SQL, QUERIES
from podlake.oracle.compare import compare, duck


def test_all_are_registered():
    names = {n.split("_")[0] for n in QUERIES}
    assert names == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    ok, message = compare(QUERIES[name](spark, SF), duck(SF), ORACLE_SQL[name])
    assert ok, f"{name}: {message}"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_no_table_is_read_on_the_driver_by_path(spark, name, monkeypatch):
    """Queries reach their tables through Spark's readers only."""
    import builtins
    opened = builtins.open

    def guarded(path, *a, **k):
        assert SF not in str(path)
        return opened(path, *a, **k)

    monkeypatch.setattr(builtins, "open", guarded)
    assert QUERIES[name](spark, SF).columns


def test_queries_run_from_another_folder(tmp_path):
    """Workers get the package from the session, not from the folder of the start."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    names = [n for n in QUERIES if n.split("_")[0] not in ("op5", "op7", "op10")] + ["pipeline"]
    code = (f"import sys; sys.path.insert(0, {root!r})\n"
            "from podlake.session import get_spark\nimport __spark_entry__ as e\n"
            "spark = get_spark('local[4]', shuffle_partitions=4)\n"
            f"print('ROWS', *[e.queries()[n](spark, {SF!r}).count() for n in {names!r}])")
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=900)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
    assert len(out.stdout.split("ROWS")[1].split()) == len(names)
