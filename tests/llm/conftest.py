import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from samples import DOC_SCHEMA, doc, prose  # noqa: E402


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and very long texts, ties, repeated rows."""
    base = prose(1, 120)
    return [
        doc(1, base), doc(2, base), doc(2, base), doc(3, base.replace("alpha", "Alpha")),
        doc(4, None), doc(5, ""), doc(6, " \n\t \n"), doc(7, "one two three"), doc(8, "one two three"),
        doc(None, "no id here " + prose(2, 40)), doc(9, prose(3, 40), None, None),
        doc(10, prose(4, 30000)), doc(11, "x" * 200_000), doc(12, prose(5, 60) + "\n" + prose(6, 60), None, "s"),
        doc(12, prose(7, 50)), doc(13, "ÉCOLE\u00a0é " + prose(8, 30), "fr"), doc(14, "\x00\x1f 🙂 " + prose(9, 25)),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
