"""Rows and settings that the tests of the corpus operators share."""

import random

SF = "/root/testdata/sf0.001"
WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike".split()

#: doc_id, text, lang, source, n_chars, and extra columns whose names operators use inside.
DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key string, fp long, "
              "kept boolean, n long, keep string, node long, rank int")


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(500)) for _ in range(n))


def doc(i, text, lang="en", source="s"):
    return (i, text, lang, source, None if text is None else len(text), "k", 1, True, 2, "x", 3, 4)
