"""Tables with nulls, empty and long texts, ties, repeated rows and clashing column names."""

from __future__ import annotations

import random

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside.
CLASHES = "id string, row string, key int, node int, fp int, runs int, items int, ranges int, text_id int, body int, rank int, slot int, host int"

_rng = random.Random(5)
_SYLLABLES = "an en er in on re st th ti ou ha he".split()


def word() -> str:
    return "".join(_rng.choice(_SYLLABLES) for _ in range(_rng.randint(1, 3)))


def prose(count: int) -> str:
    return " ".join(word() for _ in range(count))


PASSAGE = prose(60)
LONG = prose(30_000)

TEXTS = [
    (1, prose(80)),
    (2, None),
    (3, ""),
    (4, "  \n\t "),
    (5, LONG),
    (6, LONG),
    (7, "Same text here"),
    (7, "Same text here"),
    (8, "same  TEXT here"),
    (9, prose(20) + " " + PASSAGE + " " + prose(15)),
    (10, PASSAGE),
    (11, prose(30) + "\n" + PASSAGE + "."),
    (None, "a row without an id"),
    (None, "a row without an id"),
    (12, "漢字 ééé 🙂 ﬁ ǅ\x00\x1f\x85 end"),
    (13, "x" * 5000),
    (14, "a"),
    (15, "word " * 200),
    (-1, "a row without an id"),
]


def documents(spark, texts=TEXTS):
    rows = [(i, t, "en", "src0", len(t) if t is not None else None) for i, t in texts]
    return spark.createDataFrame(rows, DOCUMENT)


def clashing(spark, texts=TEXTS):
    names = [c.strip() for c in CLASHES.split(",")]
    rows = [(i, t, "en", "s", 0, *["x" if "string" in c else 7 for c in names]) for i, t in texts]
    return spark.createDataFrame(rows, f"{DOCUMENT}, {CLASHES}")


def empty(spark):
    return spark.createDataFrame([], DOCUMENT)


def plain(df):
    """Rows in an order of their own, for comparison."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
