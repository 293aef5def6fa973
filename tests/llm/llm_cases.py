"""Documents of edge cases, as fixtures that the tests import."""

import pytest
from pyspark.sql import functions as F

SF_SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Column names that the operators use inside; inputs may carry them too.
CLASHES = ("size", "target", "node", "key", "component", "label", "bands", "row", "doc", "ord", "at", "kept", "place",
           "fingerprint", "next_text", "_block", "cuts", "n_tokens", "mix_place", "mix_cut", "_mix_cut",
           "gone_id", "again_id", "nth", "cut_doc", "cut_row", "cut_at", "copy", "source_size", "whole")


def words(n: int, seed: int) -> str:
    """``n`` words that differ from those of any other seed."""
    return " ".join(f"w{seed}x{i * i % 97}y{i}" for i in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with null ids and texts, empty and blank texts, repeated rows,
    exact and near copies, personal data, odd characters and a long text."""
    base = words(120, 1)
    near = base.replace("w1x1y1 ", "changed ", 1)
    rows = [
        (1, base, "en", "a", len(base)), (2, base, "en", "a", 1), (3, near, "en", "b", None),
        (4, None, None, None, None), (5, "", "en", "a", 0), (6, " \t\r\n ", None, "b", 4),
        (7, words(60, 7) + "\nmail me: a.b@c.org or +1 (017) 555-7713, ip 10.0.0.1\n" + words(60, 8), "de", None, 3),
        (8, "one two three", "en", "c", 13), (9, "One TWO three", "en", "c", 13),
        (10, "é" * 700 + " ΑΣ 漢字 \U0001F600 <|endoftext|> " + words(70, 10), "fr", "c", 9),
        (11, "a" * 3000, "en", "a", 3000), (12, " ".join(words(400, s) for s in range(20, 60)), "es", "b", 1),
        (13, "same line here again and again now\n" * 30, "en", "b", 1), (13, words(80, 13), "en", "b", 1),
        (14, words(80, 14), None, "a", 1), (14, words(80, 14), None, "a", 1),
        (None, words(90, 15), "en", "a", 1), (None, None, "en", "a", 1), (16, base + "\n" + words(30, 16), "en", "", 2),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def wide(docs):
    """The same documents beside columns whose names the operators use."""
    return docs.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHES)])


def unchanged(df):
    """Whether every added column kept its values."""
    return df.select(*[F.col(c).alias(c) for c in CLASHES]).distinct().collect() in (
        [], [tuple(f"x{i}" for i in range(len(CLASHES)))])


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)
