import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

KINDS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators also use, inside or in their results.
CLASHES = ["shard", "slot", "score", "lang_pred", "n_lines", "component_id", "start", "id", "rank"]


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, clashing columns."""
    long = " ".join(f"wort{i % 977} and" for i in range(30_000))
    body = "the quick brown fox jumps over the lazy dog while seven wizards brew odd potions"
    rows = [
        (1, f"{body} today", "en", "a", 5), (1, f"{body} today", "en", "a", 5),
        (2, f"{body} today", "en", "b", 5), (3, f"{body.upper()}\ttoday", None, None, None),
        (4, None, "de", "a", None), (5, "", "de", "a", 0), (6, " \n\t ", "fr", None, 4),
        (7, long, "en", "a", len(long)), (8, long + " extra", "en", "a", len(long) + 6),
        (9, "12345 --- !!!", None, "b", 13), (None, "ein kleiner satz ohne nummer", "de", "c", 1),
        (10, "kurz", "de", "c", 4), (11, "Ünïcode ÉCOLE écoLE straße", "fr", "c", 26),
        (12, "same\nsame\nother", "en", "d", 15)]
    df = spark.createDataFrame(rows, KINDS)
    for i, name in enumerate(CLASHES):
        df = df.selectExpr("*", f"{i} AS {name}")
    return df


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], KINDS)


@pytest.fixture(scope="session")
def marks(spark):
    """Labels with nulls, a repeated row and one for no document."""
    rows = [(1, 1, 0), (1, 1, 0), (2, None, 1), (3, 0, None), (None, 1, 0), (7, 1, 0), (8, 0, 1), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
