import random
import re

import pytest
from pyspark.sql import functions as F

from articlelake.functions import text


def one(spark, value, expression, kind="string"):
    df = spark.createDataFrame([(value,)], f"c {kind}")
    return df.select(expression(F.col("c")).alias("r")).first().r


@pytest.mark.parametrize(
    "raw, day",
    [
        ("2022-08-08T23:31:00+08:00", "2022-08-08"),
        ("2022-08-08 23:31:00", "2022-08-08"),
        ("2022-8-8 3:05:00", "2022-08-08"),
        ("8/8/2022 23:31", "2022-08-08"),
        ("08/08/2022 23:31", "2022-08-08"),
        ("12/31/2021 3:05", "2021-12-31"),
        ("13/8/2022 10:00", None),
        ("2022-02-30 10:00:00", None),
        ("8/8/22 10:00", None),
        ("2022-08-08T23:31:00Z", None),
        ("2022-08-08T23:31:00+09:00", None),
        ("2022-08-08T23:31:00.5+08:00", None),
        ("2022-08-08", None),
        ("2022-08-08TT23:31:00", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_day(spark, raw, day):
    got = one(spark, raw, text.parse_day)
    assert (str(got) if got else None) == day


def test_quarter_label(spark):
    got = one(spark, "2022-08-08 10:00:00", lambda c: text.quarter_label(text.parse_day(c)))
    assert got == "2022Q3"


def test_trim_takes_all_unicode_space(spark):
    assert one(spark, "\t  a b 　\n", text.trim_unicode) == "a b"
    assert one(spark, " \n", text.trim_unicode) == ""


def test_key_is_null_as_soon_as_a_part_is(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    rows = df.select(text.joined_key(" | ", F.col("x"), F.col("y")).alias("k")).collect()
    assert [r.k for r in rows] == [None, "a | b"]


@pytest.mark.parametrize(
    "content, units",
    [
        ("Hello   world.\tAgain", ["Hello world.", "Again"]),
        ("First sentence. Second sentence! Third one?",
         ["First sentence.", "Second sentence!", "Third one?"]),
        ("", []),
        ("   \t ", []),
        ("This is e.g. an example.", ["This is e.g. an example."]),
        ('He left. "Why?" she asked. (Nobody knew.) 3 days passed.',
         ["He left.", '"Why?" she asked.', "(Nobody knew.) 3 days passed."]),
        ("Fin. École reste.", ["Fin. École reste."]),
    ],
)
def test_sentences(spark, content, units):
    assert one(spark, content, text.sentences) == units


def test_sentences_of_null_is_null(spark):
    assert one(spark, None, text.sentences) is None


def test_collapse_agrees_with_unicode_space_class(spark):
    rng = random.Random(7)
    alphabet = "ab. \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0    ​    　﻿"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(3000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.c for r in df.select("i", text.collapse_space(F.col("t")).alias("c")).collect()}
    assert all(got[i] == " ".join(t.split()) for i, t in enumerate(texts))
    assert re.sub(r"\s+", " ", texts[0]).strip() == got[0]


def test_retrieval_text(spark):
    df = spark.createDataFrame([("T", ["a", "b"], "x")], "t string, p array<string>, e string")
    got = df.select(text.retrieval_text(F.col("t"), F.col("p"), F.col("e")).alias("r")).first().r
    assert got == "Title: T\nTopics: a, b\n\nArticle excerpt:\nx"
