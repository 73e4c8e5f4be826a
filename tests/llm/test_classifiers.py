import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from articlelake.llm import language, quality_gam
from articlelake.llm.frames import text_bytes, texts
from articlelake.llm.queries import held_out, teaches
from tests.llm.conftest import prose

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["eux", "tion", "oi", "élé"], "cc": ["schü", "ung", "heit", "pf"]}


def sentence(lang, seed, words=80):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def test_languages_held_out_and_mixtures(spark):
    rows = [(i, sentence(lang, i), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 40)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn(train.where(teaches()))
    found = {r["doc_id"]: r for r in language.predict(texts(train), model).collect()}
    assert all(found[i]["lang_pred"] == lang and found[i]["score"] > 0.9 for i, _, lang in rows)
    odd = [(1, None), (2, ""), (3, "12 !! ..."), (None, sentence("bb", 7)), (5, sentence("aa", 500, 60) + " " + sentence("cc", 501, 40)), (6, sentence("bb", 1, 20_000)), (7, "日本")]
    got = language.predict(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()
    named = {r["doc_id"]: r for r in got}
    assert len(got) == 7 and all(named[i]["lang_pred"] == "und" and named[i]["score"] == 0 for i in (1, 2, 3))
    assert named[None]["lang_pred"] == "bb" and named[6]["lang_pred"] == "bb" and named[7]["lang_pred"] in SYLLABLES
    shares = {x["lang"]: x["share"] for x in named[5]["languages"]}
    assert set(shares) == {"aa", "cc"} and abs(shares["aa"] - 0.6) < 0.1 and named[5]["lang_pred"] == "aa"


def test_proportions_converge_for_each_text_alone():
    rng = np.random.default_rng(2)
    words = np.array([3, 400, 50, 1, 900])
    likely = rng.random((words.sum(), 3)) ** np.repeat([9, 0.3, 2, 1, 0.2], words)[:, None]
    first, even = np.cumsum(words) - words, np.full((5, 3), 1 / 3)
    whole = language._maximise(likely, words, first, even)
    for i, (a, n) in enumerate(zip(first, words)):
        own = likely[a : a + n]
        assert np.array_equal(whole[i : i + 1], language._maximise(own, words[i : i + 1], np.zeros(1, dtype=np.int64), even[:1]))
        part = own * whole[i]
        assert np.abs((part / part.sum(axis=1, keepdims=True)).mean(axis=0) - whole[i]).max() < 1e-3


def test_languages_without_teachers(spark, docs, no_docs):
    model = language.learn(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in language.predict(texts(docs), model).collect()} == {"und"}
    assert language.accepted(docs, model).count() == 0
    assert language.predict(texts(no_docs), language.learn(no_docs)).collect() == []


def quality_rows():
    rows, labels = [], []
    for i in range(240):
        text, good = prose(i, 60 + i % 50), i % 4 != 0
        if not good:
            text = text.upper() if i % 8 == 0 else text.replace(" ", " | ")
        rows.append((i, text))
        labels.append((i, int(good)))
    return rows, labels


def test_quality_held_out(spark):
    rows, labels = quality_rows()
    rows += [(900, None), (901, ""), (902, " \n "), (None, rows[1][1]), (1, rows[1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels + [(1, None), (2, labels[2][1]), (None, 1)], "doc_id long, label int")
    found = quality_gam.scores(docs, known, teaches()).withColumn("held_out", held_out()).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    truth = dict(labels)
    out = [r for r in found if r["held_out"] and r["doc_id"] in truth]
    assert len(out) > 50 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in out]) > 0.97
    kept = quality_gam.accepted(docs, quality_gam.learn(docs.where(teaches()), known))
    assert kept.columns == docs.columns and kept.where("doc_id < 240 AND doc_id % 4 = 0").count() <= 2


def test_quality_features_are_of_the_text_alone():
    rows = ["one", "one", "", "one two two", "two", "||", "|| x", "x", "\n", "\n|", "| |", None, "two two"]
    whole = quality_gam.features(*text_bytes(pa.array(rows, pa.string())))
    alone = [quality_gam.features(*text_bytes(pa.array([r], pa.string())))[0] for r in rows]
    assert np.array_equal(whole, np.stack(alone))


def test_quality_without_labels_or_with_one_kind(spark, docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, label int")
    assert {r["score"] for r in quality_gam.scores(docs, none, teaches()).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(12)], "doc_id long, label int")
    assert all(r["predicted"] == 1 for r in quality_gam.scores(docs, ones, teaches()).collect())
    assert quality_gam.scores(no_docs, ones, teaches()).collect() == []


def test_pairs_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x[:3000], y[:3000])
    assert np.mean((model.score(x[3000:]) >= 0.5) == y[3000:]) > 0.9  # edges of the bins blur the border
