"""Queries whose input once lay in one task: the same rows from many."""

import hashlib

import pytest
from pyspark.sql import functions as F

from articlelake.operators import embed
from articlelake.operators.pacing import Pace
from articlelake.plans import jobs, queries
from articlelake.plans.stand_in import Endpoint
from articlelake.runtime import run_folder


def texts(n):
    return [None if i % 41 == 40 else f"text {i}\n" + "xy " * (i * 37 % 900) for i in range(n)]


@pytest.fixture
def corpus(spark, tmp_path):
    """Documents with text of uneven lengths, over line ends, some of it null."""
    rows = [(3 * i, t, "en", "src1", len(t or "")) for i, t in enumerate(texts(450))]
    spark.createDataFrame(rows[::-1], "doc_id long, text string, lang string, source string, n_chars long").repartition(
        3
    ).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


@pytest.fixture
def embedded(monkeypatch):
    """Rows of each partition that is embedded."""
    seen = []

    def counting(rows, *args, made=embed.embed_rows, **kw):
        seen.append([r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()])
        return made(rows, *args, **kw)

    monkeypatch.setattr(embed, "embed_rows", counting)
    return seen


def requests():
    all_texts = [t or "" for t in texts(450)]
    return [all_texts[i : i + 20] for i in range(0, 450, 20)]


def test_a_large_export_is_several_files(spark, corpus, monkeypatch):
    files = []
    write = queries.write_raw_csv
    monkeypatch.setattr(queries, "write_raw_csv", lambda raw, path: files.append(raw.rdd.getNumPartitions()) or write(raw, path))
    monkeypatch.setattr(queries, "EXPORT_BYTES", 200_000, raising=False)
    found = {r.url: (r.content_md5, r.characters) for r in queries.spanning_csv(spark, corpus).collect()}
    assert files[0] > 1
    said = {f"https://example.test/{3 * i}": t for i, t in enumerate(texts(450))}
    assert found == {u: (t and hashlib.md5(t.encode()).hexdigest(), t and len(t)) for u, t in said.items()}


def test_retried_requests_are_dealt_over_tasks(spark, corpus, embedded):
    found = {tuple(r) for r in queries.retried_requests(spark, corpus).collect()}
    assert found == {(i, i % 5 + 1, 5 * (2 ** (i % 5) - 1), len(r)) for i, r in enumerate(requests())}
    assert len(embedded[0]) > 1 and all(n <= 120 for n in embedded[0])


def test_paced_requests_are_dealt_over_tasks(spark, corpus, embedded, monkeypatch):
    monkeypatch.setattr(queries, "TOKENS", 60_000, raising=False)  # fewer than there are
    clock, expected = Endpoint(seconds=0.25), {}
    limiter, call = Pace(60, 60_000, count=len).limiter(clock.clock, clock.sleep), clock.connect()
    for request in requests():
        limiter.start(request)
        starts, tokens = expected.get(clock.now // 60, (0, 0))
        expected[clock.now // 60] = starts + 1, tokens + sum(map(len, request))
        call(request)
    assert len(expected) > 2
    assert {r.minute: (r.starts, r.tokens) for r in queries.paced_requests(spark, corpus).collect()} == expected
    assert len(embedded[0]) > 1 and all(n <= 120 for n in embedded[0])


def test_places_follow_an_order_with_ties_and_nulls(spark):
    rows = spark.createDataFrame([(None if i % 5 == 0 else i // 4, f"{i:03d}") for i in range(100)], "id long, retrieval_text string")
    rows = rows.withColumns({"chunk_id": F.col("id").cast("string"), "text_hash": F.lit("")})
    found, each = embed.in_sequence(rows, ["id"], 7, 4, lambda r: jobs.staged(r, run_folder(spark, "rows")))
    got = found.orderBy("place").collect()
    assert [r.place for r in got] == list(range(100)) and [r.request for r in got] == [i // 7 for i in range(100)] and each == 4
    ids = [-1 if r.id is None else r.id for r in got]
    assert ids == sorted(ids) and {r.retrieval_text for r in got} == {f"{i:03d}" for i in range(100)}
    none = embed.in_sequence(rows.limit(0), ["id"], 7, 4, lambda r: jobs.staged(r, run_folder(spark, "rows")))
    assert none[0].count() == 0 and none[1] == 1


def test_unpaced_intervals_are_tasks_of_one_job(spark, embedded):
    chunks = spark.range(600).select(F.format_string("a:%d", "id").alias("chunk_id"), F.format_string("text %d", "id").alias("retrieval_text"))
    chunks, vectors = jobs.staged(chunks, run_folder(spark, "chunks")), run_folder(spark, "vectors")

    def connect():
        def call(texts):
            if "text 7" in texts:
                raise RuntimeError("down")
            return [[1.0] * 4 for _ in texts]

        return call

    lost = jobs.Embedding(connect, "m", 4, batch_size=5, requests_per_minute=None, save_every=2, options={"waits": ()})
    with pytest.raises(Exception, match="down"):
        jobs.embed_all(spark, chunks, vectors, lost)
    assert len(embedded) == 1 and max(embedded[0]) <= 10 and sum(embedded[0]) == 600
    saved = jobs.read_vectors(spark, vectors).count()
    whole = jobs.Embedding(lambda: lambda texts: [[1.0] * 4 for _ in texts], "m", 4, requests_per_minute=None)
    assert jobs.embed_all(spark, chunks, vectors, whole).where("embedding is not null").count() == 600
    assert sum(embedded[1]) == 600 - saved


def test_whitespace_is_collapsed_whatever_the_run(spark):
    runs = [" ", "  ", "\n", " \n", "\n ", "\t \t", "\x1c", " \x1f ", " ", "  ", "　 "]
    rows = [(f"{a}x{b}y{a}{b}z w{b}",) for a in runs for b in runs]
    for said, got in spark.createDataFrame(rows, "t string").select("t", queries.text.collapse_space(F.col("t"))).collect():
        assert got == " ".join(said.split()), repr(said)
