import hashlib
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from articlelake.errors import IntegrityError
from articlelake.functions import text
from articlelake.operators import embed
from articlelake.plans import jobs
from articlelake.plans.stand_in import hashed_vectors
from articlelake.runtime import run_folder
from articlelake.sources import lake as lakes
from tests.plans import exchanged


def chunk_frame(spark, n):
    rows = [(f"a:chunk_{i}", "a", i, f"text {i}") for i in range(n)]
    return spark.createDataFrame(
        rows, "chunk_id string, article_id string, chunk_index long, retrieval_text string"
    )


def expected_vector(text, size):
    digest = hashlib.md5(text.encode()).digest()
    return [(b - 128) / 128 for b in digest[:size]]


def log_folder():
    return tempfile.mkdtemp(prefix="articlelake-log-")


def recording(folder, size=4, fail_first=0, fail_always=False):
    """A client that notes each request in a file of its own."""

    def connect():
        import hashlib
        import os
        import uuid

        state = {"failures": fail_first}

        def call(texts):
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
                f.write("\n".join(texts))
            if fail_always or state["failures"] > 0:
                state["failures"] -= 1
                raise RuntimeError("busy")
            return [
                [(b - 128) / 128 for b in hashlib.md5(t.encode()).digest()[:size]] for t in texts
            ]

        return call

    return connect


def noting(folder):
    """A sleep that notes how long it was asked to."""

    def sleep(seconds):
        import os
        import uuid

        with open(os.path.join(folder, f"{seconds:.3f}-{uuid.uuid4().hex}"), "w"):
            pass

    return sleep


def requests_in(folder):
    return [open(os.path.join(folder, f)).read().split("\n") for f in os.listdir(folder)]


def waits_in(folder):
    return sorted(float(f.split("-")[0]) for f in os.listdir(folder))


def test_vectors_come_in_whole_batches(spark):
    folder = log_folder()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = embed.embed_rows(
            embed.to_embed(chunk_frame(spark, 45)).coalesce(1), recording(folder), "m", batch_size=20
        ).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(len, requests_in(folder))) == [5, 20, 20]
    assert {r.chunk_id: r.embedding for r in rows} == {
        f"a:chunk_{i}": expected_vector(f"text {i}", 4) for i in range(45)
    }
    assert {(r.model, r.dimension) for r in rows} == {("m", 4)}
    assert rows[0].text_hash == hashlib.sha256(b"text 0").hexdigest()


@pytest.mark.parametrize("failures", range(5))
@pytest.mark.parametrize("schedule", [(), (1.0,), (3.0, 1.0, 2.0)])
def test_failed_requests_follow_the_schedule(spark, failures, schedule):
    folder, waits = log_folder(), log_folder()
    df = embed.to_embed(chunk_frame(spark, 3)).coalesce(1)
    made = embed.embed_rows(
        df, recording(folder, fail_first=failures), "m", waits=schedule, sleep=noting(waits)
    )
    if failures <= len(schedule):
        assert len(made.collect()) == 3
    else:
        with pytest.raises(Exception, match="busy"):
            made.collect()
    assert waits_in(waits) == sorted(schedule[:failures])
    assert len(requests_in(folder)) == min(failures, len(schedule)) + 1


def test_vector_count_must_match(spark):
    df = embed.to_embed(chunk_frame(spark, 3)).coalesce(1)
    with pytest.raises(Exception, match="2 vectors for 3 texts"):
        embed.embed_rows(df, lambda: lambda texts: [[1.0]] * 2, "m").collect()


def test_request_limit_is_shared_by_partitions(spark):
    waits, folder = log_folder(), log_folder()
    df = embed.to_embed(chunk_frame(spark, 40)).repartition(2, "chunk_id")
    embed.embed_rows(
        df, recording(folder), "m", batch_size=5, requests_per_minute=30, parallel=2,
        sleep=noting(waits), clock=lambda: 0.0,
    ).collect()
    # 2 partitions at 30 a minute in all: 4 s apart in each; none before a first request
    busy = df.select(F.spark_partition_id()).distinct().count()
    assert set(waits_in(waits)) == {4.0}
    assert len(requests_in(folder)) - len(waits_in(waits)) == busy == 2


def test_request_limit_holds_across_waves(spark):
    waits, folder = log_folder(), log_folder()
    options = {"sleep": noting(waits), "clock": lambda: 0.0}
    limited = settings(
        recording(folder), batch_size=1, requests_per_minute=30, options=options
    )
    chunks = stored(spark, 60)
    assert jobs.embed_all(spark, chunks, run_folder(spark, "v"), limited).count() == 60
    assert len(requests_in(folder)) == 60
    # every request but the very first keeps its distance
    assert waits_in(waits) == [2.0] * 59


def settings(connect, **kw):
    kw = {"model": "m", "dimension": 4, "requests_per_minute": None, **kw}
    return jobs.Embedding(connect, **kw)


def stored(spark, n):
    return jobs.staged(chunk_frame(spark, n), run_folder(spark, "chunks"))


def test_resume_takes_up_saved_vectors(spark):
    folder, vectors = log_folder(), run_folder(spark, "vectors")
    chunks = stored(spark, 60)
    first = chunks.where("chunk_index < 40")
    embed.embed_rows(embed.to_embed(first), recording(log_folder()), "m").write.parquet(vectors)
    # saved by another model, and for a text that has been edited since
    other = embed.embed_rows(embed.to_embed(chunks), recording(log_folder()), "other")
    other.write.mode("append").parquet(vectors)
    edited = chunks.where("chunk_index = 59").withColumn("retrieval_text", F.lit("old text"))
    embed.embed_rows(embed.to_embed(edited), recording(log_folder()), "m").write.mode("append").parquet(vectors)
    out = jobs.embed_all(spark, chunks, vectors, settings(recording(folder), batch_size=7)).collect()
    assert sorted(t for r in requests_in(folder) for t in r) == sorted(f"text {i}" for i in range(40, 60))
    assert {r.chunk_id: r.embedding for r in out} == {
        f"a:chunk_{i}": expected_vector(f"text {i}", 4) for i in range(60)
    }
    assert out[0].asDict().keys() == set(chunks.columns) | {"embedding"}


def test_failed_run_keeps_earlier_waves(spark):
    vectors, chunks = run_folder(spark, "vectors"), stored(spark, 200)
    def connect():
        def call(texts):
            if "text 7" in texts:
                raise RuntimeError("down")
            return [[1.0] * 4 for _ in texts]
        return call
    options = {"waits": ()}
    limited = settings(
        connect, batch_size=1, requests_per_minute=1e9, parallel=1, save_every=25, options=options
    )
    with pytest.raises(Exception, match="down"):
        jobs.embed_all(spark, chunks, vectors, limited)
    saved = jobs.read_vectors(spark, vectors).count() if lakes.exists(spark, vectors) else 0
    folder = log_folder()
    out = jobs.embed_all(spark, chunks, vectors, settings(recording(folder)))
    assert out.where("embedding is null").count() == 0 and out.count() == 200
    assert sum(map(len, requests_in(folder))) == 200 - saved


def test_duplicate_saved_vectors_do_not_multiply_rows(spark):
    vectors, chunks = run_folder(spark, "vectors"), stored(spark, 10)
    for _ in range(2):
        embed.embed_rows(embed.to_embed(chunks), recording(log_folder()), "m").write.mode("append").parquet(vectors)
    assert jobs.embed_all(spark, chunks, vectors, settings(recording(log_folder()))).count() == 10


@pytest.mark.parametrize("rows, every", [(60, 1), (300, 4), (300, 40)])
def test_a_wave_is_a_save_interval_whatever_the_size(spark, rows, every, monkeypatch):
    waves = []
    inner = embed.embed_rows

    def counting(pending, *args, **kw):
        waves.append(pending.count())
        return inner(pending, *args, **kw)

    monkeypatch.setattr(jobs.embed, "embed_rows", counting)
    chosen = settings(recording(log_folder()), batch_size=5, requests_per_minute=1e9, save_every=every)
    assert jobs.embed_all(spark, stored(spark, rows), run_folder(spark, "v"), chosen).count() == rows
    interval = 5 * every
    assert sum(waves) == rows and max(waves) <= interval + 6 * interval**0.5


def test_vectors_of_another_length_are_made_anew(spark):
    chunks, vectors, folder = stored(spark, 30), run_folder(spark, "my vectors"), log_folder()
    with pytest.raises(Exception, match="3 values instead of 4"):
        jobs.embed_all(spark, chunks, vectors, settings(recording(log_folder(), 3), options={"waits": ()}))
    embed.embed_rows(embed.to_embed(chunks), recording(log_folder(), 3), "m").write.mode("append").parquet(vectors)
    out = jobs.embed_all(spark, chunks, vectors, settings(recording(folder)))
    assert {len(r.embedding) for r in out.collect()} == {4}
    assert sum(map(len, requests_in(folder))) == 30


def test_dimensions(spark):
    chunks = stored(spark, 10)
    uneven = lambda: lambda texts: [[1.0] * (2 + len(t) % 2) for t in texts]
    texts = F.when(F.col("chunk_index") == 3, "xxx").otherwise("xx")
    with pytest.raises(IntegrityError, match="run from 2 to 3"):
        jobs.embed_all(
            spark, chunks.withColumn("retrieval_text", texts), run_folder(spark, "v"),
            settings(uneven, dimension=None),
        )
    joined = embed.attach(chunks, jobs.read_vectors(spark, _saved(spark, chunks.limit(3))), "m")
    assert joined.where("embedding is null").count() == 7
    with pytest.raises(Exception, match="missing_embedding"):
        embed.checked(joined, 4).collect()


def whole_chunks(spark, n):
    frame = chunk_frame(spark, n).drop("retrieval_text").withColumns(
        {"title": F.lit("T"), "topics": F.array(F.lit("A")), "content_chunk": F.concat(F.lit("c"), "chunk_id")}
    )
    built = text.retrieval_text(F.col("title"), F.col("topics"), F.col("content_chunk"))
    return jobs.staged(frame.withColumn("retrieval_text", built), run_folder(spark, "chunks"))


def test_texts_are_laid_out_once_and_stay(spark, monkeypatch):
    monkeypatch.setattr(jobs.embed, "embed_rows", lambda rows, *a, made=embed.embed_rows, **k: dealt.append(rows) or made(rows, *a, **k))
    dealt, chunks, vectors = [], whole_chunks(spark, 50), run_folder(spark, "v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = jobs.embed_all(spark, chunks, vectors, settings(recording(log_folder())))
        assert exchanged(out) and not any({"content_chunk", "retrieval_text"} & columns for columns in exchanged(out))
        assert dealt and not any(exchanged(rows) for rows in dealt)  # a wave is read as it was dealt
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r.chunk_id: r.embedding for r in out.collect()} == {
        r.chunk_id: expected_vector(r.retrieval_text, 4) for r in chunks.collect()
    }
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("laid_out")]


def test_pending_is_decided_by_keys(spark):
    chunks = whole_chunks(spark, 40)
    saved = embed.to_embed(chunks.where("chunk_index < 30")).select(*embed.KEYS, F.lit("m").alias("model"), F.lit(4).alias("dimension"))
    found = embed.pending(chunks, saved, "m", 4)
    assert sorted(r.chunk_id for r in found.collect()) == sorted(f"a:chunk_{i}" for i in range(30, 40))
    assert exchanged(found) == []
    assert embed.pending(chunks, saved, "other").count() == 40


def test_the_token_limit_holds_in_a_job(spark):
    waits = log_folder()
    options = {"sleep": noting(waits), "clock": lambda: 0.0}
    limited = settings(recording(log_folder()), batch_size=1, requests_per_minute=6e9, tokens_per_minute=120, options=options)
    jobs.embed_all(spark, stored(spark, 62), run_folder(spark, "v"), limited).collect()
    assert [w for w in waits_in(waits) if w >= 1]  # 62 texts of 2 words: more than a bucket of 120
    free = settings(recording(log_folder()), tokens_per_minute=1)  # holds where requests are limited
    assert jobs.embed_all(spark, stored(spark, 30), run_folder(spark, "v"), free).count() == 30


def test_nothing_to_embed(spark):
    none = chunk_frame(spark, 1).limit(0)
    assert jobs.embed_all(spark, none, run_folder(spark, "v"), settings(recording(log_folder()))).count() == 0


def test_text_built_again_must_be_the_text_that_was_embedded(spark):
    frame = chunk_frame(spark, 1).withColumns(
        {"title": F.lit("T"), "topics": F.array(F.lit("A")), "content_chunk": F.lit("c")}
    )
    with pytest.raises(Exception, match="not made of its own columns"):
        embed.attach(frame, jobs.read_vectors(spark, run_folder(spark, "v")), "m").collect()


def _saved(spark, chunks):
    path = run_folder(spark, "v")
    embed.embed_rows(embed.to_embed(chunks), recording(log_folder()), "m").write.parquet(path)
    return path


def test_embed_job_and_sample(spark):
    folder = tempfile.mkdtemp(prefix="articlelake-out-")
    source, target = f"{folder}/chunks", f"{folder}/embedded.parquet"
    chunk_frame(spark, 12).write.parquet(source)
    jobs.embed_job(spark, source, target, settings(recording(log_folder())), limit=5)
    assert not os.path.exists(target)
    sample = spark.read.parquet(f"{folder}/embedded.sample.parquet")
    assert sorted(r.chunk_index for r in sample.collect()) == [0, 1, 2, 3, 4]
    jobs.embed_job(spark, source, target, settings(recording(log_folder())))
    assert spark.read.parquet(target).count() == 12
    assert not os.path.exists(f"{target}.checkpoint")
    jobs.embed_job(spark, source, target, settings(hashed_vectors(20), dimension=20))
    assert len(spark.read.parquet(target).first().embedding) == 20
