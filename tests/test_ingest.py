import tempfile
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from articlelake.plans import jobs
from articlelake.sources.lake import Lake
from articlelake.streaming import ingest
from tests.test_jobs import EMBEDDING, PAIRS, ROWS, SMALL, export_row, kept, stage, write_csv


@pytest.fixture
def watched():
    folder = tempfile.mkdtemp(prefix="articlelake-ingest-")
    write_csv(f"{folder}/incoming/first/2023-05.csv", ROWS)
    return ingest.Ingest(Lake(f"{folder}/lake"), f"{folder}/incoming", f"{folder}/state", SMALL)


def journal(spark, watched):
    rows = ingest.journal(spark, watched).orderBy("epoch", "nth").collect()
    return [(r.epoch, r.nth, r.batch_id, r.refused, r.rows) for r in rows]


def content(spark, lake, *names):
    return {n: sorted(map(str, stage(spark, lake, n).collect())) for n in names}


def test_deliveries_end_as_if_run_by_hand(spark, watched):
    second = [export_row(n, "2023-06") for n in range(7)]
    ingest.run(spark, watched)
    write_csv(f"{watched.incoming}/second/2023-06.csv/a.csv", second[:3])
    write_csv(f"{watched.incoming}/second/2023-06.csv/b.csv", second[3:])
    ingest.run(spark, watched)
    ingest.run(spark, watched)  # nothing new
    assert [j[:4] for j in journal(spark, watched)] == [(0, 0, "2023-05", None), (1, 0, "2023-06", None)]
    assert journal(spark, watched)[0][4]["flattened"] == PAIRS
    by_hand = Lake(f"{watched.lake.root}-by-hand")
    for batch_id, path in (("2023-05", "first/2023-05.csv"), ("2023-06", "second/2023-06.csv")):
        jobs.land_batch(spark, by_hand, batch_id, f"{watched.incoming}/{path}")
        jobs.run_batch(spark, by_hand, batch_id, SMALL)
    names = ("base", "flattened", "chunks")
    assert content(spark, watched.lake, *names) == content(spark, by_hand, *names)


def failing():
    def call(texts):
        raise RuntimeError("connection lost")

    return call


def test_a_lost_run_is_taken_up_where_it_stopped(spark, watched):
    write_csv(f"{watched.incoming}/2023-06.csv", [export_row(n, "2023-06") for n in range(5)])
    lost = jobs.Embedding(failing, "md5", 8, requests_per_minute=None, options={"waits": ()})
    once = {"left": 1}
    do = ingest._do

    def first_then_lost(spark, own, delivery, batch_id):
        if not once["left"]:
            own = replace(own, embedding=lost)
        once["left"] -= 1
        return do(spark, own, delivery, batch_id)

    good = replace(watched, embedding=EMBEDDING)
    try:
        ingest._do = first_then_lost
        with pytest.raises(Exception, match="connection lost"):
            ingest.run(spark, good)
    finally:
        ingest._do = do
    done = journal(spark, good)
    assert len(done) == 1
    before = {f for f in stage(spark, good.lake, "embeddings").inputFiles()}
    ingest.run(spark, good)
    assert [j[0] for j in journal(spark, good)] == [0, 0] and {j[2] for j in journal(spark, good)} == {"2023-05", "2023-06"}
    assert before < set(stage(spark, good.lake, "embeddings").inputFiles())  # the finished one was not run again


def test_a_faulty_delivery_is_refused_and_holds_up_no_other(spark, watched):
    rows = [export_row(n, "2023-08") for n in range(5)]
    write_csv(f"{watched.incoming}/2023-07.csv", rows)  # of another month
    write_csv(f"{watched.incoming}/nonsense.csv", rows)
    write_csv(f"{watched.incoming}/2023-09.csv", [{"title": "x"}], ["title"])
    write_csv(f"{watched.incoming}/2023-08.csv", rows)
    ingest.run(spark, watched)
    found = {j[2]: j[3] for j in journal(spark, watched)}
    assert found["2023-05"] is None and found["2023-08"] is None
    assert "out_of_batch_range" in found["2023-07"] and "names no month" in found["nonsense"] and "UNRESOLVED" in found["2023-09"]
    assert {r.batch_id for r in stage(spark, watched.lake, "base").select("batch_id").collect()} == {"2023-05", "2023-08"}
    ingest.run(spark, watched)
    assert len(journal(spark, watched)) == 5


def test_a_batch_delivered_again_replaces_the_first(spark, watched):
    ingest.run(spark, watched)
    write_csv(f"{watched.incoming}/again/2023-05.csv", ROWS[:3])
    ingest.run(spark, watched)
    assert stage(spark, watched.lake, "base").count() == kept(ROWS[:3])[0]


def test_names_of_deliveries(spark):
    paths = ["file:/in/2023-05.csv", "file:/in/x/2023-06.csv/part-0.csv", "file:/in/x/2023-06.csv/part-1.csv", "s3://b/a%20b.csv"]
    files = spark.createDataFrame([(p,) for p in paths], "path string").withColumn("modificationTime", F.current_timestamp())
    found = {(r.delivery, r.batch_id) for r in ingest.deliveries(files).collect()}
    assert found == {("file:/in/2023-05.csv", "2023-05"), ("file:/in/x/2023-06.csv", "2023-06"), ("s3://b/a b.csv", "a b")}


def test_no_content_of_a_delivery_is_read_by_the_stream(spark, watched):
    seen = []
    query = ingest.watch(spark, watched.incoming).writeStream.foreachBatch(
        lambda files, n: seen.append(files._jdf.queryExecution().executedPlan().toString())
    )
    query.option("checkpointLocation", f"{watched.checkpoint}/other").trigger(availableNow=True).start().awaitTermination()
    assert seen and "content" not in seen[0].split("ReadSchema")[-1]
