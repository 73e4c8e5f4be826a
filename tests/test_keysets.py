import numpy as np
import pytest
from pyspark.sql import functions as F

from articlelake.operators import keysets
from tests.plans import exchanged

KEYS = ["k", "h"]


@pytest.fixture(scope="module")
def rows(spark):
    keys = spark.range(6000).select(F.col("id").cast("string").alias("k"), F.md5(F.col("id").cast("string")).alias("h"))
    odd = spark.createDataFrame([(None, "x"), ("y", None), ("0", "other"), ("7", "7")], "k string, h string")
    return keys.unionByName(odd).withColumn("body", F.lit("text"))


@pytest.mark.parametrize("bits", [2, 4, 12])
@pytest.mark.parametrize("share", ["id % 3 = 0", "id % 50 <> 0", "id < 0", "true"])
def test_filters_decide_exactly(spark, rows, monkeypatch, bits, share):
    monkeypatch.setattr(keysets, "BITS_PER_KEY", bits)
    monkeypatch.setattr(keysets, "LEAST_BITS", 1 << 10)  # small filters, that err
    members = rows.withColumn("id", F.coalesce(F.try_to_number("k", F.lit("999999")), F.lit(1)).cast("int")).where(share)
    members = members.select(KEYS).unionByName(spark.createDataFrame([("not there", "z")], "k string, h string"))
    found = keysets.without(rows, members, KEYS)
    expected = rows.join(members, KEYS, "left_anti")
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.select(found.columns).collect()))
    assert not any("body" in columns for columns in exchanged(found))


def test_each_level_holds_what_the_one_before_got_wrong(spark, rows, monkeypatch):
    monkeypatch.setattr(keysets, "BITS_PER_KEY", 2)
    monkeypatch.setattr(keysets, "LEAST_BITS", 1 << 10)
    levels = keysets.cascade(rows, rows.where("h < '8'"), KEYS)
    filled = [int(np.unpackbits(f.bits).sum()) for f in levels]
    assert len(levels) > 2 and filled == sorted(filled, reverse=True)


def test_sets_beyond_the_bound_are_joined(spark, rows, monkeypatch):
    monkeypatch.setattr(keysets, "BITS", 1 << 12)
    members = rows.where("h < '8'")
    assert keysets.cascade(rows, members, KEYS) is None
    found = keysets.without(rows, members, KEYS)
    assert found.count() == rows.join(members, KEYS, "left_anti").count()
    assert "LeftAnti" in found._jdf.queryExecution().optimizedPlan().toString()


def test_no_members_and_no_rows(rows):
    assert keysets.without(rows, rows.limit(0), KEYS).count() == rows.count()
    assert keysets.without(rows.limit(0), rows, KEYS).count() == 0
