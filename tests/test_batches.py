import calendar
from datetime import date

import pytest

from articlelake.errors import IntegrityError
from articlelake.operators import batches


def entries(spark, ids):
    return batches.manifest(spark.createDataFrame([(i,) for i in ids], "batch_id string"))


def single(year, month):
    return f"{year:04d}-{month:02d}"


def span(year, first, last):
    return f"{single(year, first)}_to_{single(year, last)}"


# every month pair of a leap year and of another, and both spellings of one month
PAIRS = [(y, a, b) for y in (2019, 2028) for a in range(1, 13) for b in range(1, 13)]
VALID = {span(y, a, b): (y, a, b) for y, a, b in PAIRS if a <= b}
VALID |= {single(y, a): (y, a, a) for y, a, _ in PAIRS}
INVALID = {span(y, a, b): "reversed" for y, a, b in PAIRS if a > b}
INVALID |= {f"{single(y, a)}_to_{single(y + 1, b)}": "cross_year" for y, a, b in PAIRS[:40]}
INVALID |= {bad: "month" for y in (2019, 2028) for m in (0, 13, 99) for bad in (single(y, m), span(y, 3, m), span(y, m, 12))}
STEMS = [single(2028, 7), span(2028, 7, 9)]
INVALID |= {bad: "malformed" for s in STEMS for bad in (s[:-1], s[1:], s + " ", " " + s, s + "\n", s + ".txt", s.replace("-", "/"), s.replace("0", "o"))}
INVALID |= {"": "malformed", "2028": "malformed"}


def test_manifest(spark):
    rows = {r.batch_id: r for r in entries(spark, list(VALID) + list(INVALID) * 2).collect()}
    assert len(rows) == len(VALID) + len(INVALID)
    for i, (year, first, last) in VALID.items():
        r = rows[i]
        days = (date(year, first, 1), date(year, last, calendar.monthrange(year, last)[1]))
        assert (r.year, r.start_date, r.end_date, r.error) == (year, *days, None)
    for i, error in INVALID.items():
        assert tuple(rows[i])[1:] == (None, None, None, error), i


MESSAGES = {"malformed": "no month or range", "month": "does not exist", "cross_year": "end of a year", "reversed": "ends before"}


@pytest.mark.parametrize("error", MESSAGES)
def test_resolve_names_the_error(spark, error):
    bad = next(i for i, e in INVALID.items() if e == error)
    with pytest.raises(ValueError, match=MESSAGES[error]):
        batches.resolve(spark, bad)


@pytest.mark.parametrize("first, last", [(1, 1), (4, 9), (12, 12), (1, 12)])
def test_conflicts(spark, first, last):
    """Of all ids of two years, those that share a month with the batch and are not its own."""
    own = span(2028, first, last) if first < last else single(2028, first)
    shared = {i for i, (y, a, b) in VALID.items() if y == 2028 and a <= last and b >= first and i != own}
    found = batches.conflicts(entries(spark, VALID), batches.resolve(spark, own)).collect()
    assert {r.batch_id for r in found} == shared


def test_guard_on_conflicts(spark):
    batch = batches.resolve(spark, span(2028, 4, 9))
    batches.require_no_overlap(entries(spark, []), batch)
    batches.require_no_overlap(entries(spark, [batch.batch_id, single(2028, 3), single(2019, 5)]), batch)
    with pytest.raises(IntegrityError, match=f"{single(2028, 5)}.*{single(2028, 8)}"):
        batches.require_no_overlap(entries(spark, [single(2028, 8), single(2028, 5)]), batch)
    with pytest.raises(IntegrityError, match="no batch ids.*folder_x"):
        batches.require_no_overlap(entries(spark, ["folder_x", single(2028, 8)]), batch)


def test_overlapping_pairs(spark):
    ids = ["2026-01_to_2026-03", "2026-03", "2026-04", "2025-03", "2026-02_to_2026-04", "x"]
    pairs = {(r.batch_id, r.other_batch_id) for r in batches.overlapping(entries(spark, ids)).collect()}
    assert pairs == {
        ("2026-01_to_2026-03", "2026-03"),
        ("2026-01_to_2026-03", "2026-02_to_2026-04"),
        ("2026-02_to_2026-04", "2026-03"),
        ("2026-02_to_2026-04", "2026-04"),
    }


def test_presence_and_duplicates(spark):
    wanted = spark.createDataFrame([("a",), ("b",), ("a",)], "batch_id string")
    existing = spark.createDataFrame([("b",), ("b",), ("c",)], "batch_id string")
    assert {tuple(r) for r in batches.presence(wanted, existing).collect()} == {("a", False), ("b", True)}
    articles = spark.createDataFrame(
        [("x", "1"), ("x", "1"), ("y", "1"), ("y", "2"), ("y", "2")], "article_id string, batch_id string"
    )
    assert [tuple(r) for r in batches.cross_batch_duplicates(articles).collect()] == [("y", 2)]
