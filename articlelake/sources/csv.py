"""The raw article export: a header CSV with doubled quotes."""

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from articlelake.schemas import RAW_COLUMNS

DIALECT = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}

# Every row must have the columns of the header, and every file the same header. Pruned
# columns would not be checked.
MOST_PIECES = 100_000  # of files, that a table of 10 MB describes; more are read a file by a task
STRICT = {"mode": "FAILFAST", "enforceSchema": False, "columnPruning": False}
# Nothing between two commas is NULL, "" is an empty text. Spark reads both as NULL as long as
# its mark for NULL is the empty text; with a mark that no field holds it tells them apart.
TOLD_APART = {"nullValue": "\n\x00"}


def flag(c: Column) -> Column:
    """`true` or `false` in any case; anything else is unknown."""
    return F.when(F.lower(c) == "true", True).when(F.lower(c) == "false", False)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines in file order, with the piece of the file that a task reads them from."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))


def quote_parity(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, odd, lines_odd): whether a piece of a file holds an odd number of quotes, and whether a line of it does."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    by_piece = _lines(spark, path).groupBy("file", "at")
    return by_piece.agg((F.sum(quotes) % 2 == 1).alias("odd"), F.bool_or(quotes % 2 == 1).alias("lines_odd"))


def has_spanning_records(spark: SparkSession, path: str) -> bool:
    """Whether a quoted field runs over a line end somewhere.

    The first such line has an odd number of quotes, and with none of those no line
    ends inside quotes. The scan is splittable.
    """
    return bool(quote_parity(spark, path).agg(F.bool_or("lines_odd")).first()[0])


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw articles by column name, other columns ignored.

    Rows with more or fewer fields than the header are errors, as are files whose headers
    differ. A field of nothing is NULL, one of two quotes an empty text. Where records span
    lines, the borders of records are found from the quotes, so that a large file is still
    read by many tasks. All columns are read as text: a schema would bind by position.
    """
    pieces = quote_parity(spark, path).limit(MOST_PIECES + 1).collect()
    known = len(pieces) <= MOST_PIECES
    reader = spark.read.options(**DIALECT, **STRICT, **TOLD_APART)
    if not (any(p["lines_odd"] for p in pieces) if known else has_spanning_records(spark, path)):
        rows = reader.csv(path)
    elif known:
        names = spark.read.options(**DIALECT).csv(path).columns
        rows = parsed(records(spark, path, [(p["file"], p["at"], p["odd"]) for p in pieces]), names)
    else:
        rows = reader.csv(path, multiLine=True)
    columns = [
        flag(F.col(c)).alias(c) if c == "exclude_from_housing_analysis" else F.col(c)
        for c in RAW_COLUMNS
    ]
    return rows.select(columns)


def records(spark: SparkSession, path: str, pieces: list[tuple[str, int, bool]]) -> DataFrame:
    """(file, at, first, value): the records of a CSV whose quoted fields may run over line ends.

    A line begins a record if the quotes before it in its file are even in number. Their
    parity at the start of a piece is the running sum over the `pieces` (file, at, odd) before;
    these go to all tasks, `MOST_PIECES` of them at most. Within a piece the lines of a record
    are joined where they are read; what runs over the border of pieces is put together
    after. `first` marks the first record of a file.
    """
    opened, is_open = [], {}
    for file, at, odd in sorted(pieces):
        opened.append((file, at, is_open.get(file, False)))
        is_open[file] = opened[-1][2] ^ odd
    starts = spark.createDataFrame(opened, "file string, at long, open boolean")
    parts = _lines(spark, path).join(F.broadcast(starts), ["file", "at"]).select("value", "file", "at", "open")
    parts = parts.mapInArrow(_joined, "file string, at long, kind int, value string")
    whole = parts.where(F.col("kind") <= _FIRST).select("file", "at", (F.col("kind") == _FIRST).alias("first"), "value")
    # a record cut by borders: its beginning, and what the next pieces hold of it, in their order
    order = Window.partitionBy("file").orderBy("at", F.desc("kind"))
    begins = F.col("kind").isin(_BEGINS, _BEGINS_FILE)
    cut = parts.where(F.col("kind") > _FIRST).withColumn("of", F.sum(begins.cast("int")).over(order))
    put = cut.groupBy("file", "of").agg(
        F.min("at").alias("at"),
        F.max(F.col("kind") == _BEGINS_FILE).alias("first"),
        F.array_sort(F.collect_list(F.struct("at", "value"))).alias("parts"),
    )
    put = put.select("file", "at", "first", F.array_join("parts.value", "\n").alias("value"))
    return whole.unionByName(put)


# kinds of what a task makes of the lines of a piece
_WHOLE, _FIRST, _BEGINS, _BEGINS_FILE, _GOES_ON = range(5)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of each piece joined to records, and what is cut by its borders."""
    piece, held, state = None, [], {}

    def closed() -> list:
        """What is left at the end of a piece: a record that ends with it, or one that is cut."""
        if not held:
            return []
        if state["open"]:
            kind = _GOES_ON if state["tail"] else _BEGINS_FILE if state["first"] else _BEGINS
        else:
            kind = _GOES_ON if state["tail"] else _FIRST if state["first"] else _WHOLE
        out = [(*piece, kind, "\n".join(held))]
        held.clear()
        return out

    for batch in batches:
        out = []
        odd = (pc.count_substring(batch.column(0), '"').to_numpy(zero_copy_only=False) & 1).tolist()
        for value, file, at, starts_open, flips in zip(*(c.to_pylist() for c in batch.columns), odd):
            if piece != (file, at):
                out += closed()
                piece, state = (file, at), {"open": starts_open, "tail": starts_open, "first": at == 0}
            elif held and not state["open"]:  # the record before ended with the line before
                out += closed()
                state["tail"] = state["first"] = False
            held.append(value)
            state["open"] ^= bool(flips)
        yield _rows(out)
    yield _rows(closed())


def _rows(found: list[tuple]) -> pa.RecordBatch:
    types = {"file": pa.string(), "at": pa.int64(), "kind": pa.int32(), "value": pa.string()}
    columns = list(zip(*found)) or [()] * len(types)
    return pa.RecordBatch.from_pydict({n: pa.array(c, t) for (n, t), c in zip(types.items(), columns)})


def parsed(found: DataFrame, names: list[str]) -> DataFrame:
    """Records split into named columns of text; every file must begin with these names."""
    value = F.regexp_replace("value", "\r\\z", "")
    fields = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    options = {**{k: str(v) for k, v in DIALECT.items() if k != "header"}, **TOLD_APART, "mode": "FAILFAST", "multiLine": "true"}
    split = F.from_csv(F.col("line"), fields, options)
    rows = found.select("first", value.alias("line")).where(F.col("line") != "").select("first", split.alias("row"))
    same = F.lit(True)
    for n in names:
        same &= F.col("row").getField(n).eqNullSafe(F.lit(n))
    header = F.when(~F.col("first"), True).when(same, False).otherwise(
        F.raise_error(F.lit("CSV header does not conform: the files of a delivery have different headers"))
    )
    return rows.where(header).select("row.*")


def write_raw_csv(raw: DataFrame, path: str) -> None:
    """Raw articles as CSV files of the same dialect, all text kept as it is."""
    (
        raw.select(RAW_COLUMNS)
        .write.mode("overwrite")
        .options(**DIALECT, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )
