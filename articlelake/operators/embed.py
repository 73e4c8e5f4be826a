"""Batched model inference over a table of texts, resumable from saved vectors."""

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articlelake.functions import text
from articlelake.operators import keysets, pacing
from articlelake.schemas import (
    EMBED_BATCH_SIZE,
    EMBED_CHECKPOINT_EVERY,
    EMBED_WAITS_SECONDS,
)

KEYS = ["chunk_id", "text_hash"]
_PARTS = ["title", "topics", "content_chunk"]
VECTOR_COLUMNS = ["chunk_id", "text_hash", "model", "dimension", "embedding"]
VECTOR_SCHEMA = (
    "chunk_id string, text_hash string, model string, dimension int, embedding array<float>"
)


def text_hash(c: Column) -> Column:
    """Identifies the embedded text, so that an edited text is embedded anew."""
    return F.sha2(c, 256)


def embed_rows(
    pending: DataFrame,
    connect: Callable[[], Callable[[list[str]], list[list[float]]]],
    model: str,
    batch_size: int = EMBED_BATCH_SIZE,
    requests_per_minute: float | None = None,
    parallel: int = 1,
    dimension: int | None = None,
    waits: Sequence[float] = EMBED_WAITS_SECONDS,
    wait_first: bool = False,
    sleep: Callable[[float], None] = time.sleep,
    clock: Callable[[], float] = time.monotonic,
    tokens_per_minute: float | None = None,
    count_tokens: Callable[[str], int] = pacing.words,
    paced_since: Callable[[], pacing.State | None] = lambda: None,
) -> DataFrame:
    """Vectors for (chunk_id, text_hash, retrieval_text) rows, in their partitions.

    `connect()` makes one client per task, which maps a list of texts to their vectors.
    A request that fails is made again after each of `waits`; a failure after the last is
    raised. A response is checked before it is handed on: as many vectors as texts, all of
    `dimension` values if one is asked for. Limits on requests and on tokens are shared out
    over `parallel` partitions, as many as the rows may have: each starts requests that many
    times further apart, and waits for its share of the tokens. `wait_first` keeps the
    distance to requests made just before. Requests that are made again are not paced. Where
    one sequence of requests is cut over partitions, `paced_since()` tells a task the state
    of the limits before its first request.
    """
    pace = pacing.Pace(requests_per_minute, tokens_per_minute, parallel, count_tokens)
    emit_every = EMBED_CHECKPOINT_EVERY * batch_size
    columns = VECTOR_COLUMNS

    def requests(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # whole batches, across Arrow batch borders
        held = None
        for frame in rows:
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            whole = len(held) - len(held) % batch_size
            for i in range(0, whole, batch_size):
                yield held.iloc[i : i + batch_size]
            held = held.iloc[whole:]
        if held is not None and len(held):
            yield held

    def respond(embed, texts):
        schedule = iter(waits)
        vectors = None
        while vectors is None:
            try:
                vectors = list(embed(texts))
            except Exception:
                wait = next(schedule, None)
                if wait is None:
                    raise
                sleep(wait)
        if len(vectors) != len(texts):
            raise ValueError(f"{len(vectors)} vectors for {len(texts)} texts")
        wrong = [len(v) for v in vectors if dimension is not None and len(v) != dimension]
        if wrong:
            raise ValueError(f"embedding_dimension: {wrong[0]} values instead of {dimension}")
        return vectors

    def run(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        embed = connect()
        limiter = pace.limiter(clock, sleep, wait_first, paced_since())
        ids, hashes, vectors = [], [], []

        def made() -> pd.DataFrame:
            parts = {"chunk_id": ids, "text_hash": hashes, "model": model, "dimension": list(map(len, vectors))}
            return pd.DataFrame({**parts, "embedding": vectors})[columns]

        for batch in requests(rows):
            texts = batch["retrieval_text"].tolist()
            limiter.start(texts)
            vectors += respond(embed, texts)
            ids += batch["chunk_id"].tolist()
            hashes += batch["text_hash"].tolist()
            if len(ids) >= emit_every:
                yield made()
                ids, hashes, vectors = [], [], []
        if ids:
            yield made()

    return pending.mapInPandas(run, VECTOR_SCHEMA)


def in_sequence(
    rows: DataFrame, order_by: list[str], batch_size: int, parts: int, stage: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, int]:
    """The rows with their place in an order and their `request`, both from 0; and the requests of each of `parts`.

    Ranges of the order are chosen from samples, so `stage` must write the rows to a table;
    a row's place is its place in its range, after those of the ranges before.
    """
    ranged = rows.repartitionByRange(parts, *order_by).sortWithinPartitions(*order_by)
    place = F.monotonically_increasing_id()
    ranged = stage(
        ranged.withColumns(
            {"_range": F.shiftright(place, 33).cast("int"), "_nth": place.bitwiseAND(F.lit((1 << 33) - 1))}
        )
    )
    held = {r["_range"]: r["count"] for r in ranged.groupBy("_range").count().collect()}  # of `parts` ranges
    before, offsets = 0, []
    for n in range(parts):
        offsets.append(before)
        before += held.get(n, 0)
    each = max(1, -(-before // (batch_size * parts)))
    place = F.element_at(F.lit(offsets).cast("array<bigint>"), F.col("_range") + 1) + F.col("_nth")
    request = F.expr(f"place div {batch_size}")
    return ranged.withColumn("place", place).select(*rows.columns, "place", request.alias("request")), each


def by_requests(sequence: DataFrame, parts: int, each: int) -> DataFrame:
    """The rows of `in_sequence` as `embed_rows` takes them: partition i begins with request i times `each`."""
    dealt = sequence.repartitionById(parts, F.expr(f"cast(request div {each} as int)"))
    return dealt.sortWithinPartitions("place").select("chunk_id", "text_hash", "retrieval_text")


def to_embed(chunks: DataFrame) -> DataFrame:
    """The columns a request needs."""
    return chunks.select(
        "chunk_id", text_hash(F.col("retrieval_text")).alias("text_hash"), "retrieval_text"
    )


def usable(vectors: DataFrame, model: str, dimension: int | None = None) -> DataFrame:
    """Saved vectors of the model, and of the length asked for."""
    own = vectors.where(F.col("model") == model)
    return own if dimension is None else own.where(F.col("dimension") == dimension)


def pending(
    chunks: DataFrame,
    vectors: DataFrame,
    model: str,
    dimension: int | None = None,
    stage: Callable[[DataFrame], DataFrame] = lambda keys: keys,
) -> DataFrame:
    """Rows of `to_embed` that have no usable saved vector yet.

    Keys decide, and the texts stay where they are: no exchange carries one. `stage` may
    write the keys to a table and hand that back, as they are read several times.
    """
    done = usable(vectors, model, dimension).select(KEYS)
    return keysets.without(to_embed(chunks), done, KEYS, stage)


def hashed(chunks: DataFrame) -> DataFrame:
    """The chunks with the hash of their `retrieval_text`, and without it where it can be built again."""
    with_hash = chunks.withColumn("text_hash", text_hash(F.col("retrieval_text")))
    return with_hash.drop("retrieval_text") if set(_PARTS) <= set(chunks.columns) else with_hash


def restored(rows: DataFrame) -> DataFrame:
    """`hashed` rows with their `retrieval_text`, which must hash to what it was."""
    if "retrieval_text" in rows.columns:
        return rows
    built = text.retrieval_text(*map(F.col, _PARTS))
    kept = F.when(text_hash(built) == F.col("text_hash"), built).otherwise(
        F.raise_error(F.lit("retrieval_text: a passage is not made of its own columns"))
    )
    return rows.withColumn("retrieval_text", kept)


def attach(
    chunks: DataFrame, vectors: DataFrame, model: str, dimension: int | None = None
) -> DataFrame:
    """The chunks with their `embedding`, NULL where none was saved.

    Two runs may both have saved a vector; one of them is taken. The text of a chunk goes
    through the join once: `retrieval_text` holds it a second time, so it is left out where
    it can be built again, and must then hash to what it was.
    """
    return attach_hashed(hashed(chunks), vectors, model, dimension).select(*chunks.columns, "embedding")


def attach_hashed(
    rows: DataFrame, vectors: DataFrame, model: str, dimension: int | None = None
) -> DataFrame:
    """`hashed` rows with `retrieval_text` and `embedding`. Rows bucketed by `KEYS` are not shuffled."""
    saved = usable(vectors, model, dimension).groupBy(KEYS)
    saved = saved.agg(F.first("embedding").alias("embedding"))
    return restored(rows.join(saved, KEYS, "left"))


def attach_by_key(left: DataFrame, vectors: DataFrame, key: str) -> DataFrame:
    """Left rows with the embedding saved under the same key."""
    return left.join(vectors.select(key, "embedding"), key, "left")


def checked(embedded: DataFrame, dimension: int | None) -> DataFrame:
    """The same rows, failing the task on a missing or wrongly sized embedding."""
    e = F.col("embedding")
    guarded = F.when(e.isNull(), F.raise_error(F.lit("missing_embedding: a passage has no vector")))
    if dimension is not None:
        guarded = guarded.when(
            F.array_size(e) != dimension,
            F.raise_error(F.lit(f"embedding_dimension: a vector has not {dimension} values")),
        )
    return embedded.withColumn("embedding", guarded.otherwise(e))


def sample(chunks: DataFrame, n: int) -> DataFrame:
    """The first n passages by article and position: a top-n, not a full sort."""
    return chunks.orderBy("article_id", "chunk_index").limit(n)
