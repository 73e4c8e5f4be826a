"""Jobs: each reads tables, audits them and publishes one stage.

Audits run before the write, over the slim columns they need; content checks ride along
with the write. Single-path jobs write beside their target and take its place when all is
done, lake jobs replace one partition as they commit. So a failing job publishes nothing
and removes nothing but what it wrote itself.
"""

import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from articlelake.errors import IntegrityError
from articlelake.functions.packing import Sizes
from articlelake.functions.tokens import Tokenizer
from articlelake.operators import batches, embed, pacing, quality
from articlelake.operators.batches import Batch
from articlelake.operators.chunk import chunk_articles
from articlelake.operators.clean import clean_articles
from articlelake.operators.flatten import flatten_articles
from articlelake.runtime import run_folder, spread
from articlelake.schemas import (
    BASE_COLUMNS,
    CHUNK_COLUMNS,
    EMBED_BATCH_SIZE,
    EMBED_CHECKPOINT_EVERY,
    EMBED_REQUESTS_PER_MINUTE,
    EMBED_TOKENS_PER_MINUTE,
    MAX_CHUNK_TOKENS,
    OVERLAP_TOKENS,
    RAW_COLUMNS,
    TARGET_CHUNK_TOKENS,
)
from articlelake.sources import lake as lakes
from articlelake.sources.csv import read_raw_csv
from articlelake.sources.lake import Lake

OFFENDERS_SHOWN = 20
INDEX = "article_ids"
# what a task wrote is in place when the task ends, and stays if the job is lost later
AS_TASKS_END = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


@dataclass(frozen=True)
class Chunking:
    """The sizes count what the tokenizer counts, so it has no default: 350 words are more
    than 350 tokens of most models."""

    tokenizer: Tokenizer
    sizes: Sizes = Sizes(TARGET_CHUNK_TOKENS, MAX_CHUNK_TOKENS, OVERLAP_TOKENS)

    def apply(self, base: DataFrame) -> DataFrame:
        return chunk_articles(base, self.tokenizer, self.sizes, enforce=True)


@dataclass(frozen=True)
class Embedding:
    """A model behind `connect()`, which makes a client mapping texts to vectors.

    Vectors are saved every `save_every` requests of each of the `parallel` tasks; without a
    limit on requests there are as many tasks as cores. Both limits hold for all tasks together, the one on tokens where requests are limited;
    `count_tokens` should be the model's own count.
    """

    connect: Callable
    model: str
    dimension: int | None = None
    batch_size: int = EMBED_BATCH_SIZE
    requests_per_minute: float | None = EMBED_REQUESTS_PER_MINUTE
    parallel: int = 1
    save_every: int = EMBED_CHECKPOINT_EVERY
    tokens_per_minute: float | None = EMBED_TOKENS_PER_MINUTE
    count_tokens: Callable[[str], int] = pacing.words
    options: dict = field(default_factory=dict)


# --- stage logic over DataFrames ----------------------------------------------


def audited_base(raw: DataFrame, batch: Batch | None = None) -> DataFrame:
    """The cleaned articles of a raw table that passes every guard, else an error."""
    period = (batch.start_date, batch.end_date) if batch else None
    counts = quality.audit_raw(raw, period)
    base = clean_articles(raw, batch.batch_id if batch else None)
    detail = {}
    if counts.get("out_of_batch_range"):
        outside = quality.out_of_range(base, *period).take(OFFENDERS_SHOWN)
        detail["out_of_batch_range"] = (
            f"{batch.batch_id!r} covers {period[0]} to {period[1]}, but has for example "
            f"{[tuple(map(str, r)) for r in outside]}"
        )
    quality.enforce(counts, detail)
    return base


def audited_flat(base: DataFrame) -> DataFrame:
    quality.enforce(quality.flatten_guard(base).first().asDict())
    return flatten_articles(base)


def audited_chunks(base: DataFrame, chunking: Chunking) -> DataFrame:
    # whether the rows of a repeated id have text matters only if there is one
    if not quality.duplicate_values(base, "article_id").isEmpty():
        quality.enforce(quality.duplicate_chunk_articles(base).first().asDict())
    return chunking.apply(spread(base, "article_id"))


def staged(df: DataFrame, folder: str) -> DataFrame:
    """The rows written to and read from a folder."""
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def embed_all(
    spark: SparkSession,
    chunks: DataFrame,
    vectors: str,
    embedding: Embedding,
    folder: str | None = None,
) -> DataFrame:
    """A chunk table with embeddings; vectors are saved in waves, and resumed.

    The chunks are laid out once by their keys, in buckets: what is pending is then found
    and vectors are attached without moving a text again. What has no usable vector yet is
    dealt by a hash of its key into waves of one save interval, so a lost run repeats one
    wave whatever the size of the table. Without a limit to share there is one wave, written
    where it lies into files of one save interval: each is a task, whose vectors are saved as
    it ends, so a lost run repeats the intervals that were under way. The layout lies in
    `folder`, which the caller removes when the rows have been read.
    """
    paced = embedding.requests_per_minute is not None
    parallel = embedding.parallel
    model, dimension = embedding.model, embedding.dimension
    rows = laid_out(embed.hashed(chunks), embed.KEYS, folder or run_folder(spark, "laid-out"))
    done = embed.usable(read_vectors(spark, vectors), model, dimension).select(embed.KEYS)
    missing = rows.join(done, embed.KEYS, "left_anti")
    todo = embed.restored(missing).select("chunk_id", "text_hash", "retrieval_text")
    interval = embedding.batch_size * embedding.save_every

    def save(part: DataFrame, **pace) -> None:
        made = embed.embed_rows(
            part,
            embedding.connect,
            model,
            embedding.batch_size,
            embedding.requests_per_minute,
            dimension=dimension,
            count_tokens=embedding.count_tokens,
            **pace,
            **embedding.options,
        )
        made.write.mode("append").options(**AS_TASKS_END).parquet(vectors)

    with lakes.scratch(spark, "pending") as scratch:
        if paced:
            waves = math.ceil(missing.select(embed.KEYS).count() / (interval * parallel))
        else:
            waves = 0
            todo.write.option("maxRecordsPerFile", interval).parquet(scratch)
            with lakes.settings(spark, _file_a_task(spark)):
                save(spark.read.schema(todo.schema).parquet(scratch))
        if waves:
            deal = {"wave": (F.lit(0), waves), "slot": (F.lit(1), parallel)}
            dealt = todo.withColumns({c: F.pmod(F.xxhash64(s, *embed.KEYS), F.lit(k)) for c, (s, k) in deal.items()})
            dealt.repartition("wave", "slot").write.partitionBy("wave", "slot").parquet(scratch)
        started = False
        for n in range(waves):
            if not lakes.exists(spark, f"{scratch}/wave={n}"):
                continue
            part = spark.read.schema(todo.schema).parquet(f"{scratch}/wave={n}/*")
            save(
                part.coalesce(parallel),
                parallel=parallel,
                wait_first=started,
                tokens_per_minute=embedding.tokens_per_minute,
            )
            started = True

    saved = read_vectors(spark, vectors)
    if dimension is None:
        _require_uniform(rows, saved, model)
    attached = embed.attach_hashed(rows, saved, model, dimension)
    return embed.checked(attached.select(*chunks.columns, "embedding"), dimension)


def laid_out(rows: DataFrame, keys: list[str], folder: str) -> DataFrame:
    """The rows written once in buckets of their keys: joins and groups on those find them as they lie.

    The catalog is told of the buckets only while the table is opened.
    """
    spark, name = rows.sparkSession, f"laid_out_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(buckets, *keys).write.bucketBy(buckets, *keys)
    try:
        dealt.option("path", folder).saveAsTable(name)
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _file_a_task(spark: SparkSession) -> dict[str, str]:
    """Settings under which small files are not read together."""
    return {"spark.sql.files.openCostInBytes": spark.conf.get("spark.sql.files.maxPartitionBytes")}


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Vectors saved so far, none where nothing was."""
    if not lakes.exists(spark, path):
        return spark.createDataFrame([], embed.VECTOR_SCHEMA)
    return spark.read.schema(embed.VECTOR_SCHEMA).parquet(path)


def _require_uniform(rows: DataFrame, saved: DataFrame, model: str) -> None:
    """One length over the vectors in use; only keys and lengths are read."""
    in_use = embed.usable(saved, model).join(rows.select(embed.KEYS), embed.KEYS, "left_semi")
    lengths = in_use.agg(F.min("dimension").alias("low"), F.max("dimension").alias("high")).first()
    if lengths.low != lengths.high:
        raise IntegrityError(
            f"embedding_dimension: lengths run from {lengths.low} to {lengths.high}"
        )


# --- single-path jobs -----------------------------------------------------------


def clean_job(spark: SparkSession, csv: str, output: str, batch_id: str | None = None) -> None:
    batch = batches.resolve(spark, batch_id) if batch_id else None
    with lakes.scratch(spark, "raw") as folder:
        raw = staged(read_raw_csv(spark, csv), folder)
        lakes.publish(audited_base(raw, batch), output)


def flatten_job(spark: SparkSession, base: str, output: str) -> None:
    lakes.publish(audited_flat(spark.read.parquet(base)), output)


def chunk_job(spark: SparkSession, base: str, output: str, chunking: Chunking) -> None:
    lakes.publish(audited_chunks(spark.read.parquet(base), chunking), output)


def embed_job(
    spark: SparkSession,
    chunks: str,
    output: str,
    embedding: Embedding,
    limit: int | None = None,
) -> None:
    """Embed a chunk table, or its first `limit` passages into an output of their own.

    The vectors saved on the way stay beside the output until it is published.
    """
    table, target = spark.read.parquet(chunks), output
    with lakes.scratch(spark, "sample") as folder:
        if limit is not None:
            table, target = staged(embed.sample(table, limit), folder), sample_path(output)
        vectors = f"{target}.checkpoint"
        with lakes.scratch(spark, "laid-out") as layout:
            lakes.publish(embed_all(spark, table, vectors, embedding, layout), target)
    lakes.remove(spark, vectors)


def sample_path(output: str) -> str:
    """Where a sample goes, so that it never takes the place of the full table."""
    stem = output.rstrip("/").removesuffix(".parquet")
    return f"{stem}.sample.parquet"


def run_all(
    spark: SparkSession,
    csv: str,
    folder: str,
    chunking: Chunking,
    embedding: Embedding | None = None,
) -> dict[str, str]:
    """All stages from one CSV into one folder; without an embedding it stops at chunks."""
    paths = {s: f"{folder}/{s}" for s in ("base", "flattened", "chunks", "embeddings")}
    clean_job(spark, csv, paths["base"])
    flatten_job(spark, paths["base"], paths["flattened"])
    chunk_job(spark, paths["base"], paths["chunks"], chunking)
    if embedding is None:
        return {s: p for s, p in paths.items() if s != "embeddings"}
    embed_job(spark, paths["chunks"], paths["embeddings"], embedding)
    return paths


# --- lake jobs --------------------------------------------------------------------


def stage_raw(spark: SparkSession, lake: Lake, batch: Batch, csv: str) -> DataFrame:
    """The delivery as a splittable, column-pruned table, replaced on every run."""
    raw = read_raw_csv(spark, csv).withColumns(
        {"year": F.lit(batch.year), "batch_id": F.lit(batch.batch_id)}
    )
    table = lake.staging("raw")
    if not lakes.replace_batch(raw, table, batch):
        return raw
    return lakes.read_batch(spark, table, batch, RAW_COLUMNS)


def run_batch(
    spark: SparkSession,
    lake: Lake,
    batch_id: str,
    chunking: Chunking,
    embedding: Embedding | None = None,
    dry_run: bool = False,
) -> dict[str, int]:
    """Process one delivered batch; rows published per stage.

    Names are checked before any data is read. Each stage is published as it finishes,
    so a failing embedding leaves the stages before it in place.
    """
    batch = batches.resolve(spark, batch_id)
    if dry_run:
        return {}
    delivered = batches.manifest(lakes.raw_batches(spark, lake, batch.year))
    wanted = spark.createDataFrame([(batch_id,)], "batch_id string")
    if not batches.presence(wanted, delivered).first().listed:
        raise IntegrityError(f"no delivery {batch_id!r} in {lake.raw_folder(batch.year)}")
    batches.require_no_overlap(delivered, batch)

    rows = {}
    raw = stage_raw(spark, lake, batch, lake.raw(batch))
    rows["base"] = lakes.replace_batch(
        audited_base(raw, batch), lake.stage("base"), batch
    )
    if not rows["base"]:
        for stage in ("flattened", "chunks", "embeddings"):
            lakes.remove(spark, lake.partition(stage, batch))
        return rows | {"flattened": 0, "chunks": 0}
    base = lakes.read_batch(spark, lake.stage("base"), batch, BASE_COLUMNS)
    rows["flattened"] = lakes.replace_batch(
        audited_flat(base), lake.stage("flattened"), batch
    )
    rows["chunks"] = lakes.replace_batch(
        audited_chunks(base, chunking), lake.stage("chunks"), batch
    )
    if embedding is None:
        return rows
    if not rows["chunks"]:
        lakes.remove(spark, lake.partition("embeddings", batch))
        return rows | {"embeddings": 0}
    chunks = lakes.read_batch(spark, lake.stage("chunks"), batch, CHUNK_COLUMNS)
    vectors = lakes.partition_of(lake.staging("vectors"), batch)
    with lakes.scratch(spark, "laid-out") as layout:
        embedded = embed_all(spark, chunks, vectors, embedding, layout)
        rows["embeddings"] = lakes.replace_batch(embedded, lake.stage("embeddings"), batch)
    lakes.remove(spark, vectors)
    return rows


def land_batch(
    spark: SparkSession,
    lake: Lake,
    batch_id: str,
    csv: str,
    overwrite: bool = False,
    validate: bool = True,
    dry_run: bool = False,
) -> list[str]:
    """Bring the files of a delivery into the lake as they are; returns the stages it makes stale.

    Its rows must pass every cleaning guard, nothing is kept of that trial. An existing
    delivery of the same id needs `overwrite`, and goes when the new one is complete.
    """
    batch = batches.resolve(spark, batch_id)
    with lakes.scratch(spark, "delivery") as folder:
        raw = staged(read_raw_csv(spark, csv), folder)
        if validate:
            audited_base(raw, batch)
    if dry_run:
        return []
    delivered = batches.manifest(lakes.raw_batches(spark, lake, batch.year))
    batches.require_no_overlap(delivered, batch)
    present = lakes.inventory(spark, lake, batch)
    if present["raw"] and not overwrite:
        raise IntegrityError(f"{batch_id!r} was delivered before: pass overwrite to replace it")
    arriving = f"{lake.staging('arriving')}/{uuid.uuid4().hex}"
    try:
        lakes.copy_files(spark, csv, arriving)
        lakes.swap_in(spark, arriving, lake.raw(batch))
    finally:
        lakes.remove(spark, arriving)
    return [s for s, there in present.items() if there and s != "raw"]


def index_batch(spark: SparkSession, lake: Lake, batch_id: str) -> int:
    """Keep the article ids of a processed batch in the index, in place of what it held of the batch."""
    batch = batches.resolve(spark, batch_id)
    base = lakes.read_batch(spark, lake.stage("base"), batch, ["article_id", "year"])
    return lakes.replace_batch(batches.key_index(base), lake.staging(INDEX), batch)


def repeated_articles(spark: SparkSession, lake: Lake, batch_id: str) -> DataFrame:
    """Articles of a processed batch that other indexed batches hold too: (article_id, batches).

    Reads the ids of this batch and the index, and no other article.
    """
    batch = batches.resolve(spark, batch_id)
    base = lakes.read_batch(spark, lake.stage("base"), batch, ["article_id"])
    table = lake.staging(INDEX)
    if not lakes.exists(spark, table):
        return base.select("article_id", F.lit(0).cast("bigint").alias("batches")).limit(0)
    index = lakes.read_stage(spark, table, ["article_id"])
    return batches.repeated_in(base, index.where(F.col("batch_id") != batch_id))


def retire_batch(
    spark: SparkSession, lake: Lake, batch_id: str, confirm: bool = False
) -> dict[str, bool]:
    """Remove one batch everywhere, its staging included; without `confirm` only report.

    A batch found nowhere is an error, so that a typo cannot look like success.
    """
    batch = batches.resolve(spark, batch_id)
    targets = lake.targets(batch) | {
        f"staging/{table}": lakes.partition_of(lake.staging(table), batch)
        for table in ("raw", "vectors", INDEX)
    }
    present = {name: lakes.exists(spark, path) for name, path in targets.items()}
    if not any(present.values()):
        raise IntegrityError(f"the lake holds nothing of {batch_id!r} to retire")
    if confirm:
        for name, there in present.items():
            if there:
                lakes.remove(spark, targets[name])
    return present
