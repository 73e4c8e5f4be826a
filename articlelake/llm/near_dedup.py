"""Near-duplicate documents by an LSH forest of minhash signatures, confirmed on full sets.

Texts with equal shingle sets form one node, so copies cost nothing further. Every tree of
the forest sorts the nodes by another order of the signature's values. Nodes that agree in
the first `DEPTH` values lie in one region of a tree, and only regions of two or more nodes
go on:

1. Neighbours in each sorted order, which share the longest prefixes, are candidates.
   Candidates are confirmed on the full sets, and confirmed links give components. A region
   of thousands of near copies becomes one component here, with as many pairs as nodes.
2. Regions that still hold several components are put together to clusters where they share
   nodes. In a cluster, the sets of the nodes outside the largest component meet those of
   all nodes of other components, block by block, and only links come out. So no link
   between nodes of a region is lost. A cluster in which more than `CROWDED` nodes lie
   outside its largest component is first regrouped by rare shingles: of two similar sets
   the rarest (100 - percent) % share a shingle, whatever the order of rarity. Nodes that
   share one stay together and are compared as above, so this loses no link either;
   unrelated texts with common passages come apart.

A pair of similarity s shares a region of some tree unless all of `TREES` trees part it, with
probability (1 - s**DEPTH)**TREES: 2e-8 at 0.85, 3e-6 at 0.8. In step 1 a signature rules a
pair out by five standard deviations; in step 2 none is ruled out.

Null and empty texts, and texts without words, have an empty set and are linked with
nothing. A row without doc_id takes no part: its component is null, and it is kept. Rows
with the same doc_id each count with their own text. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articlelake.llm import shingles
from articlelake.llm.frames import numbers, rows, shuffle_partitions, slices, stored, text_bytes, texts

WIDTH = 5
PERCENT = 80
TREES = 24
DEPTH = 4
VALUES = TREES * DEPTH
CROWDED = 16384
RARITY_BITS = 18
BLOCK = 512
_ROLLS = [(np.arange(VALUES) + DEPTH * t) % VALUES for t in range(TREES)]

_SKETCHES = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("fp1", pa.int64()), ("fp2", pa.int64()), ("signature", pa.binary())]
)
_PAIRS = pa.schema([("a1", pa.int64()), ("a2", pa.int64()), ("b1", pa.int64()), ("b2", pa.int64())])
_PAIRS_SQL = "a1 long, a2 long, b1 long, b2 long"
_KEY = ["fp1", "fp2"]


def sketches(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Set size, fingerprint and signature of each of `texts`."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingles.shingle_sets(*text_bytes(batch.column("text")), width)
            prints = shingles.fingerprints(sets)
            signed = shingles.signatures(sets, VALUES).astype(">u4")
            yield rows(
                _SKETCHES,
                doc_id=batch.column("doc_id"),
                n_shingles=[len(s) for s in sets],
                fp1=prints[:, 0],
                fp2=prints[:, 1],
                signature=[s.tobytes() for s in signed],
            )

    return docs.mapInArrow(sketch, "doc_id long, n_shingles long, fp1 long, fp2 long, signature binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=">u4").reshape(-1, VALUES)


def trees(nodes: DataFrame) -> DataFrame:
    """A row per node and tree: `region` (the first DEPTH values and the tree), `tree` and the node's key."""
    fields = "tree int, region long, fp1 long, fp2 long"
    schema = pa.schema([("tree", pa.int32()), ("region", pa.int64()), ("fp1", pa.int64()), ("fp2", pa.int64())])

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1 << 20):
            regions = _regions(_matrix(batch.column("signature")), DEPTH)
            n = batch.num_rows
            yield rows(
                schema,
                tree=np.repeat(np.arange(TREES, dtype=np.int32), n),
                region=regions.T.ravel(),
                fp1=np.tile(numbers(batch.column("fp1")), TREES),
                fp2=np.tile(numbers(batch.column("fp2")), TREES),
            )

    return nodes.select("fp1", "fp2", "signature").mapInArrow(plant, fields)


def _regions(signature: np.ndarray, depth: int) -> np.ndarray:
    """Key of the region of each node in each tree."""
    out = np.empty((len(signature), TREES), dtype=np.uint64)
    for tree, roll in enumerate(_ROLLS):
        key = np.full(len(signature), tree + 1, dtype=np.uint64)
        for value in signature[:, roll[:depth]].T.astype(np.uint64):
            key = shingles.mixed(key ^ value) * np.uint64(0x9E3779B97F4A7C15)
        out[:, tree] = key
    return out.view(np.int64)


def _least(percent: int) -> float:
    """Agreement of signatures below which a pair is ruled out."""
    s = percent / 100
    return s - 5 * (s * (1 - s) / VALUES) ** 0.5


def neighbours(members: DataFrame, percent: int) -> DataFrame:
    """Neighbouring nodes of a region in the sorted order of its tree, that may be similar."""
    n = shuffle_partitions(members.sparkSession)
    rolled = F.concat(
        F.substring("signature", F.col("tree") * (4 * DEPTH) + 1, F.lit(4 * VALUES)), F.substring("signature", F.lit(1), F.col("tree") * (4 * DEPTH))
    )
    sort = ["tree", "order", *_KEY]
    ordered = members.withColumn("order", rolled).select(*sort, "region", "n_shingles")
    ordered = ordered.repartitionByRange(n, *sort).sortWithinPartitions(*sort)
    least = _least(percent)

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            batch = pa.Table.from_batches([batch] if last is None else [last, batch]).combine_chunks().to_batches()[0]
            last = batch.slice(batch.num_rows - 1)
            order, size, region = _matrix(batch.column("order")), numbers(batch.column("n_shingles")), numbers(batch.column("region"))
            alike = (order[1:] == order[:-1]).mean(axis=1) >= least
            small, large = np.minimum(size[1:], size[:-1]), np.maximum(size[1:], size[:-1])
            at = np.flatnonzero(alike & (region[1:] == region[:-1]) & (100 * small >= percent * large))
            keys = [numbers(batch.column(k)) for k in _KEY]
            yield rows(_PAIRS, a1=keys[0][at], a2=keys[1][at], b1=keys[0][at + 1], b2=keys[1][at + 1])

    return ordered.mapInArrow(pair, _PAIRS_SQL)


def _in_order(pairs: DataFrame) -> DataFrame:
    """Distinct pairs, the smaller key first."""
    a, b = _node("a1", "a2"), _node("b1", "b2")
    ordered = pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    return ordered.select(*(F.col(f"{side}.fp{i}").alias(f"{side}{i}") for side in "ab" for i in (1, 2))).distinct()


def _node(first: str, second: str) -> Column:
    return F.struct(F.col(first).alias("fp1"), F.col(second).alias("fp2"))


def full_sets(docs: DataFrame, members: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """The shingle set of each node that shares a region, from the text of its first document."""
    wanted = members.select(*_KEY).distinct().join(nodes.select(*_KEY, "first_id"), _KEY)
    schema = pa.schema([("fp1", pa.int64()), ("fp2", pa.int64()), ("shingles", pa.binary())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingles.shingle_sets(*text_bytes(batch.column("text")), width)
            prints = shingles.fingerprints(sets)
            # rows with the same doc_id may have other texts
            own = (prints[:, 0] == numbers(batch.column("fp1"))) & (prints[:, 1] == numbers(batch.column("fp2")))
            yield rows(schema, fp1=prints[own, 0], fp2=prints[own, 1], shingles=[s.tobytes() for s, o in zip(sets, own) if o])

    texts_of = docs.withColumnRenamed("doc_id", "first_id").join(wanted, "first_id")
    found = texts_of.select("text", *_KEY).mapInArrow(make, "fp1 long, fp2 long, shingles binary")
    return found.dropDuplicates(_KEY)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sets are similar: 100 * intersection >= percent * union."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep = []
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                a, b = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(_PAIRS.names).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("fp1").alias("a1"), F.col("fp2").alias("a2"), F.col("shingles").alias("a"))
    right = sets.select(F.col("fp1").alias("b1"), F.col("fp2").alias("b2"), F.col("shingles").alias("b"))
    both = pairs.join(left, ["a1", "a2"]).join(right, ["b1", "b2"])
    return both.select(*_PAIRS.names, "a", "b").mapInArrow(compare, _PAIRS_SQL)


def components(links: DataFrame) -> DataFrame:
    """fp1, fp2, component of every linked node; a component is named by one of its keys.

    Rounds of contraction: each node joins the neighbour of least rank, itself included,
    where ranks are drawn anew each round, and edges inside a group vanish. The number of
    edges falls by a constant factor a round, whatever the shape; each round is written.
    """
    edges = stored(links.select(_node("a1", "a2").alias("u"), _node("b1", "b2").alias("v")), "edges")
    names = None
    turn = 0
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("r"), F.col(c).alias("node"))  # noqa: E731, B023
        least = both.groupBy("u").agg(F.min(rank("v")).alias("v_rank"))
        joined = least.select("u", F.least(rank("u"), F.col("v_rank"))["node"].alias("to"))
        joined = stored(joined, "components")
        names = joined.withColumnRenamed("u", "node") if names is None else _followed(names, joined)
        names = stored(names, "components")
        to_v = joined.select(F.col("u").alias("v"), F.col("to").alias("to_v"))
        edges = edges.join(joined, "u").join(to_v, "v").select(F.col("to").alias("u"), F.col("to_v").alias("v"))
        edges = stored(edges.where("u != v").distinct(), "edges")
        turn += 1
    if names is None:
        return links.select(F.col("a1").alias("fp1"), F.col("a2").alias("fp2"), _node("a1", "a2").alias("component")).limit(0)
    return names.select("node.fp1", "node.fp2", F.col("to").alias("component"))


def _followed(names: DataFrame, joined: DataFrame) -> DataFrame:
    onward = joined.select(F.col("u").alias("to"), F.col("to").alias("further"))
    return names.join(onward, "to", "left").select("node", F.coalesce("further", "to").alias("to"))


def across_components(members: DataFrame, named: DataFrame, sets: DataFrame, percent: int) -> Iterator[DataFrame]:
    """Links between nodes that share a region and lie in different components.

    Yields twice at most: crowded clusters come back regrouped by rare shingles.
    """
    own = _node("fp1", "fp2")
    pending = members.select(*_KEY, "region").join(named, _KEY, "left").withColumn("component", F.coalesce("component", own))
    for regrouped in (False, True):
        parts = pending.groupBy("region").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        several = stored(pending.join(parts.where("low != high").select("region"), "region"), "regions")
        if several.isEmpty():
            return
        tied = several.select(F.col("fp1").alias("a1"), F.col("fp2").alias("a2"), F.col("region").alias("b1"), F.lit(0).cast("long").alias("b2"))
        clusters = components(tied).withColumnRenamed("component", "cluster")
        inside = stored(several.select(*_KEY, "component").distinct().join(clusters, _KEY), "clusters")
        sizes = inside.groupBy("cluster", "component").count()
        sizes = sizes.groupBy("cluster").agg(F.sum("count").alias("n"), F.max(F.struct("count", "component")).alias("largest"))
        sizes = sizes.select("cluster", "n", F.col("largest.component").alias("main"), (F.col("n") - F.col("largest.count")).alias("others"))
        sizes = stored(sizes, "clusters")
        now = sizes if regrouped else sizes.where(F.col("others") <= CROWDED)
        yield _tiles(inside.join(now, "cluster").join(sets, _KEY), percent)
        crowded = sizes.where(F.col("others") > CROWDED)
        if regrouped or crowded.isEmpty():
            return
        again = stored(inside.join(crowded.select("cluster"), "cluster").join(sets, _KEY), "crowded")
        pending = stored(_by_rare_shingles(again, percent), "crowded")


def _slots(shingle: np.ndarray) -> np.ndarray:
    return (shingle >> np.uint64(64 - RARITY_BITS)).astype(np.int64)


def _frequencies(nodes: DataFrame) -> np.ndarray:
    """How many shingles of the sets fall in each slot of hashes, which ranks them by rarity."""
    schema = pa.schema([("slot", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << RARITY_BITS, dtype=np.int64)
        for batch in batches:
            found = np.frombuffer(b"".join(batch.column("shingles").to_pylist()), dtype=np.uint64)
            total += np.bincount(_slots(found), minlength=len(total))
        at = np.flatnonzero(total)
        yield rows(schema, slot=at, n=total[at])

    counted = nodes.select("shingles").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << RARITY_BITS, dtype=np.int64)
    out[counted["slot"].to_numpy()] = counted["n"].to_numpy()
    return out


def _by_rare_shingles(nodes: DataFrame, percent: int) -> DataFrame:
    """A row per node and shingle of its rarest; `region` is the shingle in its cluster.

    Sets of a and b shingles that are similar share percent % of a and of b at least, so they
    share one of the first a - percent % of a + 1 and b - percent % of b + 1 in any order of
    all shingles. The order is by frequency, for these are the shortest lists.
    """
    frequency = _frequencies(nodes)
    schema = pa.schema([("nth", pa.int64()), ("shingle", pa.int64())])

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            nth, held = [], []
            for n, shingle in enumerate(batch.column("shingles").to_pylist()):
                shingle = np.frombuffer(shingle, dtype=np.uint64)
                first = len(shingle) - -(-percent * len(shingle) // 100) + 1
                own = shingle[np.lexsort((shingle, frequency[_slots(shingle)]))[:first]]
                nth.append(np.full(len(own), n))
                held.append(own.view(np.int64))
            at = rows(schema, nth=np.concatenate(nth), shingle=np.concatenate(held))
            others = batch.select(names).take(at.column("nth"))
            yield pa.RecordBatch.from_arrays([*others.columns, at.column("shingle")], names=[*names, "shingle"])

    names = [*_KEY, "component", "cluster"]
    fields = T.StructType([*nodes.select(*names).schema.fields, T.StructField("shingle", T.LongType())])
    return nodes.select(*names, "shingles").mapInArrow(rarest, fields).select(*_KEY, F.xxhash64("cluster", "shingle").alias("region"), "component")


def _tiles(members: DataFrame, percent: int) -> DataFrame:
    """Links from the nodes outside the main component of each cluster, by blocks of both sides."""
    row = F.xxhash64("fp2", "fp1")
    blocks = lambda count: F.ceil(count / BLOCK).cast("int")
    across, down = blocks(F.col("others")), blocks(F.col("n"))
    every = lambda count: F.explode(F.sequence(F.lit(0), count - 1))
    # columns of their own on both sides, which come from the same table
    held = [F.xxhash64("cluster").alias("cluster"), *(F.col(c).alias(c) for c in (*_KEY, "shingles")), F.xxhash64("component").alias("component")]
    left = members.where("component != main").select(*held, F.pmod(row, across).cast("int").alias("i"), every(down).alias("j"))
    right = members.select(*held, (F.col("component") == F.col("main")).alias("in_main"), F.pmod(row, down).cast("int").alias("j"), every(across).alias("i"))

    def tile(a: pa.Table, b: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if a.num_rows and b.num_rows:
            sets_a, sets_b = ([np.frombuffer(x, dtype=np.uint64) for x in t["shingles"].to_pylist()] for t in (a, b))
            part_a, part_b = (t["component"].to_numpy() for t in (a, b))
            keys_a, keys_b = (list(zip(*(t[k].to_pylist() for k in _KEY))) for t in (a, b))
            in_main, size_b = np.array(b["in_main"].to_pylist()), np.array([len(x) for x in sets_b])
            known, number = np.unique(np.concatenate(sets_b), return_inverse=True)
            begins = np.cumsum(size_b) - size_b
            for own, part, key in zip(sets_a, part_a, keys_a):
                # of two nodes outside the main component, the smaller key looks for the other
                wanted = (part_b != part) & (in_main | np.array([key < k for k in keys_b]))
                wanted &= 100 * np.minimum(size_b, len(own)) >= percent * np.maximum(size_b, len(own))
                if not wanted.any():
                    continue
                at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                holds = np.zeros(len(known), dtype=np.int32)
                holds[at[known[at] == own]] = 1
                common = np.add.reduceat(holds[number], begins)
                for i in np.flatnonzero(wanted & (100 * common >= percent * (size_b + len(own) - common))).tolist():
                    out.append((*key, *keys_b[i]))
        return pa.table(dict(zip(_PAIRS.names, map(list, zip(*out)) if out else [[]] * 4)), schema=_PAIRS)

    group = ["cluster", "i", "j"]
    return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(tile, _PAIRS_SQL)


def near_duplicates(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of `docs`."""
    docs = texts(docs, id_column, text_column)
    all_sketches = stored(sketches(docs, width), "sketches")
    named = all_sketches.where("doc_id IS NOT NULL AND n_shingles > 0")
    nodes = stored(
        named.groupBy(*_KEY).agg(F.min("doc_id").alias("first_id"), F.min("n_shingles").alias("n_shingles"), F.min("signature").alias("signature")), "nodes"
    )
    planted = stored(trees(nodes), "trees")
    shared = planted.groupBy("region").count().where("count > 1").select("region")
    members = planted.join(shared, "region").join(nodes.select(*_KEY, "signature", "n_shingles"), _KEY)
    members = stored(members, "regions")

    sets = stored(full_sets(docs, members, nodes, width), "sets")
    pairs = stored(_in_order(neighbours(members, percent)), "pairs")
    links = stored(confirmed(pairs, sets, percent), "links")
    found = first = stored(components(links), "components")
    for more in across_components(members, first, sets, percent):
        more = stored(more, "links")
        if not more.isEmpty():
            links = links.union(more)
            found = None
    found = stored(components(links), "components") if found is None else found

    least = found.join(nodes, _KEY).groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_node = nodes.select(*_KEY, "first_id").join(found.join(least, "component").select(*_KEY, "component_id"), _KEY, "left")
    of_node = of_node.select(*_KEY, F.coalesce("component_id", "first_id").alias("component_id"))
    out = all_sketches.select("doc_id", "n_shingles", *_KEY).join(of_node, _KEY, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", _kept(F.col("doc_id"), F.col("component_id")))


def _kept(doc_id: Column, component_id: Column) -> Column:
    return F.coalesce(doc_id == component_id, F.lit(True))
