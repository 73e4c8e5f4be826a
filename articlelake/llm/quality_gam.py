"""Quality of documents by a generalised additive model with pairwise interactions.

Every document becomes a few features of its whole text. Boosting goes round the features
again and again: for each in turn, a shallow tree over the feature's bins is fitted to the
gradient of the log loss and added to the feature's lookup table. Then pairs of features
that explain most of what is left get tables of their own, in the same way. A score is a
sum of table entries, so scoring is a bin search and an addition per feature.

The model is fitted in the driver on at most `SAMPLE_ROWS` labelled rows, those of least
hash of doc_id; everything else is row by row in tasks.

Nulls: a null text counts as empty, and empty texts are scored like any other, from their
features. Labels that are null teach nothing; several labels of one doc_id count as their
mean, at least a half being 1. Without labelled rows every score is 0.5; with labels of
one kind it is their smoothed share. An empty table gives an empty result.
A text of any length is one row of a task, worked on in memory proportional to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articlelake.llm import shingles
from articlelake.llm.frames import filtered, rows, slices, stored, text_bytes, texts

SAMPLE_ROWS = 50_000
BINS = 64
PAIR_BINS = 16
PAIRS = 10
ROUNDS = 150
PAIR_ROUNDS = 60
RATE = 0.15
LEAVES = 4
SMOOTH = 5.0

_CLASSES = {
    "lower": range(97, 123),
    "upper": range(65, 91),
    "digit": range(48, 58),
    "blank": [9, 10, 11, 12, 13, 32],
    "stop": list(b".,;:?'\"()-"),
    "bang": list(b"!"),
    "bar": list(b"|"),
    "symbol": list(b"#$%&*+/<=>@[\\]^_`{}~"),
    "other": range(128, 256),
}
_SYMBOL = np.zeros(256, dtype=np.int32)
_SYMBOL[[*_CLASSES["symbol"], *_CLASSES["bar"], *_CLASSES["bang"]]] = 1
_UPPER = np.zeros(256, dtype=np.int32)
_UPPER[list(_CLASSES["upper"])] = 1
_BLANK = np.zeros(256, dtype=bool)
_BLANK[_CLASSES["blank"]] = True
_IN_CLASS = np.zeros((256, len(_CLASSES)))
for _i, _members in enumerate(_CLASSES.values()):
    _IN_CLASS[list(_members), _i] = 1

FEATURES = [
    *(f"share_{name}" for name in _CLASSES),
    "log_bytes",
    "bytes_a_word",
    "upper_of_letters",
    "symbols_a_word",
    "bytes_a_line",
    "most_symbols_in_a_line",
    "most_upper_in_a_line",
    "lines_with_symbols",
    "same_as_before",
    "words_as_before",
    "entropy",
]


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each text."""
    n = len(offsets) - 1
    out = np.zeros((n, len(FEATURES)), dtype=np.float64)
    sizes = np.diff(offsets)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out.astype(np.float32)
    counts = np.zeros((n, 256))
    for i in full.tolist():
        counts[i] = np.bincount(data[offsets[i] : offsets[i + 1]], minlength=256)
    by_class = counts @ _IN_CLASS
    named = dict(zip(_CLASSES, by_class.T))
    blank = _BLANK[data]
    begins = ~blank
    begins[1:] &= blank[:-1]
    inner = offsets[:-1][full]
    begins[inner] = ~blank[inner]
    words = np.maximum(np.add.reduceat(begins.astype(np.int64), inner), 1)
    # lines: what lies between line feeds and the ends of texts
    line = np.union1d(inner, np.flatnonzero(data[:-1] == 10) + 1)
    length = np.diff(line, append=len(data)).astype(np.float64)
    symbols = np.add.reduceat(_SYMBOL[data], line) / length
    upper = np.add.reduceat(_UPPER[data], line) / length
    first = np.searchsorted(line, inner)
    same = np.zeros(len(data), dtype=np.int64)
    same[1:] = (data[1:] == data[:-1]) & (_SYMBOL[data[1:]] == 1)
    same[inner] = 0  # nothing comes before the first byte of a text
    size = sizes[full].astype(np.float64)
    share = counts[full] / size[:, None]
    letters = named["lower"] + named["upper"]
    noise = named["symbol"] + named["bar"] + named["bang"]
    out[full] = np.column_stack(
        [
            by_class[full] / size[:, None],
            np.log(size),
            size / words,
            named["upper"][full] / np.maximum(letters[full], 1),
            noise[full] / words,
            size / np.diff(first, append=len(line)),
            np.maximum.reduceat(symbols, first),
            np.maximum.reduceat(upper, first),
            np.add.reduceat((symbols > 0.08).astype(np.float64), first) / np.diff(first, append=len(line)),
            np.add.reduceat(same, inner) / size,
            _repeated_words(data, offsets)[full],
            -(share * np.log(np.where(share > 0, share, 1))).sum(axis=1),
        ]
    )
    return out.astype(np.float32)


def _repeated_words(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Share of words that are the word before once more."""
    hashes, ends = shingles.words(data, offsets)
    again = np.append(False, hashes[1:] == hashes[:-1])
    again[ends[ends < len(hashes)]] = False  # the first word of a text
    same = np.append(0, np.cumsum(again))
    words = np.diff(ends, prepend=0)
    return np.diff(same[ends], prepend=0) / np.maximum(words, 1)


def tree(gradient: np.ndarray, weight: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Values of a small regression tree over ordered cells, grown best split first."""

    def value(a: int, b: int) -> float:
        return gradient[a:b].sum() / (weight[a:b].sum() + SMOOTH)

    def best(a: int, b: int) -> tuple[float, int]:
        if b - a < 2:
            return 0.0, a
        g, w = np.cumsum(gradient[a:b]), np.cumsum(weight[a:b])
        left, right = g[:-1] ** 2 / (w[:-1] + SMOOTH), (g[-1] - g[:-1]) ** 2 / (w[-1] - w[:-1] + SMOOTH)
        gain = left + right - g[-1] ** 2 / (w[-1] + SMOOTH)
        at = int(np.argmax(gain))
        return float(gain[at]), a + at + 1

    parts = [(0, len(gradient), *best(0, len(gradient)))]
    while len(parts) < leaves:
        a, b, gain, at = max(parts, key=lambda p: p[2])
        if gain <= 1e-9:
            break
        parts.remove((a, b, gain, at))
        parts += [(a, at, *best(a, at)), (at, b, *best(at, b))]
    out = np.empty(len(gradient))
    for a, b, _, _ in parts:
        out[a:b] = value(a, b)
    return out


def tree_of_pair(gradient: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """A tree of depth two over a grid: the better axis first, then each side by the other axis. With its gain."""
    best, gain = None, -1.0
    for turned in (False, True):
        g, w = (gradient.T, weight.T) if turned else (gradient, weight)
        rows_value = tree(g.sum(axis=1), w.sum(axis=1), 2)
        out = np.empty_like(g)
        for v in np.unique(rows_value):
            side = rows_value == v
            out[side] = tree(g[side].sum(axis=0), w[side].sum(axis=0), 2)
        own = float((out * g).sum() - 0.5 * (out**2 * w).sum())
        if own > gain:
            best, gain = (out.T if turned else out), own
    return best, gain


@dataclass
class Model:
    """Bin edges and lookup tables; tables of pairs are over coarser bins."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for i, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, i], side="right")]
        cells = {i: np.searchsorted(self.coarse[i], x[:, i], side="right") for pair in self.pairs for i in pair[:2]}
        for a, b, table in self.pairs:
            total += table[cells[a], cells[b]]
        return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting on rows of features and labels 0 or 1."""
    if not len(y):
        return Model()
    share = (y.sum() + 1) / (len(y) + 2)
    model = Model(base=float(np.log(share / (1 - share))))
    if y.min() == y.max():
        return model
    model.edges = [_edges(c, BINS) for c in x.T]
    model.coarse = [_edges(c, PAIR_BINS) for c in x.T]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, c, side="right") for e, c in zip(model.edges, x.T)]
    total = np.full(len(y), model.base)

    def residuals() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -50, 50)))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for table, at in zip(model.tables, bins):
            g, w = residuals()
            step = RATE * tree(np.bincount(at, g, len(table)), np.bincount(at, w, len(table)))
            table += step
            total += step[at]

    cells = [np.searchsorted(e, c, side="right") for e, c in zip(model.coarse, x.T)]
    widths = [len(e) + 1 for e in model.coarse]

    def grid(a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        g, w = residuals()
        at = cells[a] * widths[b] + cells[b]
        shape = (widths[a], widths[b])
        return np.bincount(at, g, shape[0] * shape[1]).reshape(shape), np.bincount(at, w, shape[0] * shape[1]).reshape(shape), at

    gains = {(a, b): tree_of_pair(*grid(a, b)[:2])[1] for a in range(x.shape[1]) for b in range(a + 1, x.shape[1])}
    chosen = sorted(gains, key=lambda p: (-gains[p], p))[:PAIRS]
    tables = {p: np.zeros((widths[p[0]], widths[p[1]])) for p in chosen}
    for _ in range(PAIR_ROUNDS):
        for a, b in chosen:
            g, w, at = grid(a, b)
            step = RATE * tree_of_pair(g, w)[0]
            tables[a, b] += step
            total += step.ravel()[at]
    model.pairs = [(a, b, t) for (a, b), t in tables.items()]
    return model


def with_features(docs: DataFrame) -> DataFrame:
    """doc_id and the packed features of each of `texts`."""
    schema = pa.schema([("doc_id", pa.int64()), ("features", pa.binary())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = features(*text_bytes(batch.column("text"))).astype("<f4")
            yield rows(schema, doc_id=batch.column("doc_id"), features=[r.tobytes() for r in x])

    return docs.mapInArrow(make, "doc_id long, features binary")


def sample(held: DataFrame, labels: DataFrame, sample_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the labelled rows of least hash of doc_id; `labels` has doc_id and label."""
    labels = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    taken = held.join(labels, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "features").limit(sample_rows)
    found = taken.select("features", "label").toArrow()
    x = np.frombuffer(b"".join(found["features"].to_pylist()), dtype="<f4").reshape(-1, len(FEATURES))
    return x, found["label"].to_numpy().astype(np.float64)


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on the labelled rows among `texts`; `labels` has doc_id and label."""
    return fit(*sample(with_features(docs), labels, sample_rows))


def scores(docs: DataFrame, labels: DataFrame, learn: Column, id_column: str = "doc_id", text_column: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, score and predicted of every row; `labels` (doc_id, label) teach where `learn` holds for a doc_id."""
    held = stored(with_features(texts(docs, id_column, text_column)), "quality-features")  # for the sample and the scores
    model = fit(*sample(held.where(learn), labels, sample_rows))
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("features").to_pylist()), dtype="<f4").reshape(-1, len(FEATURES))
            found = model.score(x)
            yield rows(schema, doc_id=batch.column("doc_id"), score=found, predicted=(found >= 0.5).astype(np.int32))

    return held.mapInArrow(score, "doc_id long, score double, predicted int")


def accepted(docs: DataFrame, model: Model, text_column: str = "text", least: float = 0.5) -> DataFrame:
    """Rows whose score is `least` or more, with all their columns."""

    def make():
        return lambda column: model.score(features(*text_bytes(column))) >= least

    return filtered(docs, make, text_column)
