"""Language of documents as a mixture: proportions by expectation-maximisation.

Each language has a table of likelihoods of three-byte groups around a letter, hashed to
`GRAMS` entries and counted over all teaching documents. A document is a mixture of its
words, each written in one language; EM estimates the proportions from the words'
likelihoods. The set of languages grows from the likeliest one as long as the gain in
log likelihood exceeds a penalty for another proportion. The prediction is the language of
the largest proportion in that set, the score its proportion.

Null texts and texts without a letter are `und` with score 0, as is everything when no
language was learned. Rows with a null language teach nothing. An empty table gives an
empty result.
A text of any length is one row of a task: its grams are counted in memory proportional to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articlelake.llm.frames import filtered, rows, slices, text_bytes

GRAMS = 1 << 16
ROUNDS = 10_000  # a guard only
PENALTY = 3.0
UNKNOWN = "und"
_LANGUAGES_HELD = 64
_BYTES_AT_ONCE = 1 << 20
_FOLDED = np.full(256, 32, dtype=np.uint8)
_FOLDED[97:123] = range(97, 123)
_FOLDED[65:91] = range(97, 123)
_FOLDED[128:] = range(128, 256)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entry of each letter with its neighbours, where each word begins among them, and its text."""
    held = np.full(len(data) + len(offsets), 32, dtype=np.uint8)  # a blank before each text and after the last
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    held[np.arange(len(data)) + text + 1] = _FOLDED[data]
    letter = np.flatnonzero(held != 32)
    group = held[letter - 1].astype(np.uint32) | held[letter].astype(np.uint32) << np.uint32(8) | held[letter + 1].astype(np.uint32) << np.uint32(16)
    entry = (group * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(np.int64)
    begins = np.flatnonzero(np.diff(letter, prepend=-2) != 1)
    of = np.searchsorted(offsets + np.arange(len(offsets)) + 1, letter[begins], side="right") - 1
    return entry, begins, of


def counts(docs: DataFrame) -> DataFrame:
    """lang, gram, n over all texts; counts are summed in the task before they are shuffled."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, n in held.items():
                at = np.flatnonzero(n)
                yield rows(schema, lang=[lang] * len(at), gram=at, n=n[at])
            held.clear()

        for batch in slices(batches, _BYTES_AT_ONCE):
            data, offsets = text_bytes(batch.column("text"))
            entry, begins, of = grams(data, offsets)
            of_entry = np.repeat(of, np.diff(begins, append=len(entry)))
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for lang in dict.fromkeys(langs):
                own = entry[(langs == lang)[of_entry]]
                held.setdefault(lang, np.zeros(GRAMS, dtype=np.int64))
                held[lang] += np.bincount(own, minlength=GRAMS)
                if len(held) > _LANGUAGES_HELD:
                    yield from out()
        yield from out()

    taught = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    return taught.mapInArrow(count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Log likelihoods of every gram in every learned language."""

    def __init__(self, found: pa.Table):
        self.langs = sorted(set(found["lang"].to_pylist()))
        number = {lang: i for i, lang in enumerate(self.langs)}
        n = np.zeros((len(self.langs), GRAMS))
        n[[number[x] for x in found["lang"].to_pylist()], found["gram"].to_numpy()] = found["n"].to_numpy()
        self.table = np.log((n + 0.5) / (n.sum(axis=1, keepdims=True) + 0.5 * GRAMS)).astype(np.float32)

    def mixtures(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proportions of the languages in each text (zero outside its set), and its number of words."""
        n = len(offsets) - 1
        entry, begins, of = grams(data, offsets)
        words = np.bincount(of, minlength=n)
        share = np.zeros((n, len(self.langs)))
        if not len(begins) or not self.langs:
            return share, words
        log = np.stack([np.add.reduceat(t[entry], begins) for t in self.table], axis=1)
        log -= log.max(axis=1, keepdims=True)
        likely = np.exp(np.maximum(log, -60.0)).astype(np.float64)
        full = np.flatnonzero(words)
        first = np.searchsorted(of, full)
        share[full] = _maximise(likely, words[full], first, np.full((len(full), len(self.langs)), 1 / len(self.langs)))
        share[full] = _chosen(likely, words[full], first, share[full])
        return share, words


def _maximise(likely: np.ndarray, words: np.ndarray, first: np.ndarray, share: np.ndarray) -> np.ndarray:
    """EM: each word is divided among the languages, the proportions are the mean of that.

    A text is done when its own proportions have converged, whatever texts are beside it.
    """
    share, open_at = share.copy(), np.arange(len(share))
    for _ in range(ROUNDS):
        part = likely * np.repeat(share[open_at], words, axis=0)
        part /= part.sum(axis=1, keepdims=True)
        new = np.add.reduceat(part, first, axis=0) / words[:, None]
        going = np.abs(new - share[open_at]).max(axis=1, initial=0) >= 1e-3
        share[open_at] = new
        if not going.any():
            break
        if not going.all():
            likely, words, open_at = likely[np.repeat(going, words)], words[going], open_at[going]
            first = np.cumsum(words) - words
    return share


def _log_likelihood(likely: np.ndarray, words: np.ndarray, first: np.ndarray, share: np.ndarray) -> np.ndarray:
    return np.add.reduceat(np.log((likely * np.repeat(share, words, axis=0)).sum(axis=1) + 1e-300), first)


def _chosen(likely: np.ndarray, words: np.ndarray, first: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Proportions over the set of languages that the penalty leaves, likeliest language first."""
    order = np.argsort(-share, axis=1, kind="stable")
    rank = np.argsort(order, axis=1)
    best = (rank == 0).astype(np.float64)
    value = _log_likelihood(likely, words, first, best)
    open_at = np.arange(len(share))
    for size in range(2, share.shape[1] + 1):
        held = np.repeat(np.isin(np.arange(len(share)), open_at), words)
        own = likely[held]
        n = words[open_at]
        begin = np.cumsum(n) - n
        start = np.where(rank[open_at] < size, np.maximum(share[open_at], 1e-6), 0)
        more = _maximise(own, n, begin, start / start.sum(axis=1, keepdims=True))
        gain = _log_likelihood(own, n, begin, more) - value[open_at]
        better = gain > PENALTY + 0.5 * np.log(n)
        best[open_at[better]] = more[better]
        value[open_at[better]] += gain[better]
        open_at = open_at[better]
        if not len(open_at):
            break
    return best


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def learn(docs: DataFrame) -> Model:
    """Fit on `text` and `lang` of all rows. What comes to the driver is one table of at most GRAMS counts a language."""
    return Model(counts(docs.select("text", "lang")).toArrow())


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and `languages` (the chosen set with proportions) of each of `texts`."""
    part = pa.struct([("lang", pa.string()), ("share", pa.float64())])
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("languages", pa.list_(part))])

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, _BYTES_AT_ONCE):
            share, _ = model.mixtures(*text_bytes(batch.column("text")))
            known = np.array([_has_letter(t) for t in batch.column("text").to_pylist()], dtype=bool) & bool(model.langs)
            best = share.argmax(axis=1) if model.langs else np.zeros(len(share), dtype=np.int64)
            yield rows(
                schema,
                doc_id=batch.column("doc_id"),
                lang_pred=[model.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())],
                score=np.where(known, np.minimum(share.max(axis=1, initial=0), 1), 0.0),
                languages=[[{"lang": model.langs[i], "share": float(s[i])} for i in np.flatnonzero(s)] if k else [] for s, k in zip(share, known)],
            )

    return docs.mapInArrow(name, "doc_id long, lang_pred string, score double, languages array<struct<lang: string, share: double>>")


def accepted(docs: DataFrame, model: Model, text_column: str = "text", least: float = 0.5) -> DataFrame:
    """Rows with one language of a proportion of `least` or more, with all their columns; `und` goes."""

    def make():
        def keeps(column: pa.Array) -> np.ndarray:
            share, _ = model.mixtures(*text_bytes(column))
            known = np.array([_has_letter(t) for t in column.to_pylist()], dtype=bool)
            return known & (share.max(axis=1, initial=0) >= least)

        return keeps

    return filtered(docs, make, text_column)
