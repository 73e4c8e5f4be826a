"""Token counts of whole texts under a unigram vocabulary, without making the tokens.

Per part of a text, a Viterbi pass over the matches of the automaton carries the best score
and the number of pieces on it, by the tie rules of `unigram`. Characters that are no piece
count as the bytes they fall back to.

Null and empty texts have no token and score 0. Rows come back as they are, null and
repeated doc_ids included. An empty table gives an empty result.
A text of any length is one row of a task; a part without blanks is segmented whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from articlelake.llm.frames import rows, slices, texts
from articlelake.llm.unigram import counting


def token_counts(docs: DataFrame, model: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_tokens and score (the sum over the best segmentation) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("score", pa.float64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, known = counting(model)
        for batch in slices(batches):
            numbers, scores = [], []
            for text in batch.column("text").to_pylist():
                found = list(map(known, pieces.parts(text or "")))
                numbers.append(sum(n for n, _ in found))
                scores.append(sum(s for _, s in found))
            yield rows(schema, doc_id=batch.column("doc_id"), n_tokens=numbers, score=[float(s) for s in scores])

    return texts(docs, id_column, text_column).mapInArrow(count, "doc_id long, n_tokens long, score double")
