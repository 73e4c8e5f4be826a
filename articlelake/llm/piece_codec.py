"""Encoding texts to the ids of a SentencePiece model and decoding them again.

Encoding is the single-pass Viterbi of `unigram`. Decoding puts pieces and fallback bytes
together, turns word marks to blanks and takes off the blank that encoding put in front;
bytes that are no UTF-8 become replacement characters, control pieces nothing. A text comes
back unless it holds the word mark itself, which comes back as a blank, or characters that
are unknown to a model without byte pieces, which are lost.

Null texts are empty, and empty texts have no ids. Rows come back as they are, null and
repeated doc_ids included. An empty table gives an empty result.
A text of any length is one row of a task; a part without blanks is segmented whole.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from articlelake.llm.frames import rows, slices, texts
from articlelake.llm.unigram import MARK, Pieces, encoding


def encode(docs: DataFrame, model: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, text, n_tokens, and `ids`, packed as 4-byte numbers."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, known = encoding(model)
        for batch in slices(batches):
            ids = [b"".join(map(known, pieces.parts(t or ""))) for t in batch.column("text").to_pylist()]
            yield rows(schema, doc_id=batch.column("doc_id"), text=batch.column("text"), n_tokens=[len(i) // 4 for i in ids], ids=ids)

    return texts(docs, id_column, text_column).mapInArrow(code, "doc_id long, text string, n_tokens long, ids binary")


class Decoder:
    def __init__(self, pieces: Pieces):
        self._bytes = [p.replace(MARK, " ").encode() for p in pieces.pieces]
        for value, i in pieces.byte_ids.items():
            self._bytes[i] = bytes([value])
        for i in pieces.silent:
            self._bytes[i] = b""
        self._prefix = pieces.dummy_prefix

    def decode(self, ids: bytes) -> str:
        held = b"".join(map(self._bytes.__getitem__, array("I", ids)))
        if self._prefix and held.startswith(b" "):
            held = held[1:]
        return held.decode("utf-8", errors="replace")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """The rows with `decoded`, the text that their `ids` stand for."""
    names = [f.name for f in encoded.schema]

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(Pieces(model))
        for batch in slices(batches):
            found = pa.array([decoder.decode(i or b"") for i in batch.column("ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*names, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(back, f"{fields}, decoded string")
