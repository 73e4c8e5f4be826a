"""Unigram segmentation over the pieces and scores of a SentencePiece model.

An Aho-Corasick automaton over the pieces reports, at each position, every piece that ends
there, longest first, as its output links run. A single pass relaxes the best score of the
position from them: a later candidate wins only with a strictly higher score, so of equal
ones the piece that starts first stays. A character that no piece covers alone may be
unknown, at the lowest score of the model less 10; it is tried after the pieces. These are
the tie rules of the SentencePiece and Hugging Face unigram encoders, with sums in double
precision as in the latter.

Only the pieces, scores, kinds and flags of the file are used, also where it was trained
for another algorithm. Where no piece goes on over a word mark, texts are cut before the
marks and the parts are segmented once for all their occurrences.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

from articlelake.llm.bpe import Memo

# --- fixed values (of the SentencePiece model format and its unigram encoder) ---
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0
# --------------------------------------------------------------------------------


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """Pieces, scores, kinds and flags of a model file, with the automaton over its pieces."""

    def __init__(self, path: str | None = None):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path or default_path(), "rb") as file:
            proto.ParseFromString(file.read())
        normalizer = proto.normalizer_spec
        if normalizer.precompiled_charsmap or normalizer.remove_extra_whitespaces or not normalizer.escape_whitespaces:
            raise ValueError("only models that keep characters and blanks as they are")
        self.dummy_prefix = normalizer.add_dummy_prefix
        self.pieces = [p.piece for p in proto.pieces]
        kinds = [p.type for p in proto.pieces]
        used = [(i, p.piece, float(p.score)) for i, p in enumerate(proto.pieces) if p.type in (NORMAL, USER_DEFINED)]
        highest = max(score for _, _, score in used)
        self.unknown_score = min(score for _, _, score in used) - UNKNOWN_PENALTY
        self.unknown_id = kinds.index(UNKNOWN)
        self.byte_ids = {int(p[1:-1], 16): i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == BYTE}
        self.silent = {i for i, k in enumerate(kinds) if k in (CONTROL, UNKNOWN)}
        self.automaton = ahocorasick.Automaton()
        for i, piece, score in used:
            if kinds[i] == USER_DEFINED:
                score = len(piece.encode()) * highest - 0.1
            self.automaton.add_word(piece, (len(piece), score, i))
        self.automaton.make_automaton()
        self._part = self._parts([p for _, p, _ in used])

    def _parts(self, pieces: list[str]) -> re.Pattern | None:
        """Pattern of the parts that no piece goes beyond, or None if there is none."""
        if any(MARK in p.lstrip(MARK) for p in pieces):
            return None
        if any("\n" in p for p in pieces):
            return re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        return re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")

    def parts(self, text: str) -> list[str]:
        """The text with its marks, cut where no piece goes on."""
        text = text.replace(" ", MARK)
        if self.dummy_prefix and text:
            text = MARK + text
        return self._part.findall(text) if self._part else [text] * bool(text)

    def unknown(self, character: str) -> list[int]:
        """Ids of a character that is no piece."""
        return [self.byte_ids[b] for b in character.encode()] if self.byte_ids else [self.unknown_id]

    def ending_at(self, part: str) -> Iterator[tuple[int, list[tuple[int, float, int]]]]:
        """Each position of the part and the pieces that end there, longest first."""
        place, held = 0, []
        for end, found in self.automaton.iter(part):
            while place < end:
                yield place, held
                place, held = place + 1, []
            held.append(found)
        while place < len(part):
            yield place, held
            place, held = place + 1, []

    def count(self, part: str) -> tuple[int, float]:
        """Number of ids and score of the best segmentation, without making it."""
        best, counts = [0.0], [0]
        for place, found in self.ending_at(part):
            top, number, alone = None, 0, False
            for length, score, _ in found:
                start = place + 1 - length
                total = best[start] + score
                if top is None or total > top:
                    top, number = total, counts[start] + 1
                alone |= length == 1
            if not alone:
                total = best[place] + self.unknown_score
                if top is None or total > top:
                    top, number = total, counts[place] + len(self.unknown(part[place]))
            best.append(top)
            counts.append(number)
        return counts[-1], best[-1]

    def segment(self, part: str) -> list[int]:
        """Ids of the best segmentation."""
        best, back = [0.0], [(0, None)]
        for place, found in self.ending_at(part):
            top, came, alone = None, (place, None), False
            for length, score, piece in found:
                start = place + 1 - length
                total = best[start] + score
                if top is None or total > top:
                    top, came = total, (start, piece)
                alone |= length == 1
            if not alone:
                total = best[place] + self.unknown_score
                if top is None or total > top:
                    top, came = total, (place, None)
            best.append(top)
            back.append(came)
        out, place = [], len(part)
        while place:
            start, piece = back[place]
            out.append([piece] if piece is not None else self.unknown(part[start:place]))
            place = start
        return [i for ids in reversed(out) for i in ids]


MEMO_BYTES = 64 << 20


@lru_cache(maxsize=1)
def counting(path: str | None = None) -> tuple[Pieces, Callable[[str], tuple[int, float]]]:
    """The model and its counts of parts, one memo for all tasks of a Python worker."""
    pieces = Pieces(path)
    return pieces, Memo(pieces.count, MEMO_BYTES).__getitem__


@lru_cache(maxsize=1)
def encoding(path: str | None = None) -> tuple[Pieces, Callable[[str], bytes]]:
    """The model and the packed ids of parts, one memo for all tasks of a Python worker."""
    pieces = Pieces(path)
    return pieces, Memo(lambda part: array("I", pieces.segment(part)).tobytes(), MEMO_BYTES).__getitem__
