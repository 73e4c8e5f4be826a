import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer, models

from articlelake.llm import packing, piece_codec, repair, token_counts
from articlelake.llm.bpe import ByteBpe, default_path
from articlelake.llm.frames import texts
from articlelake.llm.unigram import MARK, Pieces

ODD = ["", " ", "  ", "a  b", " a", "a ", "it's we'll  x\n\n y", "a <|endoftext|> b", "日本 語 x", "é è ÿ×÷ 1a 2²", "a\tb \t c", "a' s 's", "a\x85 b", "z" * 500, "½ a", "\n"]


@pytest.fixture(scope="module")
def byte_bpe():
    return Tokenizer.from_file(default_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_memo_changes_no_id(byte_bpe, planted_rows):
    encoder = ByteBpe(memo_bytes=50 * 250)
    for text in ODD + [t for _, t in planted_rows]:
        assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == ids_of(byte_bpe, text)


def test_repair_files_round_trip(spark, docs, planted_rows, byte_bpe, tmp_path):
    path = str(tmp_path / "files")
    repair.write(texts(docs), path, shard_tokens=3000)
    found = sorted(repair.read(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == sorted((d for d, _ in planted_rows), key=lambda d: -1 if d is None else d)
    total = 0
    for r in found:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (total, len(ids), crc(ids)) and ids[-1] == 2
        total += len(ids)
    held = sorted((str(d), ids_of(byte_bpe, t) + [2]) for d, t in planted_rows)
    assert sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in found) == held


@pytest.mark.parametrize("seed", range(4))
def test_shards_expand_to_what_was_compressed(seed):
    rng = np.random.default_rng(seed)
    ids = rng.integers(0, 3 + 40 * seed, 5000).astype(np.uint16)
    ends = np.concatenate([[0], np.sort(rng.integers(0, 5000, 30)), [5000]]).astype(np.int64)
    payload = repair.compress(ids, ends, most=50)
    shard = repair.Shard(payload)
    whole, found = shard.documents()
    assert (whole == ids).all() and (found == ends).all()
    for n in range(len(ends)):
        assert (shard.document(n) == ids[ends[n - 1] if n else 0 : ends[n]]).all()
    if seed == 0:
        assert len(payload) < ids.nbytes


def test_no_documents(spark, no_docs):
    assert repair.write_and_read(no_docs).collect() == []
    assert packing.pack_documents(no_docs).collect() == []
    assert token_counts.token_counts(no_docs).collect() == []
    assert piece_codec.decode(piece_codec.encode(no_docs)).collect() == []


def best_fit(lengths, capacity):
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= n]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - n)
        else:
            room.append(capacity - n)
    return room


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit_decreasing(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 65, 300).tolist() + [64] * 5 + [seed + 1] * 200
    counts = dict(zip(*np.unique(lengths, return_counts=True)))
    ranges = packing.plan({int(k): int(v) for k, v in counts.items()}, 64)
    filled = {}
    for length, count in counts.items():
        own = ranges[ranges[:, 0] == length]
        own = own[np.argsort(own[:, 1])]
        for rank in range(count):
            _, first, bin_, each, offset = own[np.searchsorted(own[:, 1], rank, side="right") - 1]
            place = (bin_ + (rank - first) // each, offset + (rank - first) % each * length)
            filled.setdefault(int(place[0]), []).append((int(place[1]), int(length)))
    for held in filled.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64
    assert len(filled) == len(best_fit(lengths, 64))


def cut(ids, capacity):
    """(piece, start, length, crc) of a document's pieces, the first of which may be shorter."""
    start, out = 0, []
    while start < len(ids):
        length = (len(ids) - start) % capacity or capacity
        out.append((len(out), start, length, crc(ids[start : start + length])))
        start += length
    return out


def test_packing_cuts_and_places_every_id(docs, planted_rows, byte_bpe):
    placed = packing.pack_documents(docs, capacity=256, keep_ids=True)
    rows = placed.collect()
    expected = [(str(d), *piece) for d, t in planted_rows for piece in cut(ids_of(byte_bpe, t) + [0], 256)]
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(expected)
    whole = {}
    for r in rows:
        if r["doc_id"] == 508:
            whole[r["start"]] = np.frombuffer(r["ids"], "<u2").tolist()
    long = ids_of(byte_bpe, dict(planted_rows[:-4])[508]) + [0]
    assert sum((whole[k] for k in sorted(whole)), []) == long
    assert sorted(map(len, whole.values()), reverse=True)[:-1] == [256] * (len(whole) - 1)
    assert len({r["sequence_id"] for r in rows}) == len(best_fit([r["length"] for r in rows], 256))
    built = {r["sequence_id"]: np.frombuffer(r["ids"], "<u2") for r in packing.sequences(placed).collect()}
    for r in rows:
        own = built[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
        assert crc(own) == r["ids_crc32"]
    assert sum(map(len, built.values())) == sum(len(ids_of(byte_bpe, t)) + 1 for _, t in planted_rows)


@pytest.fixture(scope="module")
def unigram():
    from sentencepiece import sentencepiece_model_pb2

    from articlelake.llm.unigram import default_path as model_path

    proto = sentencepiece_model_pb2.ModelProto()
    with open(model_path(), "rb") as f:
        proto.ParseFromString(f.read())
    vocabulary = [(p.piece, float(p.score) if p.type in (1, 4) else -1e9) for p in proto.pieces]
    return Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))


def test_counts_and_ids_are_those_of_the_unigram_encoder(docs, planted_rows, unigram, spark):
    data = planted_rows + list(enumerate(ODD, 9000))
    frame = spark.createDataFrame(data, "doc_id long, text string")
    want = sorted((str(d), ids_of(unigram, (MARK + t.replace(" ", MARK)) if t else "")) for d, t in data)
    encoded = piece_codec.encode(frame)
    got = piece_codec.decode(encoded).collect()
    assert sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in got) == want
    assert all(r["decoded"] == (r["text"] or "") for r in got)
    counted = token_counts.token_counts(frame).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in counted) == sorted((d, len(i)) for d, i in want)


def test_ties_go_to_the_piece_that_starts_first():
    pieces = Pieces()
    for text in ("aaaa", "the then", "xyz qq\n\nz"):
        for part in pieces.parts(text):
            ids = pieces.segment(part)
            assert pieces.count(part)[0] == len(ids)
