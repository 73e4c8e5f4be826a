import hashlib

import corpus_pipeline
import duckdb
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
from articlelake.llm import near_dedup, suffix_dedup
from articlelake.llm.bpe import default_path
from articlelake.llm.frames import stored
from articlelake.llm.oracle import oracle_sql
from articlelake.llm.queries import QUERIES
from check import TABLES, canonical
from tests.llm.test_near_dedup import brute_force as near_brute_force
from tests.llm.test_suffix_dedup import brute_force as suffix_brute_force
from tests.llm.test_tokens import crc
from tests.llm.test_tokens import cut as pieces_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF), name.replace(" ", "-")))
    return out


def texts_of(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


def test_stages_keep_the_columns_of_documents(outputs):
    for frame in outputs[1:-1]:
        assert frame.schema == outputs[0].schema


def test_each_stage_does_what_its_operator_says(spark, outputs):
    raw, good, named, single, cut, packed = outputs
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = {d for d, _ in texts_of(good)}
    assert all((d in left) == (q == 1) for d, q in labels.items())
    lettered = {d for d, t in texts_of(good) if any(c.isalpha() for c in t or "")}
    assert {d for d, _ in texts_of(named)} == lettered  # every text of these is in one language
    kept = {d for d, _, _, k in near_brute_force(texts_of(named), near_dedup.PERCENT) if k}
    assert {d for d, _ in texts_of(single)} == kept
    digests = {d: (removed, spans, sha) for d, _, removed, spans, sha in suffix_brute_force(texts_of(single), suffix_dedup.LENGTH)}
    before = dict(texts_of(single))
    assert {d for d, _ in texts_of(cut)} == digests.keys() and any(removed for removed, _, _ in digests.values())
    for d, text in texts_of(cut):
        removed, spans, sha = digests[d]
        left = (before[d] or "").encode()
        if left.isascii() or not removed:
            assert hashlib.sha256((text or "").encode()).hexdigest() == sha
        dropped = len(left) - removed - len((text or "").encode())
        assert 0 <= dropped <= 6 * spans  # bytes of characters cut in two
    assert {r["doc_id"] for r in packed.collect()} == digests.keys()


def test_run_is_the_stages(spark, outputs):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    run = corpus_pipeline.run(spark, SF).select(columns).collect()
    assert sorted(run) == sorted(outputs[-1].select(columns).collect())


def test_stages_take_odd_rows(spark, docs, no_docs):
    for frame in (docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            before, frame = frame, stored(stage(spark, frame, SF), "odd")
        whole = Tokenizer.from_file(default_path())
        held = [len(whole.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in texts_of(before)]
        assert sum(r["length"] for r in frame.collect()) == sum(held)
        assert {r["doc_id"] for r in frame.collect()} == {d for d, _ in texts_of(before)}
    assert frame.count() == 0  # of the empty table


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    ours, theirs = QUERIES[name](spark, SF).toPandas(), con.execute(oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns) and canonical(ours) == canonical(theirs)


@pytest.mark.parametrize("name", [f"op{n}" for n in (1, 3, 4, 5, 6, 8, 9)])
def test_query_returns_a_row_per_document(spark, documents, name):
    query = next(q for n, q in QUERIES.items() if n.startswith(f"{name}_"))
    assert sorted(r["doc_id"] for r in query(spark, SF).select("doc_id").collect()) == [d for d, _ in documents]


@pytest.fixture(scope="module")
def documents(spark):
    return texts_of(spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id"))


@pytest.fixture(scope="module")
def library_ids(documents):
    whole = Tokenizer.from_file(default_path())
    return {d: whole.encode(t or "", add_special_tokens=False).ids for d, t in documents}


def columns_of(spark, name, *columns):
    return sorted(tuple(r) for r in QUERIES[name](spark, SF).select(*columns).collect())


def test_op3_is_the_brute_force(spark, documents):
    found = columns_of(spark, "op3_suffix_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert found == sorted(map(tuple, suffix_brute_force(documents, 50)))


def test_op8_holds_the_ids_of_the_library(spark, library_ids):
    expected, start = [], 0
    for d, ids in library_ids.items():
        expected.append((d, start, len(ids) + 1, crc([*ids, 2])))
        start += len(ids) + 1
    assert columns_of(spark, "op8_repair_tokens", "doc_id", "start", "n_tokens", "ids_crc32") == expected


def test_op9_is_the_brute_force(spark, documents):
    found = columns_of(spark, "op9_lsh_forest", "doc_id", "n_shingles", "component_id", "kept")
    assert found == sorted(map(tuple, near_brute_force(documents, 85)))


def test_op10_holds_the_ids_of_the_library(spark, library_ids):
    expected = [(d, *piece) for d, ids in library_ids.items() for piece in pieces_of([*ids, 0], 2048)]
    assert columns_of(spark, "op10_best_fit_packing", "doc_id", "piece", "start", "length", "ids_crc32") == sorted(expected)


def test_op13_holds_the_ids_of_the_library_without_padding(spark, library_ids):
    found = QUERIES["op13_window_packing"](spark, SF).collect()
    places = {d: [] for d in library_ids}
    sizes = {}
    for r in found:
        ids = [*library_ids[r["doc_id"]], 0]
        assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == crc(ids[r["start"] : r["start"] + r["length"]])
        places[r["doc_id"]] += range(r["start"], r["start"] + r["length"])
        sizes[r["sequence_id"]] = sizes.get(r["sequence_id"], 0) + r["length"]
    assert all(sorted(at) == list(range(len(library_ids[d]) + 1)) for d, at in places.items())
    assert all(n == 1024 or n & (n - 1) == 0 for n in sizes.values())


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= contract.queries().keys()
