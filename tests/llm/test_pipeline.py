import importlib

import pytest

import corpus_pipeline as cp
from riskweave.llm import minhash, packing, quality, suffix
from tests.llm.test_op8_suffix import brute as brute_suffix
from tests.llm.test_op9_packing import PATH, verify
from tests.llm.test_op10_minhash import brute_classes

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(llm):
    docs, out = llm.read.parquet("/root/testdata/sf0.001/documents.parquet"), {}
    out["documents"] = docs.collect()
    for name, stage in cp.STAGES:
        path = cp.scratch_path(llm, f"test-{name}")
        stage(llm, docs, "/root/testdata/sf0.001").write.parquet(path)
        docs = llm.read.parquet(path)
        out[name] = docs.collect()
        if name != cp.STAGES[-1][0]:
            assert docs.columns == COLUMNS
    return out


def texts(rows):
    return {r["doc_id"]: r["text"] for r in rows}


def test_order_of_stages():
    assert [f.__module__ for _, f in cp.STAGES] == ["corpus_pipeline"] * 5
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "near_duplicates", "repeated_passages", "mask_secrets", "pack_sequences"]


def test_quality_drops_what_the_rules_reject(llm, stages):
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = {r["doc_id"] for r in quality.quality_rules(docs).filter("kept").collect()}
    assert set(texts(stages["quality_rules"])) == kept and 0 < len(kept) < len(stages["documents"])


def test_one_document_of_each_class_stays(stages):
    before = texts(stages["quality_rules"])
    heads = {c for _, c in brute_classes(sorted(before.items()))}
    assert texts(stages["near_duplicates"]) == {i: before[i] for i in heads}


def test_repeated_passages_go(stages):
    before = sorted(texts(stages["near_duplicates"]).items())
    want = brute_suffix([t for _, t in before], suffix.LENGTH)
    assert texts(stages["repeated_passages"]) == {i: b[3].decode("utf-8", "ignore") for (i, _), b in zip(before, want, strict=True)}


def test_secrets_are_masked(stages):
    import re
    after = texts(stages["mask_secrets"])
    assert set(after) == set(texts(stages["repeated_passages"]))
    assert not any(re.search("AKIA[A-Z0-9]{12}|[0-9a-f]{32}", t) for t in after.values())
    same = [i for i, t in texts(stages["repeated_passages"]).items() if after[i] == t]
    assert len(same) > 0.8 * len(after)


def test_sequences_hold_all_that_is_left(stages):
    from tokenizers import Tokenizer
    rows = sorted(texts(stages["mask_secrets"]).items())
    bins, total = verify(stages["pack_sequences"], rows, Tokenizer.from_file(PATH), packing.CAPACITY)
    assert bins <= 1.02 * -(-total // packing.CAPACITY) + 1


def test_run_equals_the_stages_and_is_registered(llm, stages):
    entry = importlib.import_module("__spark_entry__")
    got = entry.queries()["pipeline"](llm, "/root/testdata/sf0.001")
    key = lambda rows: sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert key(got.collect()) == key(stages["pack_sequences"])
    assert all(any(n.startswith(f"op{i}_") for n in entry.queries()) for i in range(1, 11))


def test_stages_take_empty_documents(llm):
    docs = llm.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in cp.STAGES[:-1]:
        docs = stage(llm, docs, "")
        assert docs.columns == COLUMNS and docs.count() == 0
    assert cp.STAGES[-1][1](llm, docs, "").count() == 0


def test_threshold_and_shingles_are_the_agreed_ones():
    assert (minhash.WORDS, minhash.THRESHOLD, suffix.LENGTH, packing.CAPACITY) == (5, 0.8, 400, 2048)


def test_oracle_sql_of_the_queries(llm):
    import duckdb

    from riskweave.llm.queries import ORACLE, REGISTRY
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name, sql in ORACLE.items():
        got = REGISTRY[name](llm, sf)
        cur = con.execute(sql)
        cols = [c[0] for c in cur.description]
        assert sorted(cols) == sorted(got.columns)
        assert sorted(map(repr, map(tuple, got.select(*cols).collect()))) == sorted(map(repr, cur.fetchall())), name
