import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from riskweave.llm import suffix


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(np.frombuffer(d, np.uint8)[~gone])
        out.append((len(d), int(gone.sum()), int((gone & ~np.concatenate([[False], gone[:-1]])).sum()), kept))
    return out


COLS = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def check(make_docs, texts, length, seed):
    rows = list(enumerate(texts))
    got = {r["doc_id"]: tuple(r[c] for c in COLS) for r in suffix.dedup_digest(make_docs(rows, extra=True), length, seed).collect()}
    assert got == {i: (*b[:3], hashlib.sha256(b[3]).hexdigest()) for i, b in enumerate(brute(texts, length))}


@pytest.mark.parametrize("length,seed", [(40, 12), (40, 39), (70, 20), (33, 1)])
def test_random_texts_with_shared_passages(make_docs, length, seed):
    rng = random.Random(length + seed)
    word = lambda n: "".join(rng.choices("abcdé ", k=n))
    passages = [word(rng.randrange(20, 200)) for _ in range(8)]
    texts = ["", None, "x" * 39, "ab" * 60, "a" * 100]
    for _ in range(60):
        parts = [rng.choice([word(rng.randrange(0, 80)), rng.choice(passages), rng.choice(passages)[rng.randrange(15):]])
                 for _ in range(rng.randrange(1, 6))]
        t = "".join(parts)
        texts.append(t)
        if rng.random() < 0.5:  # near copies: a letter changed, or both ends cut
            i = rng.randrange(len(t) + 1)
            texts.append(rng.choice([t[:i] + "Z" + t[i + 1:], t[i // 4:len(t) - i // 4], t]))
    check(make_docs, texts, length, seed)


def test_long_periodic_and_constant_texts(make_docs):
    check(make_docs, ["buy now " * 500, "z" * 3000, "buy now " * 3 + "and " + "later " * 400, "q" * 100], 100, 32)


def test_production_length_on_generated_documents(llm):
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = duckdb.connect().sql("select doc_id, text from '/root/testdata/sf0.001/documents.parquet'").fetchall()
    got = {r["doc_id"]: tuple(r[c] for c in COLS) for r in suffix.dedup_digest(docs).collect()}
    want = brute([t for _, t in texts], 400)
    assert got == {i: (*b[:3], hashlib.sha256(b[3]).hexdigest()) for (i, _), b in zip(texts, want, strict=True)}


def test_repeated_and_null_ids_are_rows_of_their_own(make_docs):
    a, b, c = "first passage " * 5, "".join(map(chr, range(40, 120))), "".join(map(chr, range(200, 290)))
    texts = [a + b, a + b, c, b + "tail", None, c[:50]]
    rows = list(zip([1, 1, 1, 2, None, None], texts, strict=True))
    got = sorted(((r["doc_id"], *(r[k] for k in COLS)) for r in suffix.dedup_digest(make_docs(rows), 40, 12).collect()), key=repr)
    want = [(i, *x[:3], hashlib.sha256(x[3]).hexdigest()) for (i, _), x in zip(rows, brute(texts, 40), strict=True)]
    assert got == sorted(want, key=repr)


def test_applied_removal_keeps_whole_characters(make_docs):
    shared = "é" * 30
    texts = [f"one {shared} two", f"ein {shared[:-1]}è zwei", None, "untouched"]
    out = suffix.apply_dedup(make_docs(list(enumerate(texts)), extra=True), 40, 12)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    want = [b[3].decode("utf-8", "ignore") for b in brute(texts, 40)]
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()} == {i: (t, len(t)) for i, t in enumerate(want)}


def test_empty_table(make_docs):
    assert suffix.dedup_digest(make_docs([])).count() == 0 and suffix.apply_dedup(make_docs([])).count() == 0
