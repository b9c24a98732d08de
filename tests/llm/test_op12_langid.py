"""op12: filter masks against sets, false-positive rate, held-out accuracy, odd texts."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from riskweave.llm import langid as L
from tests.conftest import SF_CHECK


def plain_grams(text):
    """N-grams by definition, character by character."""
    out, word = [], ""
    for c in text.lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            marked = "\0" + word + "\0"
            out += [marked[i:i + k] for k in L.SIZES for i in range(len(marked) - k + 1)]
            word = ""
    return out


TEXTS = ["Le chat, le CHIEN!", "a", "", "x1y2z3", "  ..  ", "日本語のテキスト", "Straße über naïve", "a" * 30, "end\n\nnew", None]


def test_grams_equal_the_definition():
    arr = pa.array([t.lower() if t is not None else "" for t in TEXTS], pa.large_string())
    sized, letters = L.grams(arr)
    for i, t in enumerate(TEXTS):
        want = plain_grams(t or "")
        for k, (hashes, off) in zip(L.SIZES, sized, strict=True):
            own = hashes[off[i]:off[i + 1]]
            exp = [g for g in want if len(g) == k]
            assert len(own) == len(exp) and len(set(own.tolist())) == len(set(exp)), (t, k)
        assert letters[i] == sum(c.isalpha() for c in t or "")
    a, b = (L.grams(pa.array([t], pa.large_string()))[0][0][0].tolist() for t in ("abc def", "def, abc"))
    assert sorted(a) == sorted(b)


def test_masks_return_all_languages_and_correct_for_chance():
    r = np.random.default_rng(1)
    sets = [r.integers(0, 1 << 63, 20_000).astype(np.uint64) for _ in range(11)]
    sets[3] = np.concatenate([sets[3], sets[9][:5000]])
    f = L.Filter([f"l{i:02d}" for i in range(11)], sets, 0)
    bit = lambda m, i: m[:, i // 8] >> np.uint8(i % 8) & 1
    for i, s in enumerate(sets):
        assert bit(f.masks(s), i).all()
    assert bit(f.masks(sets[9][:5000]), 3).all()
    other = r.integers(0, 1 << 63, 100_000).astype(np.uint64)
    rate = bit(f.masks(other), 0).mean()
    assert rate == pytest.approx(f.false[0], rel=0.15) and rate > 0.003
    corrected = f.corrected(np.array([[bit(f.masks(other), i).sum() for i in range(11)]]), np.array([len(other)]))
    assert corrected.max() < 0.002 * len(other)


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_accuracy(llm):
    docs = llm.read.parquet(f"{SF_CHECK}/documents.parquet")
    got = {r.doc_id: r for r in L.identify(docs).collect()}
    rows = docs.select("doc_id", "lang", "text").collect()
    assert len(got) == len(rows) and all(got[r.doc_id].held_out == held(r.doc_id) for r in rows)
    some = [r for r in rows if held(r.doc_id) and r.lang and r.text and any(c.isalpha() for c in r.text)]
    right = sum(got[r.doc_id].lang_pred == r.lang for r in some)
    assert len(some) > 150 and right / len(some) > 0.97, right / len(some)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_held_out_rows_and_other_columns_are_not_read(llm):
    docs = llm.read.parquet(f"{SF_CHECK}/documents.parquet").limit(400).cache()
    seen = L.identify(docs).collect()
    hidden = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(CAST(CAST(doc_id AS string) AS binary)) % 4 = 2 THEN 'xx' ELSE lang END AS lang",
                             "'none' AS source", "1 AS score", "2 AS lang_pred", "3 AS gram")
    assert sorted(L.identify(hidden).collect()) == sorted(seen)


def test_odd_texts(llm):
    rows = [(i, w * 3, la) for i in range(0, 60) for w, la in [("der und nicht ", "de") if i % 2 else ("the and not ", "en")]]
    rows += [(100, None, "en"), (101, "", "en"), (102, "123 ... 4", "de"), (103, "中文", None), (104, "und der", None),
             (105, "the the", None), (105, "nicht", None), (None, "und und", "de"), (106, "the and not " * 100_000, None),
             (107, "q" * 1_200_000, None)]
    got = L.identify(llm.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    by = {(r.doc_id, round(r.score, 3)): r.lang_pred for r in got}
    names = {r.doc_id: r.lang_pred for r in got if r.doc_id != 105}
    assert len(got) == len(rows)
    assert [names[k] for k in (100, 101, 102, 104, 106)] == ["und", "und", "und", "de", "en"]
    assert names[103] in ("de", "en") and by[(103, 0.0)] and by[(107, 0.0)] == names[103]
    assert sorted(r.lang_pred for r in got if r.doc_id == 105) == ["de", "en"]
    assert names[None] == "de" and not [r for r in got if r.doc_id is None][0].held_out


def test_nothing_to_learn(llm):
    schema = "doc_id long, text string, lang string"
    assert L.identify(llm.createDataFrame([], schema)).count() == 0
    got = L.identify(llm.createDataFrame([(1, "the", None), (2, None, "en")], schema)).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
