import random

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor

from riskweave.llm import spm

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, "Hello  world", "  lead", "tab\tx\ny", "ﬁ ﬀ é é Ａ", "　x", "▁x ▁", "a\x00b", "trail   ", "\r\n",
       " " * 40 + "x", "</s> <s> <unk> <0x41>", "日本語のテキスト 한국어 😀😀", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "0123456789" * 5,
       "internationalization, pneumonoultramicroscopic! https://example.com/a?b=1&c=2", "\n", " ", " "]


@pytest.fixture(scope="module")
def encoder():
    return spm.Encoder(PATH)


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


def encode(enc, texts):
    ids, at = enc.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]


def _lists(found):
    ids, n = found
    return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]


def test_equals_the_library_on_odd_texts(encoder, library):
    assert encode(encoder, ODD) == [library.encode(t or "") for t in ODD]


def test_equals_the_library_on_the_corpus(encoder, library):
    texts = [t for (t,) in duckdb.connect().sql("select text from '/root/testdata/sf0.01/documents.parquet'").fetchall()]
    assert encode(encoder, texts) == [library.encode(t or "") for t in texts]


def test_equals_the_library_on_random_strings(encoder, library):
    rng = random.Random(1)
    pieces = [p for p in encoder.model.id if p]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 12))) for _ in range(3000)]
    texts += ["".join(rng.choices("abcdeno rst.,é\n", k=rng.randrange(1, 30))) for _ in range(2000)]
    assert encode(encoder, texts) == [library.encode(t) for t in texts]


def test_long_words_equal_the_library(encoder, library):
    rng = random.Random(2)
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    words = [draw("ABCDEFabcdefghijklmnop0123456789+/=", n) for n in (49, 700, 5000)] + [draw([chr(c) for c in range(0x4E00, 0x9FFF)], 400)]
    words += ["a" * 300, "ab" * 200, "internationalization" * 30, "é" * 100 + "ü" * 60, "😀" * 80, "x́" * 90]
    texts = [t for w in words for t in (w, f"before {w} after")]
    for t in texts:
        assert encode(encoder, [t]) == [library.encode(t)]
    assert encode(encoder, texts) == [library.encode(t) for t in texts]


def test_long_and_batched_words_agree():
    rng = random.Random(3)
    for merges in (True, False):
        enc = spm.Encoder(PATH, merges=merges)
        for n in (1, 50, 300, 1500):
            chars = np.array([ord(rng.choice("abcdethé中")) for _ in range(n)])
            assert enc.viterbi(chars[None, :])[0].tolist() == enc.viterbi_long(chars)
    chars = np.array([rng.randrange(1, 0x10000) for _ in range(5000)])
    assert (enc._prefix_hashes(chars) == spm.substring_hashes(chars[None, :])[0]).all()


def test_texts_with_every_private_character(encoder, library):
    texts = ["".join(map(chr, range(0xE000, 0xF900))) + " x", "y z"]
    assert encode(encoder, texts) == [library.encode(t) for t in texts]


def test_round_trip(encoder):
    for t, ids in zip(ODD, encode(encoder, ODD), strict=True):
        assert encoder.model.decode(ids) == (t or "").replace("▁", " ")


def test_unigram_scores_are_maximal():
    """With scores added up, the Viterbi beats every other way to cut a short word."""
    enc = spm.Encoder(PATH, merges=False)
    score = lambda w: enc.model.scores[enc.model.id[w]] if w in enc.model.id else enc.model.scores.min() - 10

    def best(word):
        ways = [score(word) if word in enc.model.id or len(word) == 1 else -1e30]
        ways += [score(word[:i]) + best(word[i:]) for i in range(1, len(word)) if word[:i] in enc.model.id or i == 1]
        return max(ways)

    words = ["▁the", "▁other", "abcab", "▁in", "zzz"]
    for w, ids in zip(words, _lists(enc.encode_words(words)), strict=True):
        assert sum(enc.model.scores[i] for i in ids) == best(w)


def test_a_forgotten_store_gives_the_same_ids(library):
    enc = spm.Encoder(PATH, cache_words=3)
    texts = ["one two three four five", "six seven eight", "one two three"]
    assert [encode(enc, [t])[0] for t in texts] == [library.encode(t) for t in texts]


def test_operator(make_docs, library):
    rows = [*enumerate(ODD), (0, "again"), (None, "x" * 100_000)]
    coded = spm.encode(make_docs(rows, extra=True))
    got = sorted(((r["doc_id"], list(r["ids"]), r["text"]) for r in spm.decode(coded).collect()), key=repr)
    assert got == sorted(((i, library.encode(t or ""), (t or "").replace("▁", " ")) for i, t in rows), key=repr)
    both = sorted(((r["doc_id"], list(r["ids"]), r["text"]) for r in spm.round_trip(make_docs(rows)).collect()), key=repr)
    assert both == got
    assert spm.decode(spm.encode(make_docs([]))).count() == 0
