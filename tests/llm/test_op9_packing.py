import random
import subprocess
import sys
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from riskweave.llm import packing
from riskweave.llm.words import IdStore

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", None, " a\tb\x0bc　d\x85e  ", "<|endoftext|> x<|startoftext|>y", "I'm we'll don't 'S", "H̱ Á İI ΑΣ", "\n\n",
       "e\x1cf", "x" * 5000, "日本語 한국어 😀😀", " ́a", " ", "ªº µß ÀÉÎ. ÿ, ĀB ﬁ K.", "a.b, c., .d", "Word. WORD, word"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_library(library):
    texts = ODD + [t for (t,) in duckdb.connect().sql("select text from '/root/testdata/sf0.01/documents.parquet'").fetchall()]
    enc = packing.WordIds(PATH, cache_words=5000)
    for at in range(0, len(texts), 100):
        ids, off = enc.encode(pa.array(texts[at:at + 100], pa.string()))
        for k, t in enumerate(texts[at:at + 100]):
            assert ids[off[k]:off[k + 1]].tolist() == ids_of(library, t)


def test_best_fit_takes_the_tightest_bin():
    where, offsets, fills = packing.best_fit([6, 5, 4, 3, 2, 10], 10)
    assert where == [0, 1, 0, 1, 1, 2] and offsets == [0, 0, 6, 5, 8, 0] and fills == [10, 10, 10]


def verify(got, rows, library, capacity):
    """Pieces cover their documents, sequences hold at most the capacity without gaps."""
    want = []
    for i, t in rows:
        ids = np.array(ids_of(library, t) + [0], "<u4")
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want.append((i, piece, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=repr) == sorted(want, key=repr)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        end = 0
        for at, length in sorted(parts):
            assert at == end
            end += length
        assert end <= capacity
    return len(bins), sum(w[3] for w in want)


@pytest.mark.parametrize("items_per_task", [50_000, 7])
def test_pack(make_docs, library, items_per_task):
    rng = random.Random(1)
    texts = ODD + [" ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(1, 60))) for _ in range(300)]
    rows = [*enumerate(texts), (0, "again"), (None, "no id"), (None, "no id")]
    docs = make_docs(rows, extra=True).repartition(6)
    got = packing.pack(docs, capacity=64, items_per_task=items_per_task, slack=0).collect()
    bins, total = verify(got, rows, library, 64)
    if items_per_task > 1000:
        assert bins <= 1.02 * -(-total // 64) + 1


def test_items_that_never_fit_end_the_rounds(make_docs, library):
    rows = [(i, "one two three four five six") for i in range(40)]  # 7 tokens each, two do not fit
    bins, _ = verify(packing.pack(make_docs(rows).repartition(4), capacity=12, items_per_task=9).collect(), rows, library, 12)
    assert bins == 40


def test_empty_table(make_docs):
    assert packing.pack(make_docs([])).count() == 0


def test_production_capacity_is_near_the_bound(llm, library):
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    bins, total = verify(packing.pack(docs).collect(), rows, library, 2048)
    assert bins <= 1.01 * -(-total // 2048) + 1


MEMORY = """
import random, resource
import pyarrow as pa
from riskweave.llm import packing
from riskweave.llm.words import IdStore
packing._bin_id = lambda level, k: (level << 56) + k    # no task here
rng = random.Random(3)
def batches(n):
    for _ in range(n):      # 16 MB, a partition of the check, of mostly new words
        yield pa.RecordBatch.from_pydict({"doc_id": pa.array(range(1000), pa.int64()), "text": [
            " ".join(f"{rng.getrandbits(20):x}" for _ in range(300)) for _ in range(1000)]})
peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024
run = packing._cut_and_pack(PATH, packing.CAPACITY, packing.END_ID, packing.FULL_SLACK)
list(run(batches(1)))
before = peak()
assert sum(b.num_rows for b in run(batches(10))) >= 10_000
print(peak() - before)
"""


def test_a_task_holds_little_beside_its_rows():
    out = subprocess.run([sys.executable, "-c", MEMORY.replace("PATH", repr(PATH))], capture_output=True, text=True, check=True, timeout=300)
    assert float(out.stdout) < 150      # 16 MB of texts; 287 with slices of 10 MB and a store of 600,000 words


def test_spellings_of_a_word_share_a_stem():
    """The model runs once a lower-case stem, not once a spelling with its stop or comma."""
    enc = packing.WordIds(PATH)
    words = ["Haus", "haus", "HAUS.", "haus,", "Haus.", "Größe,", "größe", "h4us", "haus..", "."]
    ids, at = enc.encode(pa.array([" ".join(words), None, "haus, GRÖßE."]))
    whole = lambda t: enc.tokenizer.encode(t, add_special_tokens=False).ids
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [whole(" ".join(words)), [], whole("haus, größe.")]
    # two stems, two marks, two words for the whole tokenizer, and the empty one
    assert len(enc.slot) == 7


def test_runs_of_marks_are_parted_from_their_stem(library):
    """Only the run goes through the whole tokenizer, once for all stems."""
    enc = packing.WordIds(PATH)
    words = ["Haus%%%", "haus!?", "HAUS", "größe%%%", "a<|", "l'", "x...", "'s", "d'|>", "ªº--", "don't!", "(k)", "É\\]^_`{~"]
    text = " ".join(words)
    ids, _ = enc.encode(pa.array([text]))
    assert ids.tolist() == ids_of(library, text)
    # parted words leave no entry of their own
    assert {w[1:] for w in enc.slot if w[:1] == packing.WHOLE} == {"%%%", "!?", "<|", "'", "...", "'|>", "--", "\\]^_`{~",
                                                                 "'s", "don't!", "(k)"}


def test_a_full_store_keeps_the_words_in_use():
    """Words that most calls ask for stay when the store is full; it forgot them all before."""
    class Lengths(IdStore):
        def encode_words(self, words):
            learnt.extend(words)
            return np.array([len(w) for w in words for _ in w], np.int32), np.array([len(w) for w in words], np.int64)

    learnt, store, used = [], Lengths(20), [f"used{'x' * k}" for k in range(8)]
    for call in range(30):
        words = [*used, *(f"{call}-{k}" for k in range(7)), ""]
        ids, off = store.lookup(words, np.arange(len(words))[::-1], np.arange(len(words) + 1))
        assert [ids[a:b].tolist() for a, b in zip(off, off[1:], strict=False)] == [[len(w)] * len(w) for w in words[::-1]]
        assert len(store.slot) <= 20 + len(words)
    assert all(learnt.count(w) == 1 for w in [*used, ""])
