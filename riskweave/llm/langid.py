"""Language identification by bitmask filters of character n-grams.

The model is one bit-sliced Bloom filter: a table of slots, each a mask with a bit for
every language. An n-gram sets its language's bit in HASHES slots; the AND of its slots
is the mask of all languages that contain it. A text's n-grams are looked up once each;
a language's popcount c over N n-grams, with the filter's false-positive rate f of that
language (its share of set bits to the power HASHES), is corrected to (c - f N) / (1 - f),
0 at least. The greatest corrected count decides; the score is its share of all of them.

N-grams are of 3 and 4 lower-case characters within a word, a word being a run of letters
with one mark on either side. A language's n-grams are the ``grams`` that most of its
sampled documents hold (2 at least). Learning reads text and lang of about
``sample_docs`` documents a language (all, if there are fewer), chosen by a hash, out of
those whose crc32(doc_id) mod 4 is not 2, for the ``max_languages`` languages of most
documents; both bound the model, whatever the corpus. Scoring is one narrow pass over
whole texts.

Defined results: ``und`` with score 0 for a text that is null or has no letter, and for
every text where nothing can be learned; a text with letters but no n-gram of any
language gets the language of most sampled documents, with score 0. Ties go to the
lesser language name. Copies of a document count once in the sample; rows with equal
doc_ids are predicted row by row; a null doc_id is neither held out nor learned from. Texts
over CHUNK bytes are counted in parts, cut at spaces (inside a word only where a part has
none), so their length is bounded by Arrow alone. Other columns, lang and source among
them, are not read for predictions.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import column, mix64, per_row, pick, slices, text_bytes, write_table

SIZES = (3, 4)
HASHES = 3
SLOTS = 1 << 18
GRAMS = 20_000
SAMPLE_DOCS = 2_000
MAX_LANGUAGES = 256
CHUNK = 1 << 19
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offsets by text) of lower-case texts."""
    raw, off = text_bytes(texts)
    try:
        codes = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        return codes, np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[off]
    except UnicodeDecodeError:   # bytes that are no UTF-8: text by text
        parts = [np.frombuffer(raw[a:b].tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
                 for a, b in zip(off[:-1], off[1:], strict=True)]
        return np.concatenate([np.zeros(0, np.uint32), *parts]), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def grams(texts: pa.Array) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """([(hashes, offsets by text) for each size], letters by text) of an Arrow array of lower-case texts."""
    codes, off = _code_points(texts)
    n, size = len(texts), np.diff(off)
    row = np.repeat(np.arange(n), size)
    letter = _letters()[codes]
    # one mark before each text; then runs of anything but letters shrink to one mark
    seq = np.zeros(len(codes) + n + 1, np.uint64)
    seq[np.arange(len(codes)) + row + 1] = np.where(letter, codes, 0)
    of = np.full(len(seq), n, np.int64)
    of[np.arange(len(codes)) + row + 1] = row
    keep = seq != 0
    keep[1:] |= seq[:-1] != 0
    keep[0] = True
    seq, of = seq[keep], of[keep]
    word = seq != 0
    out = []
    for k in SIZES:
        m = max(0, len(seq) - k + 1)
        ok = np.ones(m, bool)
        h = np.full(m, k, np.uint64)
        for j in range(k):
            h = h * np.uint64(0x9E3779B97F4A7C15) + seq[j:j + m]
            if 0 < j < k - 1:
                ok &= word[j:j + m]
        at = np.flatnonzero(ok)
        owner = of[np.where(word[at], at, at + 1)]   # the text of its first letter
        out.append((mix64(h[at]), np.searchsorted(owner, np.arange(n + 1))))
    return out, per_row(letter, off)


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Lower-case texts and their row numbers; one long text comes in parts."""
    texts = pc.utf8_lower(pc.fill_null(column(batch, "text").cast(pa.large_string()), ""))
    raw, off = text_bytes(texts)
    if len(raw) <= CHUNK or batch.num_rows > 1:
        yield texts, np.arange(batch.num_rows)
        return
    at = 0
    while at < len(raw):
        end = min(len(raw), at + CHUNK)
        if end < len(raw):
            gaps = np.flatnonzero(raw[at:end] <= 32)
            starts = np.flatnonzero((raw[at:end] & 0xC0) != 0x80)
            end = at + int(gaps[-1]) + 1 if len(gaps) else at + max(int(starts[-1]), 1)
        yield pa.array([raw[at:end].tobytes().decode("utf-8", "replace")], pa.large_string()), np.zeros(1, np.int64)
        at = end


class Filter:
    """Languages by n-gram: a bit-sliced Bloom filter."""

    def __init__(self, languages: list[str], entries: list[np.ndarray], fallback: int, slots: int = SLOTS):
        self.languages, self.fallback, self.slots = languages, fallback, slots
        self.table = np.zeros((slots, -(-len(languages) // 8)), np.uint8)
        for i, hashes in enumerate(entries):
            for at in self.places(hashes):
                self.table[at, i // 8] |= np.uint8(1 << i % 8)
        fill = np.array([np.count_nonzero(self.table[:, i // 8] >> np.uint8(i % 8) & 1) for i in range(len(languages))]) / slots
        self.false = np.minimum(fill ** HASHES, 0.999)

    def places(self, hashes: np.ndarray) -> list[np.ndarray]:
        """HASHES slots of each n-gram, from parts of its hash."""
        step = np.uint64(self.slots - 1)
        return [((hashes >> np.uint64(18 * j)) & step).astype(np.int64) for j in range(HASHES)]

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        """(n-grams, bytes): the languages that contain each n-gram, and some by chance."""
        first, *rest = self.places(hashes)
        out = self.table[first]
        for at in rest:
            out &= self.table[at]
        return out

    def corrected(self, counts: np.ndarray, total: np.ndarray) -> np.ndarray:
        return np.maximum(counts - self.false * total[:, None], 0) / (1 - self.false)

    def predict(self, batch: pa.RecordBatch) -> tuple[list[str], np.ndarray]:
        """(language, score) of each text."""
        n, width = batch.num_rows, len(self.languages)
        counts, total, letters = np.zeros((n, width)), np.zeros(n), np.zeros(n, np.int64)
        for texts, rows in _parts(batch):
            sized, some = grams(texts)
            letters[rows] += some
            for hashes, off in sized:
                masks = self.masks(hashes)
                total[rows] += np.diff(off)
                for i in range(width):
                    counts[rows, i] += per_row(masks[:, i // 8] >> np.uint8(i % 8) & np.uint8(1), off)
        held = self.corrected(counts, total)
        best, every = held.argmax(axis=1), held.sum(axis=1)
        best[every == 0] = self.fallback
        score = np.divide(held[np.arange(n), best], every, out=np.zeros(n), where=every > 0)
        return [self.languages[b] if c else UNKNOWN for b, c in zip(best.tolist(), letters.tolist(), strict=True)], np.where(letters > 0, score, 0.0)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, docs): documents of a language that hold the n-gram, counted within a slice."""
    for batch in slices(batches, "text", CHUNK):
        codes, langs = np.unique(np.array(column(batch, "lang").to_pylist(), object).astype(str), return_inverse=True)
        held: list[np.ndarray] = [np.zeros(0, np.uint64)] * batch.num_rows
        for texts, rows in _parts(batch):
            for hashes, off in grams(texts)[0]:
                for i, r in enumerate(rows.tolist()):
                    held[r] = np.concatenate([held[r], np.unique(hashes[off[i]:off[i + 1]])])
        for lang, name in enumerate(codes):
            own = [np.unique(held[r]) for r in np.flatnonzero(langs == lang)]
            found, n = np.unique(np.concatenate(own), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([str(name)] * len(found), pa.string()), pa.array(found.view(np.int64)),
                                              pa.array(n.astype(np.int64))], names=["lang", "gram", "docs"])


def fold() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))


def learn(docs: DataFrame, *, sample_docs: int = SAMPLE_DOCS, most_grams: int = GRAMS, max_languages: int = MAX_LANGUAGES,
          seed: int = 11) -> Filter | None:
    """The filter from documents (doc_id, text, lang) outside the held-out fold; None where there is nothing to learn."""
    known = docs.filter("lang IS NOT NULL AND text IS NOT NULL").filter(fold() != 2)
    sizes = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages).collect()
    if not sizes:
        return None
    rates = docs.sparkSession.createDataFrame([(r["lang"], min(1_000_000, 1_000_000 * sample_docs // r["n"] + 1)) for r in sizes],
                                              "lang string, share long")
    # at most max_languages rows, so the join may broadcast them
    sample = known.join(F.broadcast(rates), "lang").filter(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1_000_000)) < F.col("share"))
    sample = write_table(sample.select("lang", "text").distinct(), "lid-sample")
    counts = sample.mapInArrow(_gram_counts, "lang string, gram long, docs long").groupBy("lang", "gram").agg(F.sum("docs").alias("docs"))
    counts = counts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("docs"), "gram")))
    # most_grams rows a language at most
    best = counts.filter(F.col("rank") <= most_grams).filter("docs > 1 OR rank <= 500").select("lang", "gram").toPandas()
    names = sorted(r["lang"] for r in sizes)
    entries = [best.gram[best.lang == lang].to_numpy(np.int64).view(np.uint64) for lang in names]
    return Filter(names, entries, names.index(sizes[0]["lang"]))


def identify(docs: DataFrame, **params) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score (0 to 1)."""
    src = pick(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    model = learn(pick(docs, doc_id="doc_id", text="text", lang="lang"), **params)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", CHUNK):
            if model is None:
                names, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            else:
                names, score = model.predict(batch)
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(names, pa.string()), pa.array(score)],
                                             names=["doc_id", "lang_pred", "score"])

    found = src.mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
