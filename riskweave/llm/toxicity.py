"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of a lexicon, second-person words near lexicon words,
capitals, punctuation, and rates of obfuscated spellings. The lexicon is learned from
labelled texts: words, and beginnings of words, that are much more frequent in toxic
ones. Trees and calibration are Spark ML models; scoring is one narrow pass.

Labelled rows are dealt to folds by crc32 of the doc_id: fold 0 is held out and never
read for learning, folds 1 and 2 give the lexicon, 3 the trees, 4 the calibration, so
that no step learns from features fitted to its own rows. Learning reads a sample of
about ``sample_rows`` labelled rows (all, if there are fewer), chosen by a hash.

Defined results: null texts are empty, and empty texts get a score too; labels that are
null, or of documents that do not exist, are not used; of several labels of a doc_id
the greatest counts; where a learning fold lacks one of the classes, every score is the
share of toxic rows among the sample (0 without rows). Rows with equal doc_ids are
scored row by row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, per_row, pick, slices, text_bytes, write_table

SAMPLE_ROWS = 20_000
LEXICON_SIZE = 5_000
MIN_TOXIC_DOCS = 3
MIN_LOG_ODDS = 2.0
STEMS = (4, 5, 6)
NEAR = 6
TREES, DEPTH = 20, 4

# Second-person words of the languages of the corpus.
SECOND_PERSON = frozenset("""
you your yours yourself yourselves du dich dir dein deine deinen deiner deinem ihr euch euer eure tu te toi ton ta tes
vous votre vos ti usted ustedes vosotros vuestro vuestra
""".split())
# Look-alikes of letters in obfuscated spellings.
LOOK_ALIKES = str.maketrans("013457@$!", "oieastasi")
INNER = re.compile(r"[^\W\d_][\d@$!*#.\-_]+[^\W\d_]")
TRIPLE = re.compile(r"([^\W\d_])\1\1")
NOISE = re.compile(r"[^\w]|[\d_]")

FEATURES = ("hit_density", "stem_density", "hit_weight", "max_weight", "distinct_hits", "second_person", "near_second",
            "obfuscated", "hidden_hits", "capitals", "shouted", "punctuation", "exclamations", "log_words")
UPPER = np.zeros(256, bool)
UPPER[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
PUNCT = np.zeros(256, bool)
PUNCT[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True


def word_codes(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, code of each word, offsets by text); words are parted by ASCII white space."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    for c in "\t\n\x0b\x0c\r":
        texts = pc.replace_substring(texts, c, " ")
    parts = pc.split_pattern(texts, " ")
    coded = parts.flatten().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    words = coded.dictionary.to_pylist()
    codes = np.asarray(coded.indices).astype(np.int64)
    off = np.asarray(parts.offsets, np.int64) - parts.offsets[0].as_py()
    if "" in words:
        real = codes != words.index("")
        kept = np.concatenate([[0], np.cumsum(real)])
        codes, off = codes[real], kept[off]
    return words, codes, off


def plain(word: str) -> str:
    """Lower case, letters only."""
    return NOISE.sub("", word.lower())


def _entries(stem: str) -> list[str]:
    """A word's lexicon entries: itself, and its beginnings (marked by a trailing star)."""
    return [stem] + [stem[:k] + "*" for k in STEMS if len(stem) > k] if stem else []


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entry, toxic, clean): documents with the entry, counted within a slice."""
    for batch in slices(batches, "text"):
        words, codes, off = word_codes(column(batch, "text"))
        toxic = column(batch, "toxic").to_numpy()
        row = np.repeat(np.arange(batch.num_rows), np.diff(off))
        pairs = np.unique(row * len(words) + codes) if len(codes) else np.zeros(0, np.int64)
        entries: dict[str, list[int]] = {}
        lists = {c: _entries(plain(words[c])) for c in np.unique(pairs % max(len(words), 1)).tolist()}
        last, seen = -1, set()
        for p in pairs.tolist():
            r, c = divmod(p, len(words))
            if r != last:
                last, seen = r, set()
            for e in lists[c]:
                if e not in seen:
                    seen.add(e)
                    entries.setdefault(e, [0, 0])[0 if toxic[r] else 1] += 1
        if entries:
            n = list(entries.values())
            yield pa.RecordBatch.from_arrays([pa.array(entries, pa.string()), pa.array([x[0] for x in n], pa.int64()),
                                              pa.array([x[1] for x in n], pa.int64())], names=["entry", "toxic", "clean"])


def learn_lexicon(labelled: DataFrame, size: int = LEXICON_SIZE) -> dict[str, float]:
    """Entry to log-odds for at most ``size`` entries that mark toxic texts; labelled: (text, toxic)."""
    n = labelled.agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).first()
    toxic, clean = n["t"] or 0, n["n"] - (n["t"] or 0)
    if not toxic or not clean:
        return {}
    counts = (labelled.mapInArrow(_token_counts, "entry string, toxic long, clean long").groupBy("entry")
              .agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).filter(F.col("t") >= MIN_TOXIC_DOCS))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    best = counts.withColumn("w", odds).filter(F.col("w") >= MIN_LOG_ODDS).orderBy(F.desc("w"), "entry").limit(size)
    return {r["entry"]: float(r["w"]) for r in best.select("entry", "w").collect()}


def features(texts: pa.Array, lexicon: dict[str, float]) -> np.ndarray:
    """(texts, FEATURES) of an Arrow array of texts."""
    raw, at = text_bytes(texts)
    words, codes, off = word_codes(texts)
    n, m = len(texts), len(words)
    weight, stem_weight, flags = np.zeros(m), np.zeros(m), np.zeros((m, 4), bool)
    ident = np.zeros(m, np.int64)
    names: dict[str, int] = {}
    for i, w in enumerate(words):
        stem = plain(w)
        hit = lexicon.get(stem, 0.0)
        begin = max((lexicon.get(stem[:k] + "*", 0.0) for k in STEMS if len(stem) > k), default=0.0)
        odd = hidden = False
        if not w.isalpha() and (INNER.search(w) or TRIPLE.search(w)):
            odd = True
        elif TRIPLE.search(w):
            odd = True
        if odd and not hit:
            shown = plain(w.lower().translate(LOOK_ALIKES))
            for s in (shown, TRIPLE.sub(r"\1", shown), plain(w)):
                if s in lexicon:
                    hit, hidden = lexicon[s], True
                    break
        weight[i], stem_weight[i] = hit, begin
        flags[i] = stem in SECOND_PERSON, odd, hidden, len(w) > 2 and w.isupper()
        ident[i] = names.setdefault(stem, len(names)) if hit or begin else -1
    count = np.diff(off)
    total = np.maximum(count, 1)
    hit = (weight[codes] > 0) | (stem_weight[codes] > 0)
    value = np.maximum(weight, stem_weight)[codes]
    row = np.repeat(np.arange(n), count)
    best = np.zeros(n)
    np.maximum.at(best, row, value)
    found = np.unique(row[hit] * max(len(names), 1) + ident[codes[hit]])
    distinct = np.bincount(found // max(len(names), 1), minlength=n)
    second = np.concatenate([[0], np.cumsum(flags[codes, 0])])
    lo = np.maximum(np.arange(len(codes)) - NEAR, off[:-1][row])
    hi = np.minimum(np.arange(len(codes)) + NEAR + 1, off[1:][row])
    near = hit & (second[hi] - second[lo] > 0)
    sums = lambda v: np.bincount(row, weights=v, minlength=n)
    size = np.maximum(np.diff(at), 1)
    out = np.column_stack([
        sums(weight[codes] > 0) / total, sums(stem_weight[codes] > 0) / total, sums(value) / total, best, distinct,
        sums(flags[codes, 0]) / total, sums(near) / total, sums(flags[codes, 1]) / total, sums(flags[codes, 2]) / total,
        per_row(UPPER[raw], at) / size, sums(flags[codes, 3]) / total, per_row(PUNCT[raw], at) / size,
        per_row(raw == ord("!"), at) / size, np.log1p(count)])
    return out


def with_features(src: DataFrame, lexicon: dict[str, float], *keep: str) -> DataFrame:
    """``keep`` columns of src (with a text) and FEATURES; the lexicon, of bounded size, goes with the task."""
    types = dict(src.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            got = features(column(batch, "text"), lexicon)
            yield pa.RecordBatch.from_arrays([*(column(batch, c) for c in keep), *map(pa.array, got.T.copy())],
                                             names=[*keep, *FEATURES])

    return src.select(*keep, "text").mapInArrow(
        run, ", ".join([*(f"{c} {types[c]}" for c in keep), *(f"{f} double" for f in FEATURES)]))


def fold() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))


def score_toxicity(docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS,
                   lexicon_size: int = LEXICON_SIZE, trees: int = TREES, depth: int = DEPTH, seed: int = 17) -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.5)."""
    src = pick(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    own = (pick(labels, doc_id="doc_id", toxic="toxic").withColumn("doc_id", F.col("doc_id").cast("long"))
           .filter("doc_id is not null and toxic is not null").withColumn("fold", fold()).filter("fold > 0")
           .groupBy("doc_id", "fold").agg(F.max("toxic").alias("toxic")))
    own = write_table(own, "tox-labels")
    n = own.count()
    if n > sample_rows:
        # about sample_rows rows, by a hash: a bound that holds at any size, so the join may broadcast them
        own = own.filter(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1_000_000)) < int(1e6 * sample_rows / n))
    learn = write_table(src.join(F.broadcast(own), "doc_id").select("text", F.col("toxic").cast("long").alias("toxic"), "fold"),
                        "tox-sample")
    lexicon = learn_lexicon(learn.filter("fold <= 2"), lexicon_size)
    held = (F.coalesce(fold(), F.lit(-1)) == 0).alias("held_out")
    sizes = {(r["fold"], r["toxic"]): r["count"] for r in learn.groupBy("fold", "toxic").count().collect()}
    if not all(sizes.get((f, t)) for f in (3, 4) for t in (0, 1)):
        toxic, every = sum(v for (_, t), v in sizes.items() if t), sum(sizes.values())
        score = F.lit(toxic / every if every else 0.0)
        return src.select("doc_id", held, score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))

    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    train = vector.transform(write_table(with_features(learn.filter("fold >= 3").coalesce(8), lexicon, "toxic", "fold"), "tox-train"))
    trees_model = GBTClassifier(labelCol="toxic", featuresCol="features", maxIter=trees, maxDepth=depth, stepSize=0.2,
                                seed=seed, cacheNodeIds=False).fit(train.filter("fold = 3").withColumn("toxic", F.col("toxic").cast("double")))
    raised = lambda d: trees_model.transform(d).withColumn("raw", vector_to_array("probability")[1])
    calibration = IsotonicRegression(labelCol="toxic", featuresCol="raw", predictionCol="score").fit(
        raised(train.filter("fold = 4")).select("raw", F.col("toxic").cast("double").alias("toxic")))
    scored = calibration.transform(raised(vector.transform(with_features(src, lexicon, "doc_id"))).select("doc_id", "raw"))
    score = F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0))
    return scored.select("doc_id", held, score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
