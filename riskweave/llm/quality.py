"""Quality rules: base counts of a text and cross-document line frequency.

Lines are normalised and hashed; per host (the ``source`` column) the operator
counts the distinct documents that hold a line, removes lines above the limit
and rejects documents that this leaves depleted.

Defined results: a null text is empty; a null host counts as the host ``''``;
documents of one host with equal texts count once, so that a group of copies
does not turn its own text into boilerplate; lines of every length count, so a
paragraph in more documents than the limits allow is boilerplate like a short line;
rows with equal doc_ids are judged row by row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, freed, mix64, per_row, pick, rows, slices, text_bytes, write_table

MIN_WORDS = 20
MAX_REPEAT_PCT = 30
WINDOW = 8
LIMIT_SHARE = 0.01
LIMIT_DOCS = 10
MAX_REMOVED_SHARE = 0.5

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

STATS = ("doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
         "n_repeat_words long, text_hash long, lines array<struct<h:long,words:long>>")
STATS_SLICE = 1 << 20


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def line_hash(line: bytes) -> int:
    """Hash of a normalised line: white space collapsed, lower case, each digit as 0."""
    s = " ".join(line.decode("utf-8", "replace").lower().split())
    return _signed(xxhash.xxh3_64_intdigest("".join("0" if c.isdigit() else c for c in s) if any(map(str.isdigit, s)) else s))


def repeat_words(codes: np.ndarray, row: np.ndarray, n_rows: int, window: int = WINDOW) -> np.ndarray:
    """Per row, the words covered by ``window``-word windows that occur twice or more in that row.

    codes: word codes of all rows in order; row: the row of each word. Windows are
    matched by hash and then compared word by word.
    """
    n = len(codes) - window + 1
    if n <= 0:
        return np.zeros(n_rows, np.int64)
    base = mix64(codes.astype(np.uint64) + np.uint64(1))
    h = np.zeros(n, np.uint64)
    for j in range(window):
        h = h * np.uint64(0x9E3779B97F4A7C15) + base[j:j + n]
    h = mix64(h ^ mix64(row[:n].astype(np.uint64) + np.uint64(0x51ED27)))
    start = np.flatnonzero(row[:n] == row[window - 1:])
    order = start[np.argsort(h[start], kind="stable")]
    a, b = order[:-1], order[1:]
    same = np.flatnonzero((h[a] == h[b]) & (row[a] == row[b]))
    a, b = a[same], b[same]
    for j in range(window):
        ok = codes[a + j] == codes[b + j]
        a, b = a[ok], b[ok]
    edge = np.zeros(len(codes) + 1, np.int64)
    hit = np.unique(np.concatenate([a, b]))
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + window, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(row[covered], minlength=n_rows)


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", STATS_SLICE):
        raw, off = text_bytes(column(batch, "text"))
        data, n = raw.tobytes(), batch.num_rows
        texts = [data[off[i]:off[i + 1]] for i in range(n)]
        words = [t.split() for t in texts]
        n_words = np.fromiter(map(len, words), np.int64, n)
        flat = np.empty(int(n_words.sum()), object)
        flat[:] = [w for ws in words for w in ws]
        codes = pd.factorize(flat)[0] if len(flat) else np.zeros(0, np.int64)
        n_repeat = repeat_words(codes, np.repeat(np.arange(n), n_words), n)
        dup, hashes, sizes, ends = [], [], [], [0]
        for t in texts:
            seen, found, again = set(), {}, 0
            for line in t.split(b"\n"):
                k = len(line.split())
                if k:
                    again += line in seen
                    seen.add(line)
                    h = line_hash(line)
                    found[h] = found.get(h, 0) + k
            dup.append(again)
            hashes.extend(found)
            sizes.extend(found.values())
            ends.append(len(hashes))
        lines = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(hashes, pa.int64()), pa.array(sizes, pa.int64())], ["h", "words"]))
        yield pa.RecordBatch.from_arrays([
            column(batch, "doc_id"), column(batch, "host"), pa.array(n_words),
            pa.array(per_row((raw & 0xC0 != 0x80) & ~SPACE[raw], off)), pa.array(per_row(SYMBOLS[raw], off)),
            pa.array(dup, pa.int64()), pa.array(n_repeat.astype(np.int64)), column(batch, "text_hash"),
            lines,
        ], names=["doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                  "text_hash", "lines"])


def text_stats(docs: DataFrame) -> DataFrame:
    """Base counts and the hashed lines of each document (``STATS``); one narrow pass over the texts."""
    src = pick(docs, doc_id="doc_id", host="source", text="text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("host").cast("string"), F.lit("")).alias("host"),
        "text", F.xxhash64("text").alias("text_hash"))
    return src.mapInArrow(freed(_stats), STATS)


def frequent_lines(stats: DataFrame, limit_share: float = LIMIT_SHARE, limit_docs: int = LIMIT_DOCS) -> DataFrame:
    """(host, h, n_docs): lines in more than ``limit_docs`` distinct documents of a host and more than its ``limit_share``."""
    once = stats.groupBy("host", "text_hash").agg(F.first("lines").alias("lines"))
    hosts = once.groupBy("host").agg(F.count("*").alias("host_docs"))
    n = (once.select("host", F.explode("lines.h").alias("h"))
         .groupBy("host", "h").agg(F.count("*").alias("n_docs")).filter(F.col("n_docs") > limit_docs))
    return n.join(hosts, "host").filter(F.col("n_docs") > F.col("host_docs") * limit_share).select("host", "h", "n_docs")


def quality_rules(docs: DataFrame, *, min_words: int = MIN_WORDS, max_repeat_pct: int = MAX_REPEAT_PCT,
                  limit_share: float = LIMIT_SHARE, limit_docs: int = LIMIT_DOCS,
                  max_removed_share: float = MAX_REMOVED_SHARE) -> DataFrame:
    """One row per document: base counts, removed lines, ``base_failed`` and ``kept``.

    A document is depleted if its frequent lines hold more than ``max_removed_share``
    of its words.
    """
    # the row number is written with the row, and so is the same whenever it is read
    stats = write_table(text_stats(docs).withColumn("row", F.monotonically_increasing_id()), "line-stats")
    bad = write_table(frequent_lines(stats, limit_share, limit_docs), "frequent-lines")
    hits = (stats.select("row", "host", F.explode("lines").alias("l"))
            .select("row", "host", F.col("l.h").alias("h"), F.col("l.words").alias("words"))
            .join(bad.select("host", "h"), ["host", "h"])
            .groupBy("row").agg(F.sum("words").alias("removed_words"), F.collect_set("h").alias("removed_lines")))
    out = stats.select("row", "doc_id", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words").join(hits, "row", "left").drop("row")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    depleted = F.col("removed_words") > max_removed_share * F.col("n_words")
    return (out.withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("long")))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & ~depleted))


def _drop_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows(batches):
        texts, bad = column(batch, "text").to_pylist(), column(batch, "removed_lines").to_pylist()
        out = [t if not b or t is None else _without(t, set(b)) for t, b in zip(texts, bad, strict=True)]
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", pa.array(out, batch.schema.field(at).type))


def _without(text: str, bad: set[int]) -> str:
    return "\n".join(x for x in text.split("\n") if not x.encode().split() or line_hash(x.encode()) not in bad)


def apply_quality(docs: DataFrame, **params) -> DataFrame:
    """The documents that the rules keep, without their frequent lines; the columns of ``docs``, n_chars made anew."""
    verdict = (quality_rules(docs, **params).filter("kept").dropDuplicates(["doc_id", "text_hash"])
               .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "removed_lines"))
    own = docs.select("doc_id", "text", "lang", "source", "n_chars")
    joined = own.join(verdict, own["doc_id"].cast("long").eqNullSafe(F.col("_id"))
                      & (F.xxhash64("text") == F.col("_hash"))).drop("_id", "_hash")
    out = joined.mapInArrow(freed(_drop_lines), joined.schema).drop("removed_lines")
    return out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
