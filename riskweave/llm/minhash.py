"""Near-duplicate classes by ProbMinHash, banding and verification.

A text is its five-word shingles, weighted by how often each occurs. ProbMinHash
gives every shingle a Poisson process of arrivals with its weight as rate; each
arrival falls on one of the signature's slots, and a slot keeps the earliest. A
shingle stops when its next arrival comes after the latest of the slots, so most
stop after one or two. Slots of two texts agree with probability equal to their
probability Jaccard similarity.

Texts that agree on a band are candidates. Equal texts collapse first, so a group
of copies is one candidate. Candidates that hang together by buckets form a group; a
group is solved in one task if it is small. In a larger one, buckets are made anew
from prefixes: with the group's shingles ordered by rarity, two texts of similarity s
share a shingle among the rarest that make up more than 1 - s of either, which is
exact and parts heavily edited copies from the rest. What is still large is compared
with one text of its group first, and what that leaves apart is compared block by
block, all in tasks of bounded size. Links are verified by the exact probability
Jaccard similarity, and links between texts already in one class are not looked for.

Defined results: words are parted by ASCII white space; a text of one to four words is
one shingle; null texts and texts without words are equal to each other; class_id is
the least doc_id of the class (null if it has none); repeated rows are copies. Texts
are told apart by a 64-bit hash of their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column, freed, mix64, pick, rows, slices, write_table
from .graph import components

WORDS = 5
THRESHOLD = 0.8
ROUNDING = 1e-9  # a similarity that equals the threshold counts, whatever its sum rounds to
BANDS, ROWS = 24, 5
GROUP_TEXTS = 1024
GROUP_SHINGLES = 2_000_000
U = np.uint64


# ---- shingles -------------------------------------------------------------------

def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, offsets by text); words are parted by ASCII white space."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    for c in "\t\n\x0b\x0c\r":
        texts = pc.replace_substring(texts, c, " ")
    parts = pc.split_pattern(texts, " ")
    coded = parts.flatten().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) if w else 0 for w in coded.dictionary.to_pylist()), np.uint64,
                         len(coded.dictionary))
    every = hashes[np.asarray(coded.indices)] if len(coded) else np.zeros(0, np.uint64)
    off = np.asarray(parts.offsets, np.int64) - parts.offsets[0].as_py()
    real = every != 0
    kept = np.concatenate([[0], np.cumsum(real)])
    return every[real], kept[off]


def text_hash(words: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each text's words, in order."""
    return np.fromiter((xxhash.xxh3_64_intdigest(words[a:b].tobytes()) for a, b in zip(off[:-1], off[1:], strict=True)),
                       np.uint64, len(off) - 1).view(np.int64)


def shingles(words: np.ndarray, off: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, times) of the distinct shingles of each text, in order of text and hash."""
    n = np.diff(off)
    h = np.zeros(max(len(words) - size + 1, 0), np.uint64)
    for j in range(size):
        h = h * U(0x9E3779B97F4A7C15) + words[j:j + len(h)]
    h = mix64(h)
    row = np.repeat(np.arange(len(n)), n)
    inside = np.flatnonzero(row[:len(h)] == row[size - 1:]) if len(h) else np.zeros(0, np.int64)
    row, h = row[inside], h[inside]
    short = np.flatnonzero((n > 0) & (n < size))
    if len(short):
        whole = np.fromiter((xxhash.xxh3_64_intdigest(words[off[i]:off[i + 1]].tobytes()) for i in short), np.uint64, len(short))
        row, h = np.concatenate([row, short]), np.concatenate([h, whole])
    order = np.argsort(row.astype(np.uint64) << U(44) | h >> U(20), kind="stable")
    row, h = row[order], h[order]
    # equal shingles of a text may stand apart where the first 44 bits tie; sort those runs fully
    tie = (row[1:] == row[:-1]) & (h[1:] < h[:-1])
    if tie.any():
        order = np.lexsort((h, row))
        row, h = row[order], h[order]
    first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])])) if len(h) else inside[:0]
    return row[first], h[first], np.diff(np.append(first, len(h)))


# ---- ProbMinHash ----------------------------------------------------------------

def prob_minhash(row: np.ndarray, h: np.ndarray, weight: np.ndarray, n_rows: int, slots: int) -> np.ndarray:
    """Signatures (n_rows, slots): the shingle whose arrival was first in each slot."""
    best = np.full(n_rows * slots, np.inf)
    who = np.zeros(n_rows * slots, np.uint64)
    late = np.full(n_rows, np.inf)
    time, k = np.zeros(len(h)), 0
    weight = weight.astype(float)
    while len(h):
        k += 1
        u = mix64(h + U(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        time = time - np.log(((u >> U(12)).astype(float) + 0.5) / 2.0 ** 52) / weight
        on = time < late[row]
        row, h, weight, time, u = row[on], h[on], weight[on], time[on], u[on]
        if not len(h):
            break
        at = row * slots + (mix64(u ^ U(0xA5A5A5A5A5A5A5A5)) % U(slots)).astype(np.int64)
        np.minimum.at(best, at, time)
        won = time == best[at]
        who[at[won]] = h[won]
        live = row[np.concatenate([[True], row[1:] != row[:-1]])]
        late[live] = best.reshape(n_rows, slots)[live].max(axis=1)
    return who.reshape(n_rows, slots)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    cut = signatures.reshape(len(signatures), bands, rows)
    h = np.arange(1, bands + 1, dtype=np.uint64)[None, :] * U(0xD6E8FEB86659FD93)
    for j in range(rows):
        h = mix64(h * U(0x9E3779B97F4A7C15) + cut[:, :, j])
    return h.view(np.int64)


def _sign(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words, off = _words(column(batch, "text"))
            row, h, times = shingles(words, off)
            keys = band_keys(prob_minhash(row, h, times, batch.num_rows, bands * rows), bands, rows)
            n = np.bincount(row, minlength=batch.num_rows)
            keys = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(n, bands, 0))]), pa.int32()),
                                            pa.array(keys[n > 0].reshape(-1)))
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(text_hash(words, off)), pa.array(n), keys],
                                             names=["doc_id", "t", "n", "keys"])
    return run


# ---- similarity -----------------------------------------------------------------

def probability_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray, at_least: float = 0.0) -> float:
    """Exact probability Jaccard of two weighted sets (sorted hashes, weights); 0 if surely below ``at_least``."""
    both, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    x, y = x.astype(float), y.astype(float)
    p, q = x / x.sum(), y / y.sum()
    if np.minimum(p[i], q[j]).sum() < at_least - ROUNDING:
        return 0.0
    only_x, only_y = x.sum() - x[i].sum(), y.sum() - y[j].sum()
    xs, ys = x[i], y[j]
    # sum over shared i of 1 / sum_k max(x_k / x_i, y_k / y_i); for shared k the first is larger iff x_k/y_k > x_i/y_i
    order = np.argsort(xs / ys)
    xs, ys = xs[order], ys[order]
    above = xs[::-1].cumsum()[::-1] + only_x   # x mass from this ratio on
    below = ys.cumsum() - ys + only_y          # y mass before it
    return float((1.0 / (above / xs + below / ys)).sum())


class _Sets:
    """Weighted sets of a group, their prefixes by rarity within it, and the classes found so far."""

    def __init__(self, hashes: list[np.ndarray], weights: list[np.ndarray], classes: list[int], threshold: float):
        self.hashes, self.weights, self.threshold = hashes, weights, threshold
        self.parent = {c: c for c in classes}
        self.classes = classes

    def find(self, i: int) -> int:
        c = self.classes[i]
        while self.parent[c] != c:
            self.parent[c] = self.parent[self.parent[c]]
            c = self.parent[c]
        return c

    def prefixes(self) -> list[np.ndarray]:
        flat = np.concatenate(self.hashes)
        tokens, code, n = np.unique(flat, return_inverse=True, return_counts=True)
        rank = np.empty(len(tokens), np.int64)
        rank[np.lexsort((tokens, n))] = np.arange(len(tokens))
        shared = n[code] > 1
        of, out = rank[code], []
        ends = np.cumsum([len(h) for h in self.hashes])
        for h, w, end in zip(self.hashes, self.weights, ends, strict=True):
            r, s = of[end - len(h):end], shared[end - len(h):end]
            out.append(r[prefix(r, w, self.threshold) & s])
        return out

    def links(self, side: list[int] | None = None) -> list[tuple[int, int]]:
        """Pairs of similar members, only as many as join the classes; with ``side``, only across sides."""
        found, held = [], {}
        for i, tokens in enumerate(self.prefixes()):
            tried: set[int] = set()
            for token in tokens.tolist():
                others = held.setdefault(token, [])
                for j in others:
                    if j in tried or side and side[i] == side[j]:
                        continue
                    tried.add(j)
                    if self.find(i) != self.find(j) and probability_jaccard(
                            self.hashes[i], self.weights[i], self.hashes[j], self.weights[j],
                            self.threshold) >= self.threshold - ROUNDING:
                        self.parent[self.find(i)] = self.find(j)
                        found.append((i, j))
                others.append(i)
        return found


def prefix(rank: np.ndarray, weight: np.ndarray, threshold: float) -> np.ndarray:
    """Mask of the rarest shingles that a similar text must share one of: the weight before each is at most 1 - threshold."""
    order = np.argsort(rank)
    before = weight[order].cumsum() - weight[order]
    mask = np.zeros(len(rank), bool)
    mask[order] = before <= (1 - threshold + ROUNDING) * weight.sum()
    return mask


def _solve(threshold: float):
    """Groups of rows (group, t, class, side, hashes, weights), sorted by group, to links (a, b)."""
    def close(rows: list[tuple]) -> list[tuple[int, int]]:
        hashes = [np.frombuffer(r[4], np.uint64) for r in rows]
        sets = _Sets(hashes, [_weights(r[5], len(h)) for r, h in zip(rows, hashes, strict=True)], [r[2] for r in rows], threshold)
        side = [r[3] for r in rows]
        return [(rows[i][1], rows[j][1]) for i, j in sets.links(side if len(set(side)) > 1 else None)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group = [], None
        for batch in batches:
            names = ("group", "t", "class", "side", "hashes", "weights")
            links = []
            for r in zip(*(column(batch, c).to_pylist() for c in names), strict=True):
                if r[0] != group:
                    links += close(held) if len(held) > 1 else []
                    held, group = [], r[0]
                held.append(r)
            if links:
                yield _pairs(links)
        if len(held) > 1 and (links := close(held)):
            yield _pairs(links)
    return run


def _pairs(links: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*links, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


# ---- Spark ----------------------------------------------------------------------

SIZE = "struct<texts:bigint,weight:bigint>"
SETS = f"t long, hashes binary, weights binary, group long, size {SIZE}"


def _weights(data: bytes, n: int) -> np.ndarray:
    """Weights of n shingles; nothing stands for ones."""
    return np.frombuffer(data, np.uint32) if data else np.ones(n, np.uint32)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    c = zstandard.ZstdCompressor(level=1)
    for batch in slices(batches, "text"):
        words, off = _words(column(batch, "text"))
        z = [c.compress((x or "").encode()) for x in column(batch, "text").to_pylist()]
        yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(text_hash(words, off)), pa.array(z, pa.binary())],
                                         names=["doc_id", "t", "z"])


def _unpack_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    d = zstandard.ZstdDecompressor()
    for batch in rows(batches):
        texts = pa.array([d.decompress(z) for z in column(batch, "z").to_pylist()], pa.binary()).cast(pa.string())
        for part in slices([pa.RecordBatch.from_arrays(
                [column(batch, "t"), texts, column(batch, "group"), column(batch, "size")],
                names=["t", "text", "group", "size"])], "text"):
            words, off = _words(column(part, "text"))
            row, h, times = shingles(words, off)
            ends = np.searchsorted(row, np.arange(part.num_rows + 1))
            yield pa.RecordBatch.from_arrays([
                column(part, "t"),
                pa.array([h[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary()),
                pa.array([times[a:b].astype(np.uint32).tobytes() if (times[a:b] > 1).any() else b""
                          for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary()), column(part, "group"),
                column(part, "size")], names=["t", "hashes", "weights", "group", "size"])


def _links_in_groups(rows: DataFrame, threshold: float) -> DataFrame:
    """Links of groups that each fit in a task; rows: group, t, class, side, hashes, weights."""
    return (rows.repartition("group").sortWithinPartitions("group", "t")
            .mapInArrow(freed(_solve(threshold)), "a long, b long"))


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for g, t, h, w in zip(*(column(batch, c).to_pylist() for c in ("group", "t", "hashes", "weights")), strict=True):
            h = np.frombuffer(h, np.int64)
            w = _weights(w, len(h)).astype(np.int64)
            for at in range(0, len(h), 100_000):
                m = len(h[at:at + 100_000])
                yield pa.RecordBatch.from_arrays([pa.array([g] * m, pa.int64()), pa.array([t] * m, pa.int64()),
                                                  pa.array(h[at:at + m]), pa.array(w[at:at + m])],
                                                 names=["group", "t", "h", "w"])


def _prefix_buckets(large: DataFrame, threshold: float) -> DataFrame:
    """(key, t): texts of a large group by each shingle of their prefix that another text of the group has."""
    tokens = large.select("group", "t", "hashes", "weights").mapInArrow(_tokens, "group long, t long, h long, w long").select(
        "group", "h", "t", "w")
    df = write_table(tokens.groupBy("group", "h").agg(F.count("*").alias("df")), "near-rarity")
    by_text = Window.partitionBy("t")  # a text's own shingles
    ranked = (tokens.join(df, ["group", "h"])
              .withColumn("total", F.sum("w").over(by_text))
              .withColumn("before", F.sum("w").over(by_text.orderBy("df", "h").rowsBetween(Window.unboundedPreceding, -1))))
    return ranked.filter((F.col("df") > 1) & (F.coalesce("before", F.lit(0)) <= (1 - threshold + ROUNDING) * F.col("total"))
                         ).select(F.xxhash64("group", "h").alias("key"), "t")


def _grouped(buckets: DataFrame) -> DataFrame:
    """(t, group): texts that hang together by buckets (key, t)."""
    least = buckets.groupBy("key").agg(F.min("t").alias("b"))
    return components(buckets.join(least, "key").select(F.col("t").alias("a"), "b")).select(
        F.col("node").alias("t"), F.col("comp").alias("group"))


def _sized(nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """groups with ``size``: texts and distinct shingles of the group."""
    size = groups.join(nodes.select("t", "n"), "t").groupBy("group").agg(
        F.struct(F.count("*").alias("texts"), F.sum("n").alias("weight")).alias("size"))
    return groups.join(size, "group").select("t", "group", "size")


def _verify_stars(rows: DataFrame, threshold: float) -> DataFrame:
    """Links of each text with one text of its group, that with the least t."""
    leaders = rows.groupBy("group").agg(F.min("t").alias("t")).join(rows.select("t", "hashes", "weights"), "t").select(
        "group", F.col("t").alias("a"), F.col("hashes").alias("ah"), F.col("weights").alias("aw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for a, ah, aw, b, bh, bw in zip(*(column(batch, c).to_pylist() for c in ("a", "ah", "aw", "t", "hashes", "weights")), strict=True):
                x, y = np.frombuffer(ah, np.uint64), np.frombuffer(bh, np.uint64)
                if a != b and probability_jaccard(x, _weights(aw, len(x)), y, _weights(bw, len(y)),
                                                  threshold) >= threshold - ROUNDING:
                    links.append((a, b))
            if links:
                yield _pairs(links)

    return rows.select("group", "t", "hashes", "weights").join(leaders, "group").mapInArrow(run, "a long, b long")


def _blocks(rows: DataFrame, classes: DataFrame, texts: int, shingle_limit: int) -> DataFrame:
    """Large groups cut into blocks; a task gets a pair of blocks, of which one holds texts outside the largest class.

    Links within a class are not looked for, so the blocks of the group's largest class
    meet only the blocks of the others.
    """
    rows = rows.join(classes, "t", "left").withColumn("class", F.coalesce("class", "t"))
    sizes = rows.groupBy("group", "class").agg(F.count("*").alias("c"))
    top = sizes.groupBy("group").agg(F.max(F.struct("c", "class")).alias("m")).select("group", F.col("m.class").alias("top"))
    rows = rows.join(top, "group").withColumn("rest", (F.col("class") != F.col("top")).cast("int"))
    parts = F.greatest(F.ceil(2 * F.col("size.texts") / texts), F.ceil(2 * F.col("size.weight") / shingle_limit)).cast("int")
    rows = rows.withColumn("parts", parts).withColumn(
        "block", F.pmod(F.xxhash64("t"), F.col("parts")).cast("int") + F.col("rest") * F.col("parts"))
    # blocks 0..p-1 hold the largest class, p..2p-1 the rest; pairs (i, j) with j of the rest and i <= j
    mates = F.when(F.col("rest") == 1, F.sequence(F.lit(0), 2 * F.col("parts") - 1)).otherwise(
        F.sequence(F.col("parts"), 2 * F.col("parts") - 1))
    pairs = rows.withColumn("mate", F.explode(mates))
    return pairs.select(
        F.xxhash64("group", F.least("block", "mate"), F.greatest("block", "mate")).alias("group"), "t", "class",
        F.when(F.col("block") == F.col("mate"), F.lit(-1)).otherwise(F.col("block")).alias("side"), "hashes", "weights")


def near_duplicates(docs: DataFrame, *, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
                    group_texts: int = GROUP_TEXTS, group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """(doc_id, t, class_id, first_t): the class of each document; (class_id, first_t) names the document that stands for it."""
    src = pick(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    signed = write_table(src.mapInArrow(freed(_sign(bands, rows)), "doc_id long, t long, n long, keys array<long>"), "near-signed")
    nodes = write_table(signed.groupBy("t").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"),
                                                F.first("keys").alias("keys")), "near-texts")
    members = nodes.select("t", F.explode("keys").alias("key"))
    full = write_table(members.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key"), "near-keys")
    buckets = write_table(members.join(full, "key").select("key", "t"), "near-buckets")
    groups = write_table(_sized(nodes, write_table(_grouped(buckets), "near-candidates")), "near-sized")
    # one document stands for a text: with its doc_id in the key, copies of a text meet nothing and are dealt out.
    # The candidates grow with the corpus, so they are never broadcast, small as they may be.
    heads = groups.join(nodes.select("t", F.col("doc_id").alias("_id")), "t").hint("merge")
    packed = src.mapInArrow(freed(_pack), "doc_id long, t long, z binary").withColumnRenamed("t", "_t")
    met = packed.join(heads, (F.col("_t") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    sets = write_table(met.groupBy("_t", "doc_id").agg(*(F.first(c).alias(c) for c in ("t", "z", "group", "size"))).select(
        "t", "z", "group", "size").mapInArrow(freed(_unpack_sets), SETS), "near-sets")

    big = (F.col("size.texts") > group_texts) | (F.col("size.weight") > group_shingles)
    own = lambda d: d.withColumn("class", F.col("t")).withColumn("side", F.lit(0)).select(
        "group", "t", "class", "side", "hashes", "weights")
    links = _links_in_groups(own(sets.filter(~big)), threshold)
    large = sets.filter(big)
    if large.head(1):
        finer = write_table(_sized(nodes, _grouped(write_table(_prefix_buckets(large, threshold), "near-prefixes"))), "near-finer")
        large = write_table(large.drop("group", "size").join(finer, "t"), "near-finer-sets")
        links = links.unionByName(_links_in_groups(own(large.filter(~big)), threshold))
        large = large.filter(big)
        if large.head(1):
            stars = write_table(_verify_stars(large, threshold), "near-stars")
            known = components(stars).select(F.col("node").alias("t"), F.col("comp").alias("class"))
            links = links.unionByName(stars).unionByName(
                _links_in_groups(_blocks(large, known, group_texts, group_shingles), threshold))
    classes = components(links)
    named = nodes.select("t", "doc_id").join(classes.withColumnRenamed("node", "t"), "t", "left").withColumn(
        "comp", F.coalesce("comp", "t"))
    heads = named.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "t")).alias("h"))
    named = named.join(heads, "comp").select("t", F.col("h.doc_id").alias("class_id"), F.col("h.t").alias("first_t"))
    return signed.select("doc_id", "t").join(named, "t").select("doc_id", "t", "class_id", "first_t")


def _with_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        words, off = _words(column(batch, "text"))
        yield batch.append_column("t", pa.array(text_hash(words, off)))


def keep_one(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with one document of each class: that with the least doc_id."""
    own = docs.select("doc_id", "text", "lang", "source", "n_chars")
    named = near_duplicates(own, **params)
    stay = named.filter(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("t") == F.col("first_t"))).select(
        F.col("doc_id").alias("_id"), F.col("t").alias("_t")).distinct()
    fields = ", ".join(f"`{c}` {t}" for c, t in own.dtypes) + ", t long"
    hashed = own.mapInArrow(freed(_with_hash), fields)
    kept = hashed.join(stay, (F.col("t") == F.col("_t")) & F.col("doc_id").cast("long").eqNullSafe(F.col("_id")), "left_semi")
    return kept.dropDuplicates(["doc_id", "t"]).drop("t")
