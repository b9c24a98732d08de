"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Suffixes are ordered by their first ``length`` bytes alone, most significant digit
first; groups that agree on all digits are exactly the repeated windows. Each pass
deals suffixes out by their next digit and drops groups of one:

1. the digit is the window's minimizer (the smallest hash of its ``SEED``-byte
   strings), with its place in the window: neighbouring suffixes that share it travel
   as one row, a block, so the pass moves a row for some 140 bytes of text;
2. blocks whose group is not uniform are cut at a fixed grid of ``GRID`` places, and
   the digit is what all windows of a cut have in common;
3. the digit is the whole window, one suffix a row.

In each pass a group whose blocks are equal as a whole is decided at once (all its
windows repeat), and equal blocks send one representative on. So copies cost a row a
block in pass 1 and nothing after it. Groups are counted with partial aggregation and
joined back; no group is gathered into a task. Digits compare by two independent
64-bit polynomial hashes.

Defined results: null texts are empty; a text shorter than ``length`` bytes keeps all;
matches never cross rows, and rows with equal doc_ids are different documents with
rows of their own; ``apply_dedup`` drops what is left of a character that a cut went
through, while digests are of the raw bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, freed, mix64, pick, rows, slices, text_bytes, write_table

LENGTH = 400
SEED = 128
GRID = 32
SLICE = 1 << 19  # some 30 arrays of a value for each byte are held at a time
U = np.uint64

BLOCKS = "row long, at long, key long, cls long"


def _constants(seed: int) -> tuple[np.ndarray, int]:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1), int(rng.integers(1, 1 << 60)) * 8 + 5


class Hashes:
    """Two 64-bit polynomial hashes of any substrings of a buffer, in arrays."""

    CONSTANTS = (_constants(11), _constants(12))

    def __init__(self, raw: np.ndarray):
        self.sums, self.inverse = [], []
        for table, base in self.CONSTANTS:
            power, inverse = self._powers(base, len(raw) + 1), self._powers(pow(base, -1, 1 << 64), len(raw) + 1)
            total = np.zeros(len(raw) + 1, np.uint64)
            np.cumsum(table[raw] * power[:-1], out=total[1:])
            self.sums.append(total)
            self.inverse.append(inverse)

    _cache: dict[int, np.ndarray] = {}

    @classmethod
    def _powers(cls, base: int, n: int) -> np.ndarray:
        got = cls._cache.get(base)
        if got is None or len(got) < n:
            got = np.full(max(n, SLICE + (1 << 18)), base, np.uint64)
            got[0] = 1
            np.cumprod(got, out=got)
            if len(got) <= 2 * SLICE:
                cls._cache[base] = got
        return got[:n]

    def raw(self, j: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[j][end] - self.sums[j][start]) * self.inverse[j][start]

    def get(self, j: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64(self.raw(j, start, end) ^ mix64((end - start).astype(np.uint64)))


def _join(*parts: np.ndarray) -> np.ndarray:
    """One 64-bit hash of several integers, as signed for Spark."""
    h = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        h = mix64(h * U(0x9E3779B97F4A7C15) + p.astype(np.uint64) + U(1))
    return h.view(np.int64)


def window_blocks(raw: np.ndarray, off: np.ndarray, length: int, seed: int):
    """Blocks of consecutive windows with one minimizer: (row, place of the minimizer in its row, least and
    greatest distance of a window's start before it, hashes of minimizer and of all bytes that the windows cover)."""
    none = np.zeros(0, np.int64)
    if len(raw) < length:
        return none, none, none, none, none, none
    h, width = Hashes(raw), length - seed + 1
    at = np.arange(len(raw) - seed + 1)
    least = h.raw(0, at, at + seed) & U(0xFFFFFFFF00000000) | at.astype(np.uint64)
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[:len(least) - (width - span)], least[width - span:])
    place = (least & U(0xFFFFFFFF)).astype(np.int64)
    # windows that lie within one row
    n_windows = np.maximum(off[1:] - off[:-1] - length + 1, 0)
    row = np.repeat(np.arange(len(off) - 1), n_windows)
    if not len(row):
        return none, none, none, none, none, none
    start = np.arange(len(row)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows) + off[row]
    place = place[start]
    first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (row[1:] != row[:-1])]))
    last = np.append(first[1:], len(row)) - 1
    lo, hi, place, row = start[first], start[last], place[first], row[first]
    key = _join(h.get(0, place, place + seed))
    cls = _join(h.get(1, lo, hi + length), place - lo, place - hi)
    return row, place - off[row], place - hi, place - lo, key, cls


def _pack_at(place, near, far):
    return (place << 20) | (near << 10) | far


def _unpack(at: str = "at"):
    """(first window, last window) of a packed block."""
    place, near, far = F.shiftright(at, 20), F.shiftright(at, 10).bitwiseAND(1023), F.col(at).bitwiseAND(1023)
    return place - far, place - near


def _blocks(length: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            raw, off = text_bytes(column(batch, "text"))
            row, place, near, far, key, cls = window_blocks(raw, off, length, seed)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "row").take(pa.array(row)), pa.array(_pack_at(place, near, far)), pa.array(key),
                 pa.array(cls)], names=["row", "at", "key", "cls"])
    return run


def _groups(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs twice or more (by ``weight``), with ``mixed``: whether their group holds unequal blocks."""
    stats = (blocks.groupBy(*keys).agg(F.sum("weight").alias("_w"), F.min("cls").alias("_lo"), F.max("cls").alias("_hi"))
             .filter("_w > 1").select(*keys, (F.col("_lo") != F.col("_hi")).alias("mixed")))
    # written, so that the join has an exchange on either side and adaptive execution can split a hot digit
    return blocks.join(write_table(stats, "suffix-stats"), keys)


def _classes(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Equal blocks of mixed groups: their weight, and the least (row, at) as representative."""
    return (blocks.filter("mixed").groupBy(*keys, "cls")
            .agg(F.sum("weight").alias("n"), F.min(F.struct("row", "at")).alias("rep")))


def _contexts(length: int):
    """Blocks to refine, given with their rows' texts, to (place, near, far, bytes that their windows cover)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = zstandard.ZstdDecompressor()
        for batch in rows(batches):
            for z, row, blocks in zip(*(column(batch, c).to_pylist() for c in ("z", "row", "blocks")), strict=True):
                text, got = d.decompress(z), []
                for b in blocks:
                    place, near, far = b["at"] >> 20, b["at"] >> 10 & 1023, b["at"] & 1023
                    got.append({"row": row, "at": b["at"], "key": b["key"], "weight": b["weight"],
                                "bytes": text[place - far:place - near + length]})
                    if len(got) >= 1000:
                        yield _context_batch(got)
                        got = []
                if got:
                    yield _context_batch(got)
    return run


CONTEXTS = pa.schema([("row", pa.int64()), ("at", pa.int64()), ("key", pa.int64()), ("weight", pa.int64()),
                      ("bytes", pa.binary())])


def _context_batch(found: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(found, CONTEXTS)


def _spread(first: np.ndarray, n: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """n[i] values from first[i] on by ``step`` for each i: (i of each, value)."""
    of = np.repeat(np.arange(len(n)), n)
    return of, first[of] + (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)) * step


def _cuts(length: int, single: bool):
    """Cut blocks at the grid of distances, or (``single``) the listed cuts into windows.

    The digit of a cut is what all windows of its grid place have in common.
    """
    step = 1 if single else GRID

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "bytes", SLICE // 4):
            raw, off = text_bytes(column(batch, "bytes"))
            at, key = (column(batch, c).to_numpy() for c in ("at", "key"))
            near, far = at >> 10 & 1023, at & 1023
            if single:
                cuts = column(batch, "cuts")
                low = cuts.flatten().to_numpy().astype(np.int64)
                of = np.repeat(np.arange(len(at)), cuts.value_lengths().to_numpy())
                lo, hi = np.maximum(near[of], low), np.minimum(far[of], low + GRID - 1)
                inner, grid = _spread(lo, hi - lo + 1, 1)
                of, lo, hi = of[inner], grid, grid
            else:
                of, grid = _spread(near // step * step, far // step - near // step + 1, step)
                lo, hi = np.maximum(near[of], grid), np.minimum(far[of], grid + step - 1)
            zero = off[:-1][of] + far[of]  # the minimizer's place in the buffer
            h = Hashes(raw)
            core, end = zero - grid, zero - (grid + step - 1) + length
            yield pa.RecordBatch.from_arrays([
                column(batch, "row").take(pa.array(of)), pa.array(_pack_at(at[of] >> 20, lo, hi)), pa.array(at[of]),
                pa.array(_join(key[of], grid, h.get(0, core, end))), pa.array(h.get(1, core, end).view(np.int64)),
                pa.array(_join(h.get(0, zero - hi, zero - lo + length), lo, hi)),
                column(batch, "weight").take(pa.array(of))],
                names=["row", "at", "block", "k1", "k2", "cls", "weight"])
    return run


CUTS = "row long, at long, block long, k1 long, k2 long, cls long, weight long"


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    c = zstandard.ZstdCompressor(level=1)
    for batch in slices(batches, "text"):
        at = batch.schema.get_field_index("text")
        z = [c.compress((t or "").encode()) for t in column(batch, "text").to_pylist()]
        yield batch.set_column(at, "z", pa.array(z, pa.binary()))


def _packed(src: DataFrame) -> DataFrame:
    """``src`` with the text as zstd bytes ``z``: half the shuffle."""
    fields = ", ".join("z binary" if c == "text" else f"`{c}` {t}" for c, t in src.dtypes)
    return src.mapInArrow(freed(_compress), fields)


def repeated_spans(src: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """(row, first, last): starts of windows of ``length`` bytes that occur twice or more, by runs.

    src: (row, text) with a distinct row number.
    """
    b = write_table(src.mapInArrow(freed(_blocks(length, seed)), BLOCKS), "suffix-1").withColumn("weight", F.lit(1).cast("long"))
    pass1 = write_table(_groups(b, ["key"]).drop("weight"), "suffix-groups-1").withColumn("weight", F.lit(1).cast("long"))
    classes = write_table(_classes(pass1, ["key"]), "suffix-classes-1")
    sure = pass1.filter("not mixed").select("row", "at").unionByName(
        pass1.filter("mixed").join(classes.filter("n > 1").select("key", "cls"), ["key", "cls"], "left_semi").select("row", "at"))
    reps = classes.select(F.col("rep.row").alias("row"), F.struct(
        F.col("rep.at").alias("at"), "key", F.least("n", F.lit(2)).alias("weight")).alias("b"))
    reps = reps.groupBy("row").agg(F.collect_list("b").alias("blocks"))  # as many as the text is long
    contexts = write_table(_packed(src).join(reps, "row").mapInArrow(
        _contexts(length), "row long, at long, key long, weight long, bytes binary"), "suffix-contexts")

    # pass 2: cuts of GRID windows; a row of weight 1 stands for itself, others for decided blocks
    cuts = write_table(contexts.mapInArrow(_cuts(length, False), CUTS), "suffix-2")
    pass2 = write_table(_groups(cuts, ["k1", "k2"]), "suffix-groups-2")
    classes2 = write_table(_classes(pass2, ["k1", "k2"]), "suffix-classes-2")
    decided2 = pass2.filter("not mixed and weight = 1").select("row", "at").unionByName(
        pass2.filter("mixed and weight = 1").join(classes2.filter("n > 1").select("k1", "k2", "cls"),
                                                  ["k1", "k2", "cls"], "left_semi").select("row", "at"))
    # pass 3: single windows, of one block for each class of the mixed groups
    left = (pass2.filter("mixed").select("row", "at", "block")
            .join(classes2.select("rep.row", "rep.at"), ["row", "at"], "left_semi")
            .groupBy("row", F.col("block").alias("at"))
            .agg(F.collect_set((F.floor(F.shiftright("at", 10).bitwiseAND(1023) / GRID) * GRID).cast("int")).alias("cuts")))
    windows = write_table(contexts.join(left, ["row", "at"]).mapInArrow(_cuts(length, True), CUTS), "suffix-3")
    decided3 = _groups(windows, ["k1", "k2"]).filter("weight = 1").select("row", "at")
    first, last = _unpack()
    return sure.unionByName(decided2).unionByName(decided3).select("row", first.alias("first"), last.alias("last"))


def _cover(spans: list[dict], length: int) -> list[tuple[int, int]]:
    """Maximal removed byte runs."""
    runs: list[list[int]] = []
    for first, last in sorted((s["first"], s["last"] + length) for s in spans or ()):
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], last)
        else:
            runs.append([first, last])
    return [(a, b) for a, b in runs]


def _kept(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for r in runs for x in r), len(text)]
    return b"".join(text[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2))


def _with_spans(docs: DataFrame, length: int, seed: int, columns: list[str]) -> DataFrame:
    """``columns`` of docs with the text as ``z``, and ``spans``, the repeated windows of the row."""
    if length - seed > 1000:
        raise ValueError("length - seed must stay below 1000")
    src = pick(docs, text="text", **{c: c for c in columns if c != "text"})
    # doc_id names a row if it is a key; else its hash with the text does, and equal rows are alike
    ids = src.select(F.col("doc_id").cast("long").alias("i")).groupBy("i").agg(F.count("*").alias("n"))
    is_key = not ids.filter("n > 1 or i is null").head(1)
    row = F.col("doc_id").cast("long") if is_key else F.xxhash64(F.col("doc_id").cast("string"), "text")
    src = src.withColumn("row", row)
    spans = repeated_spans(src.select("row", "text"), length, seed).groupBy("row").agg(
        F.collect_set(F.struct("first", "last")).alias("spans"))  # as many as the text is long
    return _packed(src).join(spans, "row", "left")


def _digest(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = zstandard.ZstdDecompressor()
        for batch in rows(batches):
            out = []
            for z, spans in zip(column(batch, "z").to_pylist(), column(batch, "spans").to_pylist(), strict=True):
                text, runs = d.decompress(z), _cover(spans, length)
                kept = _kept(text, runs)
                out.append((len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "doc_id"), *(pa.array(c) for c in zip(*out, strict=True))],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return run


def dedup_digest(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return _with_spans(docs, length, seed, ["doc_id", "text"]).mapInArrow(
        _digest(length), f"doc_id {dict(docs.dtypes)['doc_id']}, n_bytes long, n_removed long, n_spans long, "
                         "kept_sha256 string")


def _strip(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = zstandard.ZstdDecompressor()
        for batch in rows(batches):
            kept = [_kept(d.decompress(z), _cover(s, length)).decode("utf-8", "ignore") for z, s in zip(
                column(batch, "z").to_pylist(), column(batch, "spans").to_pylist(), strict=True)]
            out = batch.set_column(batch.schema.get_field_index("z"), "text", pa.array(kept, pa.string()))
            yield out.select([c for c in out.schema.names if c not in ("row", "spans")])
    return run


def apply_dedup(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """``docs`` without the repeated bytes; characters cut through go, n_chars is made anew, null texts become empty."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    packed = _with_spans(docs, length, seed, columns)
    types = dict(docs.dtypes)
    fields = ", ".join(f"`{'text' if c == 'z' else c}` {'string' if c == 'z' else types[c]}"
                       for c in packed.columns if c not in ("row", "spans"))
    out = packed.mapInArrow(freed(_strip(length)), fields).select(*columns)
    return out.withColumn("n_chars", F.length("text").cast("long"))
