"""Best-fit packing of token sequences by hierarchical residual packing.

Each partition tokenizes its documents and packs their last pieces best-fit
decreasing; bins with almost no room left are emitted. Underfull bins then merge
up a tree: in each round they are dealt anew over as few tasks as hold
``items_per_task`` of them, and are packed best-fit as items, until a single task
has seen them all or a round joins nothing more.

Defined results: a null or empty text is the end id alone; repeated rows and equal
doc_ids are packed row by row; no document gives no row.
"""

from __future__ import annotations

import re
import string
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, freed, pick, slices, write_table
from .words import IdStore, split_words

CAPACITY = 2048
END_ID = 0
ITEMS_PER_TASK = 50_000
FULL_SLACK = 8
CACHE_WORDS = 200_000
WHOLE = "\n"     # in no word
MARKS = string.punctuation
LETTERS = "".join(c for c in map(chr, range(256)) if c.isalpha())
LATIN = f"^[{LETTERS}]+[{re.escape(MARKS)}]*$"
SLICE = 2 << 20  # ids, codes and places of a slice's words take some 20 times its text

PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                    ("open", pa.bool_())])
DDL = ("doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, open boolean")


def _byte_letters() -> dict[int, str]:
    """The printable letter for each byte that byte-level vocabularies use: itself, or the next from U+0100 on."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in keep)
    return {b: chr(b) for b in keep} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class WordIds(IdStore):
    """Token ids by white-space word, each distinct one tokenized once.

    The tokenizer drops white space before it splits, so the ids of a text are those
    of its words in order. Only space and line feed part words here; any other white
    space stays inside and is the tokenizer's business. A word of Latin letters alone
    needs of the tokenizer's steps only lower case, byte letters and the model; with
    ASCII marks after them it is that word and their run. So the store holds lower-case
    stems; runs and other words go through the whole tokenizer and are kept after a WHOLE.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        super().__init__(cache_words)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, n = array("i"), []
        for word in words:
            if word[0] == WHOLE:
                new = self.tokenizer.encode(word[1:], add_special_tokens=False).ids
            else:
                text = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
                new = [t.id for t in self.model.tokenize(text)]
            ids.extend(new)
            n.append(len(new))
        return np.frombuffer(ids, np.int32), np.array(n, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of an Arrow array of texts; null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        words, codes, off = split_words(pc.replace_substring(texts, "\n", " "), " ")
        latin = pc.match_substring_regex(words, LATIN)
        whole, empty, none = (pa.scalar(x, pa.large_string()) for x in (WHOLE, "", None))
        runs = pc.if_else(latin, pc.utf8_ltrim(words, LETTERS), empty)
        stems = pc.if_else(latin, pc.utf8_lower(pc.utf8_rtrim(words, MARKS)), pc.binary_join_element_wise(whole, words, empty))
        marks = pc.if_else(pc.equal(runs, empty), none, pc.binary_join_element_wise(whole, runs, empty))
        coded = pa.concat_arrays([stems, marks]).dictionary_encode()
        stem, mark = np.asarray(coded.indices.fill_null(-1)).reshape(2, -1)
        # each word is its stem and, where it has one, its run of marks
        pairs = np.stack([stem, mark], 1)[codes]
        ends = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(1 + (pairs[:, 1] >= 0), out=ends[1:])
        return self.lookup(coded.dictionary.to_pylist(), pairs[pairs >= 0], ends[off])


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Best-fit in the given order: (bin of each item, its offset there, fill of each bin).

    The bins with room r stand in a list for r, and a bit of ``rooms`` says which lists
    have some, so the tightest bin that fits is the lowest bit from the item's size on.
    """
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, fills, where, offsets = 0, [], [], []
    for size in sizes:
        fit = rooms >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            k = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            k, room = len(fills), capacity
            fills.append(0)
        where.append(k)
        offsets.append(fills[k])
        fills[k] += size
        left = room - size
        if left:
            by_room[left].append(k)
            rooms |= 1 << left
    return where, offsets, fills


def _bin_id(level: int, k: np.ndarray | int) -> np.ndarray | int:
    return (level << 56) + (TaskContext.get().partitionId() << 32) + k


def _cut_and_pack(path: str, capacity: int, end_id: int, slack: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(path)
        try:
            yield from cut(encoder, batches)
        finally:
            encoder.clear()     # the worker is used again, and by other stages

    def cut(encoder: WordIds, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tails, used = [], 0
        for batch in slices(batches, "text", SLICE):
            ids, at = encoder.encode(column(batch, "text"))
            docs = column(batch, "doc_id").to_pylist()
            full = []
            for i, doc in enumerate(docs):
                seq = np.append(ids[at[i]:at[i + 1]], np.int32(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(seq), capacity)):
                    part = seq[start:start + capacity]
                    row = (doc, piece, start, len(part), zlib.crc32(part.tobytes()))
                    (full if len(part) == capacity else tails).append(row)
            if full:
                yield _rows(full, _bin_id(0, used + np.arange(len(full))), np.zeros(len(full), int), np.zeros(len(full), bool))
                used += len(full)
        if tails:
            tails.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[4]))
            where, offsets, fills = best_fit([r[3] for r in tails], capacity)
            where = np.array(where)
            yield _rows(tails, _bin_id(0, used + where), offsets, (capacity - np.array(fills) > slack)[where])
    return run


def _rows(rows: list[tuple], seq, offset, is_open) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
        [*cols, seq, offset, is_open], PIECES.types, strict=True)], schema=PIECES)


def _merge(level: int, capacity: int, slack: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        seq, inside, length = (table.column(c).to_numpy() for c in ("sequence_id", "offset", "length"))
        bins, of = np.unique(seq, return_inverse=True)
        size = np.bincount(of, weights=length).astype(np.int64)
        order = np.lexsort((bins, -size))
        where, offsets, fills = best_fit(size[order].tolist(), capacity)
        new, base = np.empty(len(bins), np.int64), np.empty(len(bins), np.int64)
        new[order], base[order] = where, offsets
        fills = np.array(fills)
        # a bin that met no other keeps its number, so that a round without gain changes nothing
        alone = np.bincount(new) == 1
        ids = np.where(alone[new], bins, _bin_id(level, new))
        table = table.set_column(5, "sequence_id", pa.array(ids[of], pa.int64()))
        table = table.set_column(6, "offset", pa.array(inside + base[of], pa.int64()))
        table = table.set_column(7, "open", pa.array((capacity - fills > slack)[new][of]))
        yield from table.to_batches(max_chunksize=100_000)
    return run


def pack(docs: DataFrame, tokenizer_path: str | None = None, *, capacity: int = CAPACITY, end_id: int = END_ID,
         items_per_task: int = ITEMS_PER_TASK, slack: int = FULL_SLACK) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A bin with at most ``slack`` places left counts as full and leaves the tree.
    """
    if tokenizer_path is None:
        import public_tokenizers
        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    src = pick(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    level = write_table(src.mapInArrow(freed(_cut_and_pack(tokenizer_path, capacity, end_id, slack)), DDL), "pack-0")
    done, k = [], 0
    while True:
        done.append(level.filter("not open"))
        rest = level.filter("open")
        n = rest.agg(F.count_distinct("sequence_id")).first()[0]
        tasks = -(-n // items_per_task)
        if k and (n > 0.99 * last or last_tasks == 1) or n < 2:
            break
        last, last_tasks, k = n, tasks, k + 1
        level = write_table(rest.repartition(tasks, "sequence_id").mapInArrow(_merge(k, capacity, slack), DDL), f"pack-{k}")
    out = rest
    for d in done:
        out = out.unionByName(d)
    return out.drop("open")
