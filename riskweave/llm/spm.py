"""SentencePiece encoding and decoding by a batched numpy Viterbi.

Words of equal length advance together, character by character. At each position the
substrings that end there are hashed and looked up among the sorted hashes of the
pieces; the best way to reach the position is a maximum over them, kept as a
backpointer.

A unigram model scores a way by the sum of its pieces' scores. A merge (BPE) model, as
the vocabulary here, has no such sum: there a piece may follow the last piece of the
way before it exactly if merging the two alone leaves them apart, and a text's encoding
is the one way whose neighbours all may follow each other. (No merge crosses a boundary
of the encoding, so every prefix that ends at a boundary is encoded by the pieces
before it; and a way whose neighbours stay apart in pairs has no first merge across a
boundary.) The score of a step is then 0 or minus infinity, and the result equals that
of merging by priority. Whether two pieces stay apart is worked out once a pair.

Pieces hold white space only at their start, so a text is cut before each run of it and
around characters that no piece has; each distinct word is encoded once.

Defined results: null texts are empty, and empty texts have no ids; unknown characters
fall back to byte pieces; decoding gives the text back, but that U+2581 becomes a space.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, mix64, pick, slices, text_bytes
from .words import IdStore, split_codes

SPACE = "▁"
CACHE_WORDS = 600_000
SLICE = 4 << 20
BATCH = 1 << 18
LONG, FEW = 48, 16
U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
LOW = -1e30


class Pieces:
    """Pieces, scores and kinds of a SentencePiece model."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        sp = SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.scores = np.array([sp.get_score(i) for i in range(n)])
        normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.id = {self.pieces[i]: i for i in normal}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        self.table = [b"" if sp.is_control(i) else bytes([int(self.pieces[i][3:5], 16)]) if sp.is_byte(i)
                      else " ⁇ ".encode() if sp.is_unknown(i) else self.pieces[i].replace(SPACE, " ").encode()
                      for i in range(n)]
        # merge models have ranks as scores
        self.merges = all(float(s).is_integer() for s in self.scores)
        self.longest = max(map(len, self.id))

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces joined, without the space put before the text."""
        return b"".join(map(self.table.__getitem__, ids)).removeprefix(b" ").decode("utf-8", "replace")


def substring_hashes(chars: np.ndarray) -> np.ndarray:
    """Prefix hashes of rows of code points, one column more than characters."""
    out = np.zeros((chars.shape[0], chars.shape[1] + 1), np.uint64)
    for j in range(chars.shape[1]):
        out[:, j + 1] = out[:, j] * BASE + (chars[:, j].astype(np.uint64) + U(1))
    return out


class Encoder(IdStore):
    def __init__(self, path: str, cache_words: int = CACHE_WORDS, merges: bool | None = None):
        super().__init__(cache_words)
        self.model = m = Pieces(path)
        self.merges = m.merges if merges is None else merges
        self.power = BASE ** np.arange(m.longest + 2, dtype=np.uint64)
        names = list(m.id)
        keys = np.array([self._key(p) for p in names], np.uint64)
        order = np.argsort(keys)
        keys, ids, size = keys[order], np.array([m.id[p] for p in names])[order], np.array([len(p) for p in names])[order]
        if (keys[1:] == keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        self.by_length = {n: (keys[size == n], ids[size == n]) for n in np.unique(size).tolist()}
        self.steps: dict[int, tuple] = {}
        self.apart: dict[int, bool] = {}

    @staticmethod
    def _key(piece: str) -> int:
        h = np.zeros(1, np.uint64)
        for c in piece:
            h = h * BASE + U(ord(c) + 1)
        return int(mix64(h ^ mix64(np.array([len(piece)], np.uint64)))[0])

    # -- merge models: which pieces may stand side by side

    def _merge_steps(self, piece: int) -> tuple[list[tuple[float, str, str]], bool]:
        """How merging builds the piece alone: (priority, first symbol, last symbol) of the states before each
        merge, with the merge that ends the state; and whether it is built at all."""
        got = self.steps.get(piece)
        if got is None:
            ids, scores = self.model.id, self.model.scores
            symbols, states = list(self.model.pieces[piece]), []
            while len(symbols) > 1:
                best, at = None, -1
                for i in range(len(symbols) - 1):
                    k = ids.get(symbols[i] + symbols[i + 1])
                    if k is not None and (best is None or scores[k] > best):
                        best, at = scores[k], i
                if best is None:
                    break
                states.append((best, symbols[0], symbols[-1]))
                symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            got = self.steps[piece] = (states + [(LOW * 2, symbols[0], symbols[-1])], len(symbols) == 1)
        return got

    def _stay_apart(self, a: int, b: int) -> bool:
        """Whether merging the text of pieces a and b gives them again: no merge across wins over those inside."""
        (left, whole_a), (right, whole_b) = self._merge_steps(a), self._merge_steps(b)
        if not (whole_a and whole_b):
            return False
        i = j = 0
        ids, scores = self.model.id, self.model.scores
        while True:
            x, y = left[i][0], right[j][0]
            k = ids.get(left[i][2] + right[j][1])
            # of equal priorities, the merge further left comes first
            if k is not None and scores[k] > x and scores[k] >= y:
                return False
            if x <= LOW and y <= LOW:
                return True
            if x >= y:
                i += 1
            else:
                j += 1

    def _may_follow(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether each piece may follow the one before it; -1 before stands for the word's start, and what is
        not a piece (an unknown character, from len(pieces) on) may stand beside anything."""
        n = len(self.model.pieces)
        out = (before < 0) | (before >= n) | (piece >= n)
        ask = np.flatnonzero(~out)
        keys, of = np.unique(before[ask] * n + piece[ask], return_inverse=True)
        keys = keys.tolist()
        for k in keys:
            if k not in self.apart:
                self.apart[k] = self._stay_apart(*divmod(k, n))
        out[ask] = np.fromiter(map(self.apart.__getitem__, keys), bool, len(keys))[of]
        return out

    def _merge_values(self, end: int, last: np.ndarray, piece: np.ndarray, value: np.ndarray) -> None:
        """Sets the value of the one piece that may end here to 0. Exactly one of a position's pieces may, so the
        longest are asked first, and the last one left need not be asked."""
        left = (piece >= 0).sum(axis=0)
        open_ = np.ones(piece.shape[1], bool)
        for s in range(len(piece), 0, -1):
            some = np.flatnonzero(open_ & (piece[s - 1] >= 0))
            if not len(some):
                continue
            may = left[some] == 1
            ask = some[~may]
            if len(ask):
                may[~may] = self._may_follow(last[ask, end - s], piece[s - 1, ask])
            left[some] -= 1
            value[s - 1, some[may]] = 0.0
            open_[some[may]] = False

    # -- the Viterbi

    def viterbi(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each word has) of words of one length, given as rows of code points.

        A character without piece gets len(pieces) + its code point.
        """
        count, length = chars.shape
        n, longest = len(self.model.pieces), self.model.longest
        sums = substring_hashes(chars)
        score = np.full((count, length + 1), LOW)
        score[:, 0] = 0
        last = np.full((count, length + 1), -1)
        back = np.zeros((count, length + 1), np.int64)
        for end in range(1, length + 1):
            spans = range(1, min(end, longest) + 1)
            value, piece = np.full((len(spans), count), LOW), np.full((len(spans), count), -1)
            for s in spans:
                key = mix64((sums[:, end] - sums[:, end - s] * self.power[s]) ^ mix64(np.full(1, s, np.uint64)))
                keys, ids = self.by_length.get(s, (None, None))
                if keys is None:
                    continue
                place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                piece[s - 1] = np.where(keys[place] == key, ids[place], -1)
            piece[0] = np.where(piece[0] < 0, n + chars[:, end - 1], piece[0])
            if self.merges:
                self._merge_values(end, last, piece, value)
            else:
                for s in spans:
                    ok = np.flatnonzero((piece[s - 1] >= 0) & (score[:, end - s] > LOW))
                    got = piece[s - 1, ok]
                    own = np.where(got < n, self.model.scores[np.minimum(got, n - 1)], self.model.scores.min() - 10)
                    value[s - 1, ok] = score[ok, end - s] + own
            best = value.argmax(axis=0)
            row = np.arange(count)
            score[:, end], last[:, end], back[:, end] = value[best, row], piece[best, row], end - 1 - best
        # all words go back by their pointers together; column k holds the kth piece from the end
        at, row, columns, n_ids = np.full(count, length), np.arange(count), [], np.zeros(count, np.int64)
        while len(row):
            column = np.full(count, -1)
            column[row] = last[row, at[row]]
            columns.append(column)
            n_ids[row] += 1
            at[row] = back[row, at[row]]
            row = row[at[row] > 0]
        flat = np.column_stack(columns[::-1]).reshape(-1)
        return flat[flat >= 0], n_ids

    def viterbi_long(self, chars: np.ndarray) -> list[int]:
        """Ids of one long word, as ``viterbi`` gives them: its substrings probe the sorted keys for all positions at
        once, and the forward pass then asks only pieces that were found."""
        length, n = len(chars), len(self.model.pieces)
        sums = substring_hashes(chars[None, :])[0] if length < 1 << 12 else self._prefix_hashes(chars)
        ending: list[list[tuple[int, int]]] = [[] for _ in range(length + 1)]
        for s, (keys, ids) in sorted(self.by_length.items(), reverse=True):
            if s > length:
                continue
            key = mix64((sums[s:] - sums[:-s] * self.power[s]) ^ mix64(np.full(1, s, np.uint64)))
            place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            for i in np.flatnonzero(keys[place] == key).tolist():
                ending[i + s].append((s, int(ids[place[i]])))
        last, back, score = [-1] * (length + 1), [0] * (length + 1), [LOW] * (length + 1)
        score[0], floor = 0.0, float(self.model.scores.min()) - 10
        for end in range(1, length + 1):
            found = ending[end]
            if not found or found[-1][0] != 1:
                found.append((1, n + int(chars[end - 1])))
            if self.merges:
                for k, (s, piece) in enumerate(found):     # longest first; the last one left need not be asked
                    if k == len(found) - 1 or self._follows(last[end - s], piece):
                        last[end], back[end] = piece, end - s
                        break
            else:
                for s, piece in reversed(found):           # of equal scores the shortest, as the maximum of a column
                    own = self.model.scores[piece] if piece < n else floor
                    if score[end - s] > LOW and (back[end] == 0 and last[end] < 0 or score[end - s] + own > score[end]):
                        score[end], last[end], back[end] = score[end - s] + own, piece, end - s
        out, at = [], length
        while at > 0:
            out.append(last[at])
            at = back[at]
        return out[::-1]

    @staticmethod
    def _prefix_hashes(chars: np.ndarray) -> np.ndarray:
        """Prefix hashes of one long row of code points: by blocks, whose own hashes are carried on."""
        block = 1 << 10
        rows = np.zeros(-(-len(chars) // block) * block, np.int64)
        rows[:len(chars)] = chars
        inner = substring_hashes(rows.reshape(-1, block))
        out, carry = np.zeros(len(chars) + 1, np.uint64), U(0)
        power = np.ones(block + 1, np.uint64)
        power[1:] = np.multiply.accumulate(np.full(block, BASE))
        for k, own in enumerate(inner):
            at, end = k * block, min((k + 1) * block, len(chars))
            out[at:end + 1] = own[:end - at + 1] + carry * power[:end - at + 1]
            carry = out[end]
        return out

    def _follows(self, before: int, piece: int) -> bool:
        n = len(self.model.pieces)
        if before < 0 or before >= n or piece >= n:
            return True
        key = before * n + piece
        if key not in self.apart:
            self.apart[key] = self._stay_apart(before, piece)
        return self.apart[key]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words by the Viterbi, equal lengths together, few long ones each alone; unknown characters by bytes."""
        n_words = len(words)
        lengths = np.fromiter(map(len, words), np.int64, n_words)
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        parts, owners = [], []
        for length in np.unique(lengths[lengths > 0]).tolist():
            rows = np.flatnonzero(lengths == length)
            if length > LONG and len(rows) < FEW:
                for i in rows.tolist():
                    got = self.viterbi_long(chars[starts[i]:starts[i] + length])
                    parts.append(np.array(got, np.int64))
                    owners.append(np.full(len(got), i))
                continue
            step = max(1, BATCH // length)
            for k in range(0, len(rows), step):
                some = rows[k:k + step]
                ids, n_ids = self.viterbi(chars[starts[some][:, None] + np.arange(length)])
                parts.append(ids)
                owners.append(np.repeat(some, n_ids))
        if not parts:
            return np.zeros(0, np.int32), np.zeros(n_words, np.int64)
        ids, owner = np.concatenate(parts), np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        ids, owner = ids[order], owner[order]
        odd = np.flatnonzero(ids >= len(self.model.pieces))
        if len(odd):
            spelt = [self._bytes(c) for c in (ids[odd] - len(self.model.pieces)).tolist()]
            times = np.ones(len(ids), np.int64)
            times[odd] = [len(b) for b in spelt]
            at = np.cumsum(times) - times
            ids, owner = np.repeat(ids, times), np.repeat(owner, times)
            for k, b in zip(at[odd].tolist(), spelt, strict=True):
                ids[k:k + len(b)] = b
        return ids.astype(np.int32), np.bincount(owner, minlength=n_words)

    def _bytes(self, char: int) -> list[int]:
        if len(self.model.bytes) < 256:
            return [self.model.unknown]
        return [self.model.bytes[b] for b in chr(char).encode()]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of an Arrow array of texts."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        mark = self._separator(texts)
        full = pc.not_equal(pc.binary_length(texts), 0)
        texts = pc.if_else(full, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts,
                                                             pa.scalar("", pa.large_string())), texts)
        if any(pc.any(pc.match_substring(texts, x)).as_py() for x in ("  ", SPACE)):
            texts = pc.replace_substring_regex(texts, f"[ {SPACE}]+", mark + r"\0")
        else:
            texts = pc.replace_substring(texts, " ", mark + " ")
        texts = pc.replace_substring(pc.replace_substring(texts, "\n", f"{mark}\n{mark}"), " ", SPACE)
        return self.lookup(*split_codes(texts, mark))



    @staticmethod
    def _separator(texts: pa.Array) -> str:
        """A character that no text of the batch has: of private use, else any but controls and white space."""
        for c in map(chr, range(0xE000, 0xE010)):
            if not pc.any(pc.match_substring(texts, c)).as_py():
                return c
        raw, _ = text_bytes(texts)
        used = np.zeros(0x110000, bool)
        used[np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)] = True
        used[:0x21] = used[0xD800:0xE000] = True
        for lo, hi in ((0xE000, 0xF900), (0xF0000, 0x110000), (0x21, 0xF0000)):
            free = np.flatnonzero(~used[lo:hi])
            if len(free):
                return chr(lo + int(free[0]))
        raise ValueError("a text holds every character there is")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in slices(batches, "text", SLICE):
            ids, at = enc.encode(column(batch, "text"))
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))],
                names=["doc_id", "ids"])
    return run


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _texts(table: Pieces, ids: pa.ListArray) -> pa.Array:
    flat, at = ids.flatten().to_numpy(), np.concatenate([[0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy())])
    return pa.array([table.decode(flat[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True)], pa.string())


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(path)
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, min(500, batch.num_rows - k))
                ids = column(part, "ids")
                yield pa.RecordBatch.from_arrays([column(part, "doc_id"), ids, _texts(table, ids)], names=["doc_id", "ids", "text"])
    return run


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, ids) of each document; no shuffle."""
    src = pick(docs, doc_id="doc_id", text="text")
    return src.withColumn("text", F.col("text").cast("string")).mapInArrow(
        _encode(model or default_model()), f"doc_id {dict(src.dtypes)['doc_id']}, ids array<int>")


def _round_trip(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _decode(path)(_encode(path)(batches))
    return run


def round_trip(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, ids, text): each document encoded and its ids decoded again, in one pass of one worker."""
    src = pick(docs, doc_id="doc_id", text="text")
    return src.withColumn("text", F.col("text").cast("string")).mapInArrow(
        _round_trip(model or default_model()), f"doc_id {dict(src.dtypes)['doc_id']}, ids array<int>, text string")


def decode(coded: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, ids, text) from (doc_id, ids); null ids are none."""
    return coded.select("doc_id", "ids").mapInArrow(
        _decode(model or default_model()), f"doc_id {dict(coded.dtypes)['doc_id']}, ids array<int>, text string")
