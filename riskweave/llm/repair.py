"""Conversation structure repair: the cheapest edits as a shortest path with integer weights.

A conversation is repaired when the initials of its roles read (s?(ua)+)?. Edits of a row
are Keep (0), Rerole to user or assistant (1) and Delete (2, the only one for blank and
repeated rows); an empty user or assistant row may be Inserted anywhere (5); a truncated
row that is not deleted adds 5. Of the cheapest edits, those whose initials are least in
ASCII order count.

Both are one integer minimum over a graph without cycles. Nodes are (rows read, state of
the pattern). An edge reads one row, after an insertion or none, and weighs
``cost * 64^n + code * 64^(n-i)`` for row i of n (from 1): the high digits add up costs,
and the low ones spell the letters, D, I, K, R as 1 to 4, in a place of two octal digits
for each row (its insertion and its edit, padded with a zero at the end); an insertion
after the last row is decided last. No place's spelling begins another's, so integers compare
as costs and then as strings. Two insertions side by side never pay: without them the
state is the same, or the row before them is better deleted. A letter gives the new role,
as the pattern has only one that fits, so the winning integer holds the whole repair.

Rows go through in chunks of CHUNK rows. A chunk's result is the least integer between
each pair of states; chunks are joined by a Viterbi pass in which the rank of each state's
prefix stands for its letters, so integers stay as long as a chunk. Conversations of at
most ``hot_rows`` rows and ``hot_bytes`` bytes are repaired in one task, streamed from
sorted partitions. Larger ones are dealt by ranges of their rows: equal rows are counted
first, repeats found by a join, chunks solved where they lie, and only the chunks' 16
integers meet. One row a conversation comes out, with its whole text, so a conversation's
output is bounded by a row (2 GB).

Defined results: nulls are one space (a null conv_id is a conversation of its own, a null
turn is first and no turn for gaps). Rows of one turn come by role, then text. A role
whose initial the pattern lacks, or an empty one, can be reroled or deleted but not kept.
A conversation of which no row is left gives zeros and nothing repaired. Very long texts
are only compared and searched at their end. Extra columns are not read; empty tables
give no row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, pick, rows as cut, write_table

CHUNK = 512
HOT_ROWS = 20_000
HOT_BYTES = 32 << 20
SPACE = " \t\n\x0b\x0c\r"
LEGAL = frozenset(("su", "ua", "au"))
START, SYSTEM, USER, ASSISTANT = range(4)
DONE = (START, ASSISTANT)
# state after a role's initial; and the one role that an insertion or rerole can give in a state
READS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
GIVES = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
NAMES = {USER: "user", ASSISTANT: "assistant"}
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
LETTERS = "?DIKR"
COSTS = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED = 5
BITS = 6

RESULT = ("conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired array<struct<role: string, text: string>>")


class Row:
    """A row as the pattern sees it: must it go, is it cut short, its initial, its text."""

    __slots__ = ("gone", "cut", "role", "text")

    def __init__(self, role: str, text: str, repeated: bool):
        end = text.rstrip(SPACE)
        self.role, self.text = role, text
        self.gone = not end or repeated
        self.cut = not self.gone and end[-1] not in ".!?"


def _edges(row: Row) -> list[tuple[int, int, int, int]]:
    """(state, next state, cost, code) of a row's place."""
    out = []
    for state in range(4):
        for first, at, paid in ((0, state, 0), (INSERT, GIVES[state], COSTS[INSERT])):
            ways = [(DELETE, at)]
            if not row.gone:
                kept = READS.get(row.role[:1], {}).get(at)
                ways += [(REROLE, GIVES[at])] + ([(KEEP, kept)] if kept is not None else [])
            for letter, then in ways:
                cost = paid + COSTS[letter] + (TRUNCATED if row.cut and letter != DELETE else 0)
                out.append((state, then, cost, first << 3 | letter if first else letter << 3))
    return out


_KINDS: dict[tuple, list] = {}


def _edges_of(row: Row) -> list[tuple[int, int, int, int]]:
    kind = (row.gone, row.cut, row.role[:1])
    if kind not in _KINDS:
        if len(_KINDS) > 10_000:
            _KINDS.clear()
        _KINDS[kind] = _edges(row)
    return _KINDS[kind]


def solve(rows: list[Row], state: int) -> list[int | None]:
    """The least integer from ``state`` to each state over the rows' places."""
    n = len(rows)
    best: list[int | None] = [None] * 4
    best[state] = 0
    for i, row in enumerate(rows):
        low, then = BITS * (n - 1 - i), [None] * 4
        for a, b, cost, code in _edges_of(row):
            if best[a] is not None:
                w = best[a] + (cost << BITS * n) + (code << low)
                if then[b] is None or w < then[b]:
                    then[b] = w
        best = then
    return best


def table(rows: list[Row], states: Iterable[int] = range(4)) -> list[int | None]:
    """16 integers of a chunk: from state a to b at 4 a + b."""
    out: list[int | None] = [None] * 16
    for a in states:
        out[4 * a:4 * a + 4] = solve(rows, a)
    return out


def join_chunks(chunks: list[tuple[int, list[int | None]]]) -> tuple[int, list[tuple[int, int]], bool]:
    """(cost, (state before, letters) of each chunk, insertion at the end) of the least path; chunks: (rows, table)."""
    held, back = {START: (0, 0)}, []
    for n, best in chunks:
        width, met = BITS * n, {}
        for a, (cost, rank) in held.items():
            for b in range(4):
                w = best[4 * a + b]
                if w is not None:
                    letters = w & ((1 << width) - 1)
                    scalar = (cost + (w >> width) << width + 3) | rank << width | letters
                    if b not in met or scalar < met[b][0]:
                        met[b] = (scalar, a, letters)
        ranks = {b: r for r, b in enumerate(sorted(met, key=lambda b: met[b][0] & ((1 << width + 3) - 1)))}  # noqa: B023
        held = {b: (met[b][0] >> width + 3, ranks[b]) for b in met}
        back.append({b: (a, letters) for b, (_, a, letters) in met.items()})
    ends = []
    for a, (cost, rank) in held.items():
        if a in DONE:
            ends.append((cost, rank, 0, a))
        if GIVES[a] in DONE:
            ends.append((cost + COSTS[INSERT], rank, INSERT << 3, a))
    cost, _, last, state = min(ends)
    path = []
    for step in reversed(back):
        a, letters = step[state]
        path.append((a, letters))
        state = a
    return cost, path[::-1], bool(last)


def spell(rows: list[Row], state: int, letters: int, last: bool = False) -> tuple[str, list[dict[str, str]]]:
    """(audit, repaired rows) of a chunk from its state before and its letters."""
    audit, out = [], []

    def give() -> None:
        nonlocal state
        state = GIVES[state]

    for i, row in enumerate(rows):
        code = letters >> BITS * (len(rows) - 1 - i) & 63
        for letter in (code >> 3, code & 7):
            if not letter:
                continue
            audit.append(LETTERS[letter])
            if letter == INSERT:
                give()
                out.append({"role": NAMES[state], "text": ""})
            elif letter == KEEP:
                state = READS[row.role[:1]][state]
                out.append({"role": row.role, "text": row.text})
            elif letter == REROLE:
                give()
                out.append({"role": NAMES[state], "text": row.text})
    if last:
        give()
        audit.append("I")
        out.append({"role": NAMES[state], "text": ""})
    return "".join(audit), out


class Facts:
    """What is counted of consecutive rows."""

    def __init__(self) -> None:
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.last_turn = self.first = self.initial = None

    def add(self, turn: int | None, row: Row, repeated: bool) -> None:
        blank = not row.text.rstrip(SPACE)
        self.blank += blank
        self.duplicate += repeated and not blank
        self.truncated += row.cut
        if self.n:
            self.illegal += self.initial + row.role[:1] not in LEGAL
        else:
            self.first = row.role[:1]
        self.n, self.initial = self.n + 1, row.role[:1]
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn

    def join(self, then: dict) -> None:
        """Go on with the facts of the next chunk."""
        for k in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, k, getattr(self, k) + then[k])
        if self.n:
            self.illegal += self.initial + then["first"] not in LEGAL
            self.turns -= then["low"] is not None and then["low"] == self.high
        self.n, self.initial = self.n + then["n"], then["initial"]
        if then["high"] is not None:
            self.low, self.high = then["low"] if self.low is None else self.low, then["high"]

    def totals(self) -> list[int]:
        gaps = 0 if self.high is None else self.high - self.low + 1 - self.turns
        return [gaps, self.blank, self.duplicate, self.truncated, self.illegal]


class Conversation:
    """Rows of one conversation in order; rows are solved a chunk at a time."""

    def __init__(self, conv_id: object):
        self.conv_id, self.facts, self.rows, self.seen = conv_id, Facts(), [], set()

    def add(self, turn: int | None, role: str, text: str, copies: int) -> None:
        for _ in range(copies):
            repeated = (role, text) in self.seen
            self.seen.add((role, text))
            row = Row(role, text, repeated)
            self.facts.add(turn, row, repeated)
            self.rows.append(row)

    def result(self) -> list:
        parts = [self.rows[i:i + CHUNK] for i in range(0, len(self.rows), CHUNK)]
        cost, path, last = join_chunks([(len(p), table(p, range(4) if i else (START,))) for i, p in enumerate(parts)])
        told = [spell(p, a, letters, last and i == len(parts) - 1) for i, (p, (a, letters)) in enumerate(zip(parts, path, strict=True))]
        return [self.conv_id, *self.facts.totals(), cost, "".join(t for t, _ in told), [r for _, some in told for r in some]]


def _python(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(column(batch, c).to_pylist() for c in names), strict=True)


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


REPAIRED = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _whole(id_type: pa.DataType):
    """Repair of conversations whose rows lie together, in order."""
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = pa.schema([("conv_id", id_type), *((c, pa.int64()) for c in counts), ("audit", pa.string()), ("repaired", REPAIRED)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out, size = None, [], 0
        for batch in cut(batches):
            for conv_id, turn, role, text, copies in _python(batch, "conv_id", "turn", "role", "text", "n"):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        out.append(now.result())
                        size += sum(len(r.text) for r in now.rows)
                    now = Conversation(conv_id)
                    if len(out) >= 200 or size > 2 << 20:
                        yield _batch(out, schema)
                        out, size = [], 0
                now.add(turn, role, text, copies)
        if now is not None:
            yield _batch([*out, now.result()], schema)
    return run


CHUNKS = ("part int, no int, n long, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, "
          "first string, initial string, best array<binary>, roles array<string>, texts array<string>, gone array<boolean>")
CHUNK_TYPES = [pa.int32(), pa.int32(), *[pa.int64()] * 8, pa.string(), pa.string(), pa.list_(pa.binary()), pa.list_(pa.string()),
               pa.list_(pa.string()), pa.list_(pa.bool_())]
CHUNK_NAMES = [c.split()[0] for c in CHUNKS.split(", ")]


def _bytes(w: int | None) -> bytes | None:
    return None if w is None else w.to_bytes(w.bit_length() // 8 + 1, "big")


def _in_chunks(id_type: pa.DataType):
    """Chunks of conversations whose rows lie in ranges, in order; a chunk's place is (part, no)."""
    schema = pa.schema([("conv_id", id_type), *zip(CHUNK_NAMES, CHUNK_TYPES, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no, now = TaskContext.get().partitionId(), 0, None
        facts, rows, size = Facts(), [], 0

        def done() -> pa.RecordBatch:
            f = facts
            # rows that go are never read again
            return _batch([[now[0], part, no, f.n, f.blank, f.duplicate, f.truncated, f.illegal, f.turns, f.low, f.high, f.first, f.initial,
                            [_bytes(w) for w in table(rows)], ["" if r.gone else r.role for r in rows],
                            ["" if r.gone else r.text for r in rows], [r.gone for r in rows]]], schema)

        for batch in cut(batches):
            for conv_id, turn, role, text, copies, first in _python(batch, "conv_id", "turn", "role", "text", "n", "is_first"):
                for i in range(copies):
                    if rows and (now[0] != conv_id or len(rows) >= CHUNK or size > 2 << 20):
                        yield done()
                        no, facts, rows, size = no + 1, Facts(), [], 0
                    now = (conv_id,)
                    repeated = i > 0 or not first
                    row = Row(role, text, repeated)
                    facts.add(turn, row, repeated)
                    rows.append(row)
                    size += len(text)
        if rows:
            yield done()
    return run


def _solved(id_type: pa.DataType):
    """One conversation's chunks without their texts: the state before each and its letters; totals on the first one."""
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = pa.schema([("conv_id", id_type), ("part", pa.int32()), ("no", pa.int32()), ("state", pa.int32()), ("letters", pa.binary()),
                        ("last", pa.bool_()), *((c, pa.int64()) for c in names)])

    def run(chunks: pa.Table) -> pa.Table:
        found = sorted(chunks.to_pylist(), key=lambda r: (r["part"], r["no"]))
        facts = Facts()
        for f in found:
            facts.join(f)
        read = lambda b: None if b is None else int.from_bytes(b, "big")
        cost, path, last = join_chunks([(f["n"], [read(b) for b in f["best"]]) for f in found])
        out = []
        for i, (f, (state, letters)) in enumerate(zip(found, path, strict=True)):
            totals = [*facts.totals(), cost] if i == 0 else [None] * 6
            out.append([f["conv_id"], f["part"], f["no"], state, _bytes(letters), last and i == len(found) - 1, *totals])
        return pa.Table.from_batches([_batch(out, schema)])
    return run


def _spelt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("part", pa.int32()), ("no", pa.int32()), ("audit", pa.string()), ("repaired", REPAIRED)])
    for batch in cut(batches, 8):
        out = []
        for part, no, state, letters, last, roles, texts, gone in _python(
                batch, "part", "no", "state", "letters", "last", "roles", "texts", "gone"):
            rows = []
            for role, text, goes in zip(roles, texts, gone, strict=True):
                row = Row(role, text, False)
                row.gone = goes
                rows.append(row)
            out.append([part, no, *spell(rows, state, int.from_bytes(letters, "big"), last)])
        yield _batch(out, schema)


def _repair_hot(rows: DataFrame, id_type: pa.DataType, name: str, share: int) -> DataFrame:
    """Conversations of very many rows: their rows stay where a range of (turn, role, text) puts them."""
    once = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    once = write_table(once.withColumn("_k", F.sha2(F.encode("text", "utf-8"), 256)), "rep-rows")
    order = F.struct(F.col("turn").isNotNull().alias("has"), F.coalesce("turn", F.lit(0)).alias("turn"))
    first = once.groupBy(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("_k").alias("_f")).agg(F.min(order).alias("_first"))
    seen = once.join(first, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("_k") == F.col("_f")))
    seen = seen.withColumn("is_first", F.col("_first") == order)
    parts = max(4, -(-once.count() // share))
    begin = F.substring("text", 1, 256)   # orders as the text does, and bounds the sample of range bounds
    dealt = (seen.select("conv_id", "turn", "role", "text", "n", "is_first", begin.alias("_b"))
             .repartitionByRange(parts, "conv_id", "turn", "role", "_b").sortWithinPartitions("conv_id", "turn", "role", "text").drop("_b"))
    chunks = write_table(dealt.mapInArrow(_in_chunks(id_type), f"conv_id {name}, {CHUNKS}"), "rep-chunks")
    solved = write_table(chunks.drop("roles", "texts", "gone").groupBy("conv_id").applyInArrow(
        _solved(id_type), f"conv_id {name}, part int, no int, state int, letters binary, last boolean, gaps long, blank long, "
        "duplicate long, truncated long, illegal long, cost long"), "rep-solved")
    told = solved.select("part", "no", "state", "letters", "last").join(
        chunks.select("part", "no", "roles", "texts", "gone"), ["part", "no"]).mapInArrow(
        _spelt, "part int, no int, audit string, repaired array<struct<role: string, text: string>>")
    totals = [F.max(c).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    parts_of = F.sort_array(F.collect_list(F.struct("part", "no", "audit", "repaired")))
    one = solved.join(told, ["part", "no"]).groupBy("conv_id").agg(*totals, parts_of.alias("_parts"))
    return one.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
                      F.concat_ws("", F.transform("_parts", lambda p: p["audit"])).alias("audit"),
                      F.flatten(F.transform("_parts", lambda p: p["repaired"])).alias("repaired"))


def repair(rows: DataFrame, *, hot_rows: int = HOT_ROWS, hot_bytes: int = HOT_BYTES, share: int = HOT_ROWS) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired (role, text).

    rows: (conv_id, turn, role, text, n) without null roles or texts, n the copies of a row side by side; a row of
    n = 0 only names its conversation. ``share`` is the rows a task of a large conversation reads."""
    name = dict(rows.dtypes)["conv_id"]
    id_type = pa.string() if name == "string" else pa.int64()
    sizes = rows.groupBy("conv_id").agg(F.sum("n").alias("_n"), F.sum(F.octet_length("text") * F.col("n")).alias("_b"))
    hot = write_table(sizes.filter((F.col("_n") > hot_rows) | (F.col("_b") > hot_bytes)).select(F.col("conv_id").alias("_hot"), F.lit(True).alias("_is")),
                      "rep-hot")
    if hot.isEmpty():
        plain, large = rows, None
    else:
        same = F.col("conv_id").eqNullSafe(F.col("_hot"))
        plain = rows.join(hot, same, "left_anti")
        large = rows.filter("n > 0").join(hot, same, "left_semi")
    together = plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    out = together.mapInArrow(_whole(id_type), RESULT.format(id=name))
    return out if large is None else out.unionByName(_repair_hot(large, id_type, name, share))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows after the damage that crc32 of conv_id:turn decides, as ``repair`` reads them."""
    src = pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    if dict(src.dtypes)["conv_id"] != "string":
        src = src.withColumn("conv_id", F.col("conv_id").cast("long"))
    src = src.withColumn("turn", F.col("turn").cast("long"))
    space = F.lit(" ")
    named = lambda c: F.coalesce(F.col(c).cast("string"), space)
    kind = F.pmod(F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn")).cast("binary")), F.lit(20))
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    d = F.col("_d")

    def kept(c: Column) -> Column:
        return F.when(d == 0, F.lit("")).otherwise(c)

    text = F.when(d == 1, F.lit("")).when(d == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    return src.withColumn("_d", kind).select(
        "conv_id", F.when(d != 0, F.col("turn")).alias("turn"), kept(F.when(d == 4, F.lit("user")).otherwise(role)).alias("role"),
        kept(text).alias("text"), F.when(d == 0, 0).when(d == 3, 2).otherwise(1).alias("n"))


def repair_digest(conversations: DataFrame, **params) -> DataFrame:
    """``repair`` of the damaged conversations, with the digest of the repaired rows."""
    told = F.concat_ws("\n", F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])))
    return repair(damage(conversations), **params).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.sha2(F.encode(told, "utf-8"), 256).alias("repaired_sha256"))
