"""op11: the integer paths against every possible edit, chunks, large conversations, odd rows."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from riskweave.llm import repair as R
from tests.conftest import SF_CHECK

COLS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        if not text.strip(WHITE):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        elif text.rstrip(WHITE)[-1] not in ".!?":
            out.append("truncated")
        else:
            out.append("")
        seen.add((role, text))
    return out


def every_edit(rows, inserts=1):
    """(cost, audit, repaired) of the best of all edits, by trying each."""
    bad, best = faults(rows), None
    gap = [""] + ["".join(g) for k in range(1, inserts + 1) for g in itertools.product("ua", repeat=k)]
    name = {"u": "user", "a": "assistant"}
    ways = [["D"] if f in ("blank", "duplicate") else ["D", "K", "Ru", "Ra"] for f in bad]
    for edits in itertools.product(*ways):
        fixed = sum(2 if e == "D" else (5 if f == "truncated" else 0) + (e[0] == "R") for e, f in zip(edits, bad, strict=True))
        if best and fixed > best[0]:
            continue
        for gaps in itertools.product(gap, repeat=len(rows) + 1):
            cost = fixed + 5 * sum(map(len, gaps))
            if best and cost > best[0]:
                continue
            audit, out = "", []
            for i in range(len(rows) + 1):
                audit += "I" * len(gaps[i])
                out += [(name[g], "") for g in gaps[i]]
                if i < len(rows):
                    audit += edits[i][0]
                    if edits[i] != "D":
                        out.append((rows[i][1] if edits[i] == "K" else name[edits[i][1]], rows[i][2]))
            if all(r for r, _ in out) and re.fullmatch(r"(s?(ua)+)?", "".join(r[0] for r, _ in out)):
                best = min(best or (cost, audit, out), (cost, audit, out), key=lambda b: b[:2])
    return best


def solved(rows):
    c = R.Conversation(1)
    for t, role, text in rows:
        c.add(t, role, text, 1)
    return c.result()


def some_rows(r, n):
    return [(i, r.choice(["user", "assistant", "system", "tool", "a"]), r.choice(["Hi.", "Go", "", " \n", "Hi.", "Ok!", f"t{i}?"])) for i in range(n)]


@pytest.mark.parametrize("seed", range(60))
def test_integers_decide_as_all_edits_do(seed):
    r = random.Random(seed)
    rows = some_rows(r, r.randint(0, 4))
    cost, audit, out = every_edit(rows, 1 if len(rows) > 2 else 2)
    got = solved(rows) if rows else [1, 0, 0, 0, 0, 0, 0, "", []]
    assert (got[6], got[7]) == (cost, audit), rows
    assert [(x["role"], x["text"]) for x in got[8]] == out


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_chunks_join_exactly(monkeypatch, size):
    for seed in range(40):
        rows = some_rows(random.Random(seed), 24)
        want = solved(rows)
        monkeypatch.setattr(R, "CHUNK", size)
        assert solved(rows) == want
        monkeypatch.setattr(R, "CHUNK", 512)


def brute(table):
    """The digest by definition; the edits come from an own dynamic program over (cost, letters)."""
    out, convs = {}, {}
    for conv, turn, role, text in table:
        rows = convs.setdefault(conv, [])
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if d == 1:
            text = ""
        if d == 2:
            text = re.sub("[.!?]", "", text)
        if d == 4:
            role = "user"
        rows += [(turn, role, text)] * {0: 0, 3: 2}.get(d, 1)
    for conv, rows in convs.items():
        rows.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        bad = faults(rows)
        turns = {t for t, _, _ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        paths = {"": (0, "", ())}
        step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

        def insert(p):
            new = dict(p)
            for s, (c, w, o) in p.items():
                for g in "ua":
                    if (s, g) in step:
                        cand = (c + 5, w + "I", (*o, (("user" if g == "u" else "assistant"), "")))
                        t = step[s, g]
                        new[t] = min(new.get(t, cand), cand, key=lambda x: x[:2])
            return new

        for (_, role, text), f in zip(rows, bad, strict=True):
            new = {}
            for s, (c, w, o) in insert(paths).items():
                cands = [(s, (c + 2, w + "D", o))]
                if f not in ("blank", "duplicate"):
                    extra = 5 * (f == "truncated")
                    if (s, role[:1]) in step:
                        cands.append((step[s, role[:1]], (c + extra, w + "K", (*o, (role, text)))))
                    cands += [(step[s, g], (c + 1 + extra, w + "R", (*o, (n, text)))) for g, n in (("u", "user"), ("a", "assistant")) if (s, g) in step]
                for t, cand in cands:
                    new[t] = min(new.get(t, cand), cand, key=lambda x: x[:2])
            paths = new
        cost, audit, kept = min((v for s, v in insert(paths).items() if s in ("", "a")), key=lambda x: x[:2])
        told = "\n".join(f"{r}:{t}" for r, t in kept)
        out[conv] = (gaps, bad.count("blank"), bad.count("duplicate"), bad.count("truncated"), illegal, cost, audit,
                     hashlib.sha256(told.encode()).hexdigest())
    return out


def digest(df, **params):
    got = R.repair_digest(df, **params).collect()
    out = {r.conv_id: tuple(r[c] for c in COLS) for r in got}
    assert len(out) == len(got)
    return out


def test_shared_table(llm):
    df = llm.read.parquet(f"{SF_CHECK}/conversations.parquet")
    assert digest(df) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def odd_rows():
    r = random.Random(7)
    rows = [(c, t, *x[1:]) for c in range(30) for t, x in enumerate(some_rows(r, 6))]
    rows += [(None, t, "user", "Hi.") for t in range(4)] + [(50, None, "user", "A."), (50, None, None, "A."), (50, 3, "assistant", None)]
    rows += [(51, 2, "user", "Same.")] * 40 + [(52, 10 * t, "", "x.") for t in range(9)]
    rows += [(53, t, "user" if t % 2 == 0 else "assistant", f"Row {t}.") for t in range(700)]
    rows += [(54, 5, "user", "é" * 300 + f" {t % 50}.") for t in range(120)] + [(55, 1, "user", "x" * 200_000 + ".")]
    return rows


def test_odd_rows_and_large_conversations(llm):
    rows = odd_rows()
    random.Random(1).shuffle(rows)
    df = llm.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS n", "1 AS part", "2 AS `repaired`")
    want = brute(rows)
    assert digest(df) == want
    assert digest(df, hot_rows=3, share=40) == want     # every conversation of more rows goes in ranges
    assert digest(df, hot_bytes=1000, share=200) == want


def test_all_rows_dropped_and_empty_table(llm):
    gone = [(c, 1) for c in range(400) if zlib.crc32(f"{c}:1".encode()) % 20 == 0]
    got = digest(llm.createDataFrame([(c, t, "user", "x") for c, t in gone], SCHEMA))
    assert gone and set(got.values()) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert digest(llm.createDataFrame([], SCHEMA)) == {}
