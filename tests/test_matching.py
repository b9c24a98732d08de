"""Token sets and abbreviations against brute force, the variant types of a name table, plans."""

import itertools
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from riskweave.operators import matching as M

# two firms as systems spell them: canonical, without '&', abbreviated, truncated, upper case, form spelt out, zero for O,
# hyphenated, a code, with a place
STONE = ["Harbor Stone & Co LLC", "Harbor Stone Co LLC", "HS & Co", "Harbor", "HARBOR STONE & CO LLC", "Harbor Stone & Company",
         "Harb0r Stone & Co LLC", "Harbor-Stone", "HS_CO", "Harbor Stone Oslo"]
COAST = ["NTWilder Coast Bank NA", "NTWilder", "Coast", "NTWILDER COAST BANK NA", "NTWilder Coast & Co", "NTWCB", "NTWilder Coast Lima"]
OTHERS = ["Fjord Bank PLC", "Crown Bank of Malta", "Metro Savings NA", "Bank of Tyrol", "Miller Grant Holt LLC", "RST Bank NV Kyoto Branch"]


def toks(s):
    return list(dict.fromkeys(re.findall(r"[^\W_]+", s.upper())))


def brute(probes, names, permille, measure):
    n = len({x for x in names if toks(x)})
    df = {}
    for x in set(names):
        for t in toks(x):
            df[t] = df.get(t, 0) + 1
    weight = lambda t: math.floor(1000 * math.log(1 + n / df.get(t, 1)) + 0.5)
    out = set()
    for x, y in itertools.product(set(probes), set(names)):
        a, b = set(toks(x)), set(toks(y))
        common = sum(map(weight, a & b))
        wa, wb = sum(map(weight, a)), sum(map(weight, b))
        base = min(wa, wb) if measure == "overlap" else wa + wb - common
        if a & b and 1000 * common >= permille * base:
            out.add((x, y, round(common / base, 6)))
    return out


def frame(spark, some, col):
    return spark.createDataFrame([(s,) for s in some], f"{col} string")


@pytest.mark.parametrize("seed, permille, measure", [(1, 800, "overlap"), (2, 500, "overlap"), (3, 600, "jaccard"), (4, 1000, "jaccard"), (5, 300, "jaccard")])
def test_pairs_equal_brute_force(spark, seed, permille, measure):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["bank"] * 8 + ["of"] * 4
    make = lambda: " ".join(r.choice(words) for _ in range(r.randint(1, 6)))
    probes, names = [make() + r.choice(["", " zz", "-Q"]) for _ in range(120)] + ["", "***", "bank", "bank bank"], [make() for _ in range(150)] + ["", "bank"]
    got = M.similar_names(frame(spark, [*probes, None, probes[0]], "booked_name"), frame(spark, [*names, None], "canonical_name"), permille / 1000, measure)
    out = [tuple(x) for x in got.collect()]
    assert len(out) == len(set(out)) and set(out) == brute(probes, names, permille, measure)


def reading(probe, name):
    """Whether a name's words, legal forms left out at will, begin with the pieces of a probe."""
    said, words = toks_all(probe), toks_all(name)

    def fits(i, parts):
        parts = parts[1:] if parts and not parts[0] else parts
        if i == len(words):
            return not parts
        if i and words[i] in M.LEGAL_FORMS and fits(i + 1, parts):
            return True
        return bool(parts) and any(parts[0][:n] == words[i][:n] and fits(i + 1, [parts[0][n:], *parts[1:]])
                                   for n in range(1, min(len(parts[0]), len(words[i])) + 1))
    return fits(0, said)


def toks_all(s):
    return re.findall(r"[^\W_]+", s.upper())


def test_abbreviations_equal_a_recursion(spark):
    r = random.Random(9)
    words = ["ab", "abc", "ba", "b", "CO", "LLC", "aab", "NA"]
    names = [" ".join(r.choice(words) for _ in range(r.randint(1, 4))) for _ in range(60)]
    probes = list({"".join(r.choice("abCOLN _") for _ in range(r.randint(1, 7))) for _ in range(300)}) + STONE + COAST + ["***", ""]
    names += [STONE[0], COAST[0]]
    variants = spark.createDataFrame([(n, f"k{i}") for i, n in enumerate(names)], "variant_name string, counterparty_code string")
    got = {x.booked_name: (x.verdict, x.counterparty_code) for x in M.abbreviation_matches(frame(spark, probes, "booked_name"), variants).collect()}
    for p in set(probes):
        hits = sorted({f"k{i}" for i, n in enumerate(names) if toks_all(p) and reading(p, n)})
        want = ("TOO_LONG" if len("".join(toks_all(p))) > M.MAX_LETTERS else M.NO_MATCH if not hits else M.RESOLVED if len(hits) == 1 else M.AMBIGUOUS)
        assert got[p] == (want, hits[0] if want == M.RESOLVED else None), (p, hits)


def test_every_kind_of_variant_is_resolved_or_ambiguous(spark):
    names = [(STONE[0], "HSCO"), (COAST[0], "NTWC")] + [(n, f"O{i}") for i, n in enumerate(OTHERS)]
    variants = spark.createDataFrame(names, "variant_name string, counterparty_code string")
    out = M.resolve_names(frame(spark, [*STONE, *COAST, "Unheard Of", "Bank"], "booked_name"), variants, 0.65)
    got = {x.booked_name: (x.rule, x.verdict, x.counterparty_code) for x in out.collect()}
    assert all(got[n][1:] == (M.RESOLVED, "HSCO") for n in STONE), got
    assert all(got[n][1:] == (M.RESOLVED, "NTWC") for n in COAST), got
    assert got["Unheard Of"] == ("NONE", M.NO_MATCH, None) and got["Bank"] == ("TOKENS", M.AMBIGUOUS, None)
    assert {got[n][0] for n in ("HS & Co", "HS_CO", "NTWCB")} == {"ABBREVIATION"} and got["Harbor Stone Oslo"][0] == "TOKENS"


def test_common_initials_make_no_pairs(spark):
    names = spark.range(4000).select(F.concat(F.lit("Alpha Beta Gamma "), F.lit("LLC")).alias("variant_name"), F.col("id").cast("string").alias("counterparty_code"))
    probes = spark.range(50).select(F.lit("ABG").alias("booked_name"))
    out = M.abbreviation_matches(probes, names)
    assert [tuple(r) for r in out.collect()] == [("ABG", M.AMBIGUOUS, None)]
    with pytest.raises(ValueError):
        M.similar_names(probes, names, measure="cosine")
