"""B. Names beyond one edit: weighted token sets, abbreviations, and a cascade of all rules.

Truncated names, added places, spelt-out legal forms and words in another order share
tokens with the name they stand for; codes and abbreviations share the beginnings of its
words. Both searches are equi-joins on generated keys followed by an exact test: no pair of
names meets that shares no key, and no name is compared with all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import name_key
from ..plans.joins import dealt, grown
from ..session import write_scratch

RESOLVED, AMBIGUOUS, NO_MATCH, TOO_LONG = "RESOLVED", "AMBIGUOUS", "NO_MATCH", "TOO_LONG"
MAX_LETTERS = 10
MAX_OPTIONAL = 8
HOT_NAMES = 2000     # a token of more names than this is joined in parts of about as many
# Words of legal forms, which an abbreviation may leave out.
LEGAL_FORMS = ("LLC", "LTD", "LIMITED", "INC", "INCORPORATED", "CORP", "CORPORATION", "CO", "COMPANY", "PLC", "NA", "SA", "AG",
               "NV", "AND", "GROUP", "HOLDING", "HOLDINGS")


def tokens(name: Column | str) -> Column:
    """Runs of letters or digits of any script, in upper case, in order."""
    c = F.col(name) if isinstance(name, str) else name
    return F.regexp_extract_all(F.upper(c), F.lit(r"([\p{L}\p{N}]+)"), 1)


# ---- weighted token sets ------------------------------------------------------------------

def token_weights(names: DataFrame, name: str) -> DataFrame:
    """(token, names, weight): in how many distinct names a token is, and its rarity as the
    integer 1000 ln(1 + N / names). N is counted when this is called."""
    distinct = names.select(F.col(name).alias("_name")).distinct().withColumn("_t", F.array_distinct(tokens("_name"))).filter(F.size("_t") > 0)
    total = distinct.count()
    counts = distinct.select(F.explode("_t").alias("token")).groupBy("token").agg(F.count("*").alias("names"))
    return counts.select("token", "names", rarity(F.lit(total), F.col("names")).alias("weight"), F.lit(total).alias("_total"))


def rarity(total: Column, names: Column) -> Column:
    return F.round(1000 * F.log(1 + total / names)).cast("long")


def _token_sets(names: DataFrame, words: DataFrame, unknown: int) -> DataFrame:
    """(name, toks, total): a name's tokens of ``words``, rarest first, and the weight of all its
    tokens. Tokens that are not in ``words`` meet no name; they count in ``total`` alone, where
    they weigh ``unknown``."""
    known = dealt(names.select("name", F.explode(F.array_distinct(tokens("name"))).alias("token")).join(grown(words), "token", "left").drop("token"), "name")
    # a name's tokens are few: the arrays hold one name's tokens each
    tok = F.when(F.col("id").isNotNull(), F.struct("names", "id", "weight", "probes"))
    return known.groupBy("name").agg(F.sort_array(F.collect_list(tok)).alias("toks"), F.sum(F.coalesce("weight", F.lit(unknown))).alias("total"))


def _placed(sets: DataFrame, side: str) -> DataFrame:
    """A row per name and token: (id, names, probes, name, pos, rest, total, own, weights), all but
    the first three named by ``side``. ``rest`` is the weight from this token on, ``own`` and
    ``weights`` are the whole set."""
    rest = F.aggregate(F.slice("toks", F.col("_p") + 1, F.size("toks")), F.lit(0).cast("long"), lambda a, t: a + t["weight"])
    return sets.select("name", "total", "toks", F.posexplode("toks").alias("_p", "_t")).select(
        "_t.id", "_t.names", "_t.probes", F.col("name").alias(f"{side}_name"), (F.col("_p") + 1).alias(f"{side}_pos"), rest.alias(f"{side}_rest"),
        F.col("total").alias(f"{side}_total"), F.col("toks.id").alias(f"{side}_own"), F.col("toks.weight").alias(f"{side}_weights"))


def _meet(few: DataFrame, many: DataFrame, side: str, held: str) -> DataFrame:
    """Rows of ``few`` and ``many`` with a common token, of which ``held`` counts the names on the
    side of ``many``, named by ``side``. The names of a frequent token are dealt over parts and
    each row of ``few`` goes to all of them, so no task has a whole token. Names of a frequent
    token that no row of ``few`` has stay where they are."""
    busy = write_scratch(few.filter(F.col(held) >= HOT_NAMES).select("id").distinct().withColumn("_busy", F.lit(True)), "busy-tokens")
    many = many.join(busy, "id", "left").filter((F.col(held) < HOT_NAMES) | F.col("_busy")).drop("_busy")
    last = F.floor(F.col(held) / HOT_NAMES).cast("int")
    few = few.withColumn("_part", F.explode(F.sequence(F.lit(0), last))).drop("names", "probes")
    many = many.withColumn("_part", F.pmod(F.xxhash64(f"{side}_name"), last + 1).cast("int")).drop("names", "probes")
    return dealt(few, "id", "_part").join(grown(dealt(many, "id", "_part")), ["id", "_part"])


def similar_names(probes: DataFrame, names: DataFrame, threshold: float = 0.8, measure: str = "overlap",
                  probe: str = "booked_name", name: str = "canonical_name") -> DataFrame:
    """All pairs of a probe and a name whose weighted token sets are similar: (probe, name, similarity).

    ``overlap`` is the common weight over the lighter set's (a truncated name is 1), ``jaccard``
    that over the union's. Weights are rarities among the names (``token_weights``).

    Tokens have one order, rarest first. Sets that are similar enough share a token that lies
    before the point where less than a share of a set's weight is left: of ``threshold`` for the
    lighter set in ``overlap`` and the heavier one in ``jaccard``, of 2 threshold / (1 + threshold)
    for the lighter one in ``jaccard``. Only those prefixes are joined, the lighter set's being
    copied to the parts of a frequent token, so common words meet, and are copied, only where a
    name has nothing rarer. A pair is kept at its first common token alone, so it comes once
    without a ``distinct``; there the weights that are left bound what the sets can have in
    common, before the sets are compared. Integer weights make the comparison exact.

    When called it writes the distinct names, the tokens (numbered, as numbers are shorter and
    quicker to compare), the token sets of both sides and the frequent tokens of the prefixes; the
    join is lazy.
    """
    if measure not in ("overlap", "jaccard"):
        raise ValueError("measure must be 'overlap' or 'jaccard'")
    permille = round(threshold * 1000)
    probes, names = (write_scratch(df.select(F.col(c).alias("name")).filter("name IS NOT NULL").distinct(), "names") for df, c in ((probes, probe), (names, name)))
    weights = token_weights(names, "name")
    said = probes.select(F.explode(F.array_distinct(tokens("name"))).alias("token")).groupBy("token").agg(F.count("*").alias("probes"))
    words = write_scratch(weights.join(grown(said), "token", "left").select(
        "token", "names", F.coalesce("probes", F.lit(0).cast("long")).alias("probes"), "weight", "_total", F.monotonically_increasing_id().alias("id")), "name-tokens")
    # what a token of one name weighs; the number of names is a constant column
    one = words.select(rarity(F.col("_total"), F.lit(1)).alias("w")).first()
    words, unknown = words.drop("_total"), one["w"] if one else 1
    x, y = (_placed(write_scratch(_token_sets(df, words, unknown), "token-sets"), side) for df, side in ((probes, "x"), (names, "y")))
    y = y.filter("probes > 0").drop("y_pos", "y_weights")
    wx, wy = F.col("x_total"), F.col("y_total")
    left = lambda side, of, share: of * F.col(f"{side}_rest") >= share * F.col(f"{side}_total")
    if measure == "overlap":
        met = (_meet(x.filter(left("x", 1000, permille)), y, "y", "names").filter(wx <= wy)
               .unionByName(_meet(y.filter(left("y", 1000, permille)), x, "x", "probes").filter(wy < wx)))
        base = lambda common: F.least(wx, wy)
    else:
        light, heavy = (1000 + permille, 2 * permille), (1000, permille)
        met = (_meet(x.filter(left("x", *light)), y.filter(left("y", *heavy)), "y", "names").filter((wx <= wy) & (1000 * wx >= permille * wy))
               .unionByName(_meet(y.filter(left("y", *light)), x.filter(left("x", *heavy)), "x", "probes").filter((wy < wx) & (1000 * wy >= permille * wx))))
        base = lambda common: wx + wy - common
    enough = lambda common: 1000 * common >= permille * base(common)
    met = met.filter(enough(F.least("x_rest", "y_rest")))
    earlier = F.slice("x_own", 1, F.col("x_pos") - 1)
    met = met.filter(~F.arrays_overlap(earlier, F.col("y_own")))
    common = F.aggregate(F.zip_with("x_own", "x_weights", lambda t, w: F.when(F.array_contains("y_own", t), w).otherwise(F.lit(0).cast("long"))),
                         F.lit(0).cast("long"), lambda a, w: a + w)
    out = met.withColumn("_common", common).filter(enough(F.col("_common")))
    return out.select(F.col("x_name").alias(probe), F.col("y_name").alias(name),
                      F.round(F.col("_common") / base(F.col("_common")), 6).alias("similarity"))


def resolve_by_tokens(probes: DataFrame, variants: DataFrame, threshold: float = 0.8, measure: str = "overlap") -> DataFrame:
    """Per distinct booked name: the code of its most similar variant names, or AMBIGUOUS where
    several codes are equally near, or NO_MATCH."""
    pairs = similar_names(probes, variants, threshold, measure, "booked_name", "variant_name")
    codes = variants.select("variant_name", "counterparty_code").distinct()
    best = Window.partitionBy("booked_name").orderBy(F.desc("similarity"))
    near = (pairs.withColumn("_r", F.rank().over(best)).filter("_r = 1").join(grown(codes), "variant_name")
                 .groupBy("booked_name", "similarity")
                 .agg(F.countDistinct("counterparty_code").alias("n_codes"), F.min("counterparty_code").alias("_code")))
    return _verdicts(probes, near)


def _verdicts(probes: DataFrame, found: DataFrame) -> DataFrame:
    """Every distinct booked name with the verdict on ``found`` (booked_name, n_codes, _code, ...)."""
    every = probes.select("booked_name").filter("booked_name IS NOT NULL").distinct()
    j = every.join(grown(found), "booked_name", "left")
    n = F.coalesce("n_codes", F.lit(0).cast("long"))
    return j.select("booked_name", F.when(n == 1, F.lit(RESOLVED)).when(n > 1, F.lit(AMBIGUOUS)).otherwise(F.lit(NO_MATCH)).alias("verdict"),
                    F.when(n == 1, F.col("_code")).alias("counterparty_code"), n.alias("n_codes"),
                    *[F.col(c) for c in found.columns if c not in ("booked_name", "n_codes", "_code")])


# ---- abbreviations --------------------------------------------------------------------------

def _power(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), n)


def _bit(mask: Column, i: Column) -> Column:
    return F.call_function("shiftright", mask, i).bitwiseAND(F.lit(1)) == 1


def _spellings(probes: DataFrame) -> DataFrame:
    """(booked_name, cut): every way to cut a short name into pieces, its own breaks kept; the
    pieces are joined by blanks, which tokens do not have."""
    p = probes.select("booked_name", F.array_join(tokens("booked_name"), " ").alias("_s"))
    letter = lambda i: F.substring("_s", i, F.lit(1))
    after = F.when(F.length("_s") > 1, F.sequence(F.lit(2), F.length("_s"))).otherwise(F.array().cast("array<int>"))
    cuts = F.aggregate(after, F.array(letter(F.lit(1))), lambda cut, i: F.when(letter(i) == " ", cut).when(
        letter(i - 1) == " ", F.transform(cut, lambda h: F.concat(h, F.lit(" "), letter(i)))).otherwise(
        F.flatten(F.transform(cut, lambda h: F.array(F.concat(h, letter(i)), F.concat(h, F.lit(" "), letter(i)))))))
    return p.select("booked_name", F.explode(cuts).alias("cut"))


def _initials(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), "")


def _readings(variants: DataFrame, max_letters: int) -> DataFrame:
    """(counterparty_code, words): a name's words with every choice of its legal forms (the last
    MAX_OPTIONAL of them) left out; the first word always stays."""
    v = dealt(variants.select("counterparty_code", tokens("variant_name").alias("_w")).filter(F.size("_w") > 0).distinct(), "counterparty_code", "_w")
    legal = F.filter(F.sequence(F.lit(1), F.size("_w")), lambda i: (i > 1) & F.element_at("_w", i).isin(*LEGAL_FORMS))
    v = v.withColumn("_l", F.slice(legal, F.greatest(F.size(legal) - MAX_OPTIONAL + 1, F.lit(1)), MAX_OPTIONAL))
    v = v.withColumn("_m", F.explode(F.sequence(F.lit(0), _power(F.size("_l")) - 1)))
    out = F.filter(F.col("_l"), lambda i: _bit(F.col("_m"), F.array_position("_l", i).cast("int") - 1))
    kept = F.transform(F.filter(F.sequence(F.lit(1), F.size("_w")), lambda i: ~F.array_contains("_o", i)), lambda i: F.element_at("_w", i))
    return (v.withColumn("_o", out).select("counterparty_code", kept.alias("words")).filter(F.size("words") <= max_letters).distinct())


def abbreviation_matches(probes: DataFrame, variants: DataFrame, max_letters: int = MAX_LETTERS) -> DataFrame:
    """Names that a short booked name abbreviates: per distinct booked name a verdict and code.

    A name is abbreviated by beginnings of its words, one or more letters each, in order and
    without a word left out, but for legal forms (never the first word): 'HS & Co', 'HS_CO' and
    'HSCL' for 'Harbor Stone & Co LLC'. Breaks of the booked name are breaks of words. Several
    codes are AMBIGUOUS; names of more than ``max_letters`` letters are TOO_LONG for this rule.

    A booked name is cut into pieces in all ways (512 at most for ten letters); a cut reads as a
    name whose words start with its pieces. Both sides then carry the initials of their pieces
    or words as a key, with the first two letters and the place of the longest piece, which says
    what lengths of pieces a name meets. Names are cut to those lengths and summed by the cut
    (one row each), where the booked names' cuts are looked up. A cut into single letters is all
    initials, and is looked up among names summed by those. So letters that very many names
    share make no pairs of a booked name and a name.
    """
    names = probes.select("booked_name").filter("booked_name IS NOT NULL").distinct()
    letters = F.length(F.array_join(tokens("booked_name"), ""))
    short = dealt(names.filter((letters > 0) & (letters <= max_letters)), "booked_name")
    cuts = _spellings(short)
    read = _readings(variants, max_letters).withColumn("_i", _initials(F.col("words")))
    range_of = lambda df, key: df.groupBy(key).agg(F.min("counterparty_code").alias("_lo"), F.max("counterparty_code").alias("_hi"))

    # every short name has one cut into single letters
    plain = short.select("booked_name", F.array_join(tokens("booked_name"), "").alias("_i")).join(grown(range_of(read, "_i")), "_i").select(
        "booked_name", "_lo", "_hi")
    # the words as one text, which is shorter than a list where the names go to the join
    two = read.select("counterparty_code", F.array_join("words", " ").alias("_name"), "_i", F.posexplode("words").alias("_p", "_word")).filter(F.length("_word") > 1).select(
        "counterparty_code", "_name", "_i", (F.col("_p") + 1).alias("_p"), F.substring("_word", 1, 2).alias("_two"))
    initials = F.regexp_replace("cut", "([^ ])[^ ]* ?", "$1")
    pieces = cuts.filter(F.col("cut").rlike("[^ ]{2}")).select("booked_name", "cut", initials.alias("_i"), F.split("cut", " ").alias("_w"))
    keyed = pieces.withColumn("_lengths", F.transform("_w", lambda w: F.length(w))).withColumn(
        "_p", F.array_position("_lengths", F.array_max("_lengths")).cast("int")).withColumn(
        "_two", F.substring(F.element_at("_w", F.col("_p")), 1, 2))
    lengths = keyed.select("_i", "_p", "_two", "_lengths").distinct()
    # 252 cuts of a name at most (of ten letters into five pieces)
    words = F.split("_name", " ")
    cut_to = F.array_join(F.zip_with(words, "_lengths", lambda w, n: F.substring(w, F.lit(1), n)), " ")
    long_enough = F.forall(F.zip_with(words, "_lengths", lambda w, n: F.length(w) >= n), lambda x: x)
    summed = range_of(two.join(grown(lengths), ["_i", "_p", "_two"]).filter(long_enough).select("counterparty_code", cut_to.alias("cut")), "cut")
    spelt = keyed.select("booked_name", "cut").join(grown(summed), "cut").select("booked_name", "_lo", "_hi")
    found = plain.unionByName(spelt).groupBy("booked_name").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    j = names.withColumn("_n", letters).join(grown(found), "booked_name", "left")
    one = F.col("_lo") == F.col("_hi")
    return j.select("booked_name",
                    F.when(F.col("_n") > max_letters, F.lit(TOO_LONG)).when(F.col("_lo").isNull(), F.lit(NO_MATCH))
                     .when(one, F.lit(RESOLVED)).otherwise(F.lit(AMBIGUOUS)).alias("verdict"),
                    F.when(one, F.col("_lo")).alias("counterparty_code"))


# ---- all rules in order ------------------------------------------------------------------------

def resolve_names(probes: DataFrame, variants: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Every distinct booked name through B6, B7, token sets and abbreviations, in this order; a
    name goes on to the next rule only if the one before finds no name. (booked_name, rule,
    verdict, counterparty_code); several codes at one rule are AMBIGUOUS there and never picked.
    Runs when called: each rule's verdicts are written once, and the next reads what is left."""
    left = probes.select("booked_name").filter("booked_name IS NOT NULL").distinct()
    out = []

    def exact(key: Column, of: Column) -> DataFrame:
        lk = variants.select(of.alias("_k"), "counterparty_code").filter("_k IS NOT NULL").groupBy("_k").agg(
            F.min("counterparty_code").alias("_code"), F.countDistinct("counterparty_code").alias("n_codes"))
        return _verdicts(left, left.withColumn("_k", key).join(grown(lk), "_k").drop("_k"))

    for rule, found in (
            ("EXACT", lambda: exact(F.col("booked_name"), F.col("variant_name"))),
            ("KEY", lambda: exact(name_key("booked_name"), name_key("variant_name"))),
            ("TOKENS", lambda: resolve_by_tokens(left, variants, threshold)),
            ("ABBREVIATION", lambda: abbreviation_matches(left, variants))):
        got = write_scratch(found().select("booked_name", F.lit(rule).alias("rule"), "verdict", "counterparty_code"), "resolve-names")
        hit = F.col("verdict").isin(RESOLVED, AMBIGUOUS)
        out.append(got.filter(hit))
        left = got.filter(~hit).select("booked_name")
    none = left.select("booked_name", F.lit("NONE").alias("rule"), F.lit(NO_MATCH).alias("verdict"), F.lit(None).cast("string").alias("counterparty_code"))
    for part in out:
        none = none.unionByName(part)
    return none
