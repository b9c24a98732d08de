"""Secret scan: fixed patterns, and a randomness test battery over token-like strings.

Only DataFrame functions: the texts stay in the JVM.

Base spans are the leftmost non-overlapping matches of three patterns. The method
then takes the other long token-like strings, and the parts of 20 characters or more
that their separators cut them into (after an inner '=', between '/' and longer runs
of '_' or '-', between any separators), so that a key is not diluted by the name or
path it stands in. It infers their encoding (digits, letters of one case, hex, base32,
base36 or base62 by the characters used) and tests them without their separators:

* chi-squared uniformity over the alphabet of the encoding (as the index of
  coincidence), the runs test over the character classes (over the halves of the
  alphabet, where it is one class), and lag-1 serial
  correlation over alphabet positions. A string on which any of them rejects
  uniform randomness (Bonferroni, ``alpha``) is structured and dropped;
* chi-squared and runs again, one-sided, against a text-like null (symbols repeat
  ``TEXT_REPEAT`` times as often as uniform, classes switch at ``TEXT_SWITCH``),
  combined by Fisher's method to the p-value that the string is text; chi-squared
  alone for strings of one class, as text changes halves as often as random letters.

False discoveries are held at ``fdr`` by Benjamini-Hochberg within each class of
lengths, over the distinct strings of the corpus, since short strings cannot reach
the p-values of long ones; strings that occur only as parts, strings of
one letter case, of digits, and keys in groups (more than ``MAX_SEPARATORS`` of the
characters are separators) have classes of their own. p-values are binned, rounded up, to a tenth of a decade,
so the procedure needs a histogram of at most 20 x 301 rows.

Defined results: a null or empty text has no span; offsets are code points, end
exclusive; rows with equal doc_ids stay apart; the tests are linear in a string's length; UUIDs are not tested, since they are
random but public identifiers, and neither is a grouped string that holds one; a span that overlaps a base span is not added; of
strings found within each other the outermost is the span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, write_table

# The base patterns, and the least length of what they must match.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
MIN_ASSIGN, MIN_ACCESS = 8, 16

TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
# Parts of such a run that are tested as well: cut at every '=' but trailing padding, then also
# at '/' and longer runs of '_' or '-', then at every separator.
PAD = r"(?:=+(?![A-Za-z0-9+/_=-]))?"
PARTS = (r"[A-Za-z0-9+/_-]{20,}+" + PAD,
         r"[A-Za-z0-9+](?:[A-Za-z0-9+]|(?<![_-])[_-](?![_-])){19,}+" + PAD,
         r"[A-Za-z0-9]{20,}+" + PAD)
UUID = r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$"
INNER_UUID = r"(?<![0-9A-Fa-f])" + UUID[1:-1] + r"(?![0-9A-Fa-f])"
MIN_CORE = 18
MAX_SEPARATORS = 0.125
ALPHA = 0.001
FDR = 0.01
TEXT_REPEAT = 1.75
TEXT_SWITCH = 0.25
LENGTH_CLASSES = (28, 40, 64)
BINS = 300
BLOCK = 256

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _spans(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Column ``name``: array<struct<s,e,m>> of the pattern's leftmost non-overlapping matches.

    What lies between matches comes from ``split``; ends are prefix sums of both
    lengths, in blocks so that thousands of matches in a text stay cheap.
    """
    df = df.withColumn("_m", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    df = df.withColumn("_p", F.when(F.size("_m") > 0, F.split("text", pattern, -1)))
    df = df.withColumn("_l", F.when(F.size("_m") > 0, F.transform(
        F.sequence(F.lit(1), F.size("_m")),
        lambda i: (F.length(F.element_at("_p", i)) + F.length(F.element_at("_m", i))).cast("long"))))
    add = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda x, y: x + y)
    blocks = F.sequence(F.lit(0), F.floor((F.size("_l") - 1) / BLOCK).cast("int"))
    df = df.withColumn("_s", F.when(F.size("_l") > 0, F.transform(
        blocks, lambda b: add(F.slice("_l", b * BLOCK + 1, BLOCK)))))
    df = df.withColumn("_b", F.when(F.size("_l") > 0, F.transform(blocks, lambda b: add(F.slice("_s", F.lit(1), b)))))
    df = df.withColumn("_e", F.when(F.size("_l") > 0, F.transform(
        F.sequence(F.lit(0), F.size("_l") - 1),
        lambda i: F.element_at("_b", F.floor(i / BLOCK).cast("int") + 1)
        + add(F.slice("_l", F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK + 1)))))
    out = F.when(F.size("_m") > 0, F.zip_with("_e", "_m", lambda e, m: F.struct(
        (e - F.length(m)).alias("s"), e.alias("e"), m.alias("m"))))
    none = F.array().cast("array<struct<s:bigint,e:bigint,m:string>>")
    return df.withColumn(name, F.coalesce(out, none)).drop("_m", "_p", "_l", "_s", "_b", "_e")


def _tail(z: Column) -> Column:
    """Upper tail of the standard normal, by a logistic of a cubic (error below 0.0002, tails within a factor of 3)."""
    return 1 / (1 + F.exp(F.least(1.5976 * z + 0.07056 * z * z * z, F.lit(600.0))))


def token_tests(df: DataFrame, token: str = "m") -> DataFrame:
    """Adds encoding, n, p_uniform and p_text to rows with a token-like string; null where nothing is tested."""
    core = F.regexp_replace(token, "[^A-Za-z0-9]", "")
    df = df.withColumn("core", core).withColumn("n", F.length("core"))
    has = lambda p: F.col("core").rlike(p)
    df = df.withColumn("grouped", F.length(token) - F.col("n") > MAX_SEPARATORS * F.length(token))
    tested = ((F.col("n") >= MIN_CORE) & ~F.col(token).rlike(UUID) & ~(F.col("grouped") & F.col(token).rlike(INNER_UUID)))
    df = df.withColumn("encoding", F.when(tested, F.when(has("^[0-9]+$"), "digits").when(has("^[a-z]+$"), "lower")
                                          .when(has("^[A-Z]+$"), "upper")
                                          .when(has("^[0-9a-f]+$"), "hex").when(has("^[0-9A-F]+$"), "HEX")
                                          .when(has("^[A-Z2-7]+$"), "base32").when(has("^[0-9a-z]+$"), "base36")
                                          .when(has("^[0-9A-Z]+$"), "BASE36").otherwise("base62")))
    one = F.col("encoding").isin("digits", "lower", "upper")
    alphabet = {"digits": DIGITS, "lower": LOWER, "upper": UPPER,
                "hex": DIGITS + LOWER[:6], "HEX": DIGITS + UPPER[:6], "base32": UPPER + DIGITS[2:8],
                "base36": DIGITS + LOWER, "BASE36": DIGITS + UPPER, "base62": DIGITS + UPPER + LOWER}
    pick_one = lambda what: F.coalesce(*[F.when(F.col("encoding") == k, what(v)) for k, v in alphabet.items()])
    df = df.withColumn("k", pick_one(lambda a: F.lit(float(len(a)))))
    # index of coincidence: equal pairs of symbols
    df = df.withColumn("chars", F.when(F.col("encoding").isNotNull(), F.split("core", "")))
    size = F.col("n").cast("double")   # products of lengths pass 32 bits
    in_order = F.array_join(F.sort_array("chars"), "")
    counts = F.transform(F.regexp_extract_all(in_order, F.lit(r"(.)\1*+"), F.lit(0)), lambda run: F.length(run).cast("double"))
    df = df.withColumn("pairs", F.aggregate(counts, F.lit(0.0), lambda a, k: a + k * (k - 1) / 2))
    all_pairs = size * (size - 1) / 2
    # runs of character classes, or of the halves of an alphabet that is one class
    classes = F.when(one, F.translate("core", DIGITS + LOWER + UPPER, "x" * 5 + "y" * 5 + ("x" * 13 + "y" * 13) * 2)).otherwise(
        F.translate("core", DIGITS + LOWER + UPPER, "d" * 10 + "l" * 26 + "u" * 26))
    shape = F.regexp_replace(classes, r"(.)\1+", "$1")
    df = df.withColumn("switches", F.length(shape) - 1)
    parts = {k: [sum(c in v for c in s) / len(v) for s in (DIGITS, LOWER, UPPER)] for k, v in alphabet.items()}
    parts |= {k: [0.5, 0.5] for k in ("digits", "lower", "upper")}
    df = df.withColumn("p_switch", F.coalesce(*[F.when(F.col("encoding") == k, F.lit(1 - sum(x * x for x in v)))
                                                for k, v in parts.items()]))
    # lag-1 serial correlation of alphabet positions, from sums over one pass of the string: they are whole numbers
    # (a lambda that named another column would evaluate that column's expression for each character)
    df = df.withColumn("at", pick_one(lambda a: F.transform("chars", lambda c: F.instr(F.lit(a), c).cast("double"))))
    zero = F.struct(*[F.lit(0.0).alias(x) for x in ("sum", "squares", "products", "last")])
    df = df.withColumn("sums", F.aggregate("at", zero, lambda a, v: F.struct(
        (a["sum"] + v).alias("sum"), (a["squares"] + v * v).alias("squares"), (a["products"] + a["last"] * v).alias("products"), v.alias("last"))))
    total, first, last = F.col("sums.sum"), F.element_at("at", 1), F.col("sums.last")
    mean = total / size
    df = df.withColumn("var", F.col("sums.squares") - total * mean)
    lag = F.col("sums.products") - mean * (2 * total - first - last) + (size - 1) * mean * mean
    # the least variance of a string that is not one letter over and over is 1 - 1/n
    df = df.withColumn("z_serial", F.when(F.col("var") > 0.5, F.abs(lag / F.col("var") + 1 / size) * F.sqrt(size)).otherwise(F.lit(99.0)))
    even = all_pairs / F.col("k")
    z_pairs = (F.col("pairs") - even) / F.sqrt(even * (1 - 1 / F.col("k")))
    steps = F.col("n") - 1
    z_runs = (F.col("switches") - steps * F.col("p_switch")) / F.sqrt(steps * F.col("p_switch") * (1 - F.col("p_switch")))
    known = F.col("encoding").isNotNull()  # least() passes over NULLs, so ask before
    df = df.withColumn("p_uniform", F.when(known, F.least(F.lit(1.0), 3 * F.least(
        _tail(z_pairs), 2 * _tail(F.abs(z_runs)), 2 * _tail(F.col("z_serial"))))))
    text = even * TEXT_REPEAT
    p_pairs = _tail((text - F.col("pairs")) / F.sqrt(text))
    p_runs = _tail((F.col("switches") - steps * TEXT_SWITCH) / F.sqrt(steps * TEXT_SWITCH * (1 - TEXT_SWITCH)))
    half = -(F.log(p_pairs) + F.log(p_runs))
    # text does not switch between halves of the alphabet any less than random strings do
    df = df.withColumn("p_text", F.when(known, F.when(one, p_pairs).otherwise(F.exp(-half) * (1 + half))))
    return df.drop("core", "k", "chars", "pairs", "switches", "p_switch", "at", "sums", "var", "z_serial")


def _length_class() -> Column:
    family = (F.when(F.col("encoding") == "digits", 4).when(F.col("encoding").isin("lower", "upper"), 3)
              .when(F.col("grouped"), 2).when(F.col("whole"), 0).otherwise(1))
    c = family * (len(LENGTH_CLASSES) + 1)
    for edge in LENGTH_CLASSES:
        c = c + (F.col("n") >= edge).cast("int")
    return c


def discoveries(tested: DataFrame, fdr: float = FDR) -> DataFrame:
    """(length_class, least_bin): Benjamini-Hochberg over the tested strings (distinct), by length class."""
    hist = tested.groupBy("length_class", "bin").agg(F.count("*").alias("c"))
    up = Window.partitionBy("length_class").orderBy(F.desc("bin"))
    whole = Window.partitionBy("length_class")
    return (hist.withColumn("above", F.sum("c").over(up)).withColumn("m", F.sum("c").over(whole))
            .filter(F.pow(F.lit(10.0), -F.col("bin") / 10) <= fdr * F.col("above") / F.col("m"))
            .groupBy("length_class").agg(F.min("bin").alias("least_bin")))


SPAN = "struct<s:bigint,rank:int,e:bigint,kind:string>"


def _kind(col: str, name: str, rank: int, keep=None) -> Column:
    spans = F.filter(col, keep) if keep else F.col(col)
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(rank).alias("rank"), x["e"].alias("e"),
                                                 F.lit(name).alias("kind")))


def find_secrets(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), *, fdr: float = FDR, alpha: float = ALPHA) -> DataFrame:
    """The columns ``keep`` of ``docs``, ``base`` and ``spans`` (array<struct<s,rank,e,kind>>, in order).

    One pass over the texts writes spans and candidates; all that follows works on
    those alone: tests run once per distinct string, and the strings found are joined
    back (a hot string is split by adaptive execution) and gathered per row.
    """
    df = pick(docs, text="text", **{c: c for c in keep})
    df = df.withColumn("text", F.coalesce(F.col("text"), F.lit("")))
    parts = [(f"_part{i}", p) for i, p in enumerate(PARTS)]
    for name, pattern in (("_assign", ASSIGN), ("_access", ACCESS), ("_hex", HEX), ("_token", TOKEN), *parts):
        df = _spans(df, name, pattern)
    df = df.withColumn("base", F.array_sort(F.concat(
        _kind("_assign", "assign", 0, lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= MIN_ASSIGN),
        _kind("_access", "access", 1, lambda x: F.length(x["m"]) >= MIN_ACCESS),
        _kind("_hex", "hex", 2))))
    df = df.withColumn("_token", F.filter(F.concat(
        F.transform("_token", lambda t: t.withField("whole", F.lit(True))),
        *[F.transform(name, lambda t: t.withField("whole", F.lit(False))) for name, _ in parts]),
        lambda t: ~F.exists("base", lambda b: (b["s"] < t["e"]) & (t["s"] < b["e"]))))
    df = df.withColumn("_row", F.monotonically_increasing_id())  # written, and so fixed, with the row
    df = write_table(df.drop("text", "_assign", "_access", "_hex", *[name for name, _ in parts]), "secret-spans")
    tested = (token_tests(df.select(F.explode("_token").alias("t")).select("t.m", "t.whole")
                          .groupBy("m").agg(F.max("whole").alias("whole"))).filter("encoding is not null")
              .withColumn("length_class", _length_class())
              .withColumn("bin", F.least(F.lit(BINS), F.floor(-F.log10("p_text") * 10).cast("int"))))
    tested = write_table(tested.select("m", "p_uniform", "length_class", "bin"), "secret-tests")
    found = (tested.join(F.broadcast(discoveries(tested, fdr)), "length_class")  # a row for each length class
             .filter((F.col("bin") >= F.col("least_bin")) & (F.col("p_uniform") >= alpha)).select("m"))
    more = (df.select("_row", F.explode("_token").alias("t")).select("_row", "t.s", "t.e", "t.m")
            .join(found, "m").select("_row", "s", "e"))
    more = (_outermost(more).groupBy("_row").agg(F.collect_list(F.struct(
        "s", F.lit(3).alias("rank"), "e", F.lit("random").alias("kind"))).alias("more")))
    return df.join(more, "_row", "left").withColumn("spans", F.array_sort(F.concat(
        "base", F.coalesce("more", F.array().cast(f"array<{SPAN}>"))))).drop("_row", "_token", "more")


def _outermost(found: DataFrame) -> DataFrame:
    """Of strings found within each other the outermost."""
    before = Window.partitionBy("_row").orderBy("s", F.desc("e")).rowsBetween(Window.unboundedPreceding, -1)
    return (found.withColumn("before", F.max("e").over(before))
            .filter(F.col("before").isNull() | (F.col("s") >= F.col("before"))).drop("before"))


def spans_text(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def redact(docs: DataFrame, mask: str = "[SECRET]", **params) -> DataFrame:
    """``docs`` with every span found replaced by ``mask`` (overlapping spans by one), n_chars made anew.

    Rows meet their spans by a hash of doc_id and text, so equal rows stay apart.
    """
    own = docs.select("doc_id", "text", "lang", "source", "n_chars").withColumn(
        "_key", F.xxhash64(F.col("doc_id").cast("string"), "text"))
    found = (find_secrets(own, ("_key",), **params).filter(F.size("spans") > 0)
             .select("_key", "spans").dropDuplicates(["_key"]))
    # start a new piece only where a span begins beyond all before it
    joined = own.join(found, "_key", "left").drop("_key")
    acc = F.aggregate(
        "spans", F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda a, x: F.struct(
            F.when(x["s"] >= a["at"], F.concat(
                a["out"], F.substring("text", a["at"].cast("int") + 1, (x["s"] - a["at"]).cast("int")), F.lit(mask)))
            .otherwise(a["out"]).alias("out"),
            F.greatest(a["at"], x["e"]).alias("at")),
        lambda a: F.concat(a["out"], F.substring("text", a["at"].cast("int") + 1, F.length("text"))))
    out = joined.withColumn("text", F.when(F.col("spans").isNotNull(), acc).otherwise(F.col("text")))
    return out.drop("spans").withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
