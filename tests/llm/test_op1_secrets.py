import hashlib
import random
import re
import string

import pytest

from riskweave.llm import secrets

WORDS = ["password", "passwd", "secret", "token", "api_key", "apikey", "API_KEY", "Token"]


def base_spans(text):
    out = []
    either = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
                      for w in ("password", "passwd", "secret", "token", "api")).replace("[aA][pP][iI]", "[aA][pP][iI]_?[kK][eE][yY]")
    for m in re.finditer(rf"({either})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end(), "assign"))
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def told(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)


def scan(docs, **params):
    df = secrets.find_secrets(docs, **params)
    return df.select("doc_id", secrets.spans_text("base").alias("base"), secrets.spans_text("spans").alias("spans")).collect()


def random_text(rng):
    parts = []
    for _ in range(rng.randrange(1, 12)):
        parts.append(rng.choice([
            f"{rng.choice(WORDS)}{rng.choice(['', chr(34), chr(39)])}{' ' * rng.randrange(3)}{rng.choice(':=')}{' ' * rng.randrange(2)}"
            f"{rng.choice(['', chr(34)])}{''.join(rng.choices('abcXYZ0189+/_.=-', k=rng.randrange(1, 14)))}",
            "AKIA" + "".join(rng.choices("ABC0189", k=rng.randrange(0, 16))),
            "".join(rng.choices("0123456789abcdef", k=rng.randrange(20, 45))),
            "token=secret: password=abc", "ünï 😀 ſecret=abcdefghij", "plain words of text,\nand more"]))
    return rng.choice([" ", "", "\n", "é"]).join(parts)


def test_base_spans_match_python(make_docs):
    rng = random.Random(1)
    texts = [random_text(rng) for _ in range(300)] + ["", None, "token=" * 400, "password=" + "x" * 50_000]
    got = {r["doc_id"]: r["base"] for r in scan(make_docs(list(enumerate(texts)), extra=True))}
    assert got == {i: told(base_spans(t or "")) for i, t in enumerate(texts)}


def test_many_matches_in_one_text_keep_their_places(make_docs):
    text = " ".join(f"token=abcdefgh{i}" for i in range(1500))
    (row,) = scan(make_docs([(1, text)]))
    assert row["base"] == told(base_spans(text))


def test_battery_finds_random_strings_and_leaves_text(make_docs):
    rng = random.Random(3)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rng.choices(alphabet, k=rng.choice([40, 48, 64]))) for _ in range(40)]
    clean = ["ThisIsALongCamelCaseIdentifierOfTheProgram2024", "z" * 38 + "1",
             "abcdefghijklmnopqrstuvwxyz0123456789abcdefgh", "550e8400-e29b-41d4-a716-446655440000",
             "internationalizationandlocalization", "usr/share/doc/packages/readme/index", "2024-01-01-2024-01-02-2024-01-03"]
    docs = [(i, f"see {k} here") for i, k in enumerate(keys)] + [(100 + i, f"see {k} here") for i, k in enumerate(clean)]
    got = {r["doc_id"]: r["spans"] for r in scan(make_docs(docs))}
    found = [i for i, k in enumerate(keys) if got[i] == f"random:4:{4 + len(k)}"]
    assert len(found) >= 36
    assert [got[100 + i] for i in range(len(clean))] == [""] * len(clean)


def test_copies_do_not_change_what_is_found(make_docs):
    rng = random.Random(5)
    key = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=60))
    once = scan(make_docs([(1, f"a {key}")]))[0]["spans"]
    many = scan(make_docs([(1, f"a {key}")] * 50))
    assert once == f"random:2:{2 + len(key)}" and [r["spans"] for r in many] == [once] * 50


def test_added_spans_never_overlap_base_spans(make_docs):
    text = "token=" + "Zx8" * 15 + " " + "0f" * 20
    (row,) = scan(make_docs([(1, text)]))
    assert row["base"] == row["spans"] == told(base_spans(text))


def test_redaction_masks_every_span_and_keeps_the_rest(make_docs):
    rng = random.Random(7)
    texts = [random_text(rng) for _ in range(60)] + ["", None, "token=abcdefgh"]
    docs = make_docs([*enumerate(texts), (0, texts[0])])
    got = secrets.redact(docs, fdr=0.0)  # base spans alone
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"] and got.count() == len(texts) + 1
    for r in got.collect():
        text, at, out = texts[r["doc_id"]], 0, ""
        if text is None:
            assert r["text"] is None and r["n_chars"] == 0
            continue
        for s, _, e, _ in base_spans(text):
            if s >= at:
                out += text[at:s] + "[SECRET]"
            at = max(at, e)
        assert r["text"] == out + text[at:] and r["n_chars"] == len(r["text"])


def test_empty_table(make_docs):
    assert scan(make_docs([])) == [] and secrets.redact(make_docs([])).count() == 0


def test_no_python_on_the_executors(make_docs):
    plan = secrets.find_secrets(make_docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("text,digest", [(None, ""), ("token=abcdefgh", "assign:0:14")])
def test_digest_columns(make_docs, text, digest):
    (row,) = scan(make_docs([(1, text)]))
    assert hashlib.sha256(row["base"].encode()).hexdigest() == hashlib.sha256(digest.encode()).hexdigest()


def test_oracle_sql_finds_the_same_random_strings(llm, tmp_path):
    import duckdb

    from riskweave.llm.queries import ORACLE, REGISTRY
    rng = random.Random(11)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    texts = [f"a {''.join(rng.choices(rng.choice([letters, letters[26:], letters[:16], '0123456789ABCDEF', letters[:26] + '234567']), k=n))} b"
             for n in range(18, 80) for _ in range(4)] + [random_text(rng) for _ in range(200)]
    llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = REGISTRY["op1_secret_battery"](llm, str(tmp_path)).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    cur = con.execute(ORACLE["op1_secret_battery"])
    cols = [c[0] for c in cur.description]
    assert sorted(tuple(r[c] for c in cols) for r in got) == sorted(cur.fetchall())
    assert sum("random" in r["spans"] for r in got) > 50


@pytest.mark.parametrize("name", ["AWS_SECRET_ACCESS_KEY=", "usr/share/doc/packages/", "my_settings__production--", "sk_live_of_the_account_"])
def test_keys_after_a_name_or_path_are_found_alone(make_docs, name):
    rng = random.Random(13)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rng.choices(alphabet, k=k)) for k in (24, 32, 40) for _ in range(40)]
    got = {r["doc_id"]: r["spans"] for r in scan(make_docs([(i, f"see {name}{k}== here") for i, k in enumerate(keys)]))}
    e = [4 + len(name) + len(k) + 2 for k in keys]
    whole = [got[i] in (f"random:4:{e[i]}", f"random:{4 + len(name)}:{e[i]}") for i in range(len(keys))]
    assert sum(whole) >= 95


@pytest.mark.parametrize("alphabet,group,least", [
    ("abcdefghijklmnopqrstuvwxyz", 40, 120), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 40, 120), ("0123456789", 28, 100),
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 5, 120)])
def test_keys_of_one_class_and_in_groups_are_found(make_docs, alphabet, group, least):
    rng = random.Random(17)
    keys = ["-".join("".join(rng.choices(alphabet, k=group)) for _ in range(max(1, 25 // group))) for _ in range(200)]
    clean = ["internationalizationandlocalization", "this-is-the-title-of-a-page-about-nothing-in-particular", "2024010120240102202401030104",
             "see-550e8400-e29b-41d4-a716-446655440000"]
    docs = [(i, f"see {k} here") for i, k in enumerate(keys)] + [(1000 + i, f"see {k} here") for i, k in enumerate(clean)]
    got = {r["doc_id"]: r["spans"] for r in scan(make_docs(docs))}
    assert sum(got[i] == f"random:4:{4 + len(k)}" for i, k in enumerate(keys)) >= least
    assert [got[1000 + i] for i in range(len(clean))] == [""] * len(clean)


def test_very_long_tokens(llm, make_docs):
    """Products of lengths beyond 32 bits, and strings of one letter; linear, so a million characters pass."""
    r = random.Random(4)
    letters = string.ascii_letters + string.digits
    long_ones = ["".join(r.choice(letters) for _ in range(n)) for n in (50_000, 1_000_000)]
    flat = ["z" * 50_000, "Z" * 1_000_000]
    rows = [(i, f"see {t} end") for i, t in enumerate(long_ones + flat)]
    got = {x.doc_id: [(s.kind, s.s, s.e) for s in x.spans] for x in secrets.find_secrets(make_docs(rows)).collect()}
    assert got == {0: [("random", 4, 50_004)], 1: [("random", 4, 1_000_004)], 2: [], 3: []}
