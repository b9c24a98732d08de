import random
from collections import Counter

from riskweave.llm import quality


def brute_counts(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


COLS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts_equal_brute_force(make_docs):
    rng = random.Random(1)
    texts = []
    for _ in range(300):
        vocabulary = [rng.choice(["é", "word", "a", "#x", "<b>", "x y", "日本"]) + str(rng.randrange(rng.choice([2, 40])))
                      for _ in range(12)]
        texts.append("".join(rng.choice(vocabulary) + rng.choice([" ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b"])
                             for _ in range(rng.randrange(0, 90))))
    texts += ["", None, " \n\t", "a " * 30_000, "w" * 200_000, "one two three four five six seven eight " * 2]
    got = {r["doc_id"]: tuple(r[c] for c in COLS) for r in quality.quality_rules(make_docs(list(enumerate(texts)), extra=True)).collect()}
    assert got == {i: brute_counts(t) for i, t in enumerate(texts)}


def body(rng, n=60):
    return " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))


def test_frequent_lines_deplete_documents(make_docs):
    rng = random.Random(2)
    notice = "all rights reserved by the site in year 2020 and no part of it may be copied elsewhere"
    rows = [(i, f"{body(rng)}\n{notice.replace('2020', str(2000 + i))}", "a") for i in range(30)]       # above the limit
    rows += [(100, f"{notice}\nbut these four words and then a few more of them", "a")]                 # depleted
    rows += [(101, f"{notice}\nbut these four words and then a few more of them", "b")]                 # other host
    rows += [(200 + i, f"{body(rng)}\n{'common line ' * 2}", None) for i in range(8)]                    # below the limit
    got = {r["doc_id"]: r for r in quality.quality_rules(make_docs(rows), limit_docs=10).collect()}
    assert all(got[i]["kept"] and got[i]["removed_words"] == 18 for i in range(30))
    assert not got[100]["kept"] and not got[100]["base_failed"] and got[101]["kept"]
    assert all(got[200 + i]["kept"] and got[200 + i]["removed_words"] == 0 for i in range(8))


def test_long_frequent_lines_are_removed_too(make_docs):
    rng = random.Random(4)
    notice = "this text may be used under the terms of the licence of the site " * 4  # 56 words, under 400 bytes
    rows = [(i, f"{body(rng, 80)}\n{notice}", "a") for i in range(30)] + [(50, f"{notice}\n{body(rng, 5)}", "a")]
    got = {r["doc_id"]: r for r in quality.quality_rules(make_docs(rows), max_repeat_pct=100).collect()}
    assert all(got[i]["kept"] and got[i]["removed_words"] == 56 for i in range(30)) and not got[50]["kept"]
    texts = [r["text"] for r in quality.apply_quality(make_docs(rows), max_repeat_pct=100).collect()]
    assert len(texts) == 30 and not any("licence" in t for t in texts)


def test_copies_are_one_document(make_docs):
    text = "\n".join(f"line {i} of a text that was copied many times over" for i in range(9))
    rows = [(i, text, "a") for i in range(40)]
    assert all(r["kept"] and r["removed_words"] == 0 for r in quality.quality_rules(make_docs(rows), max_repeat_pct=100).collect())


def test_applied_rules_drop_rejects_and_lines(make_docs):
    rng = random.Random(3)
    bodies = [body(rng) for _ in range(20)]
    rows = [(i, f"Footer  LINE 1 of site\n{b}\nfooter line 2 of site", "a") for i, b in enumerate(bodies)]
    rows += [(50, "too short", "a"), (51, None, "a"), (0, rows[0][1], "a"), (0, "other text " + body(rng), "a")]
    out = quality.apply_quality(make_docs(rows, extra=True))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = sorted((r["doc_id"], r["text"], r["n_chars"]) for r in out.collect())
    want = [(i, b) for i, b in enumerate(bodies)] + [(0, bodies[0]), (0, rows[-1][1])]
    assert got == sorted((i, t, len(t)) for i, t in want)


def test_empty_table(make_docs):
    assert quality.quality_rules(make_docs([])).count() == 0 and quality.apply_quality(make_docs([])).count() == 0


def test_all_columns_null(llm, make_docs):
    df = make_docs([(1, "x")]).selectExpr(*[f"CAST(NULL AS {t}) AS {c}" for c, t in
                                            (("doc_id", "long"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "long"))])
    (r,) = quality.quality_rules(df).collect()
    assert (r["doc_id"], r["n_words"], r["base_failed"], r["kept"]) == (None, 0, True, False)
