import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from riskweave.llm import toxicity


def corpus(n, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"wor{rng.randrange(10 ** 4)}d" for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.randrange(20, 80))
        toxic = rng.random() < 0.3
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["gribble", "snorkface", "Snorkling"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


@pytest.fixture(scope="module")
def scored(llm, make_docs):
    rows, labels = corpus(800)
    rows += [(9000, ""), (9001, None), (9002, "x" * 100_000), (None, "gribble"), (5, rows[5][1])]
    lab = llm.createDataFrame([(i, t, "z") for i, t in labels] + [(1, None, "z"), (77777, 1, "z"), (None, 1, "z")],
                              "doc_id long, toxic int, text string")
    return rows, dict(labels), toxicity.score_toxicity(make_docs(rows, extra=True), lab).collect()


def test_held_out_accuracy(scored):
    _, labels, got = scored
    held = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 100
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_every_row_gets_a_score(scored):
    rows, _, got = scored
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((i is None, i or 0) for i, _ in rows)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (r["doc_id"] is not None and fold(r["doc_id"]) == 0)


def test_held_out_labels_are_never_read(llm, make_docs):
    rows, labels = corpus(300, seed=2)
    flip = [(i, 1 - t if fold(i) == 0 else t) for i, t in labels]
    run = lambda lab: sorted((r["doc_id"], r["score"]) for r in toxicity.score_toxicity(
        make_docs(rows), llm.createDataFrame(lab, "doc_id long, toxic int")).collect())
    assert run(labels) == run(flip)


@pytest.mark.parametrize("labels", [[], [(i, 0) for i in range(50)], [(1, None)]])
def test_without_both_classes_scores_are_the_base_rate(llm, make_docs, labels):
    got = toxicity.score_toxicity(make_docs(corpus(50)[0]), llm.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(got) == 50 and {r["score"] for r in got} == {0.0} and {r["predicted"] for r in got} == {0}


def test_empty_documents(llm, make_docs):
    labels = llm.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.score_toxicity(make_docs([]), labels).count() == 0


def test_features_of_obfuscated_and_near_words():
    names = {f: i for i, f in enumerate(toxicity.FEATURES)}
    lexicon = {"idiot": 4.0, "snork*": 3.0}
    texts = ["you idiot", "the 1d10t here", "an i.d.i.o.t there", "Snorkling along", "IDIOT!", "", None, "your " + "x " * 20 + "idiot", "idioooot no"]
    x = toxicity.features(pa.array(texts), lexicon)
    get = lambda f: x[:, names[f]]
    assert x.shape == (len(texts), len(names)) and np.isfinite(x).all()
    assert (get("near_second") > 0).tolist() == [True] + [False] * 8
    assert (get("hidden_hits") > 0).tolist() == [False, True, False, False, False, False, False, False, False]
    assert (get("max_weight") > 0).tolist() == [True, True, True, True, True, False, False, True, False]
    assert get("shouted")[4] == 1 and get("stem_density")[3] == 0.5
