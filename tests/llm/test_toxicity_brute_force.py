"""Toxicity's likelihood, gradient and scores against plainly written noisy-or formulas; ties and repeated rows."""
import math
import random

import numpy as np
import pandas as pd

from hourcast.llm import toxicity


def bags(r, n, size):
    """(toxic, sentences, word lists of those with words)"""
    out = []
    for _ in range(n):
        own = [sorted(r.sample(range(size), r.randint(1, 4))) for _ in range(r.randint(0, 4))]
        out.append((r.randint(0, 1), len(own) + r.randint(0 if own else 1, 2), own))
    return out


def frame(rows):
    ends = [list(np.cumsum([len(s) for s in own]).astype(int)) for _, _, own in rows]
    return pd.DataFrame({"toxic": [t for t, _, _ in rows], "sentences": [n for _, n, _ in rows], "ends": ends, "words": [[w for s in own for w in s] for _, _, own in rows]})


def likelihood(weights, rows):
    """Sum of log P(label): a document is clean if none of its sentences offends."""
    total = 0.0
    for toxic, n, own in rows:
        clean = 1.0
        for words in [*own, *[[]] * (n - len(own))]:
            clean *= 1 - 1 / (1 + math.exp(-(weights[-1] + sum(weights[w] for w in words))))
        total += math.log(1 - clean) if toxic else math.log(clean)
    return total


def test_gradient_against_finite_differences():
    r = random.Random(1)
    rows = bags(r, 40, 6)
    weights = np.array([r.uniform(-1, 2) for _ in range(6)] + [-1.5])
    got = next(toxicity._gradients(weights)(iter([frame(rows[:15]), frame(rows[15:])])))
    assert got["rows"][0] == 40 and np.isclose(got["loss"][0], likelihood(weights, rows))
    for i in range(7):
        step = np.zeros(7)
        step[i] = 1e-5
        slope = (likelihood(weights + step, rows) - likelihood(weights - step, rows)) / 2e-5
        assert np.isclose(got["grad"][0][i], slope, rtol=1e-4, atol=1e-5)


def test_scores_against_a_direct_product():
    r = random.Random(2)
    weights = {w: r.uniform(0.1, 3) for w in ("vile", "^vile", "rotten", "^rott", "^rotte", "ugly")}
    words = ["vile", "vilest", "rotten", "rotter", "ugly", "ug", "nice", "day", "Vile", "UGLY", "x1y"]
    score = toxicity.Scorer(weights, -3.0, 0.5)
    for _ in range(200):
        text = "".join(r.choice([" ", " ", " ", ". ", "!", "?\n", "\n\n"]) + r.choice(words) for _ in range(r.randint(0, 30)))
        clean, offending = 1.0, []
        for start, end, found in toxicity.sentence_words(text):
            hits = {x for w in found for x in toxicity.features(w) if x in weights}
            p = 1 / (1 + math.exp(3.0 - sum(weights[x] for x in hits)))
            clean *= 1 - p
            if p >= 0.5:
                offending.append((start, end))
        got, spans = score(text)
        assert math.isclose(got, 1 - clean, abs_tol=1e-12) and [(s["start"], s["end"]) for s in spans] == offending


def test_fit_does_not_lose_likelihood_and_ignores_repeats_and_columns(spark):
    r = random.Random(3)
    neutral, bad = ["tree", "river", "stone", "cloud"], ["vile", "rotten"]
    texts = [". ".join(" ".join([*r.sample(neutral, 3), *([r.choice(bad)] if t and s == 1 else [])]) for s in range(3)) for t in [i % 2 for i in range(80)]]
    rows = [(i, t, "z", i) for i, t in enumerate(texts)] + [(3, texts[3], "z", 3)] * 2 + [(None, None, None, None), (900, "", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic string, score long")  # columns of the same names as results
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(80)], "doc_id long, quality int, toxic int")
    fits = [toxicity.fit(docs, labels, steps=s) for s in (1, 40)]
    sample = [(i % 2, texts[i]) for i in range(80)]

    def loss(model):
        total, score = 0.0, toxicity.Scorer(model.weights, model.bias, 0.5)
        for toxic, text in sample:
            p = min(max(score(text)[0], 1e-12), 1 - 1e-12)
            total += math.log(p if toxic else 1 - p)
        return total

    assert loss(fits[1]) > loss(fits[0])
    assert fits[1].weights == toxicity.fit(docs, labels, steps=40).weights  # reruns agree
    got = toxicity.score_documents(docs, fits[1]).collect()
    assert len(got) == len(rows) and {r.predicted for r in got if r.doc_id == 3} == {1}
    assert [r.score for r in got if r.doc_id in (None, 900)] == [0.0, 0.0]
    assert toxicity.keep_clean(docs, fits[1]).columns == docs.columns
    assert toxicity.score_documents(docs.limit(0), fits[1]).collect() == []
