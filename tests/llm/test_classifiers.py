import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from userflow.llm import quality, toxicity

LABELS = "doc_id long, toxic int, quality int, text string"


def prose(draw, n=40):
    return " ".join(draw.choice(["sun", "moon", "river", "stone", "garden", "letter", "window", "road"]) for _ in range(n))


@pytest.fixture(scope="module")
def cases():
    draw = random.Random(4)
    rows, labels = [], []
    for i in range(240):
        text, toxic = prose(draw), i % 4 == 0
        if toxic:
            text += draw.choice([" women", "", ""]) + " idiot scum"
        elif i % 7 == 0:
            text += " muslims"
        poor = i % 5 == 0
        rows.append((i, "!! ".join(text.upper().split()) if poor else text))
        labels.append((i, int(toxic), int(not poor), "t"))
    return rows, labels


ODD = [(None, "idiot scum sun"), (500, None), (501, ""), (502, " "), (503, "sun " * 40_000 + "idiot scum"), (1, "sun"), (1, "sun")]
ODD_LABELS = [(None, 1, 1, "t"), (500, 0, 1, "t"), (600, 1, 0, "t"), (3, None, None, "t"), (5, 1, 0, "t"), (5, 0, 1, "t")]


def test_toxic_texts_go_and_neutral_mentions_stay(spark, documents, cases):
    rows, labels = cases
    docs, known = documents(rows + ODD), spark.createDataFrame(labels + ODD_LABELS, LABELS)
    model = toxicity.fit(docs, known)
    scored = {}
    for r in docs.select("doc_id", toxicity.score("text", model).alias("s")).collect():
        scored.setdefault(r.doc_id, []).append(r.s)
    assert all(0 <= s <= 1 for own in scored.values() for s in own)
    assert all((scored[i][0] >= 0.5) == bool(toxic) for i, toxic, *_ in labels if i not in (1, 5))
    assert scored[None][0] > 0.5 and scored[503][0] > 0.5 and scored[500] == scored[501] == scored[502]
    left = toxicity.drop_toxic(docs, known)
    assert left.columns == docs.columns and left.where("doc_id = 1").count() == 3
    fair = spark.createDataFrame([(t,) for t in toxicity.IDENTITY_TERMS], "t string")
    named = fair.select(toxicity.score(F.concat(F.lit("the garden of the "), "t"), model).alias("s")).collect()
    plain = spark.range(1).select(toxicity.score(F.lit("the garden of the "), model).alias("s")).first().s
    assert max(abs(r.s - plain) for r in named) < 0.1


def test_poor_texts_go(spark, documents, cases):
    rows, labels = cases
    docs, known = documents(rows + ODD), spark.createDataFrame(labels + ODD_LABELS, LABELS)
    model = quality.fit(docs, known, F.col("doc_id") % 2 == 0)
    scored = {r.doc_id: r.s for r in docs.select("doc_id", quality.score("text", model).alias("s")).collect()}
    assert all(0 <= s <= 1 for s in scored.values())
    right = [(scored[i] >= 0.5) == bool(good) for i, _, good, _ in labels if i not in (1, 5)]
    assert sum(right) / len(right) > 0.97
    left = quality.drop_poor(docs, known)
    assert left.columns == docs.columns and left.count() < docs.count()


@pytest.mark.parametrize("labels", [[], [(1, 0, 1, "t")], [(1, None, None, "t")]])
def test_labels_of_one_kind_drop_nothing(spark, documents, labels):
    docs, known = documents([(1, "a"), (2, None)]), spark.createDataFrame(labels, LABELS)
    assert toxicity.drop_toxic(docs, known).count() == 2
    assert quality.drop_poor(docs, known).count() == 2
    assert toxicity.drop_toxic(documents([]), known).count() == quality.drop_poor(documents([]), known).count() == 0


def test_learning_is_bounded_and_repeatable(spark, documents, cases):
    rows, labels = cases
    docs, known = documents(rows), spark.createDataFrame(labels, LABELS)
    first, second = (toxicity.fit(docs.repartition(n), known, rows=100) for n in (1, 5))
    assert first.bias == second.bias and (first.weights == second.weights).all()


def test_few_toxic_labels_are_all_learnt_from(spark, documents):
    rows = [(i, f"a remark {i % 7}" + " of vile scum" * (i < 12)) for i in range(600)]
    known = spark.createDataFrame([(i, int(i < 12)) for i, _ in rows], "doc_id long, toxic int")
    docs = documents(rows)
    model = toxicity.fit(docs, known, rows=60)
    scores = {r.doc_id: r.s for r in docs.select("doc_id", toxicity.score("text", model).alias("s")).collect()}
    assert min(scores[i] for i in range(12)) > 0.5 > max(scores[i] for i in range(12, 600))


SUN = ["sun", "moon", "river", "stone", "garden", "letter", "window", "road", "market", "winter", "paper", "music"]
INSULTS = ["idiot", "scum", "vermin", "filth", "trash", "moron"]


def biased(n, seed):
    """Texts whose toxic half names groups often, and the clean half seldom."""
    draw, texts, toxic = random.Random(seed), [], []
    for i in range(n):
        own = [draw.choice(SUN) for _ in range(30)]
        if i % 2 == 0:
            own.insert(draw.randrange(30), draw.choice(INSULTS))
            if draw.random() < 0.8:
                own.insert(draw.randrange(30), draw.choice(["women", "muslims", "immigrants"]))
            if draw.random() < 0.4:
                own.insert(draw.randrange(30), draw.choice(["gay", "black"]))
        elif draw.random() < 0.05:
            own.insert(draw.randrange(30), draw.choice(["women", "muslims"]))
        texts.append(" ".join(own))
        toxic.append(1 - i % 2)
    return texts, toxic


def mentions(words, seed=2):
    draw = random.Random(seed)
    return [" ".join([draw.choice(SUN) for _ in range(30)] + [w]) for w in words for _ in range(20)]


def test_the_penalty_keeps_neutral_mentions_clean(spark, documents):
    texts, toxic = biased(600, 1)
    docs = documents(list(enumerate(texts)))
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    neutral = documents(list(enumerate(mentions(["women", "muslims", "immigrants", "gay", "black", "jews", "latino"]))))
    insulting = documents(list(enumerate(mentions(INSULTS))))

    def flagged(model, rows):
        return rows.where(toxicity.score("text", model) >= 0.5).count() / rows.count()

    plain, fair = toxicity.fit(docs, labels, fairness=0.0), toxicity.fit(docs, labels)
    assert flagged(plain, neutral) > 0.1  # what the penalty is for
    assert flagged(fair, neutral) == 0 and flagged(fair, insulting) == 1


def test_all_named_terms_are_swapped():
    texts = ["the women and the muslims meet gay men", "no group at all"]
    numbers = [np.frombuffer(x, "<i4") for x in toxicity._feature_lists(pa.array(texts)).to_pylist()]
    row, feature, sign = toxicity._counterfactuals(numbers)
    terms = {t: set(np.frombuffer(x, "<i4").tolist()) for t, x in zip(toxicity.IDENTITY_TERMS, toxicity._feature_lists(pa.array(toxicity.IDENTITY_TERMS)).to_pylist(), strict=True)}
    gone = set(feature[(row == 0) & (sign < 0)].tolist())
    come = set(feature[(row == 0) & (sign > 0)].tolist())
    for term in ("women", "muslims", "gay", "men"):
        # What is not also a part of another term's replacement goes.
        assert max(terms[term]) in gone | come or terms[term] & gone
    assert sum(own <= come | set(numbers[0].tolist()) for own in terms.values()) >= 8  # four named, four put in their place
    assert not (row[sign < 0] == 1).any() and (row[sign > 0] == 1).any()


def test_toxicity_decides_as_a_dense_fit(spark, documents):
    texts, toxic = biased(400, 5)
    others, _ = biased(300, 6)
    docs = documents(list(enumerate(texts)))
    model = toxicity.fit(docs, spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int"))
    got = np.array(toxicity._scores(pa.array(others), model))

    # The loss with its penalties, minimised by plain gradient steps over a dense matrix of words.
    known = sorted({w for t in texts for w in t.split()} | set(toxicity.IDENTITY_TERMS))

    def dense(some):
        return np.array([[w in t.split() for w in known] for t in some], float)

    x, y = dense(texts), np.array(toxic, float)
    named = np.array([w in toxicity.IDENTITY_TERMS for w in known])
    swapped = np.where(named, -x, 0.0)
    swapped[:, known.index("jews")] += 1
    w, b = np.zeros(len(known)), 0.0
    for _ in range(3000):
        error = (1 / (1 + np.exp(-(x @ w + b))) - y) / len(y)
        w -= 1.0 * (x.T @ error + swapped.T @ (swapped @ w) / len(y))
        w = np.sign(w) * np.maximum(np.abs(w) - 1e-3, 0)
        b -= 1.0 * error.sum()
    want = 1 / (1 + np.exp(-(dense(others) @ w + b)))
    assert ((got >= 0.5) == (want >= 0.5)).mean() > 0.98


def test_quality_decides_as_a_dense_fit(spark, documents, cases):
    rows, labels = cases
    model = quality.fit(documents(rows), spark.createDataFrame(labels, LABELS))
    shapes = quality._shapes(pa.array([t for _, t in rows]))
    good = np.array([q for _, _, q, _ in labels])
    x = quality._expanded(shapes, model.centre, model.spread)
    # All pairs, and plain gradient steps.
    apart = (x[good == 1][:, None, :] - x[good == 0][None, :, :]).reshape(-1, x.shape[1])
    w = np.zeros(x.shape[1])
    for _ in range(400):
        wrong = 1 / (1 + np.exp(np.clip(apart @ w, -30, 30)))
        w += 0.05 * ((apart * wrong[:, None]).mean(axis=0) - quality.SHRINK * w)
    want = x @ w >= np.quantile(x @ w, (good == 0).mean(), method="midpoint")
    got = x @ model.weights >= model.cut
    assert (got == want).mean() > 0.98


def test_long_texts_are_left_out_of_learning_first(spark):
    rows = [(i, "x" * (100_000 if i < 4 else 100), i % 2) for i in range(40)]
    taken = spark.createDataFrame(rows, "doc_id long, text string, label int")
    assert toxicity.labelled.within(taken, 1 << 20).count() == 40
    kept = {r.doc_id for r in toxicity.labelled.within(taken, 220_000).collect()}
    assert kept >= set(range(4, 40)) and len(kept) == 38
    assert toxicity.labelled.within(taken.where("false"), 10).count() == 0


def test_quality_learns_from_every_label(spark, documents, monkeypatch):
    draw = random.Random(8)
    rows = [(i, "!! ".join(prose(draw).upper().split()) if i % 3 == 0 else prose(draw, draw.randrange(5, 60))) for i in range(600)]
    labels = [(i, int(i % 3 != 0 and (i + i // 7) % 11 != 0)) for i, _ in rows]
    docs, known = documents(rows), spark.createDataFrame(labels, "doc_id long, quality int")
    shapes, good = quality._shapes(pa.array([t for _, t in rows])), np.array([q for _, q in labels])
    for block in (8192, 50):  # one block of all, and many
        monkeypatch.setattr(quality, "BLOCK", block)
        model = quality.fit(docs, known)
        assert np.allclose(model.centre, shapes.mean(axis=0)) and np.allclose(model.spread, shapes.std(axis=0) + 1e-9)
        x = quality._expanded(shapes, model.centre, model.spread)
        # The slope of the loss over all pairs ends there.
        apart = (x[good == 1][:, None, :] - x[good == 0][None, :, :]).reshape(-1, x.shape[1])
        wrong = 1 / (1 + np.exp(apart @ model.weights))
        assert np.abs(-(apart * wrong[:, None]).mean(axis=0) + quality.SHRINK * model.weights).max() < 1e-4
        assert np.isclose(model.cut, np.quantile(x @ model.weights, (good == 0).mean(), method="midpoint"))


def test_toxicity_learns_from_every_label(spark, documents, monkeypatch):
    texts, toxic = biased(400, 9)
    docs, known = documents(list(enumerate(texts))), spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    ends, solved = [], toxicity._solved
    monkeypatch.setattr(toxicity, "_solved", lambda *a: ends.append(solved(*a)) or ends[-1])
    monkeypatch.setattr(toxicity, "ROUNDS", 5)
    model = toxicity.fit(docs, known, fairness=0.0)
    bias, weights = ends[-1][0], ends[-1][1:][ends[-1][1:] != 0]
    # Over all texts and all their features, no slope is beyond the penalty there.
    lists = [set(np.frombuffer(x, "<i4").tolist()) for x in toxicity._feature_lists(pa.array(texts)).to_pylist()]
    every = sorted(set().union(*lists))
    x, y = np.array([[f in own for f in every] for own in lists], float), np.array(toxic, float)
    w = np.zeros(len(every))
    w[np.searchsorted(every, model.features)] = weights
    slope = x.T @ (1 / (1 + np.exp(-bias - x @ w)) - y) / len(y)
    often = x.sum(axis=0) >= toxicity.LEAST_TEXTS
    assert np.abs(slope[often]).max() < 1.02 * toxicity.SPARSITY
    assert np.allclose(slope[w != 0], -toxicity.SPARSITY * np.sign(w[w != 0]), atol=5e-5)
    # Held on the driver or summed by tasks, in blocks of any size, the model is the same.
    monkeypatch.setattr(toxicity, "BLOCK", 50)
    here = toxicity.fit(docs, known)
    monkeypatch.setattr(toxicity, "HELD", -1)
    there = toxicity.fit(docs, known)
    assert here.bias == there.bias and np.array_equal(here.weights, there.weights)


def test_packed_features_come_back():
    lists = [np.array(x, "<i4") for x in ([], [0], [65534, 65535, 131070, 1 << 19], [(1 << 20) - 1], [5, 65540, 65541])]
    row, number = toxicity._unpacked(pa.array([toxicity._packed(x) for x in lists], pa.binary()))
    assert [number[row == i].tolist() for i in range(len(lists))] == [x.tolist() for x in lists]
