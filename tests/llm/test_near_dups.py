import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from userflow.llm import near_dups

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n):
    own = SPACED.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} or ({tuple(own)} if own else set())


def expected(rows, n, percent):
    """component by id, by comparing all pairs of texts."""
    sets = [(i, shingles(t, n)) for i, t in rows if i is not None]
    smallest = {i: i for i, _ in sets}

    def find(i):
        while smallest[i] != i:
            i = smallest[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and i != j and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                smallest[max(x, y)] = min(x, y)
    return {i: find(i) for i in smallest}


def checked(docs, rows, n=5, percent=80):
    got = near_dups.near_duplicates(docs, shingle=n, percent=percent).collect()
    want = expected(rows, n, percent)
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id])
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)
    sizes = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles) for r in got)
    assert sizes == sorted((i is None, i or 0, len(shingles(t, n))) for i, t in rows)


def test_odd_rows(documents):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [
        (5, None), (6, ""), (7, " \t\n"), (8, "one"), (9, "ONE"), (9, "one"), (10, "one two"), (3, "One  two"),
        (11, long), (2, long + " end"), (None, long), (None, None), (12, "a b c d e f g"), (12, "h i j k l m n"),
        (13, "A b c d e f g"), (14, "h i j k l m N"), (-4, "é è"), (15, "É è"),
    ]
    checked(documents(rows), rows)


def test_no_rows(documents):
    assert near_dups.near_duplicates(documents([])).collect() == []
    assert near_dups.drop_near_duplicates(documents([])).collect() == []


@pytest.mark.parametrize("n", [2, 5])
def test_groups_of_near_copies(documents, n):
    draw = random.Random(n)
    rows = []
    for _ in range(6):
        base = [f"v{draw.randrange(4000)}" for _ in range(draw.choice([30, 120]))]
        for _ in range(40):
            own = list(base)
            for _ in range(draw.randrange(9)):
                own[draw.randrange(len(own))] = f"x{draw.randrange(9)}"
            rows.append((len(rows), " ".join(own)))
    rows += [(len(rows) + k, rows[0][1]) for k in range(30)]
    checked(documents(rows), rows, n)


def test_one_of_each_group_stays(documents):
    text = "the quick brown fox jumps over the lazy dog and goes home"
    rows = [(4, text), (2, text), (2, text), (7, "else"), (7, "other"), (None, text), (None, None), (8, None)]
    left = near_dups.drop_near_duplicates(documents(rows))
    assert left.columns == documents(rows).columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in left.collect()) == [(False, 2), (False, 7), (False, 7), (False, 8), (True, 0), (True, 0)]


def survivors(rows, n=5, percent=80):
    """Rows that stay: one text (id, set) of each group of linked texts, one row of each text."""
    texts = sorted({(i, t) for i, t in rows if i is not None and shingles(t, n)})
    sets = [shingles(t, n) for _, t in texts]
    group = list(range(len(texts)))

    def find(k):
        while group[k] != k:
            k = group[k]
        return k

    for k, a in enumerate(sets):
        for j, b in enumerate(sets[:k]):
            if 100 * len(a & b) >= percent * len(a | b):
                group[max(find(j), find(k))] = min(find(j), find(k))
    groups = {}
    for k, text in enumerate(texts):
        groups.setdefault(find(k), []).append(text)
    bare = {(i, t) for i, t in rows if i is not None and not shingles(t, n)}
    return groups.values(), bare, [t for i, t in rows if i is None]


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_rows_that_share_an_id_are_judged_by_their_texts(spark, partitions):
    draw = random.Random(11)
    bases = [[f"v{draw.randrange(300)}" for _ in range(40)] for _ in range(12)]
    rows = []
    for _ in range(150):
        own = list(draw.choice(bases))
        for _ in range(draw.randrange(3)):
            own[draw.randrange(40)] = f"x{draw.randrange(5)}"
        rows.append((draw.choice([1, 2, 3, draw.randrange(60)]), draw.choice([" ", "  "]).join(own)))
    rows += [(1, "alpha beta gamma delta epsilon zeta"), (1, "one two three four five six"), (1, None), (1, ""), (1, None), (2, " "), (None, rows[0][1]), (None, None)]
    # Names that helper columns might take.
    docs = spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in rows], "doc_id long, text string, gone string, again string, key string, mark string")
    left = near_dups.drop_near_duplicates(docs.repartition(partitions, "text"))
    assert left.columns == docs.columns
    got = [(r.doc_id, r.text) for r in left.collect()]
    groups, bare, nameless = survivors(rows)
    assert sorted(t or "" for i, t in got if i is None) == sorted(t or "" for t in nameless)
    named = [r for r in got if r[0] is not None]
    assert len(set(named)) == len(named) == len(groups) + len(bare) and bare <= set(named)
    for group in groups:
        stays = [r for r in named if r in group]
        assert len(stays) == 1 and stays[0][0] == min(i for i, _ in group)


def look_alikes(n, common, own):
    """Texts of one template, none linked with another."""
    return [(i, " ".join([*(f"c{k}" for k in range(common)), *(f"u{i}w{k}" for k in range(own))])) for i in range(n)]


@pytest.mark.parametrize("wide", [0, 3])
def test_wide_buckets_lose_no_link(documents, monkeypatch, wide):
    monkeypatch.setattr(near_dups, "WIDE", wide)
    draw = random.Random(wide)
    rows = look_alikes(60, 60, 30)
    for i, text in rows[:40]:
        own = text.split()
        own[draw.randrange(len(own))] = "other"
        rows.append((100 + i, " ".join(own)))
    checked(documents(rows), rows)


def test_look_alikes_are_compared_in_proportion(documents, monkeypatch):
    across, compared = near_dups._across, []

    def counted(placed, mixed, forms, plausible):
        n = placed.groupBy("key").agg(F.count("*").alias("n"))
        compared.append(mixed.join(n, "key").agg(F.coalesce(F.sum(F.col("outside") * F.col("n")), F.lit(0))).first()[0])
        return across(placed, mixed, forms, plausible)

    monkeypatch.setattr(near_dups, "_across", counted)
    totals = {}
    for n in (200, 800):
        compared.clear()
        rows = look_alikes(n, 70, 34)  # similarity 0.5
        assert near_dups.near_duplicates(documents(rows)).where("kept").count() == n
        totals[n] = sum(compared)
    # All pairs of the buckets would be some 44,000 and 710,000.
    assert totals[800] <= 8 * max(totals[200], 100)


def test_sketches_tell_high_similarities(documents):
    base = [f"v{i}" for i in range(400)]
    rows = [(k, " ".join(base[:-k] if k else base)) for k in (0, 10, 40, 80, 120)]
    signed = near_dups.signatures(documents(rows).select("doc_id", "text"), 1, 31, near_dups.SAMPLES)
    found = {r.doc_id: r for r in signed.collect()}
    flips = {k: sum(bin((x ^ y) & (2**64 - 1)).count("1") for x, y in zip(found[0].sketch, found[k].sketch, strict=True)) for k in found}
    most = near_dups.most_flips(80, near_dups.SAMPLES)
    assert flips[0] == 0 and flips[10] < flips[80] <= most
    # The parity of the sets never shows more differences than there are.
    for k in found:
        assert sum(bin((x ^ y) & (2**64 - 1)).count("1") for x, y in zip(found[0].parity, found[k].parity, strict=True)) <= k


def test_no_pair_list_of_copies(documents):
    rows = [(i, "same words in every one of the copies") for i in range(500)]
    got = near_dups.near_duplicates(documents(rows)).agg(F.countDistinct("component_id"), F.sum(F.col("kept").cast("int"))).first()
    assert tuple(got) == (1, 1)


def test_sketches_seldom_refute_a_pair_at_the_threshold():
    draw, lost = np.random.default_rng(5), 0
    samples, bits, rows = near_dups.SAMPLES, 64 * near_dups.SKETCH_WORDS, 20_000
    for _ in range(15):
        differing = draw.binomial(samples, 0.2, rows)
        row = np.repeat(np.arange(rows), 2 * differing)
        flips = np.bincount(row * bits + draw.integers(bits, size=len(row)), minlength=rows * bits)
        lost += ((flips.reshape(rows, bits) & 1).sum(1) > near_dups.most_flips(80, samples)).sum()
    assert lost == 0
