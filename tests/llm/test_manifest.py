import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from userflow.llm import manifest, tables

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, path int, `row` int, __node string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """All levels, from the nodes up."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
    return levels


def steps(levels, at):
    """(sibling or None, whether it stands left) up to the top."""
    for level in levels[:-1]:
        other = at ^ 1
        yield (level[other] if other < len(level) else None), other < at
        at //= 2


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([leaf(r) for r in sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))]) for g, own in groups.items()}
    top = tree([trees[g][-1][0] for g in order])
    out = []
    for place, g in enumerate(order):
        for at, row in enumerate(sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))):
            path = [*steps(trees[g], at), *steps(top, place)]
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None
            node = leaf((*row[:3], row[3] + 1, *row[4:])) if tampered else leaf(row)
            for sibling, left in path:
                node = digest(node if sibling is None else sibling + node if left else node + sibling)
            root = top[-1][0]
            out.append((row[0], leaf(row), trees[g][-1][0], root, digest("".join(s or "" for s, _ in path)), node, node == root))
    return out


def found(spark, rows, **how):
    docs = spark.createDataFrame([(*r, "x", 1, 2, "n") for r in rows], SCHEMA)
    out = manifest.manifest(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, **how)
    return [(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in out.collect()]


def ordered(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("height", [1, 2, manifest.HEIGHT])
def test_against_a_plain_tree(spark, height):
    draw = random.Random(height)
    rows = [(i, "s", draw.choice(["en", "en", "en", "de", "É", "z", None, ""]), draw.choice([None, 3, i]), f"text {i}") for i in range(75)]
    rows += [rows[5], rows[5], rows[5], (7, "s", "en", 1, "another"), (None, None, None, None, None), (None, "s", "en", 2, ""), (-3, "s", "one", 9, "É\n")]
    want = expected(rows)
    assert ordered(found(spark, rows, height=height)) == ordered(want)
    assert {r[-1] for r in want} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9])
def test_small_trees(spark, n):
    rows = [(i, None, "en", 1 << 62, "t") for i in range(n)]
    assert ordered(found(spark, rows, height=2)) == ordered(expected(rows))


def test_no_rows(spark):
    assert found(spark, []) == []


def test_a_group_of_most_rows_is_dealt_out(spark, monkeypatch):
    rows = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit("same").alias("text"))
    rows = rows.withColumns({"source": F.lit(None).cast("string"), "n_chars": F.lit(1).cast("long")}).repartition(4)
    out = manifest.manifest(rows, height=10)
    assert out.where("verified").count() == 40_000 and out.select("root").distinct().count() == 1
    written = []
    monkeypatch.setattr(manifest, "stored", lambda *a: written.append(tables.stored(*a)) or written[-1])
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, False)
    held = manifest.numbered(rows, "lang", ["doc_id"])
    spark.conf.unset(coalesce)
    assert written[0].select(F.shiftright("__at", 33)).distinct().count() > 1
    assert held.where("__position = doc_id and __n = 40000").count() == 40_000


def test_witnesses_extend_as_siblings_are_complete():
    frontier, nodes = manifest.Frontier(), [bytes([i]) * 32 for i in range(6)]
    sizes = []
    for node in nodes:
        frontier.append(node)
        sizes.append([len(w) for w in frontier.witnesses])
    assert sizes[2] == [1, 1, 0] and sizes[3] == [2, 2, 2, 2] and sizes[5] == [2, 2, 2, 2, 1, 1]
    root = frontier.close(3)
    assert root.hex() == tree([n.hex() for n in nodes])[-1][0] and [len(w) for w in frontier.witnesses] == [3] * 6
