import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from userflow.llm import bloom, decontaminate, words

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def found(text):
    return ALNUM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def expected(rows, items, window):
    windows = {}
    for item, text in items:
        own = found(text)
        n = min(window, len(own))
        for i in range(len(own) - n + 1 if own else 0):
            windows.setdefault(tuple(own[i : i + n]), set()).add(item)
    out = []
    for doc, text in rows:
        own, hit, named = found(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(own) - n + 1):
                if (w := tuple(own[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    named |= windows[w]
        bad = bool(hit) and 20 * len(hit) >= len(own)
        out.append((doc, len(own), len(hit), sorted(x for x in named if x is not None), bad))
    return sorted(out, key=str)


def judged(docs, benchmark, **options):
    rows = decontaminate.judged(decontaminate.matches(docs, benchmark, **options)).collect()
    for r in rows:
        assert r.n_items == len(r["items"]) and all(a.past < b.first for a, b in zip(r.spans, r.spans[1:], strict=False))
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in rows), key=str)


@pytest.fixture
def cases(spark, documents):
    draw = random.Random(3)

    def prose(n):
        return " ".join(draw.choice(["ab", "Cd", "é", "x1", "the"]) + draw.choice([" ", ", ", "\n"]) for _ in range(n))

    items = [(i, prose(draw.choice([5, 13, 40]))) for i in range(8)]
    items += [(20, None), (21, ""), (None, prose(15)), (3, items[0][1]), (30, items[2][1])]
    rows = [(i, prose(draw.choice([0, 3, 60, 400]))) for i in range(30)]
    rows += [(100 + i, prose(20) + " " + (items[i % 8][1] or "") + " . " + prose(30)) for i in range(20)]
    rows += [(200, None), (201, ""), (202, "..."), (None, items[1][1]), (203, items[1][1]), (203, items[1][1])]
    rows += [(204, prose(20_000) + items[1][1] + prose(300))]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, spans string")
    return documents(rows), rows, benchmark, items


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 100])
def test_hits_against_all_windows(cases, block_bytes):
    docs, rows, benchmark, items = cases
    assert judged(docs, benchmark, window=6, block_bytes=block_bytes) == expected(rows, items, 6)


def test_contaminated_documents_go(cases):
    docs, rows, benchmark, items = cases
    want = [r[0] for r in expected(rows, items, 13) if not r[4]]
    left = decontaminate.decontaminate(docs, benchmark)
    assert len(want) < len(rows) and left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(map(str, want))


@pytest.mark.parametrize("few", [bloom.FEW_IDS, 0])
def test_documents_go_alike_with_any_number_of_blocks(cases, documents, few, monkeypatch):
    monkeypatch.setattr(bloom, "FEW_IDS", few)
    _, rows, benchmark, items = cases
    rows = [*rows, (203, "a clean text"), (None, "another"), (None, None), (None, rows[-1][1])]
    want = [r[0] for r in expected(rows, items, 13) if not r[4]]
    left = decontaminate.decontaminate(documents(rows), benchmark, block_bytes=100)
    assert None in want and 203 in want and left.columns == documents(rows).columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(map(str, want))


def test_blocks_hold_a_text_of_many_items_once(spark, documents):
    long = " ".join(f"w{i}" for i in range(200))
    items = [(i, long) for i in range(400)] + [(None, long), (400, None), (401, "")] + [(500 + i, f"short text {i}") for i in range(200)]
    benchmark = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    known = decontaminate.benchmark_of(benchmark, 13, 900)
    sizes = known.texts.groupBy("block").agg(F.sum(F.octet_length("text")).alias("n")).collect()
    assert known.texts.count() == 202 and sum(r.n for r in sizes) == sum(len(t or "") for t in {t for _, t in items})
    assert max(r.n for r in sizes) <= 900 + len(long) and known.n == max(r.block for r in sizes) + 1 > 3
    docs = documents([(1, "a " + long), (2, "short text 7"), (3, "none")])
    got = judged(docs, benchmark, block_bytes=900)
    assert [(r[0], len(r[3])) for r in got] == [(1, 400), (2, 1), (3, 0)]
    assert got == judged(docs, benchmark)


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 40])
def test_many_rows_of_one_text_are_judged_alike(spark, block_bytes):
    text = " ".join(f"w{i}" for i in range(40))
    benchmark = spark.createDataFrame([(1, text), (2, "other words here"), (3, "w3 w4 w5")], "item_id long, text string")
    docs = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("x " + text).alias("text"))
    found = decontaminate.judged(decontaminate.matches(docs, benchmark, block_bytes=block_bytes))
    assert found.groupBy("doc_id", "n_words", "n_hit", "n_items", "contaminated").count().collect()[0][:] == (None, 41, 40, 2, True, 20_000)


def test_empty_tables(spark, documents):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert judged(documents([(1, "a b"), (2, None)]), benchmark) == [(1, 2, 0, [], False), (2, 0, 0, [], False)]
    assert judged(documents([]), some) == []
    assert decontaminate.decontaminate(documents([]), some).count() == 0
    assert decontaminate.decontaminate(documents([(1, "a b")]), benchmark).count() == 1
    assert decontaminate.longest_matches(documents([(1, "a")]), benchmark).collect() == []


def test_longest_matches(spark, documents):
    item = " ".join(f"w{i}" for i in range(30))
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    docs = documents([(1, "x " + " ".join(f"w{i}" for i in range(3, 20))), (2, " ".join(f"w{i}" for i in range(5, 30)))])
    got = {r.item_word: (r.item_id, r.length, r.doc_id, r.word) for r in decontaminate.longest_matches(docs, benchmark).collect()}
    assert got[3] == (7, 17, 1, 1) and got[5] == (7, 25, 2, 0) and set(got) == {3, 4, *range(5, 18)}


def test_suffix_array_orders_suffixes():
    text = np.array(random.Random(1).choices(range(4), k=300))
    order = decontaminate.suffix_array(text, 300)
    suffixes = [text[i:].tolist() for i in order]
    assert suffixes == sorted(suffixes) and sorted(order) == list(range(300))
    assert len(decontaminate.suffix_array(np.empty(0, np.int64), 5)) == 0
    assert words.SLICE_BYTES > 0
