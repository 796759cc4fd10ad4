import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from userflow.llm import lengths, packing, tokens
from userflow.llm.tables import stored

VOCABULARY = tokens.public()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY.file)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_ids_are_the_librarys(text):
    whole = Tokenizer.from_file(VOCABULARY.file) if not hasattr(test_ids_are_the_librarys, "t") else test_ids_are_the_librarys.t
    test_ids_are_the_librarys.t = whole
    for case in (text, text + "<|endoftext|>", " \n" + text + "  x"):
        assert tokens.encoder(VOCABULARY).ids(case).tolist() == whole.encode(case, add_special_tokens=False).ids


def test_every_id_lies_in_one_piece(documents, library):
    draw = random.Random(2)
    rows = [(i, " ".join(draw.choice(["tion", "Straße", "é", "cat", "\n\n"]) for _ in range(draw.choice([0, 5, 300, 900, 3000])))) for i in range(150)]
    rows += [(200, None), (201, ""), (None, "x"), (202, "<|endoftext|> a"), (203, "z " * 30_000), (0, rows[0][1])]
    pieces = stored(packing.pack(documents(rows).repartition(3), VOCABULARY), "test-pieces")
    grouped = packing.with_step_groups(pieces, step_ids=8192)
    assert grouped.columns == [*(c for c in pieces.columns if c != "place"), "step_group"]
    got = grouped.collect()
    want = defaultdict(list)
    for i, text in rows:
        want[i].append([*library.encode(text or "", add_special_tokens=False).ids, 1])
    sequences, found = defaultdict(dict), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r.length > 0
        assert r.offset not in sequences[r.sequence_id]
        sequences[r.sequence_id][r.offset] = r
        found[r.doc_id].append((r.start, ids, r.doc_tokens))
    for own in sequences.values():
        at = 0
        for offset in sorted(own):
            assert offset == at
            at += own[offset].length
        assert at <= 2048 and {r.window for r in own.values()} == {at if at & (at - 1) == 0 else 2048}
    padding = sum(next(iter(own.values())).window - sum(r.length for r in own.values()) for own in sequences.values())
    assert padding <= 0.01 * sum(r.length for r in got)
    for i, texts in want.items():
        if len(texts) == 1:
            ids = [x for _, part, _ in sorted(found[i]) for x in part]
            assert ids == texts[0] and {n for *_, n in found[i]} == {len(ids)}
        else:
            assert sorted(x for _, part, _ in found[i] for x in part) == sorted(x for text in texts for x in text)
    groups = defaultdict(lambda: defaultdict(set))
    for r in got:
        groups[r.window][r.step_group].add(r.sequence_id)
    numbers = {r.step_group for r in got}
    for own in groups.values():
        held = [len(own[g]) for g in numbers]
        assert max(held) - min(held) <= 1


def test_no_documents(documents):
    pieces = stored(packing.pack(documents([]), VOCABULARY), "test-pieces")
    assert packing.with_step_groups(pieces).collect() == []


def test_crc_of_ids(documents):
    row = packing.pack(documents([(1, "a cat")]), VOCABULARY).withColumn("crc", F.crc32("ids")).collect()
    assert all(r.crc == zlib.crc32(r["ids"]) for r in row)


def test_length_sums(documents, library):
    draw = random.Random(1)
    texts = [None, "", *(" ".join(["cat"] * draw.choice([1, 4, 40, 3000])) for _ in range(40))]
    sizes = np.array([len(library.encode(t or "", add_special_tokens=False).ids) for t in texts])
    sums = lengths.with_suffix_sums(lengths.histogram(documents(list(enumerate(texts))), VOCABULARY))
    rows = sums.collect()
    assert sorted(r.length for r in rows) == sorted(set(sizes.tolist()))
    for r in rows:
        assert r.n_docs == (sizes == r.length).sum() and r.docs_at_least == (sizes >= r.length).sum()
        assert r.tokens_at_least == sizes[sizes >= r.length].sum() and r.truncated_tokens == np.minimum(sizes, r.length).sum()
        assert r.share_up_to == pytest.approx((sizes <= r.length).mean())
    for limit in (0, 3, 17, 10**6):
        one = lengths.truncated_total(sums, limit).first()
        assert (one.tokens, one.docs_cut) == (np.minimum(sizes, limit).sum(), (sizes > limit).sum())
    assert lengths.quantile(sums, 0.5).first()[0] == np.sort(sizes)[-(-len(sizes) // 2) - 1]
    none = lengths.with_suffix_sums(lengths.histogram(documents([]), VOCABULARY))
    assert none.collect() == [] and lengths.truncated_total(none, 5).first().tokens is None
