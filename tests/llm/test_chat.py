import hashlib
import random

import pytest
from pyspark.sql import functions as F

from userflow.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, part int, loss int, formatted string, last boolean"
NASTY = ["\\", "\\\\", "</turn>", "</turn>\n", "<\\/turn>", "### Assistant: ", "### User", "#### User: x</tur", "### ", "n>\n", ": ", "É😀", "\n", "", " ok", "### Role a: b"]


def made(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "f", True) for r in rows], SCHEMA)


def key(v):
    return (v is not None, v if v is not None else 0)


def in_order(rows):
    rows = [(c, t, r or "", x or "") for c, t, r, x in rows]
    return sorted(rows, key=lambda r: (key(r[0]), key(r[1]), r[2].encode(), r[3].encode()))


def by_conversation(rows):
    out = {}
    for c, _, role, text in in_order(rows):
        out.setdefault(c, []).append((role, text))
    return out


def violation(roles):
    follows = {"": {"system", "user"}, "system": {"user"}, "user": {"assistant"}, "assistant": {"user"}}
    state = ""
    for i, role in enumerate(roles):
        if role not in follows.get(state, ()):
            return i
        state = role
    return None if state == "assistant" else len(roles)


@pytest.fixture(scope="module")
def odd():
    draw = random.Random(3)
    rows = []
    for c in range(40):
        for t in range(draw.randrange(1, 9)):
            text = "".join(draw.choices(NASTY, k=draw.randrange(6)))
            role = draw.choice(["user", "assistant", "system"]) if c % 3 else ["user", "assistant"][t % 2]
            rows.append((c, t, role, draw.choice([text, text, None])))
    rows += [(90, 1, "tool: x", "a"), (90, 1, "tool: x", "a"), (90, 2, None, ":"), (90, None, "User", "b"), (90, 1, "tool:", "\\")]
    rows += [(None, 0, "user", "c"), (None, 1, "assistant", "d"), (91, 0, "</turn>\n### User: ", "e"), (92, 0, "user", "x" * 300_000)]
    return rows


@pytest.mark.parametrize("part_chars", [chat.PART_CHARS, 1])
def test_turns_come_back(spark, odd, part_chars):
    parts = chat.formatted(made(spark, odd), part_chars=part_chars)
    want = by_conversation(odd)
    got = {}
    for r in sorted(chat.read(parts).collect(), key=lambda r: r.turn):
        assert r.loss == (r.role == "assistant")
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == want
    assert parts.where("turns > 1").isEmpty() == (part_chars == 1)


def test_digests(spark, odd):
    got = {r.conv_id: r for r in chat.round_trip(made(spark, odd)).collect()}
    want = by_conversation(odd)
    assert set(got) == set(want)
    for c, turns in want.items():
        learnt = "".join(x for r, x in turns if r == "assistant")
        r = got[c]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(learnt))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()
        assert r.first_violation == violation([a for a, _ in turns])
    assert any(r.first_violation is None for r in got.values()) and any(r.first_violation == 0 for r in got.values())


def test_segments_are_the_parts(spark, odd):
    parts = chat.formatted(made(spark, odd))
    pieces = {}
    for r in sorted(chat.segments(parts).collect(), key=lambda r: r.segment):
        pieces.setdefault(r.conv_id, []).append((r.text, r.loss))
    codec = chat.Codec(chat.Template())
    turns = by_conversation(odd)
    for r in parts.collect():
        own = pieces[r.conv_id]
        assert "".join(text for text, _ in own) == r.formatted
        assert [text for text, loss in own if loss] == [codec.escaped(x) for role, x in turns[r.conv_id] if role == "assistant"]


def test_no_text_holds_a_control_string():
    template = chat.Template()
    codec, draw = chat.Codec(template), random.Random(1)
    for _ in range(3000):
        text = "".join(draw.choices([*NASTY, *"#</turn> User:\\"], k=draw.randrange(9)))
        inside = codec.escaped(text)
        assert codec.unescaped(inside) == text and not any(c in inside for c in template.controls())


def test_another_template(spark):
    template = chat.Template(names={"human": "H", "bot": "B"}, open="aa", named="|>", other="?", close="aab", end="", learnt=frozenset({"bot"}),
                             follows={chat.START: frozenset({"bot"})}, final=frozenset({"bot"}))
    rows = [(1, 0, "human", "aaaaab|>aaH|>aaaB|>"), (1, 1, "x|>|", "aaaa"), (2, 0, "bot", "a")]
    parts = chat.formatted(made(spark, rows), template)
    got = {(r.conv_id, r.turn): (r.role, r.text, r.loss) for r in chat.read(parts, template).collect()}
    assert got == {(c, t): (r, x, r == "bot") for c, t, r, x in rows}
    assert {r.conv_id: r.first_violation for r in parts.collect()} == {1: 0, 2: None}


@pytest.mark.parametrize("wrong", [{"close": "aba"}, {"open": ""}, {"named": ":"}, {"close": "\\"}, {"names": {"a": "X", "b": "X"}}, {"names": {"a": "Role a"}}])
def test_templates_that_cannot_be_read_are_refused(wrong):
    with pytest.raises(ValueError):
        chat.Template(**{"end": "", **wrong})


def test_no_rows(spark):
    empty = made(spark, [])
    assert chat.round_trip(empty).collect() == [] and chat.read(chat.formatted(empty)).collect() == []
    assert chat.segments(chat.formatted(empty)).collect() == []


def test_one_long_conversation_is_cut_in_parts(spark):
    rows = spark.range(30_000).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.repeat(F.lit("word "), 20).alias("text"),
    )
    parts = chat.formatted(rows, part_chars=10_000)
    assert parts.count() > 300 and parts.agg(F.max(F.char_length("formatted"))).first()[0] < 10_200
    got = chat.digests(parts).first()
    assert (got.n_turns, got.loss_chars, got.first_violation) == (30_000, 1_500_000, None)
