import json
import random
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from userflow.functions.json_text import json_text, number_text, respaced
from userflow.sources import topic

STRINGS = ["", "plain ~ text", 'a "quoted" one', "back\\slash/", "tab\tnl\ncr\rbs\bff\f", "é ü 中文", "😀𝒳", "\x00\x01\x1f\x7f", " ﻿￿", "{}[],: 1.5e3 null"]


def doubles(n):
    draw = random.Random(n)
    out = [0.0, -0.0, 1.0, 1e-5, 1e-4, 1e15, 1e16, 1e22, 1e23, 0.1 + 0.2, 5e-324, 1e-323, 1.7976931348623157e308, 9007199254740993.0, -2.5, 1e7, 4.35, 2e-3]
    for _ in range(n):
        out += [struct.unpack("d", draw.randbytes(8))[0], draw.uniform(-180, 180), round(draw.uniform(-180, 180), draw.randrange(8))]
    return out


def test_doubles_as_python_writes_them(spark):
    values = doubles(3000) + [float("nan"), float("inf"), float("-inf")]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", number_text(F.col("v")).alias("t")).collect()
    assert [r.t for r in rows if r.t != json.dumps(r.v)] == []


SCHEMA = T.StructType(
    [
        T.StructField("a b", T.StringType()),
        T.StructField('né"', T.LongType()),
        T.StructField("flag", T.BooleanType()),
        T.StructField("x", T.DoubleType()),
        T.StructField("list", T.ArrayType(T.StringType())),
        T.StructField("deep", T.StructType([T.StructField("in", T.ArrayType(T.StructType([T.StructField("v", T.StringType()), T.StructField("n", T.IntegerType())])))])),
        T.StructField("map", T.MapType(T.StringType(), T.DoubleType())),
    ]
)


def records():
    draw = random.Random(8)

    def maybe(make):
        return None if draw.random() < 0.2 else make()

    def text():
        return draw.choice(STRINGS)

    for _ in range(300):
        yield {
            "a b": maybe(text),
            'né"': maybe(lambda: draw.randrange(-(2**63), 2**63)),
            "flag": maybe(lambda: draw.random() < 0.5),
            "x": maybe(lambda: draw.choice([1.0, -0.25, 1e-7, 3e20, 12345678.9])),
            "list": maybe(lambda: [maybe(text) for _ in range(draw.randrange(4))]),
            "deep": maybe(lambda: {"in": maybe(lambda: [maybe(lambda: {"v": maybe(text), "n": maybe(lambda: 7)}) for _ in range(draw.randrange(3))])}),
            "map": maybe(lambda: {k: maybe(lambda: 0.5) for k in draw.sample(STRINGS, draw.randrange(2))}),
        }


def test_records_as_python_writes_them(spark):
    given = list(records())
    rows = spark.createDataFrame([json.dumps(g) for g in given], "string").select(F.from_json("value", SCHEMA).alias("r"))
    made = spark.createDataFrame([tuple(g.values()) for g in given], SCHEMA)
    got = made.select(json_text(F.struct("*"), made.schema).alias("t")).collect()
    assert [r.t for r in got] == [json.dumps(g) for g in given]
    whole = rows.select(json_text(F.col("r"), SCHEMA).alias("t")).collect()
    assert len(whole) == len(given)
    assert spark.range(1).select(json_text(F.lit(None), T.NullType()), json_text(F.struct(), T.StructType())).first()[:] == ("null", "{}")


@pytest.mark.parametrize("separators", [(",", ":"), (" ,\n ", "\t:  ")])
@pytest.mark.parametrize("ascii_only", [True, False])
def test_texts_are_respaced(spark, separators, ascii_only):
    given = [*records(), [1, -0.0, 1e5, [], {}], "x", 5, None, True]
    texts = [json.dumps(g, separators=separators, ensure_ascii=ascii_only) for g in given]
    texts += ['{"a":1.0E5,"b":-0,"c":"\\/\\u00C9\\u0041","d":2E-3}', '  [ ]  ']
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", respaced(F.col("t")).alias("t"))
    got = {r.i: r.t for r in rows.collect()}
    assert [got[i] for i in range(len(texts))] == [json.dumps(json.loads(t)) for t in texts]


def test_messages_have_the_bytes_of_a_producer_in_python(spark):
    users = [{"login": {"uuid": 'ü"1'}, "name": {"first": "Zoë", "last": None}}, {"login": {"uuid": None}, "name": None}, {"login": None, "name": {"first": "", "last": "\\"}}]
    kind = "login struct<uuid: string>, name struct<first: string, last: string>"
    frame = spark.createDataFrame([tuple(u.values()) for u in users], kind)
    got = [(r.key and bytes(r.key), bytes(r.value)) for r in topic.encode_topic(frame, spaced=True).collect()]
    uuids = [(u["login"] or {}).get("uuid") for u in users]
    want = [(json.dumps({"uuid": k}).encode() if k else None, json.dumps(u).encode()) for k, u in zip(uuids, users, strict=True)]
    assert got == want
    lines = spark.createDataFrame([json.dumps(u, separators=(",", ":"), ensure_ascii=False) for u in users] + ["not {json", ""], "string")
    sent = [(r.key and bytes(r.key), bytes(r.value)) for r in topic.encode_records(lines, spaced=True).collect()]
    assert sent == [*want, (None, b"not {json"), (None, b"")]


def test_bytes_are_refused(spark):
    frame = spark.createDataFrame([(b"x",)], "v binary")
    with pytest.raises(TypeError):
        topic.encode_topic(frame, spaced=True)
