import json

import pytest
from pyspark.sql import functions as F

from userflow.operators.parse import FIELDS, parse_users, unknown_value

FLAT = {"id": "a", "age": 3, "location": {"country": "X", "city": "C", "coordinates": {"latitude": "1", "longitude": "2"}}}
RAW = {
    "gender": "male",
    "name": {"first": "f", "last": "l"},
    "login": {"uuid": "u-1", "username": "n"},
    "dob": {"date": "d", "age": 4},
    "nat": "NO",
    "location": {"country": "Y", "street": {"number": 5, "name": "s"}, "coordinates": {"latitude": "1", "altitude": 7}},
}
BODIES = [
    FLAT,
    {**FLAT, "device": {"os": "x", "sizes": [1, {"a": None}]}, "score": 1.5},
    RAW,
    {"login": "text", "location": [1], "extra": None},
    {},
]
BAD = ["not json", "[1]", "5", "", None, '{"extra":1', '{"extra":1,"extra":2}']
WANT = [
    None,
    {"device": {"os": "x", "sizes": [1, {"a": None}]}, "score": 1.5},
    {"login": {"username": "n"}, "location": {"street": {"number": 5, "name": "s"}, "coordinates": {"altitude": 7}}},
    {"extra": None},
    None,
]


def messages(spark, bodies):
    rows = [(n, b if b is None or isinstance(b, str) else json.dumps(b)) for n, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "timestamp int, value string").coalesce(1)


def unknown(users):
    return [None if r[0] is None else json.loads(r[0]) for r in users.select(F.to_json("unknown")).collect()]


def test_unknown_keys_of_both_shapes_come_back(spark):
    users = parse_users(messages(spark, BODIES + BAD), unknown=True)
    assert unknown(users) == WANT + [None] * len(BAD)
    assert users.columns == [*FIELDS, "unknown"]


def test_the_other_columns_and_the_row_count_stay(spark):
    rows = messages(spark, BODIES + BAD)
    with_, without = parse_users(rows, unknown=True).drop("unknown"), parse_users(rows)
    assert with_.collect() == without.collect() and without.count() == len(BODIES) + len(BAD)
    strict = parse_users(rows, fields=("id",), skip_bad=True, unknown=True, arrival=True)
    assert strict.columns == ["id", "arrived", "unknown"]
    assert strict.count() == parse_users(rows, fields=("id",), skip_bad=True).count()
    assert unknown(strict)[: len(WANT)] == WANT
    assert unknown(parse_users(rows, fields=(), unknown=True))[: len(WANT)] == WANT


def test_declared_mode_knows_its_own_keys_only(spark):
    users = parse_users(messages(spark, [RAW]), mode="declared", fields=("gender",), unknown=True)
    assert unknown(users) == [{"login": RAW["login"], "nat": "NO", "location": WANT[2]["location"]}]


@pytest.mark.parametrize(
    "path,kind,want",
    [
        ("$.device.os", "string", "x"),
        ("$.device.os", "int", None),
        ("$.score", "double", 1.5),
        ("$.score", "int", 1),
        ("$.device.sizes[0]", "bigint", 1),
        ("$.device.missing", "string", None),
        ("$.id", "string", None),
    ],
)
def test_typed_reads(spark, path, kind, want):
    users = parse_users(messages(spark, [BODIES[1]]), unknown=True)
    assert users.select(unknown_value(path, kind)).first()[0] == want


def test_unknown_keys_are_stored_and_read_back(spark, tmp_path):
    parse_users(messages(spark, BODIES), fields=("id",), unknown=True).write.parquet(str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert [r[0] for r in back.select(unknown_value("$.location.street.number", "int")).collect()] == [None, None, 5, None, None]
