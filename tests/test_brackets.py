import pytest
from pyspark.sql import functions as F

from userflow.functions.brackets import LABELS, age_bracket, bracket_rank

EDGES = {
    None: "65+",
    -1: "0-17",
    0: "0-17",
    17: "0-17",
    18: "18-24",
    24: "18-24",
    25: "25-34",
    34: "25-34",
    35: "35-44",
    44: "35-44",
    45: "45-54",
    54: "45-54",
    55: "55-64",
    64: "55-64",
    65: "65+",
    120: "65+",
}


@pytest.fixture(scope="module")
def ages(spark):
    return spark.createDataFrame([(a,) for a in EDGES], "age int")


def test_edges(ages):
    rows = ages.select("age", age_bracket("age").alias("label")).collect()
    assert {r.age: r.label for r in rows} == EDGES


def test_unknown_label_takes_null_ages_only(ages):
    rows = ages.select("age", age_bracket(F.col("age"), "unknown").alias("label")).collect()
    assert {r.age: r.label for r in rows} == {**EDGES, None: "unknown"}


def test_rank_follows_display_order(spark):
    labels = spark.createDataFrame([(x,) for x in (*LABELS, "other", None)], "label string")
    rows = labels.select("label", bracket_rank("label").alias("rank")).collect()
    assert {r.label: r["rank"] for r in rows} == {
        **{label: i + 1 for i, label in enumerate(LABELS)},
        "other": 8,
        None: 8,
    }


def test_fractional_ages_between_brackets_fall_through(spark):
    rows = spark.createDataFrame([(17.5,), (24.5,)], "age double")
    assert [r[0] for r in rows.select(age_bracket("age")).collect()] == ["0-17", "65+"]
