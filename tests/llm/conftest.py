import glob
import os

import duckdb
import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        # Columns whose names the operators use themselves.
        T.StructField("score", T.StringType()),
        T.StructField("component", T.LongType()),
        T.StructField("label", T.StringType()),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


@pytest.fixture
def documents(spark):
    def made(rows):
        return spark.createDataFrame([(i, text, "s", 1, "l", ["x"]) for i, text in rows], DOCS)

    return made


@pytest.fixture(scope="session")
def duck():
    def over(folder):
        con = duckdb.connect()
        for path in glob.glob(f"{folder}/*.parquet"):
            name = os.path.splitext(os.path.basename(path))[0]
            con.execute(f"create view {name} as select * from read_parquet('{path}')")
        return con

    return over


def auc(scores, labels):
    """Share of pairs of unlike labels in the right order."""
    good = [s for s, y in zip(scores, labels, strict=True) if y == 1]
    bad = [s for s, y in zip(scores, labels, strict=True) if y == 0]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
