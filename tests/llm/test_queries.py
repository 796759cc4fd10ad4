"""The registered queries against their SQL, and the classifiers on held-out labels."""

import zlib

import pytest
from conftest import auc

from userflow.llm import oracles, queries


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("" if row[i] is None else str(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_matches_sql(spark, duck, sf_dir, name):
    want = duck(sf_dir).execute(oracles.ORACLES[name])
    columns = [d[0] for d in want.description]
    expected = canonical(columns, want.fetchall())
    got = queries.QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(columns)
    assert expected and canonical(got.columns, got.collect()) == expected


@pytest.mark.parametrize(("name", "label", "folds", "fold", "least"), [("op6_toxicity", "toxic", 5, 0, 0.9), ("op7_quality", "quality", 3, 1, 0.99)])
def test_held_out_labels_are_predicted(spark, duck, name, label, folds, fold, least):
    folder = "/root/testdata/sf0.1" if name == "op6_toxicity" else "/root/testdata/sf0.01"
    rows = queries.QUERIES[name](spark, folder).collect()
    known = dict(duck(folder).execute(f"select doc_id, {label} from labels").fetchall())
    assert len({r.doc_id for r in rows}) == len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == fold)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [(r.score, known[r.doc_id]) for r in rows if r.held_out and r.doc_id in known]
    assert auc([s for s, _ in held], [y for _, y in held]) > least
