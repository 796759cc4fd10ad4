"""Each stage of the pipeline on its own input, held against a plain computation."""

import numpy as np
from test_decontaminate import expected as hits
from test_near_dups import expected as groups
from tokenizers import Tokenizer

import corpus_pipeline
from userflow.llm import tokens


def test_stages(spark, duck, small_dir, tmp_path):
    con = duck(small_dir)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality", "near_duplicates", "decontamination", "packing"]
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    columns, texts = docs.columns, dict(con.execute("select doc_id, text from documents").fetchall())
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        before = sorted(r.doc_id for r in docs.select("doc_id").collect())
        out = stage(spark, docs, small_dir)
        out.write.parquet(path := str(tmp_path / name))
        docs = spark.read.parquet(path)
        if name == "packing":
            break
        assert docs.columns == columns
        left[name] = sorted(r.doc_id for r in docs.select("doc_id").collect())
        assert set(left[name]) <= set(before) and len(set(left[name])) == len(left[name])
        rows = [(i, texts[i]) for i in before]
        if name == "near_duplicates":
            component = groups(rows, 5, 80)
            assert left[name] == sorted(i for i in before if component[i] == i)
        if name == "decontamination":
            items = con.execute("select item_id, text from benchmark").fetchall()
            bad = {r[0] for r in hits(rows, items, 13) if r[4]}
            assert left[name] == [i for i in before if i not in bad]
    known = con.execute("select doc_id, toxic, quality from labels").fetchall()
    toxic = [i in left["toxicity"] for i, t, _ in known if t]
    clean = [i in left["toxicity"] for i, t, _ in known if not t]
    assert np.mean(toxic) < 0.3 and np.mean(clean) > 0.97
    good = [i in left["quality"] for i, t, q in known if i in left["toxicity"] and q]
    poor = [i in left["quality"] for i, t, q in known if i in left["toxicity"] and not q]
    assert np.mean(poor) < 0.1 and np.mean(good) > 0.97
    library = Tokenizer.from_file(tokens.public().file)
    total = {r.doc_id: r.n for r in docs.groupBy("doc_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
    assert total == {i: len(library.encode(texts[i], add_special_tokens=False).ids) + 1 for i in left["decontamination"]}


def test_run_gives_the_last_stages_rows(spark, small_dir):
    rows = corpus_pipeline.run(spark, small_dir)
    assert {"doc_id", "start", "length", "ids_crc32", "sequence_id", "offset", "step_group"} <= set(rows.columns) and rows.count() > 0


def test_no_documents(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = docs.where("false")
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, small_dir)
        assert rows.count() == 0, name
        assert name == "packing" or rows.columns == docs.columns
