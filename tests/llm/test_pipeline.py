import os
import random
import tempfile

import pytest
from helpers import DOC_SCHEMA, invented

import __spark_entry__ as entry
import corpus_pipeline
from oracle_compare import compare, duck
from tidemark.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def tables(spark, docs, labels, items):
    d = tempfile.mkdtemp(prefix="tidemark-pipeline-")
    spark.createDataFrame(docs, DOC_SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def planted():
    rng, docs, labels = random.Random(9), [], []
    leak = " ".join(invented(30, 999))
    for i in range(200):
        w = invented(rng.randint(30, 120), i, 5000)
        bad = i % 5 == 0
        text = " ".join(x + "$$$" for x in w) if bad else " ".join(w).capitalize() + "."
        docs.append((i, text, "en", "s", len(text)))
        labels.append((i, int(not bad), 0))
    near = docs[1][1].split()
    near[3] = "changed"
    docs.append((300, " ".join(near), "en", "s", 1))
    docs.append((301, docs[2][1], "en", "s", 1))
    docs.append((302, docs[3][1] + "\n" + leak, "en", "s", 1))
    docs.append((303, " ".join(invented(60, 7777, 5000)).capitalize() + ".\n" + leak + " .", "en", "s", 1))
    docs.append((304, docs[4][1] + "\nits own last line, which no other text has", "en", "s", 1))
    return docs, labels, [(1, leak)]


def test_stages_on_planted_documents(spark):
    d = tables(spark, *planted())
    out, docs = [], spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, d).checkpoint()
        assert docs.columns == spark.read.parquet(f"{d}/documents.parquet").columns
        out.append({r["doc_id"]: r["text"] for r in docs.collect()})
    quality, lines, near, clean = out
    assert not any(i in quality for i in range(0, 200, 5)) and {i for i in range(200) if i % 5} <= quality.keys()
    assert lines.keys() == quality.keys() and lines[301] == "" and lines[304] == "its own last line, which no other text has"
    assert 1 in near and 300 not in near and {i for i in range(200) if i % 5} <= near.keys()
    assert 302 in near and 302 not in clean and 303 not in clean or 302 not in clean
    assert {i for i in range(200) if i % 5} <= clean.keys()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, d).collect()
    assert {r["doc_id"] for r in packed} == clean.keys()
    run = corpus_pipeline.run(spark, d).collect()
    assert sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in run) == sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in packed)


def test_registered():
    names = entry.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    r = compare(entry.queries()[name](spark, SF), duck(SF), ORACLE[name])
    assert r["cols_match"] and r["rows"][0] == r["rows"][1] and r["hash_match"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(set(QUERIES) | {"pipeline"}))
def test_runs_on_the_driver_tables(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0
