import random

from helpers import DOC_SCHEMA

import tidemark.llm.text as text
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.text import ChunkCache, slices_at_space


def test_cache_is_bounded_and_right():
    made = []
    cache = ChunkCache(lambda c: made.append(c) or c.upper(), limit=10, longest=5)
    rng = random.Random(1)
    for _ in range(2000):
        w = rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 7)
        assert cache[w] == w.upper()
        assert len(cache) + len(cache.older) <= 10 and all(len(k) <= 5 for k in cache)


def test_slices():
    for t in ("", "a", "a b c  d\n" * 50, "x" * 100, " " * 30):
        assert "".join(slices_at_space(t, 7)) == t
        assert [w for p in slices_at_space(t, 7) for w in p.split()] == t.split()


def test_joins_beyond_the_broadcast_bound_give_the_same(spark, monkeypatch):
    docs = [(i, f"a line that all documents have in common\nown line {i % 9} of some length\nown line number {i:05d} here") for i in range(60)]
    df = spark.createDataFrame([(*d, "en", "s", 1) for d in docs], DOC_SCHEMA)
    want = sorted((r["doc_id"], r["text"]) for r in dedup_lines(df).collect())
    monkeypatch.setattr(text, "BROADCAST_ROWS", 0)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = dedup_lines(df)
        assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
        assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_first_by_hash(spark):
    from pyspark.sql import functions as F

    from tidemark.llm.text import first_by_hash

    rows = spark.range(20_000).withColumn("at", F.xxhash64("id")).withColumn("third", F.col("id") % 3 == 0)
    order = [(r["at"] % (1 << 64) >> 1, r["id"], r["third"]) for r in rows.collect()]
    for limit in (1, 70, 5000, 20_000, 50_000):
        got = {r["id"] for r in first_by_hash(rows, F.col("at"), [(F.lit(True), limit)]).collect()}
        assert got == {i for _, i, _ in sorted(order)[:len(got)]} and min(limit, 20_000) * 0.93 - 3 <= len(got) <= limit
    both = first_by_hash(rows, F.col("at"), [(F.lit(True), 300), (F.col("third"), 300)]).collect()
    assert sum(r["third"] for r in both) <= 300 and 450 <= len(both) <= 600 and len({r["id"] for r in both}) == len(both)
    assert first_by_hash(rows.limit(0), F.col("at"), [(F.lit(True), 5)]).count() == 0


def test_workers_keep_no_cache_behind_a_task(spark):
    import pyarrow as pa

    import corpus_pipeline as cp

    docs = spark.createDataFrame([(i, " ".join(f"word{i * j % 7919}x" for j in range(60)), "en", "s", 1) for i in range(400)], DOC_SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    kept = cp.resample(docs.repartition(4), labels).count()
    assert 0 < kept <= 400
    assert cp.keep_one_of_each(docs.repartition(4)).count() <= 400
    assert cp.pack(docs.repartition(4), cp.vocabulary_path(cp.PACK_VOCABULARY)).count() >= 400

    def sizes(batches):
        from tidemark.llm import near_dedup, packing, quality
        caches = [quality._CODES, near_dedup._WORD_HASHES, *[c for t in packing._TOKENIZERS.values() for c in (t.others, t.words)]]
        for _ in batches:
            pass
        yield pa.RecordBatch.from_arrays([pa.array([sum(len(c) + len(getattr(c, "older", ())) for c in caches)])], names=["n"])

    assert [r["n"] for r in spark.range(0, 64, 1, 8).mapInArrow(sizes, "n long").collect()] == [0] * 8
