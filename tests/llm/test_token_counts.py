import random

from helpers import empty_docs, odd_docs
from pyspark.sql import functions as F

from tidemark.llm.queries import EDITS
from tidemark.llm.token_counts import EDIT_TYPE, SegmentTree, apply_edits, build_trees, counter, leaves
from tidemark.llm.vocabulary import vocabulary_path

PATH = vocabulary_path("byte_bpe_50k.json")
ODD = "ab's 're  \n\t12.,!é “’l<|endoftext|>"


def full(text):
    return len(counter(PATH).tokenizer.encode(text, add_special_tokens=False).ids)


def test_counts_after_edits_equal_a_full_count():
    rng, c = random.Random(5), counter(PATH)
    for k in range(1500):
        size = rng.choice([0, 1, 5, 50, 400, 1500])
        t = "".join(rng.choice(ODD) for _ in range(size)) if k % 2 else " ".join(rng.choice(["the", "don't", "  x", "12", "...", "\n\nfoo"]) for _ in range(size // 5))
        tree = SegmentTree(t, *leaves(t, c), c)
        for _ in range(rng.randint(1, 6)):
            n, s, length = len(t), rng.randint(0, len(t)), rng.choice([0, 0, 1, 2, 8, 60])
            new = "".join(rng.choice(ODD) for _ in range(rng.choice([0, 1, 2, 6, 30])))
            t = t[:s] + new + t[min(s + length, n):]
            tree.edit(s, length, new)
            assert tree.text == t and tree.tokens == full(t) and tree.sums[1, 0] == len(t)


def test_an_edit_recounts_a_few_leaves_of_a_long_text():
    c = counter(PATH)
    t = " ".join(f"word{i % 500}" for i in range(60_000))
    tree = SegmentTree(t, *leaves(t, c), c)
    tree.edit(len(t) // 2, 3, "x y")
    assert tree.recounted <= 100 and tree.tokens == full(tree.text)


def test_large_insertion_builds_the_tree_anew():
    c = counter(PATH)
    t = "some words to begin with"
    tree = SegmentTree(t, *leaves(t, c), c)
    tree.edit(5, 0, " more words" * 2000)
    tree.edit(100, 3, "")
    assert tree.n > 50 and tree.tokens == full(tree.text)


def test_tables(spark):
    docs = odd_docs(spark, ["the quick brown fox " * 400, "x"])
    trees = build_trees(docs, PATH)
    rows = trees.collect()
    assert len(rows) == docs.count() and all(sum(r["leaf_tokens"]) == full(r["text"]) and sum(r["leaf_chars"]) == len(r["text"]) for r in rows)
    edited = apply_edits(trees.withColumn("edits", F.expr(EDITS).cast(EDIT_TYPE)), PATH).collect()
    assert len(edited) == len(rows)
    for r in edited:
        assert r["tokens_after"] == full(r["text"]) == sum(r["leaf_tokens"]) and r["n_edits"] >= 1
    assert {r["n_edits"] for r in edited if r["doc_id"] == 0} == {4}
    twice = apply_edits(apply_edits(trees.withColumn("edits", F.expr(EDITS).cast(EDIT_TYPE)), PATH).withColumn(
        "edits", F.expr("array(named_struct('start', -5L, 'length', 9999999999L, 'text', 'all new'), null, named_struct('start', null, 'length', null, 'text', null))").cast(EDIT_TYPE)), PATH)
    assert {(r["text"], r["tokens_after"], r["n_edits"]) for r in twice.collect()} == {("all new", full("all new"), 2)}
    none = apply_edits(trees.withColumn("edits", F.lit(None).cast(EDIT_TYPE)), PATH).collect()
    assert all(r["tokens_before"] == r["tokens_after"] and r["n_edits"] == 0 for r in none)
    assert build_trees(empty_docs(spark), PATH).count() == 0
