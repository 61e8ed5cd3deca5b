import hashlib
import os
import random
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from helpers import DOC_SCHEMA, empty_docs, odd_docs

from tidemark.llm import suffix_dedup as sd


def brute(rows, length):
    """(doc_id, n_bytes, n_removed, n_spans, digest), string by string."""
    first = {}
    texts = [(d, (t or "").encode()) for d, t in rows]
    for d, t in texts:
        for i in range(len(t) - length + 1):
            if d is not None:
                first[t[i:i + length]] = min(first.get(t[i:i + length], d), d)
    out = []
    for d, t in texts:
        gone = set()
        for i in range(len(t) - length + 1):
            if d is not None and first[t[i:i + length]] < d:
                gone.update(range(i, i + length))
        spans = sum(i - 1 not in gone for i in gone)
        kept = bytes(c for i, c in enumerate(t) if i not in gone)
        out.append((d, len(t), len(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def texts(n=90, seed=0):
    """Copies, near copies, shared passages at odd places, repeats in a text, marks of two to
    four bytes."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéßñ你𝄞") for _ in range(rng.randrange(1, 7)))
    passages = [" ".join(word() for _ in range(rng.randrange(3, 40))) for _ in range(6)]
    out = []
    for _ in range(n):
        kind = rng.randrange(5)
        if kind == 0 and out:
            out.append(rng.choice(out))
        elif kind == 1 and out:
            t = list(rng.choice(out))
            for _ in range(3):
                if t:
                    t[rng.randrange(len(t))] = rng.choice("xyzé")
            out.append("".join(t))
        else:
            out.append(" ".join(rng.choice(passages) if rng.random() < 0.3 else word() for _ in range(rng.randrange(40))))
    return out


@pytest.mark.parametrize(("length", "hot"), [(50, 64), (50, 1), (7, 64), (7, 3)])
def test_whole_table_against_brute_force(spark, monkeypatch, length, hot):
    monkeypatch.setattr(sd, "SHARD_SEGMENTS", hot)
    docs = odd_docs(spark, texts(seed=length))
    more = spark.createDataFrame([(905, "the same row twice for all of us, and then some more of it, so it is longer", None, None, 1),
                                  (950, "a" * 3000, None, None, 1), (951, "a" * 700 + "b" + "a" * 60, None, None, 1),
                                  (952, "ab" * 400, None, None, 1), (953, "b" + "ab" * 300, None, None, 1)], DOC_SCHEMA)
    docs = docs.unionByName(more, allowMissingColumns=True).repartition(5)
    got = sorted((tuple(r) for r in sd.suffix_dedup(docs, length).collect()), key=str)
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], length)
    assert got == want
    assert sum(r[2] for r in got) > 1000


def test_long_texts_are_cut_with_overlap(monkeypatch):
    monkeypatch.setattr(sd, "BLOCK", 400)
    text = "".join(chr(97 + i * i % 23) for i in range(1500)).encode()
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([text.decode(), "z" * 60])], names=["doc_id", "text"])
    strings = []
    for block, starts, sizes, ids, _, offsets in sd.blocks(iter([batch]), 50):
        assert len(block) <= 400
        h, piece, at, n = sd.segments_of(block, starts, sizes, 50)
        for p, a, m in zip(piece, at, n, strict=True):
            strings += [(ids[p], a - starts[p] + offsets[p] + i, bytes(block[a + i:a + i + 50])) for i in range(m)]
    assert sorted(strings) == [(1, i, text[i:i + 50]) for i in range(1451)] + [(2, i, b"z" * 50) for i in range(11)]


def test_equal_strings_have_one_anchor_wherever_they_stand():
    rng = np.random.default_rng(3)
    s = rng.integers(97, 100, 50, np.uint8)
    seen = set()
    for pad in range(0, 200, 17):
        block = np.concatenate([rng.integers(97, 123, pad, np.uint8), s, rng.integers(97, 123, 30, np.uint8)])
        h, _, at, n = sd.segments_of(block, np.array([0]), np.array([len(block)]), 50)
        seen.add(int(h[(at <= pad) & (pad < at + n)][0]))
    assert len(seen) == 1


def test_report_has_the_texts(spark):
    passage = "this passage of more than fifty bytes stands in two documents"
    docs = spark.createDataFrame([(1, "A " + passage + "!"), (2, "Before. " + passage + " After.")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in sd.kept_bytes(docs).collect()}
    assert rows[1]["spans"] is None and bytes(rows[1]["kept"]).decode() == "A " + passage + "!"
    assert bytes(rows[2]["kept"]) == b"Before." + b" After." and rows[2]["spans"] == [7, 8 + len(passage)]


def test_empty_table_and_bad_length(spark):
    assert sd.suffix_dedup(empty_docs(spark)).count() == 0
    with pytest.raises(ValueError):
        sd.suffix_dedup(empty_docs(spark), 1)


STORED = """
import glob, sys, time
from tidemark.llm.suffix_dedup import _stored
from tidemark.session import build_session

scratch = sys.argv[1]
spark = build_session("local[2]", 2, extra={"spark.checkpoint.dir": scratch + "/ckpt", "spark.local.dir": scratch + "/local",
                                            "spark.driver.memory": "1g", "spark.cleaner.referenceTracking": "false"})
confs = lambda: sorted((r[0], r[1]) for r in spark.sql("SET").collect())
before = confs()
table = _stored(spark, lambda: spark.range(5000).selectExpr("id % 1000 k").groupBy("k").count(), scratch, "t")
assert confs() == before
end = time.time() + 10
while (files := glob.glob(scratch + "/local/**/shuffle_*.data", recursive=True)) and time.time() < end:
    time.sleep(0.2)
print("left", len(files), table.filter("count = 5").count())
"""


def test_a_stored_table_leaves_no_shuffle_files(scratch):
    """Also where nothing is collected, as happens by chance while references are held."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    got = subprocess.run([sys.executable, "-c", STORED, scratch], env={**os.environ, "PYTHONPATH": root}, capture_output=True, text=True, timeout=120)
    assert "left 0 1000" in got.stdout, got.stdout + got.stderr[-2000:]
