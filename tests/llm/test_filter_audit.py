import itertools
import random
from collections import Counter

import duckdb
import pytest
from helpers import empty_docs, odd_docs

from tidemark.llm.filter_audit import AUDIT_SQL, FailureDiagram, adjacent_swaps, audit_part, filter_audit


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def masks_of(docs, labels):
    """part -> mask -> [n, good, toxic], straight from the rules."""
    import re
    first, flags, out = {}, {}, {}
    for r in docs:
        if r["doc_id"] is not None:
            t = r["text"] or ""
            first[t] = min(first.get(t, r["doc_id"]), r["doc_id"])
    for d, q, x in labels:
        g, b = flags.get(d, (False, False))
        flags[d] = (g or q == 1, b or x == 1)
    for r in docs:
        t = r["text"] or ""
        w = re.findall("[^\x20\x09-\x0D]+", t)
        fails = [len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 bool(re.search("[#$%&*|]", t)), r["doc_id"] is not None and r["doc_id"] > first[t]]
        c = out.setdefault(r["lang"] or "", {}).setdefault(sum(f << i for i, f in enumerate(fails)), [0, 0, 0])
        good, toxic = flags.get(r["doc_id"], (False, False)) if r["doc_id"] is not None else (False, False)
        for i, x in enumerate((1, good, toxic)):
            c[i] += x
    return out


def brute(masks):
    """Every order played through by itself."""
    out, shares = [], Counter()
    total = lambda keep, i=0: sum(c[i] for m, c in masks.items() if keep(m))
    for order in itertools.permutations(range(5)):
        for i, f in enumerate(order):
            gone = sum(1 << g for g in order[:i])
            here = lambda m: not m & gone and m >> f & 1  # noqa: B023, E731
            out.append(["".join("ABCDE"[g] for g in order), i + 1, total(lambda m: not m & (gone | 1 << f)), total(here),  # noqa: B023
                        total(lambda m: m & gone and m >> f & 1), total(lambda m: m == 1 << f), total(here, 1), total(here, 2)])  # noqa: B023
            shares["ABCDE"[f]] += out[-1][3]
    return sorted((*r, shares[r[0][r[1] - 1]]) for r in out)


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_swaps_lead_through_every_order_once(n):
    order, seen = list(range(n)), {tuple(range(n))}
    for at in adjacent_swaps(n):
        order[at], order[at + 1] = order[at + 1], order[at]
        seen.add(tuple(order))
    assert len(seen) == len(list(itertools.permutations(range(n)))) == 1 + sum(1 for _ in adjacent_swaps(n))


def test_a_swap_keeps_the_documents_and_shares_nodes():
    rng = random.Random(1)
    masks = {m: (rng.randrange(3),) for m in range(32)}
    d = FailureDiagram(masks, 5)
    for at in [0, 3, 1, 2, 0, 3, 3]:
        d.swap(at)
        for m, (n,) in masks.items():
            node = d.root
            for f in d.order:
                node = node[m >> f & 1]
            assert node == (n,)
    assert d.root[2] == (sum(n for n, in masks.values()),)
    even = FailureDiagram({m: (1,) for m in range(32)}, 5)
    assert [len(x) for x in even.levels] == [1] * 5


def test_audit_of_one_part_is_that_of_each_order():
    rng = random.Random(2)
    masks = {m: (n := rng.randrange(9), rng.randrange(n + 1), rng.randrange(n + 1)) for m in rng.sample(range(32), 20)}
    assert sorted(audit_part(masks, "ABCDE")) == brute(masks)
    assert sorted(audit_part({}, "ABCDE")) == brute({})


def texts():
    rng = random.Random(3)
    out = []
    for _ in range(150):
        n, v = rng.choice([3, 80, 99, 100, 101, 140]), rng.choice([20, 90, 5000])
        words = [rng.choice(["w{}", "W{}", "é{}", "ABC{}"]).format(rng.randrange(v)) for _ in range(n)]
        out.append(rng.choice([" ", "\t", "\x0b", " \n "]).join(words) + rng.choice(["", "", " #", "$", "\x1c", " x"]))
    return out + out[:60]


def test_audit_equals_the_rules_played_through(spark):
    docs = odd_docs(spark, texts())
    rng = random.Random(4)
    rows = [(d, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d in [*range(210), 5, 5, 900, 905, None, 10_000]]
    langs = ["en", "de", None, ""]
    docs = docs.withColumn("lang", docs["lang"])
    from pyspark.sql import functions as F
    docs = docs.withColumn("lang", F.element_at(F.array(*[F.lit(x) for x in langs]), F.coalesce(F.col("doc_id") % 4, F.lit(0)).cast("int") + 1))
    want = {p: brute(m) for p, m in masks_of([r.asDict() for r in docs.collect()], [r for r in rows if r[0] is not None]).items()}
    got = {}
    out = filter_audit(docs.repartition(5), labels_of(spark, rows))
    assert out.schema.simpleString() == ("struct<part:string,filter_order:string,step:int,kept:bigint,removed:bigint,redundant:bigint,"
                                         "unique_fails:bigint,good_lost:bigint,toxic_lost:bigint,shapley:bigint>")
    for r in out.collect():
        got.setdefault(r["part"], []).append(tuple(r)[1:])
    assert set(got) == {"en", "de", ""}
    assert {p: sorted(x) for p, x in got.items()} == want
    # the SQL says the same
    documents, labels = docs.select("doc_id", "text", "lang").toPandas(), labels_of(spark, rows).toPandas()  # noqa: F841
    sql = duckdb.connect().execute(AUDIT_SQL).fetchall()
    assert sorted(sql) == sorted((p, *r) for p, x in want.items() for r in x)


def test_empty_tables(spark):
    assert filter_audit(empty_docs(spark), labels_of(spark, [])).count() == 0
    assert filter_audit(odd_docs(spark), labels_of(spark, [])).filter("good_lost + toxic_lost > 0").count() == 0
