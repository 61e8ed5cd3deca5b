import random
from collections import Counter

import numpy as np
from helpers import DOC_SCHEMA, empty_docs, invented, odd_docs

from tidemark.llm.near_dedup import common_counts, connected, dart_minhash, elements, keep_one_of_each, near_classes


def bag(text):
    words = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
    n = min(5, len(words))
    return Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if n else Counter()


def similarity(a, b):
    if not a and not b:
        return 1.0
    common = sum((a & b).values())
    return common / (sum(a.values()) + sum(b.values()) - common)


def brute_classes(docs):
    bags, part = [bag(t) for _, t in docs], list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if part[i] != part[j] and similarity(bags[i], bags[j]) >= 0.8:
                old, new = part[i], part[j]
                part = [new if p == old else p for p in part]
    least = {}
    for (d, _), p in zip(docs, part):
        least[p] = min([x for x in (least.get(p), d) if x is not None], default=None)
    return sorted((str(d), str(least[p])) for (d, _), p in zip(docs, part))


def near(words, rng, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10 ** 6)}"
    return words


def corpus(seed):
    rng = random.Random(seed)
    docs = [" ".join(invented(rng.randint(20, 200), seed * 1000 + i)) for i in range(60)]
    base = invented(150, 77)
    docs += [" ".join(near(base, rng, rng.randint(1, 5))) for _ in range(60)]  # copies of a base that isn't there
    docs += [" ".join(base).upper() + "!"] * 5
    docs += [" ".join(near(docs[i].split(), rng, 1)) for i in range(10)]
    docs += [" ".join(base[:60] + invented(90, 500 + i)) for i in range(10)]  # a shared passage only
    docs += ["one two", "one two", "one", ""]
    return [(i, t) for i, t in enumerate(docs)]


def test_classes_equal_brute_force(spark):
    for seed in (1, 2):
        docs = corpus(seed) + [(None, "a b c d e f g"), (None, None)]
        df = spark.createDataFrame([(*d, "en", "s", 1) for d in docs], DOC_SCHEMA).repartition(4)
        got = near_classes(df).collect()
        assert sorted((str(r["doc_id"]), str(r["class_id"])) for r in got) == brute_classes(docs)
        sizes = Counter(r["class_id"] for r in got if r["class_id"] is not None)
        assert all(sizes[r["class_id"]] == r["class_size"] for r in got if r["class_id"] is not None)


def test_signature_estimates_weighted_similarity():
    rng, base = random.Random(3), invented(300, 5, 10 ** 6)
    for edits in (3, 12):
        diff = []
        for _ in range(30):
            x, y = elements(" ".join(base)), elements(" ".join(near(base, rng, edits)))
            common = len(np.intersect1d(x, y))
            diff.append((dart_minhash(x) == dart_minhash(y)).mean() - common / (len(x) + len(y) - common))
        assert abs(np.mean(diff)) < 0.03
    x, y = elements(" ".join(["a b c d e f"] * 30)), elements(" ".join(["a b c d e f"] * 24))
    assert abs((dart_minhash(x) == dart_minhash(y)).mean() - 140 / 176) < 0.15


def test_connected_parts_of_a_long_chain(spark):
    links = spark.createDataFrame([(bytearray([i]), bytearray([i + 1])) for i in range(40) if i != 20], "a binary, b binary")
    got = {r["key"][0]: r["part"][0] for r in connected(links).collect()}
    assert got == {i: 0 if i <= 20 else 21 for i in range(41)}


def test_keeps_one_row_and_all_columns(spark):
    docs = odd_docs(spark, ["a b c d e f g h", "A b, c d e f g h", "something else altogether in here"])
    out = keep_one_of_each(docs)
    assert out.columns == docs.columns
    ids = sorted(str(r["doc_id"]) for r in out.collect())
    # wordless texts (900, 901, 902, 903 and the null id) are one class, 905 stands twice
    assert ids == sorted(["0", "2", "900", "None", "904", "905"])
    assert keep_one_of_each(empty_docs(spark)).count() == 0 and near_classes(empty_docs(spark)).count() == 0


def test_all_null_ids(spark):
    df = spark.createDataFrame([(None, "a b c d e f", "", "", 1), (None, "a b c d e f", "", "", 1), (None, "q r s t u v", "", "", 1)], DOC_SCHEMA)
    assert keep_one_of_each(df).count() == 2


def test_large_families_below_the_threshold(spark, monkeypatch):
    """Copies that are alike in pairs by some two thirds, with a few real links among them."""
    import tidemark.llm.near_dedup as near_dedup
    monkeypatch.setattr(near_dedup, "PAIR_ROWS", 4)
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 16)
    rng, base = random.Random(6), invented(200, 3)
    docs = [near(base, rng, 7) for _ in range(70)]
    docs += [near(d, rng, 1) for d in docs[:12]]
    docs = [(i, " ".join(d)) for i, d in enumerate(docs)]
    df = spark.createDataFrame([(*d, "en", "s", 1) for d in docs], DOC_SCHEMA)
    assert sorted((str(r["doc_id"]), str(r["class_id"])) for r in near_classes(df).collect()) == brute_classes(docs)


def test_common_counts():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, rng.integers(0, 120))).astype(np.uint64) for _ in range(90)] + [np.empty(0, np.uint64)]
    want = [[len(np.intersect1d(a, b)) if i != j else 0 for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    got = common_counts(sets)
    np.fill_diagonal(got, 0)
    assert (got == np.array(want)).all()
