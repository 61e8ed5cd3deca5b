import itertools
import random

from helpers import DOC_SCHEMA, empty_docs, invented, odd_docs

from tidemark.llm.decontaminate import LEAST_ITEM_WORDS, LEAST_WORDS, MASKS, SPAN, contaminated, remove_contaminated


def words(text):
    return "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()


def stretch(flags):
    best, run, start, hit = (0, 0, -1, 0), 0, 0, 0
    for i, f in enumerate(flags):
        if run <= 0:
            run, start, hit = 0, i, 0
        run += 1 if f else -4
        hit += f
        if run > best[0]:
            best = (run, start, i, hit)
    return best


def brute(docs, items):
    """Every shift of every item along every document that some mask window agrees in."""
    out = []
    for d, t in docs:
        x = words(t)
        for i, y in items:
            best = None
            masks = MASKS if len(y) >= SPAN else (tuple(range(len(y))),)
            for shift in range(-len(y) + 1, len(x)):
                lo, hi = max(0, -shift), min(len(y), len(x) - shift)
                flags = [x[shift + j] == y[j] for j in range(lo, hi)]
                if not any(all(flags[p + o] for o in m) for m in masks for p in range(len(flags) - m[-1])):
                    continue
                score, a, b, hits = stretch(flags)
                if b - a + 1 >= min(LEAST_WORDS, len(y)):
                    found = (score, -(shift + lo + a), b - a + 1, hits)
                    best = found if best is None or found > best else best
            if best:
                out.append((str(d), i, -best[1], best[2], best[3]))
    return sorted(out)


def test_equals_brute_force(spark):
    rng = random.Random(4)
    items = [(i, invented(rng.randint(25, 50), 100 + i)) for i in range(12)] + [(50, invented(7, 3)), (51, ["a", "b"]), (52, invented(11, 9))]
    docs = []
    for i in range(60):
        w = invented(rng.randint(0, 120), i)
        if i % 3 == 0:
            _, item = rng.choice(items)
            part = list(item)
            for _ in range(rng.randint(0, 4)):  # substituted words
                part[rng.randrange(len(part))] = "other"
            cut = part[rng.choice([0, 0, 5]):]
            at = rng.randint(0, len(w))
            w = w[:at] + [x.upper() + rng.choice(["", ",", "."]) for x in cut] + w[at:]
        docs.append((i if i % 20 else None, " ".join(w)))
    docs += [docs[3], docs[3], (500, None), (501, "")]
    df = spark.createDataFrame([(*d, "en", "s", 1) for d in docs], DOC_SCHEMA).repartition(3)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(90, " ".join(items[0][1]).upper()), (91, None), (92, "")], "item_id long, text string")
    got = [(str(r["doc_id"]), r["item_id"], r["start"], r["words"], r["equal"]) for r in contaminated(df, bench).collect()]
    want = brute(docs, [(i, w) for i, w in items if len(w) >= LEAST_ITEM_WORDS])
    assert sorted(got) == want and len(want) > 15
    copies = {r["item_id"]: r["item_copies"] for r in contaminated(df, bench).collect()}
    assert copies.get(0, 2) == 2 and set(copies.values()) <= {1, 2}
    kept = sorted(str(r["doc_id"]) + str(r["text"]) for r in remove_contaminated(df, bench).collect())
    bad = {w[0] for w in want if w[0] != "None"}
    assert all(k for k in kept) and {str(d) for d, _ in docs if d is not None and str(d) not in bad} <= {str(r["doc_id"]) for r in remove_contaminated(df, bench).collect()}
    assert not bad & {str(r["doc_id"]) for r in remove_contaminated(df, bench).collect()}


def test_odd_rows(spark):
    leak = " ".join(invented(30, 1))
    docs = odd_docs(spark, ["before it " + leak + " behind it", "clean text of some words and more of them than the masks need, all said"])
    bench = spark.createDataFrame([(1, leak), (None, "null id " + leak[::-1])], "item_id long, text string")
    out = remove_contaminated(docs, bench)
    assert out.columns == docs.columns and out.count() == docs.count() - 1
    assert contaminated(empty_docs(spark), bench).count() == 0
    assert contaminated(docs, bench.limit(0)).count() == 0 and remove_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_one_passage_in_most_documents(spark):
    leak = " ".join(invented(40, 8))
    df = spark.createDataFrame([(i, f"{leak} and its own word {i}" if i % 3 else f"clean {i}", "en", "s", 1) for i in range(200)], DOC_SCHEMA)
    bench = spark.createDataFrame([(1, leak)], "item_id long, text string")
    assert sorted(r["doc_id"] for r in remove_contaminated(df, bench).collect()) == [i for i in range(200) if i % 3 == 0]


def test_substitutions_at_every_place(spark):
    rng, docs, items, must, never = random.Random(9), [], [], set(), set()
    for n in range(5, 21):
        item = [f"i{n}x{j}" for j in range(n)]
        items.append((n, " ".join(item)))
        for gone in [*itertools.combinations(range(n), 1), *itertools.combinations(range(n), 2), *([tuple(rng.sample(range(n), 4)) for _ in range(40)] if n == 20 else [])]:
            doc = len(docs)
            text = [w if j not in gone else "other" for j, w in enumerate(item)]
            docs.append((doc, " ".join([*invented(9, doc), *text, *invented(9, -doc - 1)])))
            if len(gone) * 5 <= n:
                must.add((doc, n))
            elif n < LEAST_WORDS:
                never.add((doc, n))
    df = spark.createDataFrame([(*d, "en", "s", 1) for d in docs], DOC_SCHEMA)
    got = {(r["doc_id"], r["item_id"]): r for r in contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert must <= got.keys() and not never & got.keys()
    assert all(r["equal"] * 5 >= r["words"] * 4 and r["words"] >= min(LEAST_WORDS, i) for (_, i), r in got.items())
