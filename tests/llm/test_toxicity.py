import random
import zlib

from helpers import DOC_SCHEMA, distance, empty_docs, invented, odd_docs

from tidemark.llm.toxicity import FuzzyLexicon, Reader, WholeLexicon, edits_allowed, fit, pick_terms, score_toxicity

LABELS = "doc_id long, quality int, toxic int"
TERMS = ["idiot", "worthless", "scum", "vequ"]


def corpus(spark, n=600):
    rng, docs, labels = random.Random(1), [], []
    for i in range(n):
        w = invented(rng.randint(10, 120), i, 300)
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randint(1, 4)):
                term = rng.choice(TERMS)
                w.insert(rng.randint(0, len(w)), term + rng.choice(["on", "er", "ai"]) if term == "vequ" else term + rng.choice(["", ".", ","]))
        docs.append((i, " ".join(w), "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    return spark.createDataFrame(docs, DOC_SCHEMA).repartition(4), spark.createDataFrame([*labels, (None, 1, 1), (3, None, None)], LABELS)


def test_held_out_rows_and_digest(spark):
    docs, labels = corpus(spark)
    got = score_toxicity(docs, labels).collect()
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all((r["score"] >= 0.5) == bool(r["predicted"]) and 0 <= r["score"] <= 1 for r in got)
    wrong = [r for r in held if r["predicted"] != (r["doc_id"] % 5 == 0)]
    assert len(wrong) <= 2


def test_labels_of_held_out_rows_are_not_used(spark):
    docs, labels = corpus(spark, 200)
    rows = [(r["doc_id"], r["quality"], 1 - r["toxic"] if r["doc_id"] is not None and r["toxic"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 else r["toxic"]) for r in labels.collect()]
    a = {r["doc_id"]: r["score"] for r in score_toxicity(docs, labels).collect()}
    b = {r["doc_id"]: r["score"] for r in score_toxicity(docs, spark.createDataFrame(rows, LABELS)).collect()}
    assert a == b


def brute_match(terms, word):
    found = []
    for t, term in enumerate(terms):
        if word.startswith(term):
            found.append((0, -len(term), t))
        elif word[0] == term[0] and distance(word, term) <= edits_allowed(term):
            found.append((distance(word, term), -len(term), t))
    return min(found)[:1] if found else None


def test_automaton_equals_brute_force():
    rng = random.Random(5)
    terms = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(3, 11))) for _ in range(40)})
    lexicon = FuzzyLexicon(terms)
    lexicon.STATES = 500  # also when the table is emptied on the way
    for _ in range(6000):
        w = list(rng.choice(terms)) if rng.random() < 0.7 else [rng.choice("abc") for _ in range(rng.randint(1, 12))]
        for _ in range(rng.randint(0, 3)):
            p, o = rng.randrange(len(w)), rng.random()
            if o < 0.3 and len(w) > 1:
                w.pop(p)
            elif o < 0.6:
                w.insert(p, rng.choice("abcd"))
            else:
                w[p] = rng.choice("abcd")
        word = "".join(w)
        got, want = lexicon.match(word), brute_match(terms, word)
        if want is None or want[0] > 0:
            assert (got and (got[1],)) == want or (got and got[1] == 0), (word, got, want)
        if want and want[0] == 0:
            assert got[1] == 0 and word.startswith(terms[got[0]])


def test_context():
    reader = Reader(FuzzyLexicon(["idiot", "worthless"]))
    assert reader.read('you worthless idoit')["plain"] and reader.read("you idiot")["addressed"] == 1
    assert reader.read("an idiot and worthless")["clustered"] == 2
    for quoted in ('she wrote “idiot” there', 'the "idiot" here', "he said idiot once", '"what an idiot this is"'):
        r = reader.read(quoted)
        assert r["quoted"] and not r["plain"], quoted
    assert reader.read('"closed" before an idiot here')["plain"]
    assert reader.read(None)["hits"] == 0 and reader.read("")["words"] == 0


def test_pick_terms_takes_the_longest_that_keeps_its_rows():
    rows = [("idi", 100, 5.0), ("idio", 100, 5.0), ("idiot", 99, 6.0), ("veq", 50, 4.0), ("vequ", 50, 5.0), ("vequo", 20, 5.0), ("vequa", 20, 5.0)]
    assert pick_terms(rows) == ["idiot", "vequ"]


def test_odd_rows(spark):
    _, labels = corpus(spark, 100)
    docs = odd_docs(spark, ["an idiot here", "fine words"])
    got = score_toxicity(docs, labels)
    assert got.count() == docs.count() and got.filter("score is null or predicted is null or held_out is null").count() == 0
    assert score_toxicity(docs, labels.limit(0)).count() == docs.count()
    assert score_toxicity(empty_docs(spark), labels).count() == 0
    assert fit(docs, labels.filter("toxic = 0")).terms == []


def swapped_distance(a, b):
    """Edit distance in which a swap of neighbours is one edit and changes nothing else."""
    d = [[max(i, j) if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_whole_automaton_equals_brute_force():
    rng = random.Random(6)
    terms = sorted({"".join(rng.choice("abcd") for _ in range(rng.randint(3, 11))) for _ in range(30)})
    lexicon = WholeLexicon(terms)
    lexicon.STATES = 500
    for _ in range(1500):
        w = list(rng.choice(terms)) + [rng.choice("abcd") for _ in range(rng.choice([0, 0, 1, 3]))]
        for _ in range(rng.randint(0, 3)):
            p = rng.randrange(len(w))
            w[p:p + 2] = rng.choice([w[p:p + 2][::-1], [rng.choice("abcde"), *w[p + 1:p + 2]], w[p + 1:p + 2], [rng.choice("abcde"), *w[p:p + 2]]])
            w = w or ["a"]
        word = "".join(w)
        found = []
        for t, term in enumerate(terms):
            for n in range(1, len(word) + 1):
                e = swapped_distance(word[:n], term)
                if e <= WholeLexicon.allowed(term):
                    found.append((e if n == len(word) or not e else e + 2, -len(term), t))
        want = min(found) if found else None
        assert lexicon.match(word) == (want and (want[2], want[0])), (word, want)


def test_every_kind_of_misspelling_alone(spark):
    docs, labels = corpus(spark)
    model = fit(docs, labels)
    alone = ["mdiot", "diot", "iidiot", "id1ot", "1diot", "i*iot", "idoit", "diiot", "idot", "idiiot", "scvm", "scmu", "sc*m", "worhtless", "wrothles", "w0rthl3ss", "idoits", "worhtlessness"]
    rows = [(i, f"w1 w2 w3 {w} w4 w5", "en", "s", 1) for i, w in enumerate(alone)] + [(99, "w1 w2 w3 decent w4 w5", "en", "s", 1)]
    got = {r["doc_id"]: r["hits"] for r in score_toxicity(spark.createDataFrame(rows, DOC_SCHEMA), labels, model).collect()}
    assert [w for i, w in enumerate(alone) if got[i] != 1] == [] and got[99] == 0
