"""Small tables with every odd row that the operators must take."""

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd_docs(spark, texts=()):
    """Texts given, and rows with nulls, empty texts, a long text, ties and repeated rows; with
    columns whose names the operators use themselves."""
    rows = [(i, t, "en", "s0", len(t or "")) for i, t in enumerate(texts)]
    long_text = " ".join(f"word{i % 977}" for i in range(30_000))
    rows += [(900, None, None, None, None), (901, "", "en", "s0", 0), (902, " \n ", "en", "s0", 3), (None, "no id here at all, one two three", "en", None, 1),
             (None, None, None, None, None), (903, "!!! ... ###", "en", "s0", 5), (904, long_text, "en", "s0", len(long_text)),
             (905, "the same row twice for all of us", "en", "s0", 1), (905, "the same row twice for all of us", "en", "s0", 1)]
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    for c in ("key", "norm", "row", "h1", "line", "bucket", "words", "sequence_id", "score", "label", "gone"):
        df = df.withColumn(c, df["lang"])
    return df


def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def invented(n, seed=0, vocabulary=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]
