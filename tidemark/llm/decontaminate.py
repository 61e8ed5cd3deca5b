"""Benchmark decontamination by spaced-seed hashing.

A seed is a mask over a window of words: the words at its places are hashed, those between
are ignored, so a window still hits when ignored words were substituted. The hashes of all
windows of the documents meet those of the benchmark items; each hit names a document, an
item and a shift between them, and along that shift the texts are compared word by word: a
stretch of 13 words or more (the whole item if that is shorter) counts if at least four of
five of its words are equal, wherever in it the others are. The masks miss no such stretch
(see :data:`MASKS`).

Everything here is DataFrame expressions. Texts are compared as words (lower case, without
marks); documents and items that are equal word for word are looked at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.near_dedup import text_key, word_text
from tidemark.llm.text import join_counted
from tidemark.session import ensure_checkpoint_dir

# Places of the masks in a window. Of any stretch of 13 words or more in which one word of
# five is substituted, wherever, a mask has all its words equal: every arrangement in 13 to
# 25 words was tried, and of a longer stretch one half has no larger share of substitutions.
MASKS = ((0, 1, 3, 4, 5, 6), (0, 1, 2, 4, 10, 11), (0, 1, 6, 8, 10, 12), (0, 2, 4, 9, 11, 12))
SPAN = 13
# The same for whole items of fewer words.
SHORT_MASKS = {
    5: ((0, 1, 2, 3), (0, 1, 2, 4), (0, 1, 3, 4), (0, 2, 3, 4)),
    6: ((0, 1, 2, 3, 4), (0, 1, 3, 4, 5), (0, 2, 3, 4, 5), (0, 1, 2, 3, 5), (0, 1, 2, 4, 5)),
    7: ((0, 1, 2, 3, 5), (0, 3, 4, 5, 6), (0, 1, 2, 5, 6)),
    8: ((0, 1, 2, 3, 4, 6), (0, 3, 4, 5, 6, 7), (0, 1, 2, 4, 5, 6)),
    9: ((0, 1, 2, 3, 4, 5, 6), (0, 1, 2, 3, 6, 7, 8), (0, 1, 3, 4, 5, 6, 7), (0, 1, 2, 3, 4, 5, 7)),
    10: ((0, 1, 3, 4, 5, 6), (0, 1, 2, 3, 6, 7), (0, 1, 3, 5, 7, 8), (0, 2, 4, 5, 7, 9), (0, 1, 4, 5, 7, 8)),
    11: ((0, 1, 2, 4, 5, 6), (0, 1, 3, 6, 7, 8), (0, 2, 3, 4, 6, 9), (0, 2, 7, 8, 9, 10)),
    12: ((0, 1, 2, 4, 5, 6, 7), (0, 1, 2, 3, 5, 8, 9), (0, 1, 3, 6, 7, 9, 10), (0, 1, 3, 4, 5, 6, 8), (0, 2, 5, 6, 7, 9, 11)),
}
LEAST_ITEM_WORDS = 5  # items with fewer words are no evidence
LEAST_WORDS = 13  # length of a verified overlap, or the whole item if that is shorter
SUBSTITUTION_COST = 4  # a stretch counts if at least 4 of 5 words agree


def _words(norm: Column) -> Column:
    return F.when(norm == "", F.array().cast("array<string>")).otherwise(F.split(norm, " "))


def _window_hash(offsets: tuple[int, ...]) -> str:
    """SQL: hash of the window at ``pos`` of ``wh`` under one mask, null where it doesn't fit."""
    places = ", ".join(f"wh[pos + {o}]" for o in offsets)
    return f"if(pos + {offsets[-1]} < size(wh), xxhash64('{offsets}', {places}), null)"


def _windows(rows: DataFrame, masks: list[tuple[int, ...]], keep: list[str]) -> DataFrame:
    """``hash, pos`` of every window under every mask, with the ``keep`` columns; ``rows``
    has ``words``."""
    hashed = rows.select(*keep, F.transform("words", lambda w: F.xxhash64(w)).alias("wh"))
    places = hashed.select(*keep, "wh", F.posexplode("wh").alias("pos", "own"))
    hashes = F.array(*[F.expr(_window_hash(m)) for m in masks])
    return places.select(*keep, "pos", F.explode(hashes).alias("hash")).filter(F.col("hash").isNotNull())


def _keyed(docs: DataFrame) -> DataFrame:
    norm = docs.select("doc_id", word_text(F.col("text")).alias("norm"))
    return norm.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("norm")).alias("key"), "norm")


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """``item_id, copies, words, n``: distinct items by their words, under the smallest id."""
    norm = benchmark.select(F.col("item_id").cast("long").alias("item_id"), word_text(F.col("text")).alias("norm"))
    one = norm.groupBy("norm").agg(F.min("item_id").alias("item_id"), F.count("*").alias("copies"))
    return (one.select("item_id", "copies", _words(F.col("norm")).alias("words"))
            .withColumn("n", F.size("words")).filter(F.col("n") >= LEAST_ITEM_WORDS))


def _best_stretch(flags: Column, least: Column) -> Column:
    """Struct (score, first, last, hits) of the stretch of at least ``least`` flags with the
    highest score, an equal word counting 1 and another one -SUBSTITUTION_COST; the first of
    equal ones. The score is -1 if no such stretch has four of five words equal."""
    behind = F.slice(F.concat(F.array_repeat(F.lit(None).cast("boolean"), least), flags), F.lit(1), F.size(flags))
    zero = F.struct(*[F.lit(v).alias(c) for c, v in (
        ("i", 0), ("head", 0), ("hit", 0), ("tail", 0), ("left", 0), ("low", 0), ("low_left", 0), ("start", 0),
        ("score", -1), ("first", 0), ("last", -1), ("hits", 0))])

    def step(s: Column, f: Column) -> Column:
        def worth(flag: Column) -> Column:
            return F.when(flag.isNull(), 0).when(flag, 1).otherwise(-SUBSTITUTION_COST)

        # sums up to this word, and up to where a stretch of the least length that ends here starts
        head, hit = s["head"] + worth(f["now"]), s["hit"] + f["now"].cast("int")
        tail, left = s["tail"] + worth(f["behind"]), s["left"] + F.coalesce(f["behind"].cast("int"), F.lit(0))
        lower = f["behind"].isNotNull() & (tail <= s["low"])
        low, low_left = F.when(lower, tail).otherwise(s["low"]), F.when(lower, left).otherwise(s["low_left"])
        start = F.when(lower, s["i"] + 1 - least).otherwise(s["start"])
        better = (s["i"] + 1 >= least) & (head - low > s["score"])
        return F.struct((s["i"] + 1).alias("i"), head.alias("head"), hit.alias("hit"), tail.alias("tail"), left.alias("left"),
                        low.alias("low"), low_left.alias("low_left"), start.alias("start"),
                        F.when(better, head - low).otherwise(s["score"]).alias("score"),
                        F.when(better, start).otherwise(s["first"]).alias("first"),
                        F.when(better, s["i"]).otherwise(s["last"]).alias("last"),
                        F.when(better, hit - low_left).otherwise(s["hits"]).alias("hits"))

    return F.aggregate(F.zip_with(flags, behind, lambda a, b: F.struct(a.alias("now"), b.alias("behind"))), zero, step)


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``key, item_id, copies, start, words, equal`` (materialised): for every distinct word
    text (``key``) its verified overlap with each item: the best stretch over all shifts,
    its first word in the document, its length and its equal words."""
    ensure_checkpoint_dir(docs.sparkSession)
    items = benchmark_items(benchmark).checkpoint()
    short = sorted(r["n"] for r in items.filter(F.col("n") < SPAN).select("n").distinct().collect())  # at most SPAN values
    by_hash = _windows(items.filter(F.col("n") >= SPAN), list(MASKS), ["item_id"])
    for n in short:
        by_hash = by_hash.union(_windows(items.filter(F.col("n") == n), list(SHORT_MASKS[n]), ["item_id"]))
    masks = sorted({*MASKS, *(m for n in short for m in SHORT_MASKS[n])})
    by_hash = by_hash.select("item_id", "pos", "hash").checkpoint()
    known = by_hash.select("hash").distinct().checkpoint()

    keyed = _keyed(docs)
    windows = _windows(keyed.select("key", _words(F.col("norm")).alias("words")), masks, ["key"])
    hits = join_counted(windows, known, "hash").select("key", "pos", "hash").distinct().checkpoint()
    seeded = by_hash.select("item_id", F.col("pos").alias("at"), "hash")
    shifts = hits.join(seeded, "hash").select("key", "item_id", (F.col("pos") - F.col("at")).alias("shift")).distinct().checkpoint()

    keys = shifts.select("key").distinct().checkpoint()
    texts = join_counted(keyed.select("key", "norm"), keys, "key").groupBy("key").agg(F.first("norm").alias("norm"))
    texts = texts.select("key", _words(F.col("norm")).alias("text_words")).checkpoint()
    aligned = join_counted(shifts.join(texts, "key"), items, "item_id")
    begin = F.greatest(F.col("shift"), F.lit(0))
    skip = begin - F.col("shift")
    length = F.least(F.size("text_words") - begin, F.col("n") - skip)
    aligned = aligned.select("key", "item_id", "copies", "n", begin.alias("begin"),
                             F.slice("text_words", begin + 1, length).alias("x"), F.slice("words", skip + 1, length).alias("y"))
    aligned = aligned.withColumn("least", F.least(F.lit(LEAST_WORDS), F.col("n"))).filter(F.size("x") >= F.col("least"))
    flagged = aligned.select("key", "item_id", "copies", "least", "begin", F.zip_with("x", "y", lambda a, b: a == b).alias("flags"))
    best = flagged.select("key", "item_id", "copies", "begin", _best_stretch(F.col("flags"), F.col("least")).alias("s"))
    words = F.col("s.last") - F.col("s.first") + 1
    found = best.filter(F.col("s.score") >= 0).select(
        "key", "item_id", F.struct(F.col("s.score").alias("score"), (-(F.col("begin") + F.col("s.first"))).alias("before"),
                                   words.alias("words"), F.col("s.hits").alias("equal"), "copies").alias("o"))
    return (found.groupBy("key", "item_id").agg(F.max("o").alias("o"))
            .select("key", "item_id", F.col("o.copies").alias("copies"), (-F.col("o.before")).alias("start"),
                    F.col("o.words").alias("words"), F.col("o.equal").alias("equal")).checkpoint())


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, item_copies, start, words, equal``: a row for every document row and
    distinct benchmark item with a verified overlap.

    Null, empty and wordless texts overlap nothing, nor do items of fewer than 5 words. Items
    that are equal word for word are one, under their smallest id, with their number.
    Repeated rows are all returned, with a null doc_id where it is null. Empty tables give
    no rows."""
    found = overlaps(docs, benchmark)
    return join_counted(_keyed(docs).select("doc_id", "key"), found, "key").select(
        "doc_id", "item_id", F.col("copies").alias("item_copies"), "start", "words", "equal")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, without a verified overlap with a benchmark item;
    see :func:`contaminated` for the rules."""
    keys = overlaps(docs, benchmark).select(F.col("key").alias("found_key")).distinct().checkpoint()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text_key(word_text(F.col("text"))).alias("found_key"))
    return join_counted(rows, keys, "found_key", "left_anti").select("row.*")
