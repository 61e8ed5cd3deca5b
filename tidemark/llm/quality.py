"""Quality filter by importance resampling with hashed n-gram models.

Two bag-of-n-grams models over hashed buckets are counted: one of the target text (rows
labelled good) and one of the raw text (all rows). A document's importance weight is the
ratio of its probabilities under the two, and resampling without replacement in proportion
to the weights is the Gumbel top-k: each log weight gets Gumbel noise of its own and the k
largest are taken.

The n-grams are words, word pairs, and the shapes of three tokens in a row (case, digits,
marks, a repeat of the token before), so that layout counts as well as vocabulary. The
weight is per n-gram (the mean log ratio times ``SHARPNESS``), so that length alone
neither selects nor rejects. k is the number of rows that the same noisy weights place on
the good side of the cut that parts the labelled rows best.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.near_dedup import mix
from tidemark.llm.text import ChunkCache, first_by_hash, release, slices_at_space
from tidemark.session import ensure_checkpoint_dir

BUCKETS = 1 << 14
LABEL_ROWS = 20_000  # labelled rows that the target model and the cut are fitted on
SHARPNESS = 200.0
SMOOTHING = 1.0
PRIOR = 0.1  # raw counts mixed into the target's, as a share of the target's own
SEED = 17

_LETTERS = re.compile(r"[^\W\d_]+")
_MARKS = re.compile(r"[^\w\s]+")
_P = np.uint64(0xC2B2AE3D27D4EB4F)
_SHAPES = 16


def shape(chunk: str) -> int:
    """Layout class of a white-space-separated chunk, 0 to 15: case of its letters (none,
    lower, capital, upper) and what else it holds (nothing, closing point or comma,
    digits, other marks)."""
    letters = "".join(_LETTERS.findall(chunk))
    if not letters:
        case = 0
    elif len(letters) > 1 and letters.isupper():
        case = 3
    else:
        case = 2 if letters[0].isupper() else 1
    rest = _LETTERS.sub("", chunk)
    if not rest:
        other = 0
    elif rest in (".", ","):
        other = 1
    else:
        other = 2 if any(c.isdigit() for c in rest) and not _MARKS.search(rest.strip(".,")) else 3
    return case * 4 + other


def _chunk_code(chunk: str) -> int:
    """Word hash in the upper bits, shape in the lower four."""
    word = "".join(_LETTERS.findall(chunk)).lower() or chunk
    return (xxhash.xxh64_intdigest(word) & ~0xF) | shape(chunk)


_CODES = ChunkCache(_chunk_code)


def end_of_task() -> None:
    """A function of the module, since what a nested one names is sent to the worker as a copy."""
    release(_CODES)


def ngram_buckets(text: str | None) -> np.ndarray:
    """Buckets of all n-grams of a text; a text without words has none."""
    out = []
    tail = np.empty(0, np.uint64)
    for part in slices_at_space(text or ""):
        chunks = part.split()
        codes = np.concatenate([tail, np.fromiter(map(_CODES.__getitem__, chunks), np.uint64, len(chunks))])
        old, n = len(tail), len(codes)
        if n == old:
            continue
        shapes, words = codes & np.uint64(15), codes >> np.uint64(4)
        repeat = np.concatenate(([False], words[1:] == words[:-1])) if n else np.empty(0, bool)
        marked = shapes + np.uint64(_SHAPES) * repeat.astype(np.uint64)
        pieces = [mix(words[old:] + np.uint64(1))]
        if n > 1:
            pieces.append(mix(words[:-1] * _P + words[1:])[max(old - 1, 0):])
            pieces.append(mix(marked[:-1] * np.uint64(64) + marked[1:] + (np.uint64(1) << np.uint64(40)))[max(old - 1, 0):])
        if n > 2:
            pieces.append(mix((marked[:-2] * np.uint64(64) + marked[1:-1]) * np.uint64(64) + marked[2:]
                              + (np.uint64(1) << np.uint64(41)))[max(old - 2, 0):])
        out += [p % np.uint64(BUCKETS) for p in pieces]
        tail = codes[-3:]  # the first one only tells whether the next repeats it
    return np.concatenate(out).astype(np.int64) if out else np.empty(0, np.int64)


def labelled_sample(labels: DataFrame, column: str, rows: int = LABEL_ROWS) -> DataFrame:
    """``label_id, label`` of at most ``rows`` labelled rows: all, or those first by a hash of
    the id; of several labels of an id the smallest counts. Rows with a null id or label
    are left out."""
    one = (labels.filter(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
           .groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.min(F.col(column).cast("int")).alias("label")))
    return first_by_hash(one, F.xxhash64("label_id"), [(F.lit(True), rows)])


def count_models(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n-gram counts by bucket over all rows, over the good and over the bad labelled rows.

    Every task counts its rows into arrays of fixed size; the sums go to the driver."""
    rows = docs.select(F.col("doc_id").cast("long").alias("label_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(F.broadcast(labels), "label_id", "left").select("text", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, BUCKETS), np.int64)
        for b in batches:
            for text, label in zip(b.column("text"), b.column("label").to_pylist(), strict=True):
                c = np.bincount(ngram_buckets(text.as_py()), minlength=BUCKETS)
                total[0] += c
                if label is not None:
                    total[1 if label == 1 else 2] += c
        end_of_task()
        seen = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(seen), *[pa.array(t[seen]) for t in total]], names=["bucket", "raw", "good", "bad"])

    sums = rows.mapInArrow(run, "bucket long, raw long, good long, bad long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    out = np.zeros((3, BUCKETS))
    for r in sums.collect():  # at most BUCKETS rows
        out[:, r["bucket"]] = r["raw"], r["good"], r["bad"]
    return out[0], out[1], out[2]


def log_ratios(raw: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Per bucket: log probability in the target model minus that in the raw model. The
    target model is mixed with the raw one in a share that doesn't depend on the size, so a
    bucket that the target lacks weighs so much and no more."""
    base = (raw + SMOOTHING) / (raw + SMOOTHING).sum()
    mass = PRIOR * good.sum() + SMOOTHING
    target = (good + mass * base) / (good.sum() + mass)
    return np.log(target / base)


def weight_column(text: Column, ratios: np.ndarray) -> Column:
    """The log weight of a text: the mean log ratio of its n-grams times ``SHARPNESS``; 0 for
    a text without words."""
    @F.arrow_udf("double")
    def log_weight(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = np.zeros(len(texts))
            for i, t in enumerate(texts):
                x = ngram_buckets(t.as_py())
                if len(x):
                    out[i] = SHARPNESS * float(ratios[x].sum()) / len(x)
            yield pa.array(out)
        end_of_task()

    return log_weight(text.cast("string"))


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Standard Gumbel noise that depends on the seed and the id alone."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id), 11).cast("double") + 0.5) / F.lit(float(2 ** 53))
    return -F.log(-F.log(u))


def kth_largest(values: DataFrame, column: str, k: int, bins: int = 4096, exact: int = 10_000) -> float:
    """The k-th largest value of a materialised column, found by counting in ever finer bins;
    at most ``bins`` counts or ``exact`` values come to the driver."""
    x = F.col(column)
    lo, hi, n = values.agg(F.min(x), F.max(x), F.count(x)).first()
    if k >= n:
        return lo
    inside, wanted = values.select(x.alias("v")), k
    while True:
        if lo == hi:
            return lo
        if n <= exact:
            return sorted((r[0] for r in inside.collect()), reverse=True)[wanted - 1]
        width = (hi - lo) / bins
        at = F.least(F.floor((F.col("v") - lo) / width), F.lit(bins - 1))
        counts = {r["b"]: r for r in inside.groupBy(at.alias("b")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()}
        for b in sorted(counts, reverse=True):
            if counts[b]["n"] >= wanted:
                break
            wanted -= counts[b]["n"]
        lo, hi, n = counts[b]["lo"], counts[b]["hi"], counts[b]["n"]
        inside = inside.filter(F.col("v").between(lo, hi))


def best_cut(labelled: list[tuple[float, int]]) -> float:
    """The weight that parts good from bad labelled rows with the best mean of both shares,
    in the middle of its gap; minus infinity unless both kinds are there."""
    good = np.sort([w for w, y in labelled if y == 1])
    bad = np.sort([w for w, y in labelled if y != 1])
    if not len(good) or not len(bad):
        return float("-inf")
    at = np.unique(np.concatenate([good, bad]))
    share = (len(good) - np.searchsorted(good, at)) / len(good) + np.searchsorted(bad, at) / len(bad)
    best = int(np.argmax(share))
    return float((at[best] + at[best - 1]) / 2) if best else float(at[0])


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float, DataFrame]:
    """The log ratios, the smallest noisy weight among the k chosen, and the materialised
    ``doc_id, log_weight, noisy``. With no good or no bad label every row is chosen."""
    ensure_checkpoint_dir(docs.sparkSession)
    sample = labelled_sample(labels, "quality").checkpoint()
    raw, good, _ = count_models(docs, sample)
    ratios = log_ratios(raw, good)
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), weight_column(F.col("text"), ratios).alias("log_weight"))
    scored = scored.withColumn("noisy", F.col("log_weight") + gumbel(F.col("doc_id"))).checkpoint()
    known = (scored.join(F.broadcast(sample), scored["doc_id"] == sample["label_id"])
             .groupBy("label_id").agg(F.min("log_weight").alias("w"), F.min("label").alias("y")))
    cut = best_cut([(r["w"], r["y"]) for r in known.collect()])  # at most LABEL_ROWS rows
    # k doesn't depend on the noise: which rows the k are does
    k = scored.filter(F.col("log_weight") >= cut).count()
    least = kth_largest(scored, "noisy", k) if k else float("inf")
    return ratios, least, scored


def selected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, log_weight, noisy, selected`` for every row of ``docs`` (``doc_id``,
    ``text``); see :func:`resample` for the rules."""
    _, least, scored = fit(docs, labels)
    return scored.withColumn("selected", F.col("noisy") >= least)


def resample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, among the k largest noisy log weights.

    Texts that are null, empty or without words have weight 0, as a text whose n-grams are
    as likely in either model. Rows with a null doc_id share one noise value, as repeated
    rows do; rows that tie with the k-th are all taken. Labels with a null id or value
    don't count; without good or bad labels nothing is rejected. Empty tables stay empty.
    """
    ratios, least, _ = fit(docs, labels)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       (weight_column(F.col("text"), ratios) + gumbel(F.col("doc_id").cast("long"))).alias("noisy"))
    return rows.filter(F.col("noisy") >= least).select("row.*")
