"""Near-duplicate documents by DartMinHash signatures and banded joining.

A document is the weighted set of its five-word shingles, the weight being the number of
occurrences. DartMinHash throws darts, placed by hashes alone, into the region of each
element: its weight (unit cells) times the rank axis (slabs). The number of darts in a
cell is Poisson in its area; each dart hits one of the signature's coordinates, which
keeps its earliest dart. Slabs are opened in order of rank until every coordinate has a
dart, so the work follows the length of the document plus the signature's, not their
product. Two documents agree in a coordinate with probability equal to their weighted
Jaccard similarity.

Texts that are equal word for word form one class at once and go on as one row. Rows that
agree in a band share a bucket. Nothing is emitted per pair of a bucket: members are first
compared with one leader, those not linked with a leader of the bucket's largest part, and
only what is still apart in a bucket is compared part against part, without a cap: in
small buckets pair by pair, in large ones (families of texts that are all alike, but less
than the threshold asks) block against block, by counting common shingles of many texts at
once and giving out no more links than connect them. Every pair is judged on whole texts;
classes are the connected parts.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.text import ChunkCache, release
from tidemark.session import ensure_checkpoint_dir

SHINGLE_WORDS = 5
SIMILARITY = 0.8
COORDINATES = 96
BANDS = 24
# At similarity 0.8 a signature agrees in 76.8 of 96 places on average with a deviation of
# 3.9; pairs below this agreement (six deviations) are not looked at further.
LEAST_AGREEMENT = 52
# Buckets with more rows that are still apart are compared in blocks of so many rows and
# shingles at most (a row may have more by itself).
PAIR_ROWS = 32
BLOCK_ROWS = 1024
BLOCK_SHINGLES = 4_000_000

_MULT = np.uint64(0x9E3779B97F4A7C15)
_POLY = np.uint64(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambling (the finaliser of the public splitmix64 generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def _poisson_cdf(area: float) -> np.ndarray:
    out, term, total, i = [], float(np.exp(-area)), 0.0, 0
    while term > 1e-19 or i < area:
        total += term
        out.append(total)
        i += 1
        term *= area / i
    return np.array(out)


_CDF = {area: _poisson_cdf(area) for area in (1 / 16, 3 / 16, 3 / 4, 1.0)}
_FIRST_SLABS = ((0.0, 1 / 16), (1 / 16, 3 / 16), (1 / 4, 3 / 4))

_WORD_HASHES = ChunkCache(lambda w: xxhash.xxh64_intdigest(w), limit=400_000)


def elements(norm: str) -> np.ndarray:
    """One 64-bit element for each shingle occurrence: the n-th occurrence of a shingle has
    an element of its own, so common elements of two documents count weighted overlap.
    Texts of one to four words have one shingle of all words; a text without words none."""
    words = norm.split(" ") if norm else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_WORD_HASHES.__getitem__, words), np.uint64, len(words))
    span = min(SHINGLE_WORDS, len(h))
    n = len(h) - span + 1
    s = h[:n].copy()
    for j in range(1, span):
        s = s * _POLY + h[j:j + n]
    s = np.sort(mix(s + np.uint64(span)))
    first = np.concatenate(([True], s[1:] != s[:-1]))
    at = np.arange(n)
    copy = at - np.maximum.accumulate(np.where(first, at, 0))
    return mix(s + copy.astype(np.uint64) * _MULT) if copy.any() else mix(s)


def dart_minhash(e: np.ndarray, k: int = COORDINATES) -> np.ndarray:
    """The signature of a non-empty element set: per coordinate the 32-bit name of its
    earliest dart."""
    best_rank, best_name = np.full(k, np.inf), np.zeros(k, np.uint32)
    step, unit = 0, 1
    while True:
        if step < len(_FIRST_SLABS):
            low, area = _FIRST_SLABS[step]
            lows, slab = np.array([low]), np.array([step], np.uint64)
        else:
            count = max(1, -(-4 * k // len(e)))
            lows = np.arange(unit, unit + count, dtype=np.float64)
            slab, area = np.arange(unit + 8, unit + 8 + count).astype(np.uint64), 1.0
            unit += count
        step += 1
        cells = mix(e[:, None] + (slab[None, :] + np.uint64(1)) * _POLY).ravel()
        u, cdf = _unit(cells), _CDF[area]
        hit = np.flatnonzero(u >= cdf[0])
        if len(hit):
            darts = np.searchsorted(cdf, u[hit], side="right")
            cell = np.repeat(hit, darts)
            number = np.arange(len(cell)) - np.repeat(np.cumsum(darts) - darts, darts)
            d = mix(cells[cell] + (number.astype(np.uint64) + np.uint64(1)) * _MULT)
            coordinate = (d % np.uint64(k)).astype(np.int64)
            d = mix(d)
            rank = lows[cell % len(lows)] + area * _unit(d)
            order = np.lexsort((rank, coordinate))
            c = coordinate[order]
            keep = order[np.concatenate(([True], c[1:] != c[:-1]))]
            better = keep[rank[keep] < best_rank[coordinate[keep]]]
            best_rank[coordinate[better]] = rank[better]
            best_name[coordinate[better]] = (d[better] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        # a dart in a later slab has a later rank: a full signature is final
        if np.isfinite(best_rank).all():
            return best_name


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    rows = signature.reshape(bands, -1).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64) * _MULT
    for j in range(rows.shape[1]):
        key = mix(key ^ rows[:, j]) * _POLY
    return key.view(np.int64)


def word_text(text: Column) -> Column:
    """Lower-case words with one space between them; null and wordless texts give ''."""
    return F.trim(F.lower(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[^\p{L}\p{M}\p{N}]+", " ")))


def text_key(norm: Column) -> Column:
    return F.unhex(F.md5(norm))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sizes, names, bands = [], [], []
        for norm in b.column("norm"):
            e = elements(norm.as_py())
            sizes.append(len(e))
            if len(e):
                s = dart_minhash(e)
                names.append((s & np.uint32(255)).astype(np.uint8).tobytes())
                bands.append(band_keys(s))
            else:
                names.append(b"")
                bands.append(np.empty(0, np.int64))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("key"), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()),
             pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "key", "n", "sig", "bands"])
    release(_WORD_HASHES)


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = np.frombuffer(b"".join(b.column("sa").to_pylist()), np.uint8).reshape(-1, COORDINATES)
        y = np.frombuffer(b"".join(b.column("sb").to_pylist()), np.uint8).reshape(-1, COORDINATES)
        yield b.select(["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= LEAST_AGREEMENT))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: OrderedDict[bytes, np.ndarray] = OrderedDict()

    def of(key: bytes, norm: pa.Scalar) -> np.ndarray:
        if key not in known:
            known[key] = elements(norm.as_py())
            if len(known) > 64:
                known.popitem(last=False)
        known.move_to_end(key)
        return known[key]

    for b in batches:
        keep = []
        for a, key, ta, tb in zip(b.column("a").to_pylist(), b.column("b").to_pylist(), b.column("ta"), b.column("tb"), strict=True):
            x, y = of(a, ta), of(key, tb)
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(common >= SIMILARITY * (len(x) + len(y) - common) - 1e-9)
        yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    release(_WORD_HASHES)


def _linked(pairs: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose texts are similar."""
    p = (pairs.join(reps.select(F.col("key").alias("a"), F.col("sig").alias("sa"), F.col("n").alias("na")), "a")
         .join(reps.select(F.col("key").alias("b"), F.col("sig").alias("sb"), F.col("n").alias("nb")), "b")
         .filter(F.least("na", "nb") >= SIMILARITY * F.greatest("na", "nb"))
         .mapInArrow(_agreeing, "a binary, b binary"))
    return (p.join(texts.select(F.col("key").alias("b"), F.col("norm").alias("tb")), "b")
            .join(texts.select(F.col("key").alias("a"), F.col("norm").alias("ta")), "a")
            .select("a", "b", "ta", "tb").mapInArrow(_verified, "a binary, b binary"))


def connected(links: DataFrame) -> DataFrame:
    """``key, part`` for every key of the links (a, b): the smallest key of its connected
    part. Labels are passed along the links and shortened until nothing changes."""
    both = links.select("a", "b").union(links.select("b", "a")).distinct().checkpoint()
    label = both.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("m")).select("key", F.least("key", "m").alias("part")).checkpoint()
    while True:
        near = (both.join(label.select(F.col("key").alias("b"), "part"), "b")
                .groupBy(F.col("a").alias("key")).agg(F.min("part").alias("m")))
        step = label.join(near, "key").select("key", F.least("part", "m").alias("part"), F.col("part").alias("old"))
        jump = label.select(F.col("key").alias("part"), F.col("part").alias("far"))
        new = (step.join(jump, "part", "left")
               .select("key", F.least("part", "far").alias("part"), "old").checkpoint())
        if new.filter(F.col("part") != F.col("old")).isEmpty():
            return new.select("key", "part")
        label = new.select("key", "part")


def _star_labels(active: DataFrame, links: DataFrame) -> DataFrame:
    """Bucket members with a label that only linked keys share: the smallest neighbour's
    smallest neighbour. Keys of one connected part may still differ; that costs some
    comparisons and no link."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    one = both.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("m")).select("key", F.least("key", "m").alias("part"))
    two = one.join(one.select(F.col("key").alias("part"), F.col("part").alias("up")), "part", "left")
    two = two.select("key", F.coalesce("up", "part").alias("part"))
    return active.join(two, "key", "left").select("bucket", "key", F.coalesce("part", "key").alias("part"))


def _divided(labelled: DataFrame) -> DataFrame:
    """Members of the buckets that still hold more than one part."""
    split = labelled.groupBy("bucket").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo <> hi")
    return labelled.join(split.select("bucket"), "bucket", "left_semi")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the numbers of common elements of every two sets."""
    m = len(sets)
    out = np.zeros((m, m), np.float32)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    values = np.concatenate(sets) if m else np.empty(0, np.uint64)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.empty(0, np.int64)
    holders = np.diff(np.append(first, len(values)))
    for d in np.unique(holders[holders > 1]).tolist():
        at = first[holders == d]
        step = max(1, 4_000_000 // (d * d)) if d <= 64 else 2048
        for i in range(0, len(at), step):
            rows = owner[at[i:i + step, None] + np.arange(d)]
            if d <= 64:  # rare elements pair by pair
                cells = (rows[:, :, None] * m + rows[:, None, :]).ravel()
                out += np.bincount(cells, minlength=m * m).reshape(m, m).astype(np.float32)
            else:  # common ones as a product of matrices
                held = np.zeros((m, len(rows)), np.float32)
                held[rows.T, np.arange(len(rows))] = 1
                out += held @ held.T
    return out


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the symmetric matrix connects, fewer than its rows."""
    todo, out = np.ones(len(linked), bool), []
    for root in range(len(linked)):
        if not todo[root]:
            continue
        todo[root] = False
        work = [root]
        while work:
            x = work.pop()
            new = np.flatnonzero(linked[x] & todo)
            todo[new] = False
            out += [(x, y) for y in new.tolist()]
            work += new.tolist()
    return out


def _block_links(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) that connect, in every bucket, the members (bucket, key, part, size,
    shingles) of different parts that are similar."""
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK_ROWS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("long")
    rows = members.withColumn("blocks", blocks).withColumn("mine", F.pmod(F.xxhash64("key"), F.col("blocks")))
    # a row meets every block, its own included, in one task each
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)"))).select(
        "bucket", "key", "part", "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    rows = rows.join(texts, "key")

    def compare(table: pa.Table) -> pa.Table:
        sets = [elements(t.as_py()) for t in table.column("norm")]
        keys, part, mine = (table.column(c).to_pylist() for c in ("key", "part", "mine"))
        n = np.array([len(s) for s in sets], np.float32)
        common = common_counts(sets)
        linked = common >= SIMILARITY * (n[:, None] + n[None, :] - common) - 1e-3
        number = np.unique(np.array([p.hex() for p in part]), return_inverse=True)[1]
        linked &= number[:, None] != number[None, :]
        if table.column("i")[0] != table.column("j")[0]:
            linked &= np.array(mine)[:, None] != np.array(mine)[None, :]
        out = _forest(linked)
        return pa.table({"a": pa.array([keys[x] for x, _ in out], pa.binary()), "b": pa.array([keys[y] for _, y in out], pa.binary())})

    return rows.groupBy("bucket", "i", "j").applyInArrow(compare, "a binary, b binary")


def near_classes(docs: DataFrame) -> DataFrame:
    """``doc_id, key, class_id, copies, class_size, kept`` for every row of ``docs``
    (``doc_id``, ``text``; other columns are not read).

    Rows are in one class if a chain of texts joins them of which neighbours have a weighted
    shingle similarity of 0.8 or more. ``class_id`` is the smallest doc_id of the class and
    null if all are null; ``key`` is the digest of the row's words, ``copies`` the number
    of rows with these words, ``class_size`` the rows of the class; ``kept`` holds for the
    rows with that doc_id and the smallest key among them. Texts that are null, empty or
    without words are copies of each other. Repeated rows are copies and all are returned.
    An empty table gives no rows.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), word_text(F.col("text")).alias("norm"))
    rows = rows.withColumn("key", text_key(F.col("norm")))
    signed = rows.mapInArrow(_signatures, "doc_id long, key binary, n long, sig binary, bands array<long>").checkpoint()
    counts = signed.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    reps = signed.select("key", "n", "sig", "bands").dropDuplicates(["key"]).join(counts, "key").checkpoint()

    buckets = reps.filter("n > 0").select("key", F.explode("bands").alias("bucket"))
    leaders = buckets.groupBy("bucket").agg(F.min("key").alias("lead"), F.max("key").alias("last")).filter("lead <> last")
    active = buckets.join(leaders.select("bucket", "lead"), "bucket").checkpoint()
    needed = reps.join(active.select("key").distinct(), "key", "left_semi").select("key", "rep")
    texts = (rows.join(needed.withColumnRenamed("key", "want"), F.col("doc_id").eqNullSafe(F.col("rep")))
             .filter(F.col("key") == F.col("want")).select("key", "norm").dropDuplicates(["key"]).checkpoint())

    tested = _ordered(active.filter("key <> lead").select(F.col("lead").alias("x"), F.col("key").alias("y"))).checkpoint()
    links = _linked(tested, reps, texts).checkpoint()
    members = active.select("bucket", "key")

    # a leader from the largest part of each bucket, another one in each bucket
    apart = _divided(_star_labels(members, links)).checkpoint()
    if not apart.isEmpty():
        parts = apart.groupBy("bucket", "part").agg(
            F.count("*").alias("size"), F.min(F.struct(F.xxhash64("key", "bucket").alias("h"), "key")).alias("some"))
        lead = parts.groupBy("bucket").agg(F.max(F.struct("size", "part", F.col("some.key").alias("lead"))).alias("top"))
        pairs = (apart.join(lead.select("bucket", F.col("top.part").alias("big"), F.col("top.lead").alias("x")), "bucket")
                 .filter("part <> big").select("x", F.col("key").alias("y")))
        pairs = _ordered(pairs).join(tested, ["a", "b"], "left_anti").checkpoint()
        links = links.union(_linked(pairs, reps, texts)).checkpoint()
        tested = tested.union(pairs)
        # whatever is still apart: part against part
        apart = _divided(members.join(connected(links), "key", "left")
                         .select("bucket", "key", F.coalesce("part", "key").alias("part"))).checkpoint()
        sized = apart.join(reps.select("key", "n"), "key")
        size = sized.groupBy("bucket").agg(F.count("*").alias("size"), F.sum("n").alias("shingles"))
        sized = sized.join(size, "bucket").checkpoint()
        small = sized.filter(F.col("size") <= PAIR_ROWS)
        pairs = (small.select("bucket", F.col("key").alias("x"), F.col("part").alias("px"))
                 .join(small.select("bucket", F.col("key").alias("y"), F.col("part").alias("py")), "bucket")
                 .filter("px < py").select("x", "y"))
        pairs = _ordered(pairs).join(tested, ["a", "b"], "left_anti")
        links = links.union(_linked(pairs, reps, texts)).union(_block_links(sized.filter(F.col("size") > PAIR_ROWS), texts)).checkpoint()

    part = connected(links)
    owners = reps.select("key", "rep", "copies").join(part, "key", "left").withColumn("part", F.coalesce("part", "key"))
    least = owners.groupBy("part").agg(
        F.min("rep").alias("class_id"), F.sum("copies").alias("class_size"),
        F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "key")).alias("first"))
    info = owners.join(least, "part").select("key", "copies", "class_id", "class_size", F.col("first.key").alias("first"))
    return (signed.select("doc_id", "key").join(info, "key")
            .select("doc_id", "key", "class_id", "copies", "class_size",
                    ((F.col("key") == F.col("first")) & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept")))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with one row left of each near-duplicate class:
    that with the smallest doc_id. Of repeated equal rows one stays."""
    kept = (near_classes(docs).filter("kept").select(F.col("doc_id").alias("kept_id"), F.col("key").alias("kept_key"))
            .distinct())
    names = docs.columns
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
                        F.col("doc_id").cast("long").alias("kept_id"), text_key(word_text(F.col("text"))).alias("kept_key"))
    kept = kept.select(F.coalesce("kept_id", F.lit(0)).alias("kept_id"), F.col("kept_id").isNull().alias("no_id"), "kept_key")
    keyed = keyed.select("row", F.coalesce("kept_id", F.lit(0)).alias("kept_id"), F.col("kept_id").isNull().alias("no_id"), "kept_key")
    on = ["kept_id", "no_id", "kept_key"]
    return keyed.join(kept, on).dropDuplicates(on).select("row.*")
