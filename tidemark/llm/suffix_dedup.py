"""Removal of repeated byte strings with suffix arrays of content-made shards.

Each string of ``length`` bytes has an anchor: the least hash among its ``GRAM``-byte
substrings. Equal strings have equal anchors, and neighbouring strings mostly share theirs,
so a document is a row of segments, one for each run of strings with one anchor. All
segments of an anchor make a shard, whose suffix array and common prefixes tell which
strings are equal. What is shuffled is made small in three steps, none of which loses a
string:

1. anchors that one document only has are left out (their hashes are counted, nothing else);
2. a segment that a document with a smaller id has in the same wording is removed as it
   stands, so only first wordings are compared further, and copies cost a row each;
3. anchors whose wordings all come from one document are left out, and the rest is cut
   anew by anchors of ``FINE_GRAM`` bytes, which hardly two texts share by chance; again
   those of one document are left out.

The bytes of the rest go to their shards. Shards are small strings, sorted thousands at a
time (:mod:`tidemark.llm.induced`). A fine anchor with more than ``SHARD_SEGMENTS`` segments
is not sorted in one place: its strings are grouped one by one by their own bytes, which is
exact too and leaves no group that grows with the table.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.induced import common_prefixes, ranges, suffix_arrays
from tidemark.session import checkpoint_path, delete_path

LENGTH = 50
GRAM, FINE_GRAM = 20, 34
SHARD_SEGMENTS = 64
RUN = 512             # strings in a segment, at most
BLOCK = 1 << 20       # bytes that are hashed at a time
SHARD_BYTES, SORT_BYTES = 512, 1 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# ``place``: 22 bits that tell rows of one doc_id from each other, the first byte, the number
# of strings
_TAG, _START, _COUNT = 41, 10, (1 << 10) - 1
_U = np.uint64


class RollingHash:
    """Hashes of all substrings of a block, from prefix sums of powers modulo 2^64."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 1 << 63, 256, np.uint64)
        base = int(rng.integers(1, 1 << 62)) * 2 + 1
        self.power, self.inverse = (np.full(BLOCK + 1, b, np.uint64) for b in (base, pow(base, -1, 1 << 64)))
        for p in (self.power, self.inverse):
            p[0] = 1
            np.cumprod(p, out=p)

    def sums(self, block: np.ndarray) -> np.ndarray:
        out = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(self.values[block] * self.power[:len(block)], out=out[1:])
        return out

    def between(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((sums[end] - sums[start]) * self.inverse[start])

    def grams(self, sums: np.ndarray, size: int) -> np.ndarray:
        n = len(sums) - size
        return mixed((sums[size:] - sums[:n]) * self.inverse[:n])


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _U(0x9E3779B97F4A7C15)
    h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


_HASHES: list[RollingHash] = []


def hashes() -> list[RollingHash]:
    """The anchors' and the segments' hash, made once a Python worker."""
    if not _HASHES:
        _HASHES.extend(RollingHash(s) for s in (11, 12))
    return _HASHES


def utf8(text: pa.StringScalar) -> bytes:
    return text.as_buffer().to_pybytes()


def text_tag(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little") >> 42


def least_of(h: np.ndarray, window: int) -> np.ndarray:
    """The least of each ``window`` neighbours."""
    size = 1
    while 2 * size <= window:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[:len(h) - (window - size)], h[window - size:]) if window > size else h


def segments_of(block: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(anchor, piece, first string, strings) of the segments of pieces of text, which lie
    at ``starts`` of the block."""
    anchors, _ = hashes()
    gram = min(gram, length)
    least = least_of(anchors.grams(anchors.sums(block), gram), length - gram + 1) >> _U(16)
    strings = np.maximum(sizes - length + 1, 0)
    at = ranges(starts, strings)
    piece = np.repeat(np.arange(len(starts)), strings)
    h = least[at]
    new = np.ones(len(at), bool)
    new[1:] = (h[1:] != h[:-1]) | (piece[1:] != piece[:-1])
    first = np.flatnonzero(new)
    run = np.diff(np.append(first, len(at)))
    if len(run) and run.max() > RUN:  # cut long runs, which repetitive text has
        parts = -(-run // RUN)
        cut = ranges(np.zeros(len(run), np.int64), parts) * RUN
        first, whole = np.repeat(first, parts) + cut, np.repeat(run, parts)
        run = np.minimum(whole - cut, RUN)
    return h[first], piece[first], at[first], run


def blocks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple]:
    """(bytes, starts, sizes, doc ids, tags, offsets in the text) of pieces of the texts,
    about ``BLOCK`` bytes together. Pieces of a long text overlap by a string but a byte."""
    data, rows, filled = [], [], 0

    def made() -> tuple:
        sizes = np.array([len(d) for d in data])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        ids, tags, offsets = (np.array(c, np.int64) for c in zip(*rows, strict=True))
        return np.frombuffer(b"".join(data), np.uint8), starts, sizes, ids, tags, offsets

    for b in batches:
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            text = utf8(text)
            tag = text_tag(text)
            for at in range(0, max(len(text) - length + 1, 1), BLOCK // 2):
                piece = text[at:at + BLOCK // 2 + length - 1]
                if filled + len(piece) > BLOCK and data:
                    yield made()
                    data, rows, filled = [], [], 0
                data.append(piece)
                rows.append((doc_id, tag, at))
                filled += len(piece)
    if data:
        yield made()


def repeated_anchors(texts: DataFrame, length: int) -> DataFrame:
    """``h`` of the anchors that more than one text has. A task names each anchor once a
    batch of texts, and twice if several texts of the batch have it; a text of several
    pieces may count as several, which costs work and changes nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, starts, sizes, *_ in blocks(batches, length):
            h, piece, _, _ = segments_of(block, starts, sizes, length)
            order = np.argsort(h, kind="stable")
            h, piece = h[order], piece[order]
            new = np.ones(len(h), bool)
            new[1:] = h[1:] != h[:-1]
            if len(h):
                first = np.flatnonzero(new)
                several = np.maximum.reduceat(piece, first) != piece[first]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([h[first], h[first][several]]).view(np.int64))], names=["h"])

    return texts.mapInArrow(run, "h long").groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")


def all_segments(texts: DataFrame, length: int) -> DataFrame:
    """``h, wording, doc_id, place`` of every segment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, starts, sizes, ids, tags, offsets in blocks(batches, length):
            h, piece, at, n = segments_of(block, starts, sizes, length)
            _, wordings = hashes()
            w = wordings.between(wordings.sums(block), at, at + n + length - 1)
            place = tags[piece] << _TAG | (at - starts[piece] + offsets[piece]) << _START | n
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(w.view(np.int64)), pa.array(ids[piece]), pa.array(place)],
                                             names=["h", "wording", "doc_id", "place"])

    return texts.mapInArrow(run, "h long, wording long, doc_id long, place long")


def _start(place):
    return F.shiftright(place, _START).bitwiseAND((1 << (_TAG - _START)) - 1)


def _tag(place):
    return F.shiftright(place, _TAG)


def fine_segments(rows: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """``h, doc_id, place, data``: the segments in ``rows`` (``doc_id, place``) cut anew by
    fine anchors, with their bytes. A document's segments come together as one row, so its
    text is read once."""
    per_doc = rows.groupBy("doc_id", _tag(F.col("place")).alias("tag")).agg(F.collect_list("place").alias("places"))
    wanted = texts.join(per_doc, "doc_id").select("doc_id", "tag", "places", "text")

    def cut(pieces: list[bytes], ids: list[np.ndarray], places: list[np.ndarray]) -> pa.RecordBatch:
        block = np.frombuffer(b"".join(pieces), np.uint8)
        sizes = np.array([len(p) for p in pieces])
        starts = np.cumsum(sizes) - sizes
        h, piece, at, n = segments_of(block, starts, sizes, length, FINE_GRAM)
        old = np.concatenate(places)[piece]
        start = (old >> _START & (1 << (_TAG - _START)) - 1) + at - starts[piece]
        spans = n + length - 1
        offsets = np.concatenate([[0], np.cumsum(spans)]).astype(np.int32)
        data = pa.BinaryArray.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(block[ranges(at, spans)])])
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.concatenate(ids)[piece]), pa.array(old >> _TAG << _TAG | start << _START | n), data],
                                          names=["h", "doc_id", "place", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, ids, places, filled = [], [], [], 0
        for b in batches:
            for doc_id, tag, segments, text in zip(*(b.column(i) for i in range(4)), strict=True):
                data = utf8(text)
                if text_tag(data) != tag.as_py():
                    continue  # another row of the same doc_id
                place = segments.values.to_numpy()
                for i in range(0, len(place), 1000):
                    part = place[i:i + 1000]
                    at, n = part >> _START & (1 << (_TAG - _START)) - 1, part & _COUNT
                    pieces += [data[a:a + m + length - 1] for a, m in zip(at.tolist(), n.tolist(), strict=True)]
                    ids.append(np.full(len(part), doc_id.as_py()))
                    places.append(part)
                    filled += int(n.sum()) + len(part) * (length - 1)
                    if filled > BLOCK // 4:  # the next thousand segments fit, too
                        yield cut(pieces, ids, places)
                        pieces, ids, places, filled = [], [], [], 0
        if pieces:
            yield cut(pieces, ids, places)

    return wanted.mapInArrow(run, "h long, doc_id long, place long, data binary")


def repeats_in_shards(h: np.ndarray, doc: np.ndarray, place: np.ndarray, data: pa.BinaryArray, length: int) -> tuple[np.ndarray, ...]:
    """(doc_id, tag, start, end) of the bytes whose strings a smaller doc_id has too, for the
    segments of whole anchors, sorted by anchor."""
    sizes = np.diff(np.frombuffer(data.buffers()[1], np.int32)[data.offset:data.offset + len(data) + 1]).astype(np.int64)
    # shards: whole anchors, until SHARD_BYTES are full; longest first
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    first = np.flatnonzero(new)
    begin = (np.cumsum(sizes + 1) - sizes - 1)[first]
    shard = np.repeat(begin // SHARD_BYTES, np.diff(np.append(first, len(h))))
    shard = np.cumsum(np.concatenate([[0], shard[1:] != shard[:-1]]))
    lengths = np.bincount(shard, weights=sizes + 1).astype(np.int64) + 1
    rank = np.empty(len(lengths), np.int64)
    rank[np.argsort(-lengths, kind="stable")] = np.arange(len(lengths))
    order = np.argsort(rank[shard], kind="stable")
    shard, sizes, doc, place, data = rank[shard][order], sizes[order], doc[order], place[order], data.take(pa.array(order))
    lengths = np.sort(lengths)[::-1]
    raw = np.frombuffer(data.buffers()[2], np.uint8, int(sizes.sum()))
    # bytes from 2, a 1 behind each segment and a 0 behind each shard
    at = np.cumsum(sizes + 1) - sizes - 1 + shard
    text = np.zeros(int(lengths.sum()), np.int32)
    text[ranges(at, sizes)] = raw.astype(np.int32) + 2
    text[at + sizes] = 1

    sa = suffix_arrays(text, lengths)
    prefix = common_prefixes(text, sa, lengths)
    strings = sizes - length + 1
    last = np.iinfo(np.int64).max
    owner = np.full(len(text), last)  # the document of each whole string
    owner[ranges(at, strings)] = np.repeat(doc, strings)
    group = np.flatnonzero(prefix[sa] < length)
    least = np.repeat(np.minimum.reduceat(owner[sa], group), np.diff(np.append(group, len(sa))))
    repeated = np.zeros(len(text) + 1, bool)
    repeated[sa] = (owner[sa] != last) & (owner[sa] > least)
    segment = np.zeros(len(text), np.int64)
    segment[ranges(at, strings)] = np.repeat(np.arange(len(sizes)), strings)
    # a byte that is no string's start lies between segments, so runs end with them
    edge = np.diff(repeated.astype(np.int8), prepend=np.int8(0))
    run, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    s = segment[run]
    start = (place[s] >> _START & (1 << (_TAG - _START)) - 1) + run - at[s]
    return doc[s], place[s] >> _TAG, start, start + (end - run) + length - 1


def shard_repeats(segments: DataFrame, length: int) -> DataFrame:
    """``doc_id, tag, start, end`` from the segments of shards of bounded size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def sort(table: pa.Table) -> pa.RecordBatch:
            c = [table.column(n).combine_chunks() for n in ("h", "doc_id", "place", "data")]
            found = repeats_in_shards(*(x.to_numpy() for x in c[:3]), c[3], length)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["doc_id", "tag", "start", "end"])

        size = 0
        for b in batches:
            for at in range(0, len(b), 4096):
                part = b.slice(at, 4096)
                kept.append(part)
                size += part.column(3).nbytes
                if size < SORT_BYTES:
                    continue
                table = pa.Table.from_batches(kept)
                h = table.column("h").to_numpy()
                done = int(np.searchsorted(h, h[-1]))  # the last anchor may go on
                if done:
                    yield sort(table.slice(0, done))
                rest = table.slice(done).combine_chunks()
                kept, size = rest.to_batches(), rest.column("data").nbytes
        if sum(map(len, kept)):
            yield sort(pa.Table.from_batches(kept))

    return (segments.select("h", "doc_id", "place", "data").repartition("h").sortWithinPartitions("h")
            .mapInArrow(run, "doc_id long, tag long, start long, end long"))


def string_repeats(segments: DataFrame, length: int) -> DataFrame:
    """``doc_id, tag, start, end`` from segments of common anchors, string by string."""
    strings = segments.select("doc_id", _tag(F.col("place")).alias("tag"), "data", _start(F.col("place")).alias("at"),
                              F.explode(F.expr(f"sequence(0, length(data) - {length})")).alias("i"))
    strings = strings.select("doc_id", "tag", (F.col("at") + F.col("i")).alias("start"), F.expr(f"substring(data, i + 1, {length})").alias("string"))
    first = strings.groupBy("string").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
    return (strings.join(first, "string").filter("doc_id > least")
            .select("doc_id", "tag", "start", (F.col("start") + length).alias("end")))


def spans(intervals: DataFrame) -> DataFrame:
    """``doc_id, tag, spans array<long>``: the union of each document's intervals, as start,
    end, start, end, ..."""
    per_doc = intervals.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "end")).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            merged = []
            for found in b.column(2):
                start, end = (found.values.field(i).to_numpy() for i in (0, 1))
                order = np.argsort(start, kind="stable")
                start, end = start[order], np.maximum.accumulate(end[order])
                new = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
                merged.append(np.column_stack([start[new], end[np.append(new[1:], len(end)) - 1]]).ravel())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(merged, pa.list_(pa.int64()))], names=["doc_id", "tag", "spans"])

    return per_doc.mapInArrow(run, "doc_id long, tag long, spans array<long>")


def several_documents(segments: DataFrame) -> DataFrame:
    """``h`` and number ``n`` of segments of the anchors that several documents have."""
    return (segments.groupBy("h").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count("*").alias("n"))
            .filter("a < b").select("h", "n"))


def _stored(spark: SparkSession, make: Callable[[], DataFrame], folder: str, name: str) -> DataFrame:
    """The table that ``make`` defines, read again from the shared folder. Its shuffle files
    are removed when it is written, not when the driver happens to collect its garbage:
    no other table is made from them."""
    path, before = f"{folder}/{name}", spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        make().write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.parquet(path)


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, tag, spans`` of the documents with repeated bytes, stored in the shared
    folder; ``tag`` is :func:`text_tag` of the text."""
    if length < 2:
        raise ValueError("the length must be 2 or more")
    spark: SparkSession = docs.sparkSession
    folder = checkpoint_path(spark, "suffix_dedup", uuid.uuid4().hex)
    texts = (docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
             .filter(f"doc_id is not null and octet_length(text) >= {length}"))
    place = F.col("place")

    def stored(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        return _stored(spark, make, folder, name)

    def compared() -> DataFrame:
        least = shared.groupBy("h", "wording").agg(F.min("doc_id").alias("least"))
        return shared.join(least, ["h", "wording"]).select("h", "doc_id", "place", (F.col("doc_id") > F.col("least")).alias("copy"))

    def wanted() -> DataFrame:
        firsts = known.filter("not copy")
        return fine_segments(firsts.join(several_documents(firsts).select("h"), "h").select("doc_id", "place"), texts, length)

    def found() -> DataFrame:
        copies = known.filter("copy").select("doc_id", _tag(place).alias("tag"), _start(place).alias("start"),
                                             (_start(place) + place.bitwiseAND(_COUNT) + (length - 1)).alias("end"))
        return spans(copies.unionByName(shard_repeats(segments.filter("not hot"), length))
                     .unionByName(string_repeats(segments.filter("hot"), length)))

    # what a table was made of goes once it is stored
    anchors = stored("anchors", lambda: repeated_anchors(texts, length))
    shared = stored("segments", lambda: all_segments(texts, length).join(anchors, "h", "left_semi"))
    delete_path(spark, f"{folder}/anchors")
    known = stored("known", compared)
    delete_path(spark, f"{folder}/segments")
    fine = stored("fine", wanted)
    segments = stored("bytes", lambda: fine.join(several_documents(fine).select("h", (F.col("n") > SHARD_SEGMENTS).alias("hot")), "h"))
    delete_path(spark, f"{folder}/fine")
    out = stored("spans", found)
    for name in ("known", "bytes"):
        delete_path(spark, f"{folder}/{name}")
    return out


def kept_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Every row of ``docs`` with ``n_bytes`` of the whole text, ``spans`` (the repeated
    bytes' starts and ends, null if none) and ``kept`` (the bytes that remain)."""
    found = repeated_spans(docs, length)
    per_doc = found.groupBy("doc_id").agg(F.collect_list(F.struct("tag", "spans")).alias("found"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.join(per_doc, "doc_id", "left").select("doc_id", "text", "found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 512):
                part = b.slice(at, 512)
                sizes, lists, kept = [], [], []
                for text, found in zip(part.column(1), part.column(2), strict=True):
                    whole, cuts = utf8(text), None
                    if found.is_valid:
                        tag = text_tag(whole)
                        cuts = next((f["spans"] for f in found.as_py() if f["tag"] == tag), None)
                    edges = [0, *(cuts or []), len(whole)]
                    sizes.append(len(whole))
                    lists.append(cuts)
                    kept.append(b"".join(whole[a:e] for a, e in zip(edges[::2], edges[1::2], strict=True)) if cuts else whole)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(lists, pa.list_(pa.int64())), pa.array(kept, pa.binary())],
                                                 names=["doc_id", "n_bytes", "spans", "kept"])

    return rows.mapInArrow(run, "doc_id long, n_bytes long, spans array<long>, kept binary")


def suffix_dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row of ``docs``: its bytes, how many of them a string of ``length`` bytes covers
    that also starts in a document with a smaller id, in how many runs, and the digest of
    the rest.

    Strings are judged on the input, not on what is left. A null text counts as empty. A row
    without an id keeps its text and is nobody's original; nor are rows with one id each
    other's. Equal rows give equal results. An empty table gives no rows. Other columns are
    not read.
    """
    kept = kept_bytes(docs, length)
    return kept.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
                       F.coalesce(F.size("spans") / 2, F.lit(0)).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
