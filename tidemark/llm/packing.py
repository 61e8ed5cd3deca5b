"""Harmonic packing of documents into fixed-capacity token sequences.

A document is cut into whole sequences and a rest; the rest stays in one piece. Rests are
in reciprocal-capacity classes: class k holds lengths above C/(k+1) and up to C/k, and a bin
of class k takes exactly k of them, whatever they are. The gap that a full bin then has is
filled by cutting the front off the next document, so a sequence has no padding, and a
document has hardly more pieces than sequences that it must touch. The classes need nothing
of each other and nothing of other partitions: each task fills its own bins in one pass,
with no shuffle, keeping at most k - 1 rests a class. What its open bins hold at the end is
laid end to end and cut at whole sequences, the last of them into the binary parts of its
length, so that these lengths are powers of two.
"""

from __future__ import annotations

import json
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm.induced import ranges
from tidemark.llm.text import UNSHARED_SPACE, ChunkCache, release

CAPACITY = 2048
PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                "sequence_id long, offset long")
_ARROW = pa.schema([pa.field(n, pa.int64()) for n in
                    ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


# Marks that form a token of their own behind a word and don't change the word.
_MARKS = "!#$%&*,.:;?|"


# Words of Latin letters, but for the one whose lower case has two characters.
_LATIN = "^[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+$"


class WordMerges:
    """The merges of a BPE vocabulary with word ends, for lower-case words of Latin letters:
    ids as :class:`WordTokenizer` gives them, in a tenth of the time. The end of
    the word is a byte of its own here; it joins the last letter first, since these ids come
    before all longer ones."""

    def __init__(self, path: str):
        import tiktoken
        # The vocabulary names a byte by this character, and the end of a word
        # by this suffix.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in own]
        byte_of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}
        suffix = "</w>"
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        ranks = {b"\0": len(vocabulary) + 1}
        for token, i in vocabulary.items():
            word = token.removesuffix(suffix)
            if word and all(c in byte_of and byte_of[c] for c in word):
                ranks[bytes(map(byte_of.get, word)) + b"\0" * (word != token)] = i
        self.encode = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.last = np.zeros(len(vocabulary) + 2, bool)  # ids that end a word
        self.last[[i for word, i in ranks.items() if word.endswith(b"\0")]] = True

    def __call__(self, words: list[str]) -> Iterator[bytes]:
        ids = np.array(self.encode("".join(w + "\0" for w in words)), "<u4")
        ends = (4 * np.flatnonzero(self.last[ids]) + 4).tolist()
        whole = ids.tobytes()
        return (whole[a:b] for a, b in zip([0, *ends], ends, strict=False))


class WordTokenizer:
    """Ids of a text as little-endian 32-bit bytes, from a tokenizer file that drops white
    space and case: its ids of a text are those of the text's white-space-separated chunks,
    one after the other, and those of a word with marks behind it are the word's and the
    marks'. So each distinct word is encoded once, and chunks are put together from words."""

    def __init__(self, path: str, limit: int = 1_000_000):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.merges, self.limit = WordMerges(path), limit
        self.words: dict[str, bytes] = {}
        self.others = ChunkCache(self.encode, limit=100_000)

    def encode(self, text: str) -> bytes:
        ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids)
        if sys.byteorder != "little":
            ids.byteswap()
        return ids.tobytes()

    def release(self) -> None:
        """At the end of a task; the vocabulary stays."""
        self.words = {}
        release(self.others)

    def chunks(self, chunks: pa.StringArray) -> list[bytes]:
        """The ids of distinct chunks. Words are remembered up to ``limit``, and never fewer
        than those at hand."""
        cores = pc.utf8_rtrim(chunks, characters=_MARKS)
        words, latin, chunks = (a.to_numpy(zero_copy_only=False).tolist() for a in
                                (pc.utf8_lower(cores), pc.match_substring_regex(cores, _LATIN), chunks))
        new = list({w for w, easy in zip(words, latin, strict=True) if easy and w not in self.words})
        if len(self.words) + len(new) > self.limit:
            self.words = {}
            new = list({w for w, easy in zip(words, latin, strict=True) if easy})
        self.words.update(zip(new, self.merges(new), strict=True))
        known, others = self.words, self.others
        return [others[c] if not easy else known[w] if len(w) == len(c) else known[w] + others[c[len(w):]]
                for c, w, easy in zip(chunks, words, latin, strict=True)]

    def __call__(self, text: str | None) -> bytes:
        return next(self.batch(pa.array([text], pa.string())))

    def batch(self, texts: pa.StringArray) -> Iterator[bytes]:
        """The ids of each text (null: none). The chunks of all texts are numbered together,
        so a chunk is looked up once a batch; the rest is done on numbers."""
        odd = pc.match_substring_regex(texts, UNSHARED_SPACE.pattern).fill_null(False)
        chunks = pc.utf8_split_whitespace(pc.if_else(odd, "", texts).fill_null(""))
        numbered = chunks.flatten().dictionary_encode()
        ids = self.chunks(numbered.dictionary)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        known, starts = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes) - sizes
        word = numbered.indices.to_numpy()
        flat = known[ranges(starts[word], sizes[word])]
        ends = np.concatenate([[0], np.cumsum(sizes[word])])[chunks.offsets.to_numpy() - chunks.offsets[0].as_py()].tolist()
        for i, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
            yield self.encode(texts[i].as_py()) if odd[i].as_py() else flat[a:b].tobytes()


def slices_of(texts: pa.StringArray, size: int = 1 << 23) -> Iterator[pa.StringArray]:
    """The texts in slices of about ``size`` bytes, of one text at least."""
    n = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy())
    at = 0
    while at < len(texts):
        to = max(int(np.searchsorted(n, (n[at - 1] if at else 0) + size, "right")), at + 1)
        yield texts.slice(at, to - at)
        at = to


_TOKENIZERS: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer a Python worker, kept between tasks."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


Piece = tuple[int | None, int, bytes, int]  # doc_id, first id, ids, the document's ids


class HarmonicBins:
    """The open bins of one task. ``add`` takes a document's ids and returns the rows of the
    sequences that it completes."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.open: dict[int, list[Piece]] = {}
        self.waiting: list[Piece] = []  # a bin with its number of rests, short of this many ids:
        self.gap = 0

    def close(self, pieces: list[Piece]) -> list[tuple]:
        rows, at = [], 0
        for doc_id, start, ids, n in pieces:
            rows.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), n, self.next_id, at))
            at += len(ids) // 4
        self.next_id += 1
        return rows

    def add(self, doc_id: int | None, ids: bytes) -> list[tuple]:
        n, start, rows, capacity = len(ids) // 4, 0, [], self.capacity
        if self.gap:
            start = min(n, self.gap)
            self.waiting.append((doc_id, 0, ids[:4 * start], n))
            self.gap -= start
            if not self.gap:
                rows += self.close(self.waiting)
        while n - start >= capacity:
            rows += self.close([(doc_id, start, ids[4 * start:4 * (start + capacity)], n)])
            start += capacity
        if start < n:
            k = capacity // (n - start)
            rests = self.open.setdefault(k, [])
            rests.append((doc_id, start, ids[4 * start:], n))
            if len(rests) == k:
                del self.open[k]
                rows += self.full(rests)
        return rows

    def full(self, rests: list[Piece]) -> list[tuple]:
        """A bin with its number of rests: closed, or waiting for the next document. While
        one waits the next document fills it before its own rest is put away; only a
        document shorter than the gap leaves it open, and has no rest then."""
        self.gap = self.capacity - sum(len(p[2]) for p in rests) // 4
        self.waiting = rests
        return [] if self.gap else self.close(rests)

    def finish(self) -> list[tuple]:
        rows, parts, size = [], [], 0
        left = [p for _, rests in sorted(self.open.items()) for p in rests] + (self.waiting if self.gap else [])
        self.open, self.waiting, self.gap = {}, [], 0
        total = sum(len(p[2]) for p in left) // 4
        sizes = [self.capacity] * (total // self.capacity)
        sizes += [1 << b for b in range(self.capacity.bit_length() - 1, -1, -1) if total % self.capacity >> b & 1]
        room = iter(sizes)
        size = next(room, 0)
        for doc_id, start, ids, n in left:
            at = 0
            while at < len(ids):
                take = ids[at:at + 4 * size]
                parts.append((doc_id, start + at // 4, take, n))
                at += len(take)
                size -= len(take) // 4
                if not size:
                    rows += self.close(parts)
                    parts, size = [], next(room, 0)
        return rows


def pack(docs: DataFrame, tokenizer_path: str, *, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all rows of ``docs`` (``doc_id``, ``text``; other columns are not read).

    A document's ids are those of the tokenizer, then ``end_id``. A null or empty text has
    the end id only. A null ``doc_id`` stays null; repeated rows are packed as often as
    they occur. An empty table gives no rows. ``sequence_id`` is the task's number in the
    upper bits and its own count in the lower 40, so a task that runs again gives the same.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, end = word_tokenizer(tokenizer_path), end_id.to_bytes(4, "little")
        bins = HarmonicBins(capacity, TaskContext.get().partitionId() << 40)
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=_ARROW)
            rows.clear()
            return out

        for b in batches:
            ids = (i for texts in slices_of(b.column(1)) for i in tokenizer.batch(texts))
            for doc_id, i in zip(b.column(0).to_pylist(), ids, strict=True):
                rows += bins.add(doc_id, i + end)
                if len(rows) >= 50_000:
                    yield batch()
        rows += bins.finish()
        tokenizer.release()
        if rows:
            yield batch()

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, PIECE_SCHEMA)
