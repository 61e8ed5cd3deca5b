"""Edit-aware token counts.

A document keeps a segment tree over its pre-tokens: a leaf stands for some 32 of them,
with its characters and its tokens, and each inner node for the sums of its two children.
An edit goes down the tree to the leaves that it touches. From the start of a leaf that
the edit can't reach, with some context, the text is split again until a split falls on an
old leaf boundary; from there on nothing has changed, for the splitting looks ahead only.
Just these pre-tokens are encoded again, and the sums above their leaves updated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import ChunkCache

LEAF = 32
# How far a pre-token may look beyond its end: a contraction of two letters, and a margin.
CONTEXT = 4
# The splitting of the byte-level vocabularies: a fixed value.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

TREE_SCHEMA = "doc_id long, text string, leaf_chars array<long>, leaf_tokens array<long>"
EDIT_TYPE = "array<struct<start: long, length: long, text: string>>"


class Counter:
    """Tokens of a pre-token, remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their names in a text are text
        self.cache = ChunkCache(lambda p: len(self.tokenizer.encode(p, add_special_tokens=False).ids), limit=800_000)

    def counts(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(map(self.cache.__getitem__, pieces), np.int64, len(pieces))


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def leaves(text: str, count: Counter) -> tuple[np.ndarray, np.ndarray]:
    """Characters and tokens of the leaves of a text; none for an empty one."""
    chars, tokens = [], []
    pieces: list[str] = []

    def close() -> None:
        n = np.fromiter(map(len, pieces), np.int64, len(pieces))
        at = np.arange(0, len(pieces), LEAF)
        chars.append(np.add.reduceat(n, at))
        tokens.append(np.add.reduceat(count.counts(pieces), at))
        pieces.clear()

    if len(text) < 1 << 20:
        pieces = PATTERN.findall(text)
    else:  # a list of all pieces of a very long text would take much memory
        for m in PATTERN.finditer(text):
            pieces.append(m.group())
            if len(pieces) == LEAF << 12:
                close()
    if pieces:
        close()
    none = np.empty(0, np.int64)
    return (np.concatenate(chars), np.concatenate(tokens)) if chars else (none, none)


class SegmentTree:
    """Sums of characters and tokens over the leaves; node 1 is the root, the children of i
    are 2i and 2i + 1."""

    def __init__(self, text: str, chars: np.ndarray, tokens: np.ndarray, count: Counter):
        self.count, self.recounted = count, 0
        self.load(text, chars, tokens)

    def load(self, text: str, chars: np.ndarray, tokens: np.ndarray) -> None:
        self.text, self.n = text, max(len(chars), 1)
        self.size = 1 << (self.n - 1).bit_length()
        self.sums = np.zeros((2 * self.size, 2), np.int64)
        self.sums[self.size:self.size + len(chars), 0] = chars
        self.sums[self.size:self.size + len(chars), 1] = tokens
        low = self.size
        while low > 1:
            self.sums[low // 2:low] = self.sums[low:2 * low].reshape(-1, 2, 2).sum(axis=1)
            low //= 2

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def leaf_at(self, char: int) -> tuple[int, int]:
        """The leaf that holds the character (the last with characters if there is none) and
        the place where it begins."""
        node, start = 1, 0
        char = min(char, int(self.sums[1, 0]) - 1)
        while node < self.size:
            node *= 2
            left = int(self.sums[node, 0])
            if char - start >= left:
                start += left
                node += 1
        return node - self.size, start

    def set_leaf(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.size
        change = np.array([chars, tokens]) - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2

    def edit(self, start: int, length: int, new: str) -> None:
        """Replace ``length`` characters from ``start`` on, both held to the text's bounds."""
        old = self.text
        start = min(max(start, 0), len(old))
        end = min(start + max(length, 0), len(old))
        if start == end and not new:
            return
        self.text = old[:start] + new + old[end:]
        if not old:
            self.load(self.text, *leaves(self.text, self.count))
            self.recounted += self.tokens
            return
        shift = len(new) - (end - start)
        first, begin = self.leaf_at(max(start - CONTEXT, 0))
        leaf, leaf_begin = self.leaf_at(max(end, begin))
        stop = leaf_begin + int(self.sums[leaf + self.size, 0])  # an old boundary, behind the edit
        pieces: list[str] = []
        at = begin
        for m in PATTERN.finditer(self.text, begin):
            pieces.append(m.group())
            at = m.end()
            while stop + shift < at and stop < len(old):
                leaf += 1
                stop += int(self.sums[leaf + self.size, 0])
            if at == stop + shift and stop > end:
                break
        self.recounted += len(pieces)
        if at >= len(self.text):
            leaf = self.n - 1
        for x in range(first, leaf + 1):
            if self.sums[x + self.size].any():
                self.set_leaf(x, 0, 0)
        if pieces:
            self.set_leaf(first, sum(map(len, pieces)), int(self.count.counts(pieces).sum()))
        if len(pieces) > 16 * LEAF and len(pieces) > 2 * LEAF * (leaf - first + 1):
            # the leaf has grown out of the tree's grain
            self.load(self.text, *leaves(self.text, self.count))

    def leaf_arrays(self) -> tuple[np.ndarray, np.ndarray]:
        held = self.sums[self.size:self.size + self.n]
        held = held[held[:, 0] > 0]
        return held[:, 0], held[:, 1]


def build_trees(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, text, leaf_chars, leaf_tokens`` for every row of ``docs`` (``doc_id``,
    ``text``): the leaves of its tree. A null text counts as empty and becomes it; an empty
    one has no leaves. A null doc_id stays null; repeated rows are all returned."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer_path)
        for b in batches:
            for some in (b.slice(i, 2000) for i in range(0, b.num_rows, 2000)):
                found = [leaves(t.as_py(), count) for t in some.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), some.column("text"), *(pa.array([f[k] for f in found], pa.list_(pa.int64())) for k in (0, 1))],
                    names=["doc_id", "text", "leaf_chars", "leaf_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, TREE_SCHEMA)


def apply_edits(trees: DataFrame, tokenizer_path: str) -> DataFrame:
    """Trees after edits: the columns of :func:`build_trees`, and ``tokens_before,
    tokens_after, n_edits, recounted`` (pre-tokens encoded again).

    ``trees`` has a column ``edits`` (``array<struct<start, length, text>>``): each edit is
    applied to what the one before has left; places are held to the text's bounds, a null
    text inserts nothing, a null edit or array does nothing. All rows are returned."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer_path)
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            for text, chars, tokens, edits in zip(b.column("text"), b.column("leaf_chars"), b.column("leaf_tokens"), b.column("edits").to_pylist(), strict=True):
                tree = SegmentTree(text.as_py() or "", np.array(chars.as_py() or [], np.int64), np.array(tokens.as_py() or [], np.int64), count)
                before, done = tree.tokens, [e for e in edits or [] if e is not None]
                for e in done:
                    tree.edit(e["start"] or 0, e["length"] or 0, e["text"] or "")
                for o, v in zip(out, (tree.text, *tree.leaf_arrays(), before, tree.tokens, len(done), tree.recounted), strict=True):
                    o.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(out[0], pa.string()), *(pa.array(o, pa.list_(pa.int64())) for o in out[1:3]),
                 *(pa.array(o, pa.int64()) for o in out[3:])],
                names=["doc_id", "text", "leaf_chars", "leaf_tokens", "tokens_before", "tokens_after", "n_edits", "recounted"])

    rows = trees.select("doc_id", "text", "leaf_chars", "leaf_tokens", F.col("edits").cast(EDIT_TYPE).alias("edits"))
    return rows.mapInArrow(run, TREE_SCHEMA + ", tokens_before long, tokens_after long, n_edits long, recounted long")
