"""Interaction audit of quality filters by decision diagrams.

Spark counts, per part, the documents with each failure mask: which of the filters a
document fails. All that follows needs these few counts only, so documents are read once
whatever the number of filter orders. A part's masks make a count-weighted decision
diagram: one level a filter, two edges a node (pass, fail), and at each node the number of
documents below it. The documents that an order keeps are those on the path of pass edges,
and what a step removes is the weight of the fail edge that leaves this path there. Two
neighbouring filters change places by swapping two levels of the diagram, which rebuilds
only the nodes of these levels; all orders follow one another by such swaps.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
AUDIT_SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
                "unique_fails long, good_lost long, toxic_lost long, shapley long")
_COUNTS = ("n", "good", "toxic")
_SPACE = r"[\x20\x09-\x0D]+"


def text_failures(text: Column, words: Column) -> list[Column]:
    """Filters A to D on a text and its words: few words, few distinct words, many capitals,
    marks of markup."""
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [n_words < 100, 100 * n_distinct < 80 * n_words, 100 * capitals > 10 * F.length(text),
            text.rlike(r"[#$%&*|]")]


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part``, ``mask`` (bit i: filter i fails), ``n``, ``good``, ``toxic``: documents of
    each mask, and how many of them the labels call good and toxic.

    Texts stay in the scan: what is shuffled is a digest, four bits and the id. Equal rows,
    then equal texts of a part, are counted before each shuffle, so no group of copies is in
    one task. A row without an id has no smaller id and is nobody's original.
    """
    rows = (docs.selectExpr("cast(doc_id as long) doc_id", "coalesce(cast(lang as string), '') part", "coalesce(cast(text as string), '') text")
            .withColumn("words", F.array_remove(F.split("text", _SPACE), "")))
    bits = [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(text_failures(F.col("text"), F.col("words")))]
    rows = rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), sum(bits[1:], bits[0]).alias("mask"))
    rows = rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n"))

    flags = (labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id"))
             .agg(F.max(F.expr("coalesce(quality = 1, false)")).alias("good"), F.max(F.expr("coalesce(toxic = 1, false)")).alias("toxic"))
             .withColumn("known", F.lit(True)))
    # rows without an id match no label; their digest spreads them over the tasks
    keyed = rows.withColumn("known", F.col("doc_id").isNotNull()).withColumn("id", F.coalesce("doc_id", F.xxhash64("digest")))
    keyed = keyed.join(flags, ["id", "known"], "left").fillna(False, ["good", "toxic"])

    first = F.min(F.when(F.col("known"), F.struct("doc_id", "n"))).alias("first")
    copies = (keyed.groupBy("digest", "part", "mask", "good", "toxic")
              .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("known"), 0).otherwise(F.col("n"))).alias("unknown"), first)
              .withColumn("least", F.min("first.doc_id").over(Window.partitionBy("digest"))))
    originals = F.col("unknown") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    copies = copies.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), originals.alias("n")),
        F.struct((F.col("mask") + (1 << 4)).alias("mask"), (F.col("n") - originals).alias("n")))).alias("m"))
    return (copies.select("part", "good", "toxic", "m.mask", "m.n").groupBy("part", "mask")
            .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
                 F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic")))


class FailureDiagram:
    """Decision diagram of failure masks. A node is ``[pass, fail, weight]``, on each level
    one node for each different pair of children; a leaf is its weight, a tuple of counts.
    """

    def __init__(self, masks: dict[int, tuple[int, ...]], n_filters: int, n_counts: int = 1):
        self.order = list(range(n_filters))
        self.none = (0,) * n_counts
        self.levels: list[dict] = [{} for _ in range(n_filters)]
        below = {m: masks.get(m, self.none) for m in range(1 << n_filters)}
        for level in range(n_filters - 1, -1, -1):  # a node for each setting of the filters above
            bit = 1 << level
            below = {m: self._node(level, below[m], below[m | bit]) for m in range(bit)}
        self.root = below[0]

    def weight(self, node) -> tuple[int, ...]:
        return node if isinstance(node, tuple) else node[2]

    @staticmethod
    def _key(node):
        return node if isinstance(node, tuple) else id(node)

    def _node(self, level: int, passes, fails) -> list:
        key = (self._key(passes), self._key(fails))
        table = self.levels[level]
        if key not in table:
            table[key] = [passes, fails, tuple(map(sum, zip(self.weight(passes), self.weight(fails), strict=True)))]
        return table[key]

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next one. Nodes above keep their
        children: a node of ``level`` stands for the same documents as before."""
        upper = list(self.levels[level].values())
        self.levels[level], self.levels[level + 1] = {}, {}
        for node in upper:
            (pp, pf), (fp, ff) = node[0][:2], node[1][:2]
            node[0], node[1] = self._node(level + 1, pp, fp), self._node(level + 1, pf, ff)
            self.levels[level][id(node[0]), id(node[1])] = node
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """(filter, kept, removed) of each step: the path of pass edges and what leaves it."""
        node = self.root
        for f in self.order:
            yield f, self.weight(node[0]), self.weight(node[1])
            node = node[0]


def adjacent_swaps(n: int) -> Iterator[int]:
    """Places whose swaps, one after the other, lead through all orders of n things once."""
    if n < 2:
        return
    inner, down = adjacent_swaps(n - 1), True
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        at = next(inner, None)
        if at is None:
            return
        yield at + down  # the largest stands at the front or the end; the others are swapped
        down = not down


def audit_part(masks: dict[int, tuple[int, ...]], names: str) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)
    of all orders of one part's filters."""
    n = len(names)
    diagram = FailureDiagram(masks, n, len(_COUNTS))
    runs, all_fails, only_fails, shares = [], [0] * n, [0] * n, [0] * n
    swaps = adjacent_swaps(n)
    while True:
        run = list(diagram.steps())
        runs.append(run)
        all_fails[run[0][0]] = run[0][2][0]    # as the first filter it meets every document
        only_fails[run[-1][0]] = run[-1][2][0]  # as the last one, those that pass all others
        for f, _, removed in run:
            shares[f] += removed[0]
        at = next(swaps, None)
        if at is None:
            break
        diagram.swap(at)
    return [("".join(names[f] for f, _, _ in run), i + 1, kept[0], removed[0], all_fails[f] - removed[0], only_fails[f], removed[1], removed[2], shares[f])
            for run in runs for i, (f, kept, removed) in enumerate(run)]


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of all orders of the five filters, for each ``lang`` of ``docs``.

    Null texts count as empty, a null ``lang`` as the empty string. Rows that are there
    twice count twice; neither is the other's copy. Without an id a row has no labels and
    fails the copy filter never. Several labels of one document: one of them is enough. An
    empty table has no parts and gives no rows. Other columns are not read.
    """
    def run(table: pa.Table) -> pa.Table:
        masks = {m: tuple(c) for m, *c in zip(*(table.column(k).to_pylist() for k in ("mask", *_COUNTS)), strict=True)}
        rows = audit_part(masks, FILTERS)
        part = [table.column("part")[0].as_py()] * len(rows)
        types = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
        names = [f.split()[0] for f in AUDIT_SCHEMA.split(", ")]
        return pa.table([pa.array(c, t) for c, t in zip([part, *zip(*rows, strict=True)], types, strict=True)], names=names)

    return failure_counts(docs, labels).groupBy("part").applyInArrow(run, AUDIT_SCHEMA)


AUDIT_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
least AS (SELECT t, min(doc_id) AS lo FROM w GROUP BY t),
l AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT w.part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
         CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(w.t, '[^A-Z]', '', 'g')) > 10 * length(w.t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(w.t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN w.doc_id > least.lo THEN 'E' ELSE '' END AS s
  FROM w JOIN least ON w.t = least.t LEFT JOIN l ON w.doc_id = l.doc_id),
m AS (
  SELECT part, s, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM f GROUP BY part, s),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (
  SELECT a.c || b.c || d.c || e.c || g.c AS o FROM x a, x b, x d, x e, x g
  WHERE len(list_distinct([a.c, b.c, d.c, e.c, g.c])) = 5),
steps AS (
  SELECT o, i AS step, substr(o, i, 1) AS c, substr(o, 1, i - 1) AS pre, substr(o, 1, i) AS upto
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS i)),
r AS (
  SELECT part, o, step, c,
         sum(CASE WHEN translate(s, upto, '') = s THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN contains(s, c) AND translate(s, pre, '') = s THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN contains(s, c) AND translate(s, pre, '') <> s THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN s = c THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN contains(s, c) AND translate(s, pre, '') = s THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN contains(s, c) AND translate(s, pre, '') = s THEN toxic ELSE 0 END) AS toxic_lost
  FROM m, steps GROUP BY part, o, step, c)
SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, c) AS BIGINT) AS shapley
FROM r
"""
