"""Removal of duplicate lines across documents by a segment-partition edit join.

A line (trimmed, of at least ``MIN_CHARS`` characters) goes if an earlier line of the
corpus, in the order of doc_id and line number, is at most one edit (insertion, deletion
or substitution of a character) away; equal lines are found first, by hash, and go on as
one.

With a threshold of one edit a line is cut into two segments. One of them is free of
edits, so the pair agrees in it and in its place; what may be probed follows from the two
lengths alone: a line of L characters probes the index of length L and, for the line that
is one longer, the index of length L - 1. A segment that many lines share (variants of a
common passage) is not paired out: the uncertain half of its lines is cut again, by eight,
the rest now having to agree, and so on until a group is small or the uncertain region is
a single character. There all lines of a group are within one edit of each other and the
earliest settles them all. Pairs are verified by a banded bit-parallel edit distance over
the uncertain region. Everything here is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import join_counted
from tidemark.session import ensure_checkpoint_dir

MIN_CHARS = 20
EDITS = 1
GROUP_ROWS = 4  # larger groups are cut again, which loses nothing
NO_ID = (1 << 63) - 1


def lines(docs: DataFrame) -> DataFrame:
    """``did, no, line, h1, h2`` for every line that takes part (``no`` from 0)."""
    split = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("did"),
                        F.posexplode(F.split(F.col("text").cast("string"), "\n")).alias("no", "raw"))
    return (split.select("did", "no", F.trim("raw").alias("line")).filter(F.char_length("line") >= MIN_CHARS)
            .select("did", "no", "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), "line").alias("h2")))


def band_distance(left: Column, right: Column, edits: int = EDITS) -> Column:
    """Edit distance of two strings if it is at most ``edits``, else a larger number.

    Bit-parallel over the band of 2 * edits + 1 diagonals: the vertical differences of a
    column's band are two bit sets, moved on by a few word operations a character."""
    width = 2 * edits + 1
    full = (1 << width) - 1
    longer, shorter = F.when(F.char_length(left) >= F.char_length(right), left).otherwise(right), \
        F.when(F.char_length(left) >= F.char_length(right), right).otherwise(left)
    m, n = F.char_length(longer), F.char_length(shorter)
    lead = (1 << (edits + 1)) - 1

    def let(value: Column, body) -> Column:
        return F.element_at(F.transform(F.array(value), body), 1)

    def step(p: Column, t: Column, gap: Column):
        def next_column(s: Column, j: Column) -> Column:
            match = F.lit(0)
            for k in range(width):
                at = j - (edits - k) - 1
                same = F.when(at >= 0, F.coalesce(F.get(p, at) == F.get(t, j - 1), F.lit(False))).otherwise(False)
                match = match.bitwiseOR(F.when(same, 1 << k).otherwise(0))
            up = F.shiftright(s["vp"], 1).bitwiseOR(F.lit(1 << (width - 1)))
            down = F.shiftright(s["vn"], 1)
            start = F.struct(match.alias("pm"), up.alias("up"), down.alias("down"), s["score"].alias("score"))
            return let(start, lambda a: let(
                F.struct(((a["pm"].bitwiseAND(a["up"]) + a["up"]).bitwiseXOR(a["up"]).bitwiseOR(a["pm"])
                          .bitwiseOR(a["down"])).bitwiseAND(F.lit(full)).alias("d0"), a["up"].alias("up"),
                         a["down"].alias("down"), a["score"].alias("score")),
                lambda b: let(
                    F.struct(b["d0"].alias("d0"), b["score"].alias("score"),
                             F.shiftleft(b["down"].bitwiseOR(F.bitwise_not(b["d0"].bitwiseOR(b["up"])).bitwiseAND(F.lit(full))), 1)
                             .bitwiseOR(F.lit(1)).bitwiseAND(F.lit(full)).alias("hp"),
                             F.shiftleft(b["d0"].bitwiseAND(b["up"]), 1).bitwiseAND(F.lit(full)).alias("hn")),
                    lambda c: F.struct(
                        c["hn"].bitwiseOR(F.bitwise_not(c["d0"].bitwiseOR(c["hp"])).bitwiseAND(F.lit(full))).alias("vp"),
                        c["hp"].bitwiseAND(c["d0"]).alias("vn"),
                        (c["score"] + 1 - _bit(c["d0"], gap + edits)).alias("score")))))
        return next_column

    def _bit(x: Column, at: Column) -> Column:
        value = F.lit(0)
        for k in range(width):
            value = F.when(at == k, F.shiftright(x, k).bitwiseAND(F.lit(1))).otherwise(value)
        return value

    begin = F.struct(F.lit(full & ~lead).alias("vp"), F.lit(lead).alias("vn"), (m - n).alias("score"))
    walk = let(F.struct(F.split(longer, "").alias("p"), F.split(shorter, "").alias("t"), (m - n).alias("gap"), n.alias("n")),
               lambda v: F.aggregate(F.sequence(F.lit(1), v["n"]), begin, step(v["p"], v["t"], v["gap"]), lambda s: s["score"]))
    return F.when(m - n > edits, m - n).when(n == 0, m).otherwise(walk)


def _bounds(level: str, region: str, length: str) -> tuple[str, str]:
    """The uncertain region [lo, hi) of an indexed line of this length, as SQL."""
    return (f"cast(({region} * {length}) div shiftleft(1L, {level}) as int)",
            f"cast((({region} + 1) * {length}) div shiftleft(1L, {level}) as int)")


def _key(level: str, region: str, length: str) -> str:
    """Hash of what must agree: the place, and the line without the uncertain region. The
    line may be longer than ``length`` (a probe); the region then is longer too."""
    lo, hi = _bounds(level, region, length)
    return (f"xxhash64({level}, {region}, {length}, substring(line, 1, {lo}), "
            f"substring(line, char_length(line) - ({length} - {hi}) + 1, {length} - {hi}))")


def _first_rows(distinct: DataFrame) -> DataFrame:
    """Index and probe rows of every line: ``key, h1, kind, region`` at level 1 (two
    segments). kind 0 is the line's own length, also indexed; kind 1 probes one shorter."""
    options = [f"struct({_key('1', f'{r}L', f'(char_length(line) - {kind})')} as key, {kind} as kind, {r}L as region)"
               for kind in (0, 1) for r in (0, 1)]
    return distinct.select("h1", F.explode(F.expr(f"array({', '.join(options)})")).alias("r")).select("h1", "r.*")


def _shared(rows: DataFrame) -> DataFrame:
    """Keys under which two different lines meet, at least one of them indexed."""
    return (rows.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b"), F.min("kind").alias("k"), F.count("*").alias("size"))
            .filter("a <> b and k = 0").select("key", "size"))


def _pairs(rows: DataFrame) -> DataFrame:
    """Verified pairs (later line's h1, h2, did, no) within the small groups of ``rows``."""
    i = rows.filter("kind = 0").select("key", *[F.col(c).alias(f"i_{c}") for c in ("h1", "h2", "line", "did", "no", "level", "region")])
    p = rows.select("key", "kind", "h1", "h2", "line", "did", "no")
    pairs = p.join(i, (p["key"] == i["key"]) & ((F.col("h1") != F.col("i_h1")) | (F.col("h2") != F.col("i_h2")))
                   & ((F.col("kind") == 1) | (F.struct("h1", "h2") > F.struct("i_h1", "i_h2"))))
    lo, hi = _bounds("i_level", "i_region", "char_length(i_line)")
    pairs = pairs.withColumns({"lo": F.expr(lo), "rest": F.expr(f"char_length(i_line) - {hi}")})
    inner = "substring({0}, lo + 1, char_length({0}) - lo - rest)"
    pairs = pairs.filter("substring(line, 1, lo) = substring(i_line, 1, lo)").filter(
        "substring(line, char_length(line) - rest + 1, rest) = substring(i_line, char_length(i_line) - rest + 1, rest)")
    near = pairs.filter(band_distance(F.expr(inner.format("line")), F.expr(inner.format("i_line"))) <= EDITS)
    return _later(near)


def _later(pairs: DataFrame) -> DataFrame:
    at = F.when(F.struct("did", "no") > F.struct("i_did", "i_no"), F.struct("did", "no", "h1")).otherwise(
        F.struct(F.col("i_did").alias("did"), F.col("i_no").alias("no"), F.col("i_h1").alias("h1")))
    return pairs.select(at.alias("later")).select("later.*")


def _settled(rows: DataFrame) -> DataFrame:
    """Later lines in groups whose uncertain region is one character: the lines of the
    index differ in that character only; a line that is one longer is within one edit of
    the indexed line that it becomes without the region's first or second character."""
    own = rows.filter("kind = 0")
    least = own.groupBy("key").agg(F.min(F.struct("did", "no")).alias("least"))
    same = own.join(least, "key").filter(F.struct("did", "no") > F.col("least")).select("did", "no", "h1")
    lo, _ = _bounds("level", "region", "(char_length(line) - 1)")
    probes = rows.filter("kind = 1").withColumn("cut", F.explode(F.expr(f"array({lo} + 1, {lo} + 2)")))
    probes = probes.withColumn("without", F.expr("concat(substring(line, 1, cut - 1), substring(line, cut + 1, char_length(line)))"))
    probes = probes.select("h1", "h2", "did", "no", F.col("without").alias("i_line")).distinct()
    index = own.select(*[F.col(c).alias(f"i_{c}") for c in ("h1", "h2", "line", "did", "no")]).distinct()
    return same.union(_later(probes.join(index, "i_line")))


def duplicate_lines(docs: DataFrame) -> DataFrame:
    """``did, no, h1`` of every line to remove (materialised); see :func:`dedup_lines`."""
    ensure_checkpoint_dir(docs.sparkSession)
    all_lines = lines(docs)
    firsts = (all_lines.groupBy("h1", "h2").agg(F.min(F.struct("did", "no")).alias("first"), F.count("*").alias("n"))
              .filter("n > 1").select("h1", "h2", "first").checkpoint())
    repeated = (join_counted(all_lines, firsts, ["h1", "h2"]).filter(F.struct("did", "no") > F.col("first"))
                .select("did", "no", "h1").checkpoint())

    distinct = join_counted(all_lines, repeated, ["did", "no", "h1"], "left_anti")
    keyed = _first_rows(distinct)
    shared = _shared(keyed).checkpoint()
    rows = join_counted(keyed, shared, "key").distinct().checkpoint()
    wanted = rows.select("h1").distinct().checkpoint()
    texts = (join_counted(all_lines, wanted, "h1").groupBy("h1", "h2")
             .agg(F.first("line").alias("line"), F.min(F.struct("did", "no")).alias("at"))
             .select("h1", "h2", "line", "at.did", "at.no").checkpoint())
    rows = rows.withColumn("level", F.lit(1)).join(texts, "h1").checkpoint()

    found = [_pairs(rows.filter(F.col("size") <= GROUP_ROWS))]
    hot = rows.filter(F.col("size") > GROUP_ROWS)
    lo, hi = _bounds("level", "region", "(char_length(line) - kind)")
    while not hot.isEmpty():
        single = hot.filter(f"{hi} - {lo} <= 1")
        found.append(_settled(single))
        cut = (hot.filter(f"{hi} - {lo} > 1").drop("key", "size").withColumn("part", F.explode(F.expr("sequence(0L, 7L)")))
               .withColumn("region", F.expr("region * 8 + part")).withColumn("level", F.expr("level + 3")).drop("part")
               .filter(f"{hi} > {lo}").withColumn("key", F.expr(_key("level", "region", "(char_length(line) - kind)"))))
        cut = cut.join(_shared(cut), "key").checkpoint()
        found.append(_pairs(cut.filter(F.col("size") <= GROUP_ROWS)))
        hot = cut.filter(F.col("size") > GROUP_ROWS)
    near = found[0]
    for f in found[1:]:
        near = near.union(f)
    return repeated.union(near).distinct().checkpoint()


def _without(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """Every row of ``docs`` as ``row``, with ``new_text`` and ``n_lines``, ``n_removed``."""
    entries = removed.count()
    by_doc = removed.groupBy("did").agg(F.collect_set(F.struct("no", "h1")).alias("gone")).select(F.col("did").alias("gone_did"), "gone")
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("gone_did"))
    joined = join_counted(held, by_doc, "gone_did", "left", rows=entries)
    text = F.col("row.text").cast("string")
    kept = F.filter(F.split(text, "\n"), lambda raw, i: ~F.array_contains(
        F.col("gone"), F.struct(i.alias("no"), F.xxhash64(F.trim(raw)).alias("h1"))))
    joined = joined.select("row", F.coalesce(F.size(F.split(text, "\n")), F.lit(0)).cast("long").alias("n_lines"),
                           F.when(F.col("gone").isNotNull(), kept).alias("kept"))
    return joined.select(
        "row", "n_lines", F.when(F.col("kept").isNull(), 0).otherwise(F.col("n_lines") - F.size("kept")).cast("long").alias("n_removed"),
        F.when(F.col("kept").isNull(), F.col("row.text").cast("string")).otherwise(F.array_join("kept", "\n")).alias("new_text"))


def remove_lines(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``docs`` without the lines named by ``removed`` (did, no, h1); other texts unchanged."""
    return _without(docs, removed).select(
        *[F.col("new_text").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs``, all rows and columns, with duplicate lines taken out of ``text``.

    A trimmed line of at least 20 characters is taken out if an earlier line is equal or one
    edit away; shorter lines stay. Lines are named by doc_id and line number: a null doc_id
    counts as the largest one, and rows that repeat a doc_id and a line at the same place
    share that line, so equal repeated rows keep theirs. A null text stays null, an empty
    one empty; a document all of whose lines go stays with an empty text. An empty table
    stays empty.
    """
    return remove_lines(docs, duplicate_lines(docs))


def line_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_removed, text_md5`` for every row of ``docs``: its lines, how many
    go, and the digest of the text that stays (null for a null text)."""
    docs = docs.select("doc_id", "text")
    return _without(docs, duplicate_lines(docs)).select(
        F.col("row.doc_id").cast("long").alias("doc_id"), "n_lines", "n_removed", F.md5("new_text").alias("text_md5"))
