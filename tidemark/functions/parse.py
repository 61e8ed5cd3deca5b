"""Text-record parsing, tokenising and formatting.

All of these are column expressions, so they run inside whole-stage codegen and work
unchanged on static and streaming DataFrames.

Strict parsing fails the job on a non-integer or missing field (Spark's ANSI casts and
array indexing raise), as the reference's parser does. The lenient form keeps the good
rows and returns the bad ones separately.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.time import col, format_ts

# Fixed values that must equal the reference's output text.
GENERATED_PREFIX = "输入数字为："
WINDOW_LABEL_PARTS = ("key=", "的窗口，其开始时间为:【", "，结束时间为:", "】数据共有： ", "条")

USER_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("address", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("create_time", T.DateType()),
])


def _fields(line: str | Column, sep: str = ",") -> Column:
    return F.split(col(line), sep, -1)


def _field(parts: Column, i: int, strict: bool) -> Column:
    return parts.getItem(i) if strict else F.try_element_at(parts, F.lit(i + 1))


def _to_int(c: Column, strict: bool) -> Column:
    return c.cast("int") if strict else c.try_cast("int")


def parse_user(line: str | Column = "value", strict: bool = True) -> list[Column]:
    """``"name,age[,...]"`` -> User columns. Only name and age are read; id,
    address, email and create_time stay null, as in the reference's parser."""
    parts = _fields(line)
    return [
        F.lit(None).cast("string").alias("id"),
        _field(parts, 0, strict).alias("name"),
        _to_int(_field(parts, 1, strict), strict).alias("age"),
        F.lit(None).cast("string").alias("address"),
        F.lit(None).cast("string").alias("email"),
        F.lit(None).cast("date").alias("create_time"),
    ]


def parse_reading(line: str | Column = "value", strict: bool = True) -> list[Column]:
    """``"id,vc,count"`` -> sensor reading."""
    parts = _fields(line)
    return [_field(parts, 0, strict).alias("id"),
            _to_int(_field(parts, 1, strict), strict).alias("vc"),
            _to_int(_field(parts, 2, strict), strict).alias("count")]


def parse_pair(line: str | Column = "value", strict: bool = True) -> list[Column]:
    """``"k,t"`` -> (k, t)."""
    parts = _fields(line)
    return [_field(parts, 0, strict).alias("k"), _to_int(_field(parts, 1, strict), strict).alias("t")]


def parse_triple(line: str | Column = "value", strict: bool = True) -> list[Column]:
    """``"k,t,v"`` -> (k, t, v)."""
    parts = _fields(line)
    return [_field(parts, 0, strict).alias("k"), _to_int(_field(parts, 1, strict), strict).alias("t"),
            _to_int(_field(parts, 2, strict), strict).alias("v")]


def parse_lenient(df: DataFrame, parser, line: str = "value",
                  required: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Parse without failing: returns ``(parsed, rejects)``. A row is rejected when any
    of ``required`` comes out null (missing field or not a number); rejects keep the
    raw line in column ``line``."""
    parsed = df.select(F.col(line).alias("_tm_raw"), *parser(line, strict=False))
    bad = F.lit(False)
    for c in required:
        bad = bad | F.col(c).isNull()
    return (parsed.where(~bad).drop("_tm_raw"),
            parsed.where(bad).select(F.col("_tm_raw").alias("line")))


def tokens(line: str | Column = "value") -> Column:
    """T4: the space-separated words of a line, as Java's ``String.split(" ")`` gives
    them: leading and inner empty words are kept, trailing ones dropped, an empty line is
    one empty word and a line of only spaces has none."""
    c = col(line)
    stripped = F.regexp_replace(c, " +$", "")
    return (F.when(c == "", F.array(F.lit("")))
            .when(stripped == "", F.array().cast("array<string>"))
            .otherwise(F.split(stripped, " ", -1)))


def lines_of(text: str | Column) -> Column:
    """The lines of a whole text, as a line-oriented file reader returns them (a final
    newline does not start an extra line)."""
    return F.split(F.regexp_replace(col(text), "\n$", ""), "\n", -1)


def words(df: DataFrame, line: str = "value", keep: Sequence[str] = (),
          position: str | None = None) -> DataFrame:
    """T4 as a flat-map: one row (``word``) per token of each line, with the same rules as
    :func:`tokens`; the trailing spaces are stripped once, before the explode. ``keep``
    carries other columns along; ``position`` adds the word's index in its line."""
    d = df.select(*keep, F.col(line).alias("_tm_l"), F.regexp_replace(line, " +$", "").alias("_tm_s"))
    toks = (F.when(F.col("_tm_l") == "", F.array(F.lit("")))
            .when(F.col("_tm_s") == "", F.array().cast("array<string>"))
            .otherwise(F.split("_tm_s", " ", -1)))
    if position:
        return d.select(*keep, F.posexplode(toks).alias(position, "word"))
    return d.select(*keep, F.explode(toks).alias("word"))


def word_pairs(df: DataFrame, line: str = "value") -> DataFrame:
    """T4 as a flat-map: one ``(word, n=1)`` row per token."""
    return words(df, line).withColumn("n", F.lit(1))


def line_pairs(df: DataFrame, line: str = "value") -> DataFrame:
    """T5: ``(line, 1)`` without splitting."""
    return df.select(F.col(line).alias("line"), F.lit(1).alias("n"))


def generated_text(index: str | Column = "id") -> Column:
    """Generator index -> text."""
    return F.concat(F.lit(GENERATED_PREFIX), col(index).cast("string"))


def window_label(key: str | Column, start: str | Column, end: str | Column,
                 n: str | Column) -> Column:
    """One printed line per window: key, start and end to the millisecond, count."""
    a, b, c, d, e = WINDOW_LABEL_PARTS
    return F.concat(F.lit(a), col(key).cast("string"), F.lit(b), format_ts(start), F.lit(c),
                    format_ts(end), F.lit(d), col(n).cast("string"), F.lit(e))


def to_line(*cols: str | Column, sep: str = ",") -> Column:
    """Build a text record from columns (the inverse of the parsers)."""
    return F.concat_ws(sep, *[col(c).cast("string") for c in cols])
