"""Text forms of results, as the reference prints them (column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.time import col

# Fixed values that must equal the reference's output text.
WINDOW_JOIN_SEP = "<----->"
INTERVAL_JOIN_SEP = "<---->"
AGGREGATE_RESULT_PREFIX = "最终结果的输出为："
LEVEL_COUNT_PARTS = ("水位传感器为:【", " 】水位线为：【", " 】出现的次数为：")
AVERAGE_PARTS = ("传感器为【", "】平均水位值为：")
TOP_N_START = "*********   start     ****\n"
TOP_N_RANK_PARTS = ("Top 【 ", " 】\n")
TOP_N_KEY = "age ="
TOP_N_COUNT = "count ="
TOP_N_END_PARTS = ("窗口i结束时间为：【 ", " 】\n")
TOP_N_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
TOP_N_END = "******  end    *******\n"


def tuple_text(*cols: str | Column) -> Column:
    """A tuple as Java prints it: ``(a,2,11)``."""
    return F.concat(F.lit("("), F.concat_ws(",", *[col(c).cast("string") for c in cols]), F.lit(")"))


def join_text(left: Column, right: Column, window_join: bool = True) -> Column:
    """J1 / J2 result line: ``(a,2)<----->(a,2,11)`` (window join) or with ``<---->``
    (interval join)."""
    return F.concat(left, F.lit(WINDOW_JOIN_SEP if window_join else INTERVAL_JOIN_SEP), right)


def aggregate_result_text(value: str | Column) -> Column:
    """A5 result rendered by the aggregate's ``getResult``."""
    return F.concat(F.lit(AGGREGATE_RESULT_PREFIX), col(value).cast("string"))


def level_count_text(sensor: str | Column, level: str | Column, n: str | Column) -> Column:
    """ST1 output line: sensor, level and how often the level occurred so far."""
    a, b, c = LEVEL_COUNT_PARTS
    return F.concat(F.lit(a), col(sensor).cast("string"), F.lit(b), col(level).cast("string"),
                    F.lit(c), col(n).cast("string"))


def average_text(sensor: str | Column, avg: str | Column) -> Column:
    """ST2 output line: sensor and its running average level (a double)."""
    a, b = AVERAGE_PARTS
    return F.concat(F.lit(a), col(sensor).cast("string"), F.lit(b), col(avg).cast("string"))


def top_n_text(ranked: str | Column, window_end: str | Column) -> Column:
    """ST4 output block of one window: ``ranked`` is its array of (rank, key, n) structs in
    order of rank."""
    a, b = TOP_N_RANK_PARTS
    lines = F.transform(col(ranked), lambda r: F.concat(
        F.lit(a), r["rank"].cast("string"), F.lit(b), F.lit(TOP_N_KEY), r["key"].cast("string"), F.lit("\n"),
        F.lit(TOP_N_COUNT), r["n"].cast("string"), F.lit("\n")))
    c, d = TOP_N_END_PARTS
    return F.concat(F.lit(TOP_N_START), F.array_join(lines, ""), F.lit(c),
                    F.date_format(col(window_end), TOP_N_TIME_FORMAT), F.lit(d), F.lit(TOP_N_END))
