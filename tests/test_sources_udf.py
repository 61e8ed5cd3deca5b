import os

import pandas as pd
from pyspark.sql import functions as F

from support import rows
from fixtures import HELLO_LINES
from tidemark.functions import udf
from tidemark.operators import aggregates
from tidemark.sources import files


def test_read_lines_word_count(spark, scratch):
    p = os.path.join(scratch, "hello.txt")
    with open(p, "w") as f:
        f.write("\n".join(HELLO_LINES))  # no newline at the end, like the reference's file
    got = dict(rows(aggregates.word_count(files.read_lines(spark, p))))
    assert got["hello"] == 5 and len(got) == 6


def test_elements_and_udfs(spark):
    df = files.elements(spark, ["a b", "c"])
    words = udf.flat_map(df, lambda b: pd.DataFrame({"w": [w for v in b.value for w in v.split(" ")]}),
                         "w string")
    assert rows(words) == [("a",), ("b",), ("c",)]
    upper = udf.map_values(lambda s: s.str.upper(), "string")
    assert rows(df.select(upper(F.col("value")).alias("u"))) == [("A B",), ("C",)]


def test_aggregate_values_per_window(spark):
    from tidemark.operators import windows

    df = spark.createDataFrame([("a", 1, 4), ("a", 2, 6), ("b", 3, 5)], "k string, t int, v long").withColumn(
        "ts", F.timestamp_seconds("t"))
    spread = udf.aggregate_values(lambda s: float(s.max() - s.min()), "double")
    out = windows.window_agg(df, ["k"], windows.tumbling("ts", "10 seconds"), [spread(F.col("v")).alias("r")])
    assert rows(out, "k", "r") == [("a", 2.0), ("b", 0.0)]
