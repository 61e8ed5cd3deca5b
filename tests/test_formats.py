from pyspark.sql import functions as F

from fixtures import JOIN_LEFT, WINDOW_JOIN_RIGHT
from tidemark.functions import formats
from tidemark.operators import joins


def test_join_text_like_java_tuples(spark):
    l = spark.createDataFrame(JOIN_LEFT[:1], "k string, lt int").withColumn("lts", F.timestamp_seconds("lt"))
    r = spark.createDataFrame(WINDOW_JOIN_RIGHT[:1], "k string, rt int, v int").withColumn(
        "rts", F.timestamp_seconds("rt"))
    j = joins.window_join(l, r, "k", "lts", "rts", "5 seconds")
    text = j.select(formats.join_text(formats.tuple_text("k", "lt"), formats.tuple_text("k", "rt", "v")).alias("t"))
    assert text.collect()[0].t == "(a,2)<----->(a,2,11)"
    text = j.select(formats.join_text(formats.tuple_text("k", "lt"), formats.tuple_text("k", "rt", "v"),
                                      window_join=False).alias("t"))
    assert text.collect()[0].t == "(a,2)<---->(a,2,11)"


def test_state_and_aggregate_texts(spark):
    df = spark.createDataFrame([("s1", 2, 3, 4 / 3, 36)], "id string, vc int, n long, a double, s long")
    r = df.select(formats.level_count_text("id", "vc", "n").alias("c"), formats.average_text("id", "a").alias("v"),
                  formats.aggregate_result_text("s").alias("g")).collect()[0]
    assert r.c == "水位传感器为:【s1 】水位线为：【2 】出现的次数为：3"
    assert r.v == "传感器为【s1】平均水位值为：1.3333333333333333"
    assert r.g == "最终结果的输出为：36"
