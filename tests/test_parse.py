import pytest
from pyspark.sql import functions as F

from support import rows
from fixtures import BAD_USER_LINES, HELLO_LINES, SENSOR_LINES, USER_LINES
from tidemark.functions import parse
from tidemark.operators import aggregates


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_word_count_hello(spark):
    got = dict(rows(aggregates.word_count(lines(spark, HELLO_LINES))))
    assert got == {"hello": 5, "HPP": 1, "DYL": 1, "flink": 1, "MWT": 1, "world": 1}


@pytest.mark.parametrize("line,expected", [
    ("a  b ", ["a", "", "b"]),      # inner empty kept, trailing dropped
    (" a", ["", "a"]),              # leading empty kept
    ("", [""]),                     # empty line: one empty word
    ("   ", []),                    # spaces only: no word
    ("hello world", ["hello", "world"]),
])
def test_tokens_follow_java_split(spark, line, expected):
    got = lines(spark, [line]).select(parse.tokens("value").alias("t")).collect()[0]["t"]
    assert got == expected


def test_word_count_whole_texts(spark):
    df = spark.createDataFrame([("hello a\nhello b\n",), ("b",)], "text string")
    got = dict(rows(aggregates.word_count(df, "text", whole_texts=True)))
    assert got == {"hello": 2, "a": 1, "b": 2}


def test_parse_users_and_filter(spark):
    users = lines(spark, USER_LINES).select(*parse.parse_user("value"))
    assert users.schema.simpleString() == parse.USER_SCHEMA.simpleString()
    adults = users.where(F.col("age") > 18)
    assert rows(adults, "name", "age") == [("ann", 19), ("bob", 30)]
    # only name and age are read
    assert users.where(F.col("address").isNotNull() | F.col("id").isNotNull()).count() == 0


def test_parse_strict_fails_on_bad_line(spark):
    df = lines(spark, USER_LINES + BAD_USER_LINES[:1]).select(*parse.parse_user("value"))
    with pytest.raises(Exception):
        df.collect()


def test_parse_lenient_rejects(spark):
    good, bad = parse.parse_lenient(lines(spark, USER_LINES + BAD_USER_LINES), parse.parse_user,
                                    required=["name", "age"])
    assert good.count() == len(USER_LINES)
    assert sorted(r["line"] for r in bad.collect()) == sorted(BAD_USER_LINES)


def test_parse_readings(spark):
    df = lines(spark, SENSOR_LINES).select(*parse.parse_reading("value"))
    assert rows(df)[:2] == [("s1", 1, 1), ("s1", 1, 1)]
    assert df.schema.simpleString() == "struct<id:string,vc:int,count:int>"


def test_line_pairs_and_generator(spark):
    pairs = parse.line_pairs(lines(spark, ["x", "y", "x"]))
    assert rows(aggregates.keyed_sum(pairs, ["line"], "n")) == [("x", 2), ("y", 1)]
    gen = spark.range(3).select(parse.generated_text("id").alias("value"))
    assert [r.value for r in gen.orderBy("value").collect()] == [
        "输入数字为：0", "输入数字为：1", "输入数字为：2"]


def test_window_label_format(spark):
    df = spark.createDataFrame([("a", 0, 10, 3)], "k string, s int, e int, n long").select(
        parse.window_label("k", F.timestamp_seconds("s"), F.timestamp_seconds("e"), "n").alias("l"))
    assert df.collect()[0]["l"] == (
        "key=a的窗口，其开始时间为:【1970-01-01 00:00:00.000，结束时间为:1970-01-01 00:00:10.000】数据共有： 3条")


def test_parse_strict_fails_on_missing_field(spark):
    df = lines(spark, ["dora"]).select(*parse.parse_user("value"))
    with pytest.raises(Exception):
        df.collect()


def test_parse_pair_and_triple(spark):
    df = lines(spark, ["a,2", "b,3"]).select(*parse.parse_pair("value"))
    assert rows(df) == [("a", 2), ("b", 3)]
    df = lines(spark, ["a,2,11"]).select(*parse.parse_triple("value"))
    assert rows(df) == [("a", 2, 11)]
