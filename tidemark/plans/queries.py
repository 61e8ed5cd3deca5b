"""The registered queries: each operator of the inventory run over the driver's tables.

Every query reads whole tables (no id subsets, samples or row caps) and returns a lazy
DataFrame; its DuckDB equivalent is in :mod:`tidemark.plans.oracle` under the same name
with the same column names.

Conventions shared with the oracle:
* money is summed in integer cents (``cents``), exact in any order;
* ``events.ts`` stays ``timestamp_ntz`` in batch, so window bounds compare to DuckDB's
  ``TIMESTAMP``;
* disordered arrival is made from the table itself:
  ``arrival = epoch_us(ts) + (event_id * 7919 % 7200) * 1e6``, ties broken by ``event_id``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import formats, ids, parse
from tidemark.functions.time import cents, epoch_micros, interval
from tidemark.operators import aggregates, joins, lateness, running, topn, user_functions, windows
from tidemark.sources.tables import table

# Fixed parameters of the query set.
DELAY = "30 minutes"          # out-of-orderness bound D
ALLOWED = "20 minutes"        # allowed lateness L
JOIN_BOUND = "2 hours"        # interval join: +-2 hours
ARRIVAL_SPREAD_S = 7200       # arrival = event time + up to 2 hours of delay
ARRIVAL_STEP = 7919


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


def _with_cents(df: DataFrame) -> DataFrame:
    return df.withColumn("cents", cents("value"))


def _with_arrival(df: DataFrame) -> DataFrame:
    delay_us = (F.col("event_id") * ARRIVAL_STEP % ARRIVAL_SPREAD_S) * 1_000_000
    return df.withColumn("arrival", epoch_micros("ts") + delay_us)


ARRIVAL = ["arrival", "event_id"]

# --------------------------------------------------------------------------- parsing


def word_count(spark, sf):
    """S1 + T4 + A1: words of every line of every document, counted."""
    docs = table(spark, sf, "documents").select("text")
    return aggregates.word_count(docs, "text", whole_texts=True)


def line_count(spark, sf):
    """T5 + A1/A3: each event type as a line, (line, 1) summed per line."""
    lines = _events(spark, sf).select(F.col("event_type").alias("value"))
    pairs = parse.line_pairs(lines)
    return aggregates.keyed_sum(pairs, ["line"], "n")


def parse_users(spark, sf):
    """``event_type,user_id`` lines parsed back as User (name, age)."""
    ev = _events(spark, sf).select("event_id", parse.to_line("event_type", "user_id").alias("value"))
    users = ev.select("event_id", *parse.parse_user("value"))
    # The parser leaves id, address, email and create_time null; compare what it reads.
    return users.select("event_id", "name", "age")


def parse_readings(spark, sf):
    """``event_type,user_id,cents%100`` lines parsed back as sensor readings."""
    ev = _with_cents(_events(spark, sf))
    lines = ev.select("event_id", parse.to_line("event_type", "user_id", F.col("cents") % 100)
                      .alias("value"))
    return lines.select("event_id", *parse.parse_reading("value"))


def parse_pairs(spark, sf):
    """``"k,t"`` lines (user, event second) parsed back."""
    ev = _events(spark, sf)
    t = F.unix_seconds(F.col("ts").cast("timestamp"))
    lines = ev.select("event_id", parse.to_line("user_id", t).alias("value"))
    return lines.select("event_id", *parse.parse_pair("value"))


def parse_triples(spark, sf):
    """``"k,t,v"`` lines parsed back."""
    ev = _with_cents(_events(spark, sf))
    t = F.unix_seconds(F.col("ts").cast("timestamp"))
    lines = ev.select("event_id", parse.to_line("user_id", t, F.col("cents") % 100).alias("value"))
    return lines.select("event_id", *parse.parse_triple("value"))


def filter_gt(spark, sf):
    """Strict ``> 18`` filter."""
    ev = _events(spark, sf)
    return ev.where(F.col("value") > 18).select("event_id", "user_id", "value")


def generate_rows(spark, sf):
    """The generator's text for the index in each row of ``lineitem``."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return li.select("l_orderkey", "l_linenumber", parse.generated_text("l_orderkey").alias("value"))

# --------------------------------------------------------------------------- windows


def _count_cents():
    return [F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents")]


def window_tumbling(spark, sf):
    """1-hour tumbling windows per event type: rows and cents."""
    ev = _with_cents(_events(spark, sf))
    return windows.window_agg(ev, ["event_type"], windows.tumbling("ts", "1 hour"), _count_cents())


def window_sliding(spark, sf):
    """W2/W7 + A6: 10-minute windows sliding by 5 minutes per event type: rows."""
    ev = _events(spark, sf)
    return windows.window_agg(ev, ["event_type"], windows.sliding("ts", "10 minutes", "5 minutes"),
                              [F.count(F.lit(1)).alias("n")])


def window_all(spark, sf):
    """1-hour windows over all rows (no key), pre-aggregated in every task."""
    ev = _with_cents(_events(spark, sf))
    return windows.window_agg(ev, [], windows.tumbling("ts", "1 hour"), _count_cents())


def window_session(spark, sf):
    """Sessions per user with a 2-hour gap."""
    ev = _with_cents(_events(spark, sf)).select("user_id", "ts", "event_id", "cents")
    return windows.session_agg(ev, ["user_id"], "ts", "2 hours", "event_id", _count_cents())


def session_gap():
    """Gap per row, by event type."""
    t = F.col("event_type")
    return (F.when(t == "click", interval("30 minutes"))
            .when(t == "view", interval("1 hour")).otherwise(interval("2 hours")))


def window_session_dynamic(spark, sf):
    """Sessions per user with a gap per row (by event type)."""
    ev = _with_cents(_events(spark, sf)).select("user_id", "ts", "event_id", "event_type", "cents")
    return windows.session_agg(ev, ["user_id"], "ts", session_gap(), "event_id", _count_cents())


def window_count_tumbling(spark, sf):
    """Groups of 5 consecutive events per user (full groups only)."""
    ev = _with_cents(_events(spark, sf)).select("user_id", "event_id", "cents")
    return windows.count_tumbling(ev, ["user_id"], ["event_id"], 5, [
        F.min("event_id").alias("first_event_id"), F.max("event_id").alias("last_event_id"),
        F.sum("cents").alias("cents")])


def window_count_sliding(spark, sf):
    """Every 2nd event per user, the last up-to-5 events."""
    ev = _with_cents(_events(spark, sf)).select("user_id", "event_id", "cents")
    return windows.count_sliding(ev, ["user_id"], ["event_id"], 5, 2, {
        "n": F.count(F.lit(1)), "first_event_id": F.min("event_id"), "cents": F.sum("cents")})


def window_reduce(spark, sf):
    """A4: per user and hour, first id, summed cents, blanked text when > 1 row."""
    ev = _with_cents(_events(spark, sf))
    return aggregates.window_reduce(ev, ["user_id"], windows.tumbling("ts", "1 hour"), "event_id",
                                    ["event_id"], "cents", ["event_type", "props"])


def window_process(spark, sf):
    """Per user and hour, start, end, row count and cents (built-ins)."""
    ev = _with_cents(_events(spark, sf))
    return windows.window_agg(ev, ["user_id"], windows.tumbling("ts", "1 hour"), _count_cents())


def window_aggregate(spark, sf):
    """A5: per user and hour, the summed cents as the aggregate's result text."""
    ev = _with_cents(_events(spark, sf))
    return aggregates.window_aggregate(ev, ["user_id"], windows.tumbling("ts", "1 hour"),
                                       F.sum("cents"), as_text=True, name="result")


class CentsSpread(user_functions.UserAggregate):
    """Count, sum and ``n * sum of squares - sum squared`` of whole cents."""

    def create(self):
        return 0, 0, 0

    def add(self, state, rows):
        cents = rows.column("cents").drop_null().to_pylist()
        return state[0] + len(cents), state[1] + sum(cents), state[2] + sum(c * c for c in cents)

    def merge(self, a, b):
        return tuple(x + y for x, y in zip(a, b, strict=True))

    def result(self, state):
        n, total, squares = state
        return {"n": n, "cents": total, "spread": n * squares - total * total}


def _daily_events(spark, sf):
    day = windows.tumbling("ts", "1 day")
    return _with_cents(_events(spark, sf)).select("event_id", "event_type", "ts", "cents", day.start.alias("window_start"))


def window_user_aggregate(spark, sf):
    """A user's create / add / merge / result per event type and day."""
    return user_functions.user_aggregate(_daily_events(spark, sf), ["event_type", "window_start"], CentsSpread(),
                                         "n long, cents long, spread long")


def _longest_gap(key, batches):
    n, last, gap = 0, None, 0
    for b in batches:
        for t in b.column("us").to_pylist():
            n, gap, last = n + 1, max(gap, t - last if n else 0), t
    yield {**key, "n": n, "longest_gap_us": gap}


def window_process_rows(spark, sf):
    """A full-window function over the rows of each event type and day, in time
    order: how many, and the longest time between two of them."""
    events = _daily_events(spark, sf).withColumn("us", epoch_micros("ts"))
    return user_functions.process_groups(events, ["event_type", "window_start"], _longest_gap,
                                         "event_type string, window_start timestamp_ntz, n long, longest_gap_us long", order=["us", "event_id"])


def window_fold_ordered(spark, sf):
    """An ordered fold that is not commutative, per event type: the first and the last
    value, and how often a value is above the one before."""
    return user_functions.fold_ordered(
        _daily_events(spark, sf), ["event_type"], ["ts", "event_id"], lambda r: (r["cents"], r["cents"], 0),
        lambda a, b: (a[0], b[1], a[2] + b[2] + (b[0] > a[1])),
        lambda s: {"first_cents": s[0], "last_cents": s[1], "rises": s[2]}, "first_cents long, last_cents long, rises long")


def window_agg_process(spark, sf):
    """Per user and hour, the aggregate together with the true row count."""
    ev = _with_cents(_events(spark, sf))
    return aggregates.window_agg_with_context(ev, ["user_id"], windows.tumbling("ts", "1 hour"),
                                              [F.sum("cents").alias("cents")])


def window_label(spark, sf):
    """Per user and hour, the printed window line."""
    ev = _events(spark, sf)
    w = windows.window_agg(ev, ["user_id"], windows.tumbling("ts", "1 hour"),
                           [F.count(F.lit(1)).alias("n")])
    return w.select("user_id", parse.window_label("user_id", "window_start", "window_end", "n")
                    .alias("label"))

# --------------------------------------------------------------------------- joins


def _clicks_purchases(spark, sf):
    ev = _events(spark, sf)
    clicks = ev.where(F.col("event_type") == "click").select(
        "user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts"))
    purchases = ev.where(F.col("event_type") == "purchase").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts"))
    return clicks, purchases


def window_join(spark, sf):
    """Clicks and purchases of the same user in the same hour."""
    clicks, purchases = _clicks_purchases(spark, sf)
    return joins.window_join(clicks, purchases, "user_id", "click_ts", "purchase_ts", "1 hour")


def interval_join(spark, sf):
    """Clicks and purchases of the same user within +-2 hours (time-bucketed)."""
    clicks, purchases = _clicks_purchases(spark, sf)
    return joins.interval_join(clicks, purchases, "user_id", "click_ts", "purchase_ts",
                               JOIN_BOUND, JOIN_BOUND)


def _join_sides_flagged(spark, sf):
    ev = _with_arrival(_events(spark, sf))
    clicks = ev.where(F.col("event_type") == "click").select(
        "user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts"),
        "event_id", "arrival")
    purchases = ev.where(F.col("event_type") == "purchase").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts"),
        "event_id", "arrival")
    return lateness.join_lateness(clicks, purchases, "click_ts", "purchase_ts", ARRIVAL, DELAY)


def interval_join_plain(spark, sf):
    """J2, second bucketing: 30-minute time buckets, so each purchase reaches up to 9
    buckets -- the same pairs as ``interval_join`` by a finer cut."""
    clicks, purchases = _clicks_purchases(spark, sf)
    return joins.interval_join(clicks, purchases, "user_id", "click_ts", "purchase_ts",
                               JOIN_BOUND, JOIN_BOUND, bucket_width="30 minutes")


def window_join_watermarked(spark, sf):
    """Clicks and purchases of the same user and hour, without rows that arrive when
    the joint watermark has passed their hour."""
    ev = _with_arrival(_events(spark, sf)).withColumn("seq", F.col("event_id"))
    sides = [ev.where(F.col("event_type") == kind).select(
        "user_id", F.col("event_id").alias(f"{kind}_id"), F.col("ts").alias(f"{kind}_ts"), "arrival", "seq")
        for kind in ("click", "purchase")]
    return joins.window_join_watermarked(*sides, "user_id", "click_ts", "purchase_ts", "1 hour", ["arrival", "seq"], DELAY)


def assigned_event_time(spark, sf):
    """Event time from an integer field, here the order key as seconds."""
    orders = lateness.with_event_time(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", "event_ts")
    return orders.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


def processing_stamps(spark, sf):
    """Current date and time and an id of 32 hex digits on every row. Their values differ by
    run, so the result says of what kind they are."""
    stamped = table(spark, sf, "orders").select("o_orderkey", F.current_date().alias("d"), F.current_timestamp().alias("t"),
                                                ids.random_id().alias("id"))
    return stamped.select("o_orderkey", (F.col("d") == F.to_date("t")).alias("dated_today"), F.col("t").isNotNull().alias("stamped"),
                          F.col("id").rlike("^[0-9a-f]{32}$").alias("hex_id"))


def interval_join_late(spark, sf):
    """J3 main output: pairs within +-2 h whose two rows are both not late."""
    l, r = _join_sides_flagged(spark, sf)
    return joins.interval_join(l.where(~F.col("late")).select("user_id", "click_id", "click_ts"),
                               r.where(~F.col("late")).select("user_id", "purchase_id", "purchase_ts"),
                               "user_id", "click_ts", "purchase_ts", JOIN_BOUND, JOIN_BOUND)


def interval_join_late_left(spark, sf):
    """J3 / L7 side output: late rows of the left (click) input."""
    l, _ = _join_sides_flagged(spark, sf)
    return l.where(F.col("late")).select("user_id", "click_id", "click_ts")


def interval_join_late_right(spark, sf):
    """J3 / L7 side output: late rows of the right (purchase) input."""
    _, r = _join_sides_flagged(spark, sf)
    return r.where(F.col("late")).select("user_id", "purchase_id", "purchase_ts")

# --------------------------------------------------------------------------- state


def running_sum(spark, sf):
    """A3: per user, running sum of cents in event order, one row per event."""
    ev = _with_cents(_events(spark, sf)).select("event_id", "user_id", "cents")
    return running.running_sum(ev, ["user_id"], ["event_id"], "cents",
                               name="running_cents").drop("cents")


def running_count(spark, sf):
    """ST1: per user and event type, running row count, one row per event."""
    ev = _events(spark, sf).select("event_id", "user_id", "event_type")
    return running.running_count(ev, ["user_id", "event_type"], ["event_id"], name="running_n")


def running_avg(spark, sf):
    """ST2: per user, running average of cents (double), one row per event."""
    ev = _with_cents(_events(spark, sf)).select("event_id", "user_id", "cents")
    return running.running_avg(ev, ["user_id"], ["event_id"], "cents",
                               name="running_avg_cents").drop("cents")


def window_top_n(spark, sf):
    """ST4: per 10-minute window sliding by 5, the 2 users with most events."""
    ev = _events(spark, sf)
    counts = windows.window_agg(ev, ["user_id"], windows.sliding("ts", "10 minutes", "5 minutes"),
                                [F.count(F.lit(1)).alias("n")])
    best = topn.top_n(counts, ["window_start", "window_end"],
                      [F.col("n").desc(), F.col("user_id").asc()], 2, salt_cols=["user_id"])
    return best.select("window_start", "window_end", "rank", "user_id", "n")


def window_top_n_text(spark, sf):
    """ST4: the printed block of each window's top 2 (at most 2 rows a window are joined)."""
    ranked = window_top_n(spark, sf)
    one = ranked.groupBy("window_end").agg(F.array_sort(F.collect_list(
        F.struct("rank", F.col("user_id").alias("key"), "n"))).alias("ranked"))
    return one.select("window_end", formats.top_n_text("ranked", "window_end").alias("result"))

# --------------------------------------------------------------------------- lateness


def _classified(spark, sf):
    ev = _with_arrival(_events(spark, sf)).select("event_id", "event_type", "ts", "arrival")
    return lateness.classify_window_rows(ev, "ts", ARRIVAL, "1 hour", DELAY, ALLOWED)


def late_events(spark, sf):
    """Every row in disordered arrival with its window, watermark and class."""
    return _classified(spark, sf).select("event_id", "event_type", "ts", "arrival",
                                         "window_start", "window_end", "wm", "lateness")


def _watermarked(spark, sf, delay):
    ev = _with_cents(_with_arrival(_events(spark, sf))).select(
        "event_id", "event_type", "ts", "arrival", "cents")
    return lateness.watermarked_windows(ev, ["event_type"], "ts", ARRIVAL, "1 hour", delay,
                                        _count_cents())


def window_watermark_ascending(spark, sf):
    """W6 + L2: ascending-timestamp watermark (no wait) over disordered arrival."""
    return _watermarked(spark, sf, "0 seconds")


def window_watermark_bounded(spark, sf):
    """W6 + L3: bounded out-of-orderness watermark (30 minutes)."""
    return _watermarked(spark, sf, DELAY)


def late_rows(spark, sf):
    """L6 side output alone: the rows past the allowed lateness."""
    late = lateness.side_outputs(_classified(spark, sf))["late"]
    return late.select("event_id", "event_type", "ts", "window_start", "window_end", "wm")


def window_watermark_sliding(spark, sf):
    """W7 + L3: 2-hour windows sliding by 1 under the bounded watermark, per event type."""
    ev = _with_cents(_with_arrival(_events(spark, sf))).select(
        "event_id", "event_type", "ts", "arrival", "cents")
    return lateness.watermarked_windows(ev, ["event_type"], "ts", ARRIVAL, "2 hours", DELAY,
                                        _count_cents(), slide="1 hour")


def window_top_n_watermarked(spark, sf):
    """ST4 + L3: per 2-hour window sliding by 1, the 2 users with most on-time events."""
    ev = _with_arrival(_events(spark, sf)).select("event_id", "user_id", "ts", "arrival")
    counts = lateness.watermarked_windows(ev, ["user_id"], "ts", ARRIVAL, "2 hours", DELAY,
                                          [F.count(F.lit(1)).alias("n")], slide="1 hour")
    best = topn.top_n(counts, ["window_start", "window_end"],
                      [F.col("n").desc(), F.col("user_id").asc()], 2, salt_cols=["user_id"])
    return best.select("window_start", "window_end", "rank", "user_id", "n")


def window_refinements(spark, sf):
    """Every firing of every (event type, hour) window with its row count."""
    return lateness.refinements(_classified(spark, sf), ["event_type"], ARRIVAL)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "word_count": word_count,
    "line_count": line_count,
    "parse_users": parse_users,
    "parse_readings": parse_readings,
    "parse_pairs": parse_pairs,
    "parse_triples": parse_triples,
    "filter_gt": filter_gt,
    "generate_rows": generate_rows,
    "window_tumbling": window_tumbling,
    "window_sliding": window_sliding,
    "window_all": window_all,
    "window_session": window_session,
    "window_session_dynamic": window_session_dynamic,
    "window_count_tumbling": window_count_tumbling,
    "window_count_sliding": window_count_sliding,
    "window_reduce": window_reduce,
    "window_process": window_process,
    "window_process_rows": window_process_rows,
    "window_user_aggregate": window_user_aggregate,
    "window_fold_ordered": window_fold_ordered,
    "window_aggregate": window_aggregate,
    "window_agg_process": window_agg_process,
    "window_label": window_label,
    "window_join": window_join,
    "interval_join": interval_join,
    "interval_join_plain": interval_join_plain,
    "window_join_watermarked": window_join_watermarked,
    "assigned_event_time": assigned_event_time,
    "processing_stamps": processing_stamps,
    "interval_join_late": interval_join_late,
    "interval_join_late_left": interval_join_late_left,
    "interval_join_late_right": interval_join_late_right,
    "running_sum": running_sum,
    "running_count": running_count,
    "running_avg": running_avg,
    "window_top_n": window_top_n,
    "window_top_n_text": window_top_n_text,
    "window_watermark_ascending": window_watermark_ascending,
    "window_watermark_bounded": window_watermark_bounded,
    "late_events": late_events,
    "late_rows": late_rows,
    "window_refinements": window_refinements,
    "window_watermark_sliding": window_watermark_sliding,
    "window_top_n_watermarked": window_top_n_watermarked,
}
