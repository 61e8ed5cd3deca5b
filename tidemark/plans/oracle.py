"""DuckDB SQL equivalents of :mod:`tidemark.plans.queries`, one per query name, with the
same output column names. They are the definitions the Spark plans are checked
against, written the straightforward way (single-window running aggregates, cross joins
with small ranges), which is fine for a single-node oracle at small scale.
"""

from __future__ import annotations

CENTS = "CAST(ROUND(value * 100) AS BIGINT)"
ARRIVAL = "epoch_us(ts) + (event_id * 7919 % 7200) * 1000000"

_SESSION = """
WITH s AS (
  SELECT user_id, event_id, ts, {cents} AS c, ts + {gap} AS en,
         MAX(ts + {gap}) OVER (PARTITION BY user_id ORDER BY ts, event_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_en
  FROM events),
f AS (
  SELECT *, SUM(CASE WHEN prev_en IS NULL OR ts > prev_en THEN 1 ELSE 0 END)
            OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid
  FROM s)
SELECT user_id, MIN(ts) AS session_start, MAX(en) AS session_end, COUNT(*) AS n,
       CAST(SUM(c) AS BIGINT) AS cents
FROM f GROUP BY user_id, sid
"""

_DYNAMIC_GAP = ("(CASE WHEN event_type = 'click' THEN INTERVAL 30 MINUTE "
                "WHEN event_type = 'view' THEN INTERVAL 1 HOUR ELSE INTERVAL 2 HOUR END)")

_HOURLY_BY_USER = f"""
SELECT user_id, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       COUNT(*) AS n, CAST(SUM({CENTS}) AS BIGINT) AS cents
FROM events GROUP BY ALL
"""

_CLASSIFIED = f"""
a AS (SELECT event_id, event_type, ts, {ARRIVAL} AS arrival FROM events),
m AS (SELECT *, MAX(ts) OVER (ORDER BY arrival, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                - INTERVAL 30 MINUTE AS wm,
             time_bucket(INTERVAL 1 HOUR, ts) AS window_start
      FROM a),
c AS (SELECT *, window_start + INTERVAL 1 HOUR AS window_end,
             CASE WHEN wm IS NULL OR window_start + INTERVAL 1 HOUR > wm THEN 'on_time'
                  WHEN window_start + INTERVAL 80 MINUTE > wm THEN 'allowed_late'
                  ELSE 'late' END AS lateness
      FROM m)
"""

_WATERMARKED = """
WITH a AS (SELECT event_type, ts, {cents} AS c, {arrival} AS arrival, event_id FROM events),
m AS (SELECT *, MAX(ts) OVER (ORDER BY arrival, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                - INTERVAL {delay} AS wm,
             time_bucket(INTERVAL 1 HOUR, ts) AS window_start
      FROM a)
SELECT event_type, window_start, window_start + INTERVAL 1 HOUR AS window_end, COUNT(*) AS n,
       CAST(SUM(c) AS BIGINT) AS cents
FROM m WHERE wm IS NULL OR window_start + INTERVAL 1 HOUR > wm
GROUP BY ALL
"""

_ON_TIME_SLIDING = f"""
a AS (SELECT event_id, user_id, event_type, ts, {CENTS} AS c, {ARRIVAL} AS arrival FROM events),
m AS (SELECT *, MAX(ts) OVER (ORDER BY arrival, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                - INTERVAL 30 MINUTE AS wm
      FROM a),
w AS (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) - i * INTERVAL 1 HOUR AS window_start FROM m, range(2) r(i)),
o AS (SELECT *, window_start + INTERVAL 2 HOUR AS window_end FROM w
      WHERE wm IS NULL OR window_start + INTERVAL 2 HOUR > wm)
"""

_CLICKS = "SELECT user_id, event_id AS click_id, ts AS click_ts FROM events WHERE event_type = 'click'"
_PURCHASES = ("SELECT user_id, event_id AS purchase_id, ts AS purchase_ts FROM events "
              "WHERE event_type = 'purchase'")

_INTERVAL_JOIN = f"""
SELECT l.user_id, l.click_id, l.click_ts, r.purchase_id, r.purchase_ts
FROM ({_CLICKS}) l JOIN ({_PURCHASES}) r
  ON l.user_id = r.user_id
 AND r.purchase_ts BETWEEN l.click_ts - INTERVAL 2 HOUR AND l.click_ts + INTERVAL 2 HOUR
"""

_JOIN_FLAGS = f"""
u AS (SELECT event_id, user_id, ts, event_type = 'click' AS is_left, {ARRIVAL} AS arrival
      FROM events WHERE event_type IN ('click', 'purchase')),
m AS (SELECT *, MAX(CASE WHEN is_left THEN ts END) OVER o AS ml,
                MAX(CASE WHEN NOT is_left THEN ts END) OVER o AS mr
      FROM u WINDOW o AS (ORDER BY arrival, event_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, CASE WHEN ml IS NOT NULL AND mr IS NOT NULL THEN least(ml, mr) - INTERVAL 30 MINUTE END AS joint,
                COALESCE(ts < CASE WHEN ml IS NOT NULL AND mr IS NOT NULL
                                   THEN least(ml, mr) - INTERVAL 30 MINUTE END, FALSE) AS late
      FROM m)
"""

ORACLE: dict[str, str] = {
    "word_count": """
WITH lines AS (SELECT unnest(string_split(regexp_replace(text, '\\n$', ''), chr(10))) AS line
               FROM documents),
toks AS (SELECT CASE WHEN line = '' THEN ['']
                     WHEN rtrim(line, ' ') = '' THEN []::VARCHAR[]
                     ELSE string_split(rtrim(line, ' '), ' ') END AS ws
         FROM lines)
SELECT w AS word, COUNT(*) AS n FROM (SELECT unnest(ws) AS w FROM toks) GROUP BY w
""",
    "line_count": "SELECT event_type AS line, CAST(SUM(1) AS BIGINT) AS n FROM events GROUP BY event_type",
    "parse_users": """
SELECT event_id, event_type AS name, CAST(user_id AS INTEGER) AS age FROM events
""",
    "parse_readings": f"""
SELECT event_id, event_type AS id, CAST(user_id AS INTEGER) AS vc,
       CAST({CENTS} % 100 AS INTEGER) AS count
FROM events
""",
    "parse_pairs": """
SELECT event_id, CAST(user_id AS VARCHAR) AS k, CAST(epoch_us(ts) // 1000000 AS INTEGER) AS t
FROM events
""",
    "parse_triples": f"""
SELECT event_id, CAST(user_id AS VARCHAR) AS k, CAST(epoch_us(ts) // 1000000 AS INTEGER) AS t,
       CAST({CENTS} % 100 AS INTEGER) AS v
FROM events
""",
    "filter_gt": "SELECT event_id, user_id, value FROM events WHERE value > 18",
    "generate_rows": """
SELECT l_orderkey, l_linenumber, '输入数字为：' || CAST(l_orderkey AS VARCHAR) AS value FROM lineitem
""",
    "window_tumbling": f"""
SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       COUNT(*) AS n, CAST(SUM({CENTS}) AS BIGINT) AS cents
FROM events GROUP BY ALL
""",
    "window_sliding": """
SELECT event_type, window_start, window_start + INTERVAL 10 MINUTE AS window_end, COUNT(*) AS n
FROM (SELECT event_type, time_bucket(INTERVAL 5 MINUTE, ts) - i * INTERVAL 5 MINUTE AS window_start
      FROM events, range(2) r(i))
GROUP BY ALL
""",
    "window_all": f"""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       COUNT(*) AS n, CAST(SUM({CENTS}) AS BIGINT) AS cents
FROM events GROUP BY ALL
""",
    "window_session": _SESSION.format(cents=CENTS, gap="INTERVAL 2 HOUR"),
    "window_session_dynamic": _SESSION.format(cents=CENTS, gap=_DYNAMIC_GAP),
    "window_count_tumbling": f"""
WITH r AS (SELECT user_id, event_id, {CENTS} AS c,
                  ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) AS rn
           FROM events)
SELECT user_id, CAST((rn - 1) // 5 AS BIGINT) AS group_no, MIN(event_id) AS first_event_id,
       MAX(event_id) AS last_event_id, CAST(SUM(c) AS BIGINT) AS cents
FROM r GROUP BY user_id, (rn - 1) // 5 HAVING COUNT(*) = 5
""",
    "window_count_sliding": f"""
WITH r AS (SELECT user_id, event_id, {CENTS} AS c,
                  ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) AS rn
           FROM events),
w AS (SELECT user_id, rn, COUNT(*) OVER f AS n, MIN(event_id) OVER f AS first_event_id,
             SUM(c) OVER f AS cents
      FROM r WINDOW f AS (PARTITION BY user_id ORDER BY event_id
                          ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
SELECT user_id, CAST(rn AS BIGINT) AS fire_seq, n, first_event_id, CAST(cents AS BIGINT) AS cents
FROM w WHERE rn % 2 = 0
""",
    "window_reduce": f"""
SELECT user_id, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       MIN(event_id) AS event_id, CAST(SUM({CENTS}) AS BIGINT) AS cents,
       CASE WHEN COUNT(*) > 1 THEN '' ELSE arg_min(event_type, event_id) END AS event_type,
       CASE WHEN COUNT(*) > 1 THEN '' ELSE arg_min(props, event_id) END AS props
FROM events GROUP BY ALL
""",
    "window_process": _HOURLY_BY_USER,
    "window_process_rows": f"""
SELECT event_type, window_start, COUNT(*) AS n, COALESCE(MAX(gap), 0) AS longest_gap_us
FROM (SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS window_start,
             epoch_us(ts) - LAG(epoch_us(ts)) OVER (PARTITION BY event_type, date_trunc('day', ts) ORDER BY ts, event_id) AS gap
      FROM events)
GROUP BY event_type, window_start
""",
    "window_user_aggregate": f"""
SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS window_start, COUNT(*) AS n, CAST(SUM({CENTS}) AS BIGINT) AS cents,
       CAST(COUNT(*) * SUM({CENTS} * {CENTS}) - SUM({CENTS}) * SUM({CENTS}) AS BIGINT) AS spread
FROM events GROUP BY ALL
""",
    "window_fold_ordered": f"""
SELECT event_type, FIRST(c ORDER BY ts, event_id) AS first_cents, LAST(c ORDER BY ts, event_id) AS last_cents,
       COUNT(*) FILTER (WHERE c > before) AS rises
FROM (SELECT event_type, ts, event_id, {CENTS} AS c,
             LAG({CENTS}) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS before FROM events)
GROUP BY event_type
""",
    "window_aggregate": f"""
SELECT user_id, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       '最终结果的输出为：' || CAST(CAST(SUM({CENTS}) AS BIGINT) AS VARCHAR) AS result
FROM events GROUP BY ALL
""",
    "window_agg_process": _HOURLY_BY_USER,
    "window_label": """
WITH w AS (SELECT user_id, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, COUNT(*) AS n
           FROM events GROUP BY ALL)
SELECT user_id,
       'key=' || CAST(user_id AS VARCHAR) || '的窗口，其开始时间为:【'
       || strftime(window_start, '%Y-%m-%d %H:%M:%S.%g') || '，结束时间为:'
       || strftime(window_start + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S.%g')
       || '】数据共有： ' || CAST(n AS VARCHAR) || '条' AS label
FROM w
""",
    "window_join": f"""
SELECT l.user_id, time_bucket(INTERVAL 1 HOUR, l.click_ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, l.click_ts) + INTERVAL 1 HOUR AS window_end,
       l.click_id, l.click_ts, r.purchase_id, r.purchase_ts
FROM ({_CLICKS}) l JOIN ({_PURCHASES}) r
  ON l.user_id = r.user_id
 AND time_bucket(INTERVAL 1 HOUR, l.click_ts) = time_bucket(INTERVAL 1 HOUR, r.purchase_ts)
""",
    "interval_join": _INTERVAL_JOIN,
    "interval_join_plain": _INTERVAL_JOIN,
    "window_join_watermarked": f"""
WITH {_JOIN_FLAGS},
w AS (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) AS ws FROM c
      WHERE joint IS NULL OR time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR > joint)
SELECT l.user_id, l.ws AS window_start, l.ws + INTERVAL 1 HOUR AS window_end, l.event_id AS click_id, l.ts AS click_ts,
       r.event_id AS purchase_id, r.ts AS purchase_ts
FROM w l JOIN w r ON l.user_id = r.user_id AND l.ws = r.ws WHERE l.is_left AND NOT r.is_left
""",
    "assigned_event_time": """
SELECT o_orderkey, make_timestamp(o_orderkey * 1000000) AS event_ts FROM orders
""",
    "processing_stamps": """
SELECT o_orderkey, true AS dated_today, true AS stamped, true AS hex_id FROM orders
""",
    "interval_join_late": f"""
WITH {_JOIN_FLAGS}
SELECT l.user_id, l.event_id AS click_id, l.ts AS click_ts, r.event_id AS purchase_id,
       r.ts AS purchase_ts
FROM c l JOIN c r
  ON l.user_id = r.user_id AND r.ts BETWEEN l.ts - INTERVAL 2 HOUR AND l.ts + INTERVAL 2 HOUR
WHERE l.is_left AND NOT r.is_left AND NOT l.late AND NOT r.late
""",
    "interval_join_late_left": f"""
WITH {_JOIN_FLAGS}
SELECT user_id, event_id AS click_id, ts AS click_ts FROM c WHERE is_left AND late
""",
    "interval_join_late_right": f"""
WITH {_JOIN_FLAGS}
SELECT user_id, event_id AS purchase_id, ts AS purchase_ts FROM c WHERE NOT is_left AND late
""",
    "running_sum": f"""
SELECT event_id, user_id,
       CAST(SUM({CENTS}) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)
            AS BIGINT) AS running_cents
FROM events
""",
    "running_count": """
SELECT event_id, user_id, event_type,
       COUNT(*) OVER (PARTITION BY user_id, event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING)
       AS running_n
FROM events
""",
    "running_avg": f"""
SELECT event_id, user_id,
       CAST(SUM({CENTS}) OVER o AS BIGINT) / COUNT(*) OVER o AS running_avg_cents
FROM events WINDOW o AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)
""",
    "window_top_n": """
WITH w AS (SELECT user_id, time_bucket(INTERVAL 5 MINUTE, ts) - i * INTERVAL 5 MINUTE AS window_start
           FROM events, range(2) r(i)),
c AS (SELECT window_start, user_id, COUNT(*) AS n FROM w GROUP BY ALL),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY window_start ORDER BY n DESC, user_id) AS rk FROM c)
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, CAST(rk AS BIGINT) AS rank,
       user_id, n
FROM r WHERE rk <= 2
""",
    "window_top_n_text": """
WITH t AS (WITH w AS (SELECT user_id, time_bucket(INTERVAL 5 MINUTE, ts) - i * INTERVAL 5 MINUTE AS window_start
           FROM events, range(2) r(i)),
c AS (SELECT window_start, user_id, COUNT(*) AS n FROM w GROUP BY ALL),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY window_start ORDER BY n DESC, user_id) AS rk FROM c)
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, CAST(rk AS BIGINT) AS rank,
       user_id, n
FROM r WHERE rk <= 2)
SELECT window_end, '*********   start     ****' || chr(10)
  || string_agg('Top 【 ' || rank || ' 】' || chr(10) || 'age =' || user_id || chr(10) || 'count =' || n || chr(10), '' ORDER BY rank)
  || '窗口i结束时间为：【 ' || strftime(window_end, '%Y-%m-%d %H:%M:%S.%g') || ' 】' || chr(10) || '******  end    *******' || chr(10) AS result
FROM t GROUP BY window_end
""",
    "late_events": f"""
WITH {_CLASSIFIED}
SELECT event_id, event_type, ts, arrival, window_start, window_end, wm, lateness FROM c
""",
    "window_watermark_ascending": _WATERMARKED.format(delay="0 SECOND", cents=CENTS, arrival=ARRIVAL),
    "window_watermark_bounded": _WATERMARKED.format(delay="30 MINUTE", cents=CENTS, arrival=ARRIVAL),
    "late_rows": f"""
WITH {_CLASSIFIED}
SELECT event_id, event_type, ts, window_start, window_end, wm FROM c WHERE lateness = 'late'
""",
    "window_watermark_sliding": f"""
WITH {_ON_TIME_SLIDING}
SELECT event_type, window_start, window_end, COUNT(*) AS n, CAST(SUM(c) AS BIGINT) AS cents FROM o GROUP BY ALL
""",
    "window_top_n_watermarked": f"""
WITH {_ON_TIME_SLIDING},
g AS (SELECT window_start, window_end, user_id, COUNT(*) AS n FROM o GROUP BY ALL),
k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY window_start ORDER BY n DESC, user_id) AS rk FROM g)
SELECT window_start, window_end, CAST(rk AS BIGINT) AS rank, user_id, n FROM k WHERE rk <= 2
""",
    "window_refinements": f"""
WITH {_CLASSIFIED},
b AS (SELECT event_type, window_start, window_end,
             COUNT(*) FILTER (WHERE lateness = 'on_time') AS n0
      FROM c GROUP BY ALL),
l AS (SELECT event_type, window_start, window_end,
             ROW_NUMBER() OVER (PARTITION BY event_type, window_start ORDER BY arrival, event_id)
             AS firing
      FROM c WHERE lateness = 'allowed_late')
SELECT event_type, window_start, window_end, CAST(0 AS BIGINT) AS firing, n0 AS n FROM b WHERE n0 > 0
UNION ALL
SELECT l.event_type, l.window_start, l.window_end, CAST(l.firing AS BIGINT) AS firing,
       b.n0 + l.firing AS n
FROM l JOIN b USING (event_type, window_start, window_end)
""",
}
