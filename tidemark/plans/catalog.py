"""The query catalog: every operator of the inventory on the driver's tables.

Each entry is ``name -> (build(spark, sf_dir) -> DataFrame, oracle SQL or None)``. The SQL is
an independent formulation in DuckDB's dialect over the same parquet tables (views named as
the tables) and returns the same column names.

Mapping of the reference's click records onto ``events``: user = ``user_id``, url =
``event_type``, order = ``(ts, event_id)``. Events are minutes apart, so the reference's
seconds are scaled (5 s -> 30 min, 10 s -> 1 h). Per-key scans cut keys into 1-day slices.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import lines as text_lines
from tidemark.functions.time import epoch_ms, floordiv, minus, ms_to_ts, seconds_ts
from tidemark.operators import aggregate, joins, keyed, patterns, state, timers, topn, transform, user_aggregate, watermark, windows
from tidemark.sources import text
from tidemark.sources.tables import EVENT_ORDER, events, table

Builder = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, tuple[Builder, str | None]] = {}

ORDER = list(EVENT_ORDER)


HOT_ROWS: int | None = None  # set while a ``_sliced`` query is built


def _split(df, key="user_id"):
    """Slices of the (ts, event_id) order per user: a hot user is cut into slices that follow the
    spread of the rows' time, every other user is one slice."""
    return keyed.hot_split(df, key, "ts", HOT_ROWS)


def _sliced(fn: Builder, hot_rows: int = 20) -> Builder:
    """``fn`` with users above ``hot_rows`` rows cut into slices."""

    def build(spark, sf):
        global HOT_ROWS
        HOT_ROWS = hot_rows
        try:
            return fn(spark, sf)
        finally:
            HOT_ROWS = None

    return build


def query(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        CATALOG[name] = (fn, sql.strip() if sql else None)
        return fn

    return deco


def _cents(c: str = "value"):
    return F.round(F.col(c) * 100).cast("bigint")


# ---------------------------------------------------------------- sources / text ----------

def _doc_lines(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return d.select("doc_id", F.posexplode(text_lines(F.col("text"))).alias("line_no", "line")).withColumn(
        "line_no", (F.col("line_no") + 1).cast("bigint")
    )


@query("s01_text_lines", """
SELECT doc_id, CAST(generate_subscripts(l, 1) AS BIGINT) AS line_no, unnest(l) AS line
FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)
""")
def s01_text_lines(spark, sf):
    return _doc_lines(spark, sf)


_SQL_TOKENS = """
WITH l AS (
  SELECT doc_id, CAST(generate_subscripts(ls, 1) AS BIGINT) AS line_no, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
w AS (
  SELECT doc_id, line_no,
         CASE WHEN line <> '' AND regexp_replace(line, ' +$', '') = '' THEN []::VARCHAR[]
              ELSE string_split(regexp_replace(line, ' +$', ''), ' ') END AS ws
  FROM l),
t AS (SELECT doc_id, line_no, CAST(generate_subscripts(ws, 1) AS BIGINT) AS pos, unnest(ws) AS word FROM w)
"""


@query("a01_word_count", _SQL_TOKENS + "SELECT word, count(*) AS cnt FROM t GROUP BY word")
def a01_word_count(spark, sf):
    return aggregate.word_count(_doc_lines(spark, sf), "line")


@query("a02_running_word_count", _SQL_TOKENS + """
SELECT doc_id, line_no, pos, word,
       count(*) OVER (PARTITION BY word ORDER BY doc_id, line_no, pos ROWS UNBOUNDED PRECEDING) AS cnt
FROM t""")
def a02_running_word_count(spark, sf):
    toks = aggregate.tokens(_doc_lines(spark, sf), "line")
    # line and position are ints: one number for both, a smaller shuffle row
    toks = toks.select("doc_id", (F.shiftleft("line_no", 32) + F.col("pos")).alias("at"), "word")
    # slices of the order: document-id ranges, about sqrt(#documents) of them; only frequent words are sliced, so the
    # table of slices has about a row per word
    docs = table(spark, sf, "documents").select("doc_id")
    is_hot = keyed.hot(toks, "word")
    split = F.lit(0).cast("bigint") if is_hot is None else F.when(is_hot, keyed.range_split(docs, "doc_id")).otherwise(F.lit(0).cast("bigint"))
    run = aggregate.running_count(toks, ["word"], ["doc_id", "at"], split, "cnt")
    return run.select("doc_id", F.shiftright("at", 32).alias("line_no"), F.col("at").bitwiseAND((1 << 32) - 1).alias("pos"), "word", "cnt")


@query("s06_parse_delimited", """
WITH l AS (SELECT doc_id, unnest(string_split(CASE WHEN text LIKE '%' || chr(10) THEN left(text, length(text) - 1) ELSE text END, chr(10))) AS line FROM documents),
p AS (SELECT doc_id, line, string_split(line, ',') AS f FROM l)
SELECT doc_id, line, trim(f[1], ' ') AS first, trim(f[2], ' ') AS second, TRY_CAST(trim(f[3], ' ') AS BIGINT) AS number,
       CASE WHEN f[2] IS NOT NULL THEN 'good' ELSE 'bad' END AS route
FROM p
""")
def s06_parse_delimited(spark, sf):
    """Lines cut at commas into trimmed, typed fields; lines without a second field go aside."""
    lines = _doc_lines(spark, sf).select("doc_id", "line")
    good, bad = text.split_bad(text.parse_delimited(lines, "first string, second string, number bigint", col="line", keep=["doc_id", "line"]), ["second"])
    return good.withColumn("route", F.lit("good")).unionByName(bad.withColumn("route", F.lit("bad")))


@query("s07_parse_untrimmed", """
SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS ms, time_bucket(INTERVAL '1 second', ts) AS second_ts,
       make_timestamp((epoch_us(ts) // 1000) * 1000) AS at, make_timestamp((epoch_us(ts) // 1000) * 1000) - INTERVAL '1 second' AS before
FROM events
""")
def s07_parse_untrimmed(spark, sf):
    """Events written as lines and parsed back without trimming; epoch milliseconds to
    times, cut to seconds, less a second."""
    ev = events(spark, sf)
    line = F.concat_ws(",", F.col("event_id").cast("string"), F.col("user_id").cast("string"), "event_type", epoch_ms("ts").cast("string"))
    p = text.parse_delimited(ev.select(line.alias("value")), "event_id bigint, user_id bigint, event_type string, ms bigint", trim=False)
    return p.withColumn("second_ts", seconds_ts("ms")).withColumn("at", ms_to_ts("ms")).withColumn("before", minus(F.col("at"), "'1' SECOND"))


# ---------------------------------------------------------------- transforms --------------

@query("p01_project", "SELECT user_id FROM events")
def p01_project(spark, sf):
    return events(spark, sf).select("user_id")


@query("p02_flatten", """
SELECT event_id, CAST(generate_subscripts(a, 1) - 1 AS BIGINT) AS field, unnest(a) AS value
FROM (SELECT event_id, [CAST(user_id AS VARCHAR), event_type, CAST(epoch_us(ts) // 1000 AS VARCHAR)] AS a FROM events)
""")
def p02_flatten(spark, sf):
    ev = events(spark, sf).withColumn("ts_ms", epoch_ms("ts"))
    return transform.flatten_fields(ev, ["user_id", "event_type", "ts_ms"], keep=["event_id"])


@query("p03_conditional_flatten", """
SELECT event_id, CAST(generate_subscripts(a, 1) - 1 AS BIGINT) AS field, unnest(a) AS value
FROM (SELECT event_id,
        CASE WHEN event_type = 'click' THEN [event_type]
             WHEN event_type = 'purchase' THEN [CAST(user_id AS VARCHAR), event_type, CAST(epoch_us(ts) // 1000 AS VARCHAR)]
             ELSE []::VARCHAR[] END AS a
      FROM events)
""")
def p03_conditional_flatten(spark, sf):
    ev = events(spark, sf).withColumn("ts_ms", epoch_ms("ts"))
    t = F.col("event_type")
    return transform.emit_when(
        ev,
        [(t == "click", [t]), (t == "purchase", [F.col("user_id"), t, F.col("ts_ms")])],
        keep=["event_id"],
    )


@query("p04_process_emit", """
SELECT event_id, CAST(generate_subscripts(a, 1) - 1 AS BIGINT) AS field, unnest(a) AS value
FROM (SELECT event_id,
        CASE WHEN event_type = 'click' THEN [CAST(user_id AS VARCHAR) || ' clicks ' || event_type]
             WHEN event_type = 'purchase' THEN [CAST(user_id AS VARCHAR), CAST(user_id AS VARCHAR)]
             ELSE []::VARCHAR[] END AS a
      FROM events)
""")
def p04_process_emit(spark, sf):
    ev = events(spark, sf)
    t, u = F.col("event_type"), F.col("user_id").cast("string")
    return transform.emit_when(
        ev, [(t == "click", [F.concat(u, F.lit(" clicks "), t)]), (t == "purchase", [u, u])], keep=["event_id"]
    )


@query("p05_filter", "SELECT event_id, user_id, event_type, ts FROM events WHERE event_type = 'purchase'")
def p05_filter(spark, sf):
    return events(spark, sf).filter(F.col("event_type") == "purchase").select("event_id", "user_id", "event_type", "ts")


@query("p06_url_length", "SELECT event_id, CAST(length(event_type) AS INTEGER) AS url_len FROM events")
def p06_url_length(spark, sf):
    return events(spark, sf).select("event_id", F.length("event_type").alias("url_len"))


@query("p07_attach_one", "SELECT event_id, user_id, 1 AS one FROM events")
def p07_attach_one(spark, sf):
    return events(spark, sf).select("event_id", "user_id", F.lit(1).alias("one"))


@query("p09_sql_projection", "SELECT user_id, event_type AS url FROM events")
def p09_sql_projection(spark, sf):
    events(spark, sf).createOrReplaceTempView("tm_events")
    return spark.sql("SELECT user_id, event_type AS url FROM tm_events")


@query("p10_select_where", "SELECT user_id, event_type AS url FROM events WHERE event_type = 'click'")
def p10_select_where(spark, sf):
    return events(spark, sf).select("user_id", F.col("event_type").alias("url")).where(F.col("url") == "click")


@query("p11_co_map", """
SELECT 'Integer: ' || CAST(CAST(user_id AS INTEGER) AS VARCHAR) AS value FROM events
UNION ALL
SELECT 'Long: ' || CAST(o_orderkey AS VARCHAR) AS value FROM orders
""")
def p11_co_map(spark, sf):
    return transform.co_map(
        events(spark, sf),
        table(spark, sf, "orders"),
        lambda d: F.concat(F.lit("Integer: "), d["user_id"].cast("int").cast("string")),
        lambda d: F.concat(F.lit("Long: "), d["o_orderkey"].cast("string")),
    )


@query("p12_split", """
SELECT event_id, CASE WHEN event_type = 'click' THEN 'click' WHEN event_type = 'purchase' THEN 'purchase'
                      ELSE 'main' END AS route
FROM events
""")
def p12_split(spark, sf):
    t = F.col("event_type")
    return transform.route(events(spark, sf), [(t == "click", "click"), (t == "purchase", "purchase")]).select(
        "event_id", "route"
    )


# ---------------------------------------------------------------- aggregates --------------

@query("a03_max_keep_first", """
SELECT user_id, first(event_type ORDER BY ts, event_id) AS event_type, max(ts) AS ts FROM events GROUP BY user_id
""")
def a03_max_keep_first(spark, sf):
    return aggregate.max_keep_first(events(spark, sf), ["user_id"], ORDER, "ts", ["event_type"])


@query("a03_running_max", """
SELECT user_id, ts, event_id,
       first_value(event_type) OVER w AS first_event_type,
       max(value) OVER w AS max_value
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
""")
def a03_running_max(spark, sf):
    """A03 emitted on every row: the key's first-row fields with the running max of value."""
    ev = events(spark, sf).select("user_id", "ts", "event_id", "event_type", "value")
    return aggregate.running_max_keep_first(ev, ["user_id"], ORDER, _split(ev), "value", ["event_type"])


@query("a04_max_by", """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn FROM events)
WHERE rn = 1
""")
def a04_max_by(spark, sf):
    return aggregate.max_by_row(events(spark, sf), ["user_id"], "value", "event_id", ["event_id", "event_type", "value"])


@query("a04_running_max_by", """
SELECT user_id, event_id, b.event_id AS best_event_id, b.value AS best_value FROM (
  SELECT user_id, event_id,
         max({'v': value, 'neg': -event_id, 'event_id': event_id, 'value': value})
           OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS b
  FROM events)
""")
def a04_running_max_by(spark, sf):
    """A04 emitted on every row: the row with the largest value so far (earliest on a tie)."""
    ev = events(spark, sf).select("user_id", "ts", "event_id", "value")
    r = aggregate.running_max_by_row(ev, ["user_id"], ORDER, _split(ev), "value", "event_id", ["event_id", "value"])
    return r.select("user_id", "event_id", "best_event_id", "best_value")


@query("a05_sum_min_min_by", """
SELECT user_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS sum_cents, min(value) AS min_value,
       first(event_type ORDER BY value, event_id) AS min_by_type
FROM events GROUP BY user_id
""")
def a05_sum_min_min_by(spark, sf):
    ev = events(spark, sf)
    return ev.groupBy("user_id").agg(
        F.sum(_cents()).alias("sum_cents"),
        F.min("value").alias("min_value"),
        F.min_by("event_type", F.struct("value", "event_id")).alias("min_by_type"),
    )


@query("a06_clicks_per_user", "SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id")
def a06_clicks_per_user(spark, sf):
    return events(spark, sf).groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt"))


@query("a06_running_clicks", """
SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS cnt
FROM events
""")
def a06_running_clicks(spark, sf):
    ev = events(spark, sf).select("event_id", "user_id", "ts")
    return aggregate.running_count(ev, ["user_id"], ORDER, _split(ev), "cnt").select("event_id", "user_id", "cnt")


@query("a07_most_active", """
SELECT user_id, cnt FROM (
  SELECT user_id, count(*) AS cnt, max(ts) AS lt, max(event_id) AS li FROM events GROUP BY user_id)
ORDER BY cnt DESC, lt DESC, li DESC LIMIT 1
""")
def a07_most_active(spark, sf):
    return aggregate.most_active(events(spark, sf), "user_id", ORDER, "cnt")


@query("a08_window_count", """
SELECT user_id, time_bucket(INTERVAL '30 minutes', ts) AS window_start,
       time_bucket(INTERVAL '30 minutes', ts) + INTERVAL '30 minutes' AS window_end, count(*) AS cnt
FROM events GROUP BY ALL
""")
def a08_window_count(spark, sf):
    return windows.window_count(events(spark, sf), ["user_id"], "ts", "30 minutes")


@query("a09_window_mean_ts", """
SELECT user_id, time_bucket(INTERVAL '30 minutes', ts) AS window_start,
       time_bucket(INTERVAL '30 minutes', ts) + INTERVAL '30 minutes' AS window_end,
       CAST(sum(epoch_us(ts) // 1000) // count(*) AS BIGINT) AS mean_ts_ms
FROM events GROUP BY ALL
""")
def a09_window_mean_ts(spark, sf):
    ev = events(spark, sf).withColumn("ts_ms", epoch_ms("ts"))
    return windows.window_agg(
        ev, ["user_id"], windows.tumbling("ts", "30 minutes"),
        [F.expr("sum(ts_ms) div count(1)").alias("mean_ts_ms")],
    )


def _half_hours(spark, sf):
    ev = events(spark, sf).withColumn("ts_ms", epoch_ms("ts"))
    w = windows.tumbling("ts", "30 minutes")
    return ev.withColumn("w", w).withColumn("window_start", F.col("w.start")).withColumn("window_end", F.col("w.end"))


@query("g04_user_window_mean", CATALOG["a09_window_mean_ts"][1])
def g04_user_window_mean(spark, sf):
    """A09 through a user aggregate: init, add, merge, finish."""
    return user_aggregate.aggregate(_half_hours(spark, sf), ["user_id", "window_start", "window_end"], user_aggregate.MeanOf("ts_ms", "mean_ts_ms"), ["ts_ms"])


@query("g05_user_reduce", """
SELECT user_id, event_id, cents FROM (
  SELECT user_id, event_id, CAST(round(value * 100) AS BIGINT) AS cents,
         row_number() OVER (PARTITION BY user_id ORDER BY CAST(round(value * 100) AS BIGINT) DESC, event_id) AS rn FROM events)
WHERE rn = 1
""")
def g05_user_reduce(spark, sf):
    """A reduce function over rows: the dearest event of each user, the earlier one on a tie."""
    ev = events(spark, sf).select("user_id", "event_id", _cents().alias("cents"))
    best = user_aggregate.Reduce("event_id bigint, cents bigint", lambda a, b: a if (-a["cents"], a["event_id"]) <= (-b["cents"], b["event_id"]) else b)
    return user_aggregate.aggregate(ev, ["user_id"], best, ["event_id", "cents"])


@query("f16_list_and_map", """
WITH f AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
l AS (SELECT user_id, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS first_ids FROM f WHERE rn <= 5 GROUP BY user_id),
c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type),
m AS (SELECT user_id, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS per_type FROM c GROUP BY user_id)
SELECT user_id, first_ids, per_type FROM l JOIN m USING (user_id)
""")
def f16_list_and_map(spark, sf):
    """A list and a map accumulated per user: the first five event ids, and counts per event type."""
    ev = events(spark, sf).select("user_id", "event_id", "event_type")
    r = user_aggregate.aggregate(ev, ["user_id"], user_aggregate.Collected("event_id", "event_type", 5), ["event_id", "event_type"])
    pairs = F.transform(F.array_sort(F.map_entries("per")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return r.select("user_id", F.array_join(F.transform("first", lambda x: x.cast("string")), ",").alias("first_ids"), F.array_join(pairs, ",").alias("per_type"))


_SQL_UV = """
SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
       time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end, count(DISTINCT user_id) AS uv
FROM events GROUP BY ALL
"""


@query("a10_uv_window", _SQL_UV)
def a10_uv_window(spark, sf):
    return aggregate.distinct_per_window(events(spark, sf), [], windows.tumbling("ts", "1 hour"), "user_id")


@query("a11_uv_window_two_stage", _SQL_UV)
def a11_uv_window_two_stage(spark, sf):
    return aggregate.distinct_per_window_two_stage(events(spark, sf), [], windows.tumbling("ts", "1 hour"), "user_id")


_SQL_URL_VIEWS = """
SELECT event_type, time_bucket(INTERVAL '1 hour', ts) AS window_start,
       time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end, count(*) AS cnt
FROM events GROUP BY ALL
"""


@query("a12_url_views", _SQL_URL_VIEWS)
def a12_url_views(spark, sf):
    return windows.window_count(events(spark, sf), ["event_type"], "ts", "1 hour")


@query("a13_window_ranking", """
SELECT *, row_number() OVER (PARTITION BY window_start, window_end ORDER BY cnt DESC, event_type) AS rn
FROM (""" + _SQL_URL_VIEWS + ")")
def a13_window_ranking(spark, sf):
    return topn.window_ranking(events(spark, sf), "event_type", "ts", "1 hour", None)


@query("a13_user_ranking", """
SELECT *, row_number() OVER (PARTITION BY window_start, window_end ORDER BY cnt DESC, user_id) AS rn
FROM (SELECT user_id, time_bucket(INTERVAL '1 day', ts) AS window_start,
             time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS window_end, count(*) AS cnt
      FROM events GROUP BY ALL)
""")
def a13_user_ranking(spark, sf):
    """A13 with many keys a window and many ties: keys of equal counts cut into ranges."""
    return topn.window_ranking(events(spark, sf), "user_id", "ts", "1 day", None, hot_rows=20)


@query("a14_sql_group_count", "SELECT user_id, count(1) AS cnt FROM events GROUP BY user_id")
def a14_sql_group_count(spark, sf):
    events(spark, sf).createOrReplaceTempView("tm_events")
    return spark.sql("SELECT user_id, COUNT(1) AS cnt FROM tm_events GROUP BY user_id")


@query("a15_avg_of_5", """
SELECT user_id, grp, CAST(sum(ms) // 5 AS BIGINT) AS avg_ts_ms FROM (
  SELECT user_id, epoch_us(ts) // 1000 AS ms,
         (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 5 AS grp FROM events)
GROUP BY user_id, grp HAVING count(*) = 5
""")
def a15_avg_of_5(spark, sf):
    ev = events(spark, sf).withColumn("ts_ms", epoch_ms("ts"))
    return aggregate.group_of_n_average(ev, ["user_id"], ORDER, _split(ev), 5, "ts_ms", "avg_ts_ms")


# ---------------------------------------------------------------- windows -----------------

@query("w01_tumble", """
SELECT event_type, time_bucket(INTERVAL '30 minutes', ts) AS window_start,
       time_bucket(INTERVAL '30 minutes', ts) + INTERVAL '30 minutes' AS window_end,
       count(*) AS cnt, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS sum_cents
FROM events GROUP BY ALL
""")
def w01_tumble(spark, sf):
    return windows.window_agg(
        events(spark, sf), ["event_type"], windows.tumbling("ts", "30 minutes"),
        [F.count(F.lit(1)).alias("cnt"), F.sum(_cents()).alias("sum_cents")],
    )


@query("w02_slide", """
SELECT event_type, s AS window_start, s + INTERVAL '1 hour' AS window_end, count(*) AS cnt
FROM (SELECT event_type, unnest([time_bucket(INTERVAL '30 minutes', ts),
                                 time_bucket(INTERVAL '30 minutes', ts) - INTERVAL '30 minutes']) AS s FROM events)
GROUP BY ALL
""")
def w02_slide(spark, sf):
    return windows.window_count(events(spark, sf), ["event_type"], "ts", "1 hour", "30 minutes")


@query("w03_session", """
SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL '30 minutes' AS window_end, count(*) AS cnt FROM (
  SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM (
    SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL '30 minutes'
                   THEN 0 ELSE 1 END AS brk FROM events))
GROUP BY user_id, sid
""")
def w03_session(spark, sf):
    ev = events(spark, sf)
    return windows.session_count(ev, ["user_id"], "ts", "30 minutes", split=_split(ev))


@query("w04_count_window", """
SELECT user_id, fire_pos, frame_rows, frame_sum, frame_first FROM (
  SELECT user_id, rn AS fire_pos,
         count(*) OVER w AS frame_rows, CAST(sum(c) OVER w AS BIGINT) AS frame_sum, min(rn) OVER w AS frame_first
  FROM (SELECT user_id, ts, event_id, CAST(round(value * 100) AS BIGINT) AS c,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
WHERE fire_pos % 2 = 0
""")
def w04_count_window(spark, sf):
    ev = events(spark, sf).withColumn("c", _cents())
    return windows.count_window(ev, ["user_id"], ORDER, _split(ev), 10, 2, "c")


@query("w06_window_all", """
SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
       time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end, count(*) AS cnt
FROM events GROUP BY ALL
""")
def w06_window_all(spark, sf):
    return windows.window_count(events(spark, sf), [], "ts", "1 hour")


def _click_view(spark, sf):
    """The reference's SQL click table: user_name, url, ts (ms) and ``et`` = ts cut to whole
    seconds (``TO_TIMESTAMP(FROM_UNIXTIME(ts / 1000))``)."""
    ev = events(spark, sf)
    v = ev.select(
        F.col("user_id").alias("user_name"), F.col("event_type").alias("url"), epoch_ms("ts").alias("ts")
    ).withColumn("et", seconds_ts("ts"))
    v.createOrReplaceTempView("tm_click_table")
    return v


_SQL_ET = "date_trunc('second', ts)"


@query("w07_sql_tumble_end", f"""
SELECT user_id AS user_name, time_bucket(INTERVAL '1 hour', {_SQL_ET}) + INTERVAL '1 hour' AS window_end, count(*) AS cnt
FROM events GROUP BY ALL
""")
def w07_sql_tumble_end(spark, sf):
    _click_view(spark, sf)
    return spark.sql(
        "SELECT user_name, window.end AS window_end, COUNT(1) AS cnt "
        "FROM tm_click_table GROUP BY user_name, window(et, '1 hour')"
    )


@query("w08_sql_tumble_tvf", f"""
SELECT user_id AS user_name, time_bucket(INTERVAL '1 hour', {_SQL_ET}) AS window_start,
       time_bucket(INTERVAL '1 hour', {_SQL_ET}) + INTERVAL '1 hour' AS window_end, count(event_type) AS cnt
FROM events GROUP BY ALL
""")
def w08_sql_tumble_tvf(spark, sf):
    _click_view(spark, sf)
    return spark.sql(
        "SELECT user_name, window.start AS window_start, window.end AS window_end, COUNT(url) AS cnt "
        "FROM tm_click_table GROUP BY user_name, window(et, '1 hour')"
    )


@query("w09_sql_hop", f"""
SELECT user_name, s AS window_start, s + INTERVAL '1 hour' AS window_end, count(*) AS cnt
FROM (SELECT user_id AS user_name, unnest([time_bucket(INTERVAL '30 minutes', {_SQL_ET}),
                                           time_bucket(INTERVAL '30 minutes', {_SQL_ET}) - INTERVAL '30 minutes']) AS s
      FROM events)
GROUP BY ALL
""")
def w09_sql_hop(spark, sf):
    _click_view(spark, sf)
    return spark.sql(
        "SELECT user_name, window.start AS window_start, window.end AS window_end, COUNT(1) AS cnt "
        "FROM tm_click_table GROUP BY user_name, window(et, '1 hour', '30 minutes')"
    )


@query("w10_cumulate", """
SELECT user_id, ws AS window_start, ws + k * INTERVAL '15 minutes' AS window_end, count(*) AS cnt
FROM (SELECT user_id, time_bucket(INTERVAL '1 hour', ts) AS ws,
             unnest(generate_series(CAST((epoch_us(ts) - epoch_us(time_bucket(INTERVAL '1 hour', ts))) // 900000000 AS INTEGER) + 1, 4)) AS k
      FROM events)
GROUP BY ALL
""")
def w10_cumulate(spark, sf):
    return windows.cumulate(events(spark, sf), ["user_id"], "ts", "15 minutes", "1 hour", {"cnt": ("count", None)})


@query("w11_over_avg", """
SELECT user_id, event_id,
       CAST(sum(epoch_us(ts) // 1000) OVER w // count(*) OVER w AS BIGINT) AS avg_ts_ms
FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)
""")
def w11_over_avg(spark, sf):
    ev = events(spark, sf).select("event_id", "user_id", "ts").withColumn("ms", epoch_ms("ts"))
    r = windows.rows_average(ev, ["user_id"], ORDER, _split(ev), "ms", 4, "avg_ts_ms")
    return r.select("user_id", "event_id", "avg_ts_ms")


@query("w12_row_number", """
SELECT * FROM (
  SELECT event_type, user_id, count(*) AS cnt,
         row_number() OVER (PARTITION BY event_type ORDER BY count(*) DESC, user_id) AS rn
  FROM events GROUP BY event_type, user_id)
WHERE rn <= 3
""")
def w12_row_number(spark, sf):
    c = events(spark, sf).groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("cnt"))
    return topn.rank_within(c, ["event_type"], [F.col("cnt").desc(), F.col("user_id")], 3)


@query("w13_integer_division_window", _SQL_URL_VIEWS)
def w13_integer_division_window(spark, sf):
    ev = events(spark, sf).withColumn("ts_ms", epoch_ms("ts"))
    return windows.integer_division_window(ev, ["event_type"], "ts_ms", 3_600_000)


# ---------------------------------------------------------------- top-n -------------------

_SQL_TOP_SLIDING = """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start, window_end ORDER BY cnt DESC, event_type) AS rn FROM (
    SELECT event_type, s AS window_start, s + INTERVAL '1 day' AS window_end, count(*) AS cnt
    FROM (SELECT event_type, unnest([time_bucket(INTERVAL '12 hours', ts),
                                     time_bucket(INTERVAL '12 hours', ts) - INTERVAL '12 hours']) AS s FROM events)
    GROUP BY ALL))
WHERE rn <= 2
"""


@query("t01_topn_sliding", _SQL_TOP_SLIDING)
def t01_topn_sliding(spark, sf):
    return topn.top_n_per_window(events(spark, sf), "event_type", "ts", "1 day", "12 hours", 2)


@query("t02_topn_window_all", _SQL_TOP_SLIDING)
def t02_topn_window_all(spark, sf):
    return topn.top_n_window_all(events(spark, sf), "event_type", "ts", "1 day", "12 hours", 2)


@query("t03_topn_total", """
SELECT user_id, cnt, row_number() OVER (ORDER BY cnt DESC, user_id) AS rn FROM (
  SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id ORDER BY cnt DESC, user_id LIMIT 2)
""")
def t03_topn_total(spark, sf):
    return topn.top_n_global(events(spark, sf), "user_id", 2)


@query("t04_sql_window_topn", f"""
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start, window_end ORDER BY cnt DESC, user_name) AS rn FROM (
    SELECT user_id AS user_name, time_bucket(INTERVAL '1 hour', {_SQL_ET}) AS window_start,
           time_bucket(INTERVAL '1 hour', {_SQL_ET}) + INTERVAL '1 hour' AS window_end, count(*) AS cnt
    FROM events GROUP BY ALL))
WHERE rn <= 2
""")
def t04_sql_window_topn(spark, sf):
    _click_view(spark, sf)
    return spark.sql(
        """
        SELECT user_name, window_start, window_end, cnt, CAST(rn AS BIGINT) AS rn FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY window_start, window_end ORDER BY cnt DESC, user_name) AS rn
          FROM (SELECT user_name, window.start AS window_start, window.end AS window_end, COUNT(1) AS cnt
                FROM tm_click_table GROUP BY user_name, window(et, '1 hour')))
        WHERE rn <= 2
        """
    )


# ---------------------------------------------------------------- union / watermarks ------

@query("u01_union", """
SELECT event_id, user_id, event_type, ts FROM events WHERE event_type = 'click'
UNION ALL
SELECT event_id, user_id, event_type, ts FROM events WHERE event_type = 'view'
""")
def u01_union(spark, sf):
    ev = events(spark, sf).select("event_id", "user_id", "event_type", "ts")
    return watermark.union_all(ev.filter(F.col("event_type") == "click"), ev.filter(F.col("event_type") == "view"))


@query("u02_watermark_trace", """
SELECT event_id, event_type, ts,
       CASE WHEN mc IS NOT NULL AND mv IS NOT NULL THEN least(mc - 600000 - 1, mv - 1800000 - 1) END AS watermark_ms
FROM (SELECT *,
        max(CASE WHEN event_type = 'click' THEN epoch_us(ts) // 1000 END)
          OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mc,
        max(CASE WHEN event_type = 'view' THEN epoch_us(ts) // 1000 END)
          OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mv
      FROM events WHERE event_type IN ('click', 'view'))
""")
def u02_watermark_trace(spark, sf):
    ev = events(spark, sf).select("event_id", "event_type", "ts").filter(F.col("event_type").isin("click", "view"))
    return watermark.watermark_trace(
        ev, "event_type", {"click": "10 minutes", "view": "30 minutes"}, ORDER, "ts", keyed.time_split(ev, "ts")
    )


def _late_input(spark, sf):
    """Disordered delivery: event time stays ``ts``; each event arrives 0-3 h late
    (``ts + 30 min x ((event_id x 7919) mod 7)``) through one of 4 sources
    (``event_id mod 4``); records are processed in arrival order."""
    ev = events(spark, sf).select("event_id", "user_id", "event_type", "ts")
    delay = F.expr("make_dt_interval(0, 0, 30 * pmod(event_id * 7919, 7), 0)")
    return ev.select("event_id", "user_id", "event_type", F.pmod("event_id", F.lit(4)).alias("source"), "ts",
                     (F.col("ts") + delay).alias("arrival"))


def _late_routed(spark, sf):
    d = _late_input(spark, sf)
    return watermark.late_route(
        d, "source", ["arrival", "event_id"], keyed.time_split(d, "arrival"), "ts", "1 hour", "1 hour", "30 minutes"
    )


_SQL_LATE = """
WITH e AS (
  SELECT event_id, user_id, event_type, event_id % 4 AS source, ts,
         ts + to_minutes(30 * ((event_id * 7919) % 7)) AS arrival FROM events),
m AS (
  SELECT *, max(epoch_us(ts)) OVER (PARTITION BY source ORDER BY arrival, event_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 3600000000 AS wm
  FROM e)
"""


@query("l06_allowed_lateness", _SQL_LATE + """
SELECT event_type, time_bucket(INTERVAL '1 hour', ts) AS window_start,
       time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end, count(*) AS cnt
FROM m
WHERE NOT coalesce(epoch_us(time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour') + 1800000000 <= wm, false)
GROUP BY ALL
""")
def l06_allowed_lateness(spark, sf):
    """Final window counts with 1 h bound and 30 min allowed lateness: rows arriving after
    their window closed for good are left out (they go to the side output, L07)."""
    r = _late_routed(spark, sf)
    return r.filter(F.col("route") == "main").groupBy("event_type", "window_start", "window_end").agg(F.count(F.lit(1)).alias("cnt"))


@query("l07_late_route", _SQL_LATE + """
SELECT event_id, user_id, event_type, source, ts, arrival,
       time_bucket(INTERVAL '1 hour', ts) AS window_start,
       time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
       make_timestamp(wm) AS watermark,
       CASE WHEN epoch_us(time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour') + 1800000000 <= wm
            THEN 'late' ELSE 'main' END AS route
FROM m
""")
def l07_late_route(spark, sf):
    return _late_routed(spark, sf)


# ---------------------------------------------------------------- timers / state ----------

@query("x01_event_timer", """
SELECT user_id, 'arrival' AS kind, ts AS at FROM events
UNION ALL
SELECT DISTINCT user_id, 'timer' AS kind, ts + INTERVAL '1 hour' AS at FROM events
""")
def x01_event_timer(spark, sf):
    return timers.event_timer(events(spark, sf), "user_id", "ts", "1 hour")


@query("x03_periodic_pv", """
WITH t0 AS (SELECT user_id, min(ts) AS t0 FROM events GROUP BY user_id),
lim AS (SELECT max(ts) AS until FROM events),
ticks AS (
  SELECT user_id, t0 + k * INTERVAL '1 day' AS tick
  FROM t0, lim, range(1, CAST((epoch_us(until) - epoch_us(t0)) // 86400000000 AS BIGINT) + 1) r(k))
SELECT ticks.user_id, tick, count(*) AS pv
FROM ticks JOIN events e ON e.user_id = ticks.user_id AND e.ts <= ticks.tick
GROUP BY ticks.user_id, tick
""")
def x03_periodic_pv(spark, sf):
    return timers.periodic_count(events(spark, sf), "user_id", "ts", "1 day")


@query("x04_value_state_previous", """
SELECT event_id, user_id,
       lag(event_type) OVER w AS prev_event_type, lag(event_id) OVER w AS prev_event_id
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def x04_value_state_previous(spark, sf):
    ev = events(spark, sf).select("event_id", "user_id", "event_type", "ts")
    r = state.value_state_previous(ev, ["user_id"], ORDER, _split(ev), ["event_type", "event_id"])
    return r.select("event_id", "user_id", "prev_event_type", "prev_event_id")


@query("x05_list_state_size", """
SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS list_size
FROM events
""")
def x05_list_state_size(spark, sf):
    ev = events(spark, sf).select("event_id", "user_id", "ts")
    return state.list_state_size(ev, ["user_id"], ORDER, _split(ev)).select("event_id", "user_id", "list_size")


@query("x06_map_state_counter", """
SELECT event_id, user_id, event_type,
       count(*) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS map_count
FROM events
""")
def x06_map_state_counter(spark, sf):
    ev = events(spark, sf).select("event_id", "user_id", "event_type", "ts")
    return state.map_state_counter(ev, ["user_id"], "event_type", ORDER, _split(ev)).select(
        "event_id", "user_id", "event_type", "map_count"
    )


@query("x07_reducing_state", """
SELECT event_id, user_id,
       first_value(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS first_event_type,
       ts AS latest_ts
FROM events
""")
def x07_reducing_state(spark, sf):
    ev = events(spark, sf).select("event_id", "user_id", "event_type", "ts")
    r = state.reducing_first_latest(ev, ["user_id"], ORDER, _split(ev), ["event_type"], "ts")
    return r.select("event_id", "user_id", "first_event_type", "latest_ts")


@query("x08_aggregating_state", """
SELECT event_id, user_id,
       'count : ' || CAST(count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS VARCHAR) AS agg
FROM events
""")
def x08_aggregating_state(spark, sf):
    ev = events(spark, sf).select("event_id", "user_id", "ts")
    return state.aggregating_count_text(ev, ["user_id"], ORDER, _split(ev)).select("event_id", "user_id", "agg")


# ---------------------------------------------------------------- joins -------------------

def _side(spark, sf, kind: str, prefix: str):
    ev = events(spark, sf).filter(F.col("event_type") == kind)
    return ev.select("user_id", F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts"))


@query("j01_window_join", """
SELECT c.user_id, time_bucket(INTERVAL '6 hours', c.ts) AS window_start,
       time_bucket(INTERVAL '6 hours', c.ts) + INTERVAL '6 hours' AS window_end,
       c.event_id AS click_id, c.ts AS click_ts, v.event_id AS view_id, v.ts AS view_ts
FROM events c JOIN events v
  ON c.user_id = v.user_id AND time_bucket(INTERVAL '6 hours', c.ts) = time_bucket(INTERVAL '6 hours', v.ts)
WHERE c.event_type = 'click' AND v.event_type = 'view'
""")
def j01_window_join(spark, sf):
    return joins.window_join(_side(spark, sf, "click", "click"), _side(spark, sf, "view", "view"), "user_id", "click_ts", "view_ts", "6 hours")


@query("j02_cogroup", """
WITH u AS (
  SELECT user_id, ts, event_id, CASE WHEN event_type = 'click' THEN 'left' ELSE 'right' END AS side,
         time_bucket(INTERVAL '6 hours', ts) AS window_start
  FROM events WHERE event_type IN ('click', 'view'))
SELECT user_id, window_start, window_start + INTERVAL '6 hours' AS window_end, side,
       row_number() OVER (PARTITION BY user_id, window_start, side ORDER BY ts, event_id) AS pos,
       ts, event_id,
       count(*) FILTER (WHERE side = 'left') OVER (PARTITION BY user_id, window_start) AS n_left,
       count(*) FILTER (WHERE side = 'right') OVER (PARTITION BY user_id, window_start) AS n_right
FROM u
""")
def j02_cogroup(spark, sf):
    ev = events(spark, sf).select("user_id", "ts", "event_id", "event_type")
    left = ev.filter(F.col("event_type") == "click").drop("event_type")
    right = ev.filter(F.col("event_type") == "view").drop("event_type")
    return joins.cogroup(left, right, "user_id", "ts", "6 hours", ORDER)


def _numbered(key, sizes, chunks):
    """A user's co-group function: every member with its place in its side's list and both sizes."""
    pos = {"left": 0, "right": 0}
    for side, rows in chunks:
        n = rows.num_rows
        at, pos[side] = range(pos[side] + 1, pos[side] + n + 1), pos[side] + n
        col = lambda c: rows.column(rows.schema.get_field_index(c))  # noqa: E731, B023
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0]] * n, pa.int64()), col("window_start"), col("window_end"), pa.array([side] * n), pa.array(at, pa.int64()), col("ts"), col("event_id"),
             pa.array([sizes[0]] * n, pa.int64()), pa.array([sizes[1]] * n, pa.int64())],
            names=["user_id", "window_start", "window_end", "side", "pos", "ts", "event_id", "n_left", "n_right"],
        )


@query("g12_user_cogroup", CATALOG["j02_cogroup"][1])
def g12_user_cogroup(spark, sf):
    """J02 through a user's co-group function that sees each group as a stream of chunks."""
    w = windows.tumbling("ts", "6 hours")
    ev = events(spark, sf).withColumn("w", w).select("user_id", "ts", "event_id", "event_type", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))
    left = ev.filter(F.col("event_type") == "click").drop("event_type")
    right = ev.filter(F.col("event_type") == "view").drop("event_type")
    out = "user_id bigint, window_start timestamp_ntz, window_end timestamp_ntz, side string, pos bigint, ts timestamp_ntz, event_id bigint, n_left bigint, n_right bigint"
    return joins.cogroup_apply(left, right, ["user_id", "window_start"], ORDER, _numbered, out)


@query("j03_interval_join", """
SELECT p.user_id, p.event_id AS buy_id, p.ts AS buy_ts, v.event_id AS view_id, v.ts AS view_ts
FROM events p JOIN events v ON p.user_id = v.user_id
 AND v.ts BETWEEN p.ts - INTERVAL '30 minutes' AND p.ts + INTERVAL '1 hour'
WHERE p.event_type = 'purchase' AND v.event_type = 'view'
""")
def j03_interval_join(spark, sf):
    return joins.interval_join(
        _side(spark, sf, "purchase", "buy"), _side(spark, sf, "view", "view"),
        "user_id", "buy_ts", "view_ts", "-30 minutes", "1 hour",
    ).select("user_id", "buy_id", "buy_ts", "view_id", "view_ts")


@query("j04_equi_join", """
SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey
""")
def j04_equi_join(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return joins.equi_join(o, c, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")


@query("j05_reconcile", """
WITH RECURSIVE a AS (SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
                     FROM events WHERE event_type = 'click'),
b AS (SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
      FROM events WHERE event_type = 'purchase'),
-- i, j: rows of each side that are settled; one step settles the earlier next row, or a pair
walk AS (
  SELECT DISTINCT user_id, 0::BIGINT AS i, 0::BIGINT AS j, NULL::BIGINT AS app_id, NULL::TIMESTAMP AS app_ts,
         NULL::BIGINT AS third_id, NULL::TIMESTAMP AS third_ts, 'start' AS status
  FROM events WHERE event_type IN ('click', 'purchase')
  UNION ALL
  SELECT user_id, i + (take <> 'b')::BIGINT, j + (take <> 'a')::BIGINT,
         CASE WHEN take <> 'b' THEN a_id END, CASE WHEN take <> 'b' THEN a_ts END,
         CASE WHEN take <> 'a' THEN b_id END, CASE WHEN take <> 'a' THEN b_ts END,
         CASE take WHEN 'ab' THEN 'matched' WHEN 'a' THEN 'missing_third' ELSE 'missing_app' END
  FROM (SELECT w.user_id, w.i, w.j, a.event_id AS a_id, a.ts AS a_ts, b.event_id AS b_id, b.ts AS b_ts,
               CASE WHEN b.ts IS NULL THEN 'a' WHEN a.ts IS NULL THEN 'b'
                    WHEN abs(epoch_us(a.ts) - epoch_us(b.ts)) <= 86400000000 THEN 'ab'
                    WHEN a.ts < b.ts THEN 'a' ELSE 'b' END AS take
        FROM walk w LEFT JOIN a ON a.user_id = w.user_id AND a.n = w.i + 1
                    LEFT JOIN b ON b.user_id = w.user_id AND b.n = w.j + 1
        WHERE a.ts IS NOT NULL OR b.ts IS NOT NULL))
SELECT user_id, app_id, app_ts, third_id, third_ts, status FROM walk WHERE status <> 'start'
""")
def j05_reconcile(spark, sf):
    a = _side(spark, sf, "click", "app")
    b = _side(spark, sf, "purchase", "third")
    return joins.reconcile(a, b, "user_id", "app_ts", "app_id", "third_ts", "third_id", "1 day", hot_rows=HOT_ROWS)


def _rules(spark):
    # The rule table of this query (action1 -> action2, version).
    rows = [("click", "purchase", 1), ("signup", "click", 2)]
    return spark.createDataFrame(rows, "action1 string, action2 string, version int")


_SQL_RULES = """
WITH p AS (SELECT user_id, event_id, event_type,
                  lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
r AS (SELECT * FROM (VALUES ('click', 'purchase', 1), ('signup', 'click', 2)) t(action1, action2, version))
SELECT user_id, event_id, event_type, action1, action2, version
FROM p JOIN r ON p.prev = r.action1 AND p.event_type = r.action2
"""


@query("j06_rule_join_all", _SQL_RULES)
def j06_rule_join_all(spark, sf):
    ev = events(spark, sf).select("user_id", "event_id", "event_type", "ts")
    r = joins.rule_join(ev, _rules(spark), "user_id", ORDER, _split(ev), "event_type", "all")
    return r.select("user_id", "event_id", "event_type", "action1", "action2", "version")


@query("j06_rule_join_latest", _SQL_RULES + " WHERE version = 2")
def j06_rule_join_latest(spark, sf):
    ev = events(spark, sf).select("user_id", "event_id", "event_type", "ts")
    r = joins.rule_join(ev, _rules(spark), "user_id", ORDER, _split(ev), "event_type", "latest")
    return r.select("user_id", "event_id", "event_type", "action1", "action2", "version")


# ---------------------------------------------------------------- patterns ----------------

@query("c01_three_fails", """
SELECT user_id, id1 AS event_id_1, id2 AS event_id_2, event_id AS event_id_3, t1 AS ts_1, t2 AS ts_2, ts AS ts_3 FROM (
  SELECT *, lag(event_type, 1) OVER w AS e2, lag(event_type, 2) OVER w AS e1,
            lag(event_id, 1) OVER w AS id2, lag(event_id, 2) OVER w AS id1,
            lag(ts, 1) OVER w AS t2, lag(ts, 2) OVER w AS t1
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE event_type = 'error' AND e1 = 'error' AND e2 = 'error'
""")
def c01_three_fails(spark, sf):
    ev = events(spark, sf).select("user_id", "event_id", "event_type", "ts")
    return patterns.adjacent(ev, ["user_id"], ORDER, _split(ev), F.col("event_type") == "error", 3, ["event_id", "ts"])


@query("c02_consecutive", """
SELECT user_id, event_id, ts, run FROM (
  SELECT *, CASE WHEN event_type = 'error'
                 THEN row_number() OVER (PARTITION BY user_id, grp ORDER BY ts, event_id)
                      - CASE WHEN grp > 0 THEN 1 ELSE 0 END
                 ELSE 0 END AS run
  FROM (SELECT *, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END)
                    OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS grp
        FROM events))
WHERE run >= 3
""")
def c02_consecutive(spark, sf):
    ev = events(spark, sf).select("user_id", "event_id", "event_type", "ts")
    return patterns.consecutive(ev, ["user_id"], ORDER, _split(ev), F.col("event_type") == "error", 3, ["event_id", "ts"])


@query("c03_followed_by_within", """
WITH s AS (SELECT user_id, event_id, ts, event_type FROM events WHERE event_type IN ('signup', 'purchase')),
n AS (SELECT *, min(CASE WHEN event_type = 'purchase' THEN {'ts': ts, 'event_id': event_id} END)
                  OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS nx
      FROM s)
SELECT user_id, event_id AS first_event_id, ts AS first_ts,
       CASE WHEN ok THEN nx.event_id END AS second_event_id, CASE WHEN ok THEN nx.ts END AS second_ts,
       CASE WHEN ok THEN 'matched' ELSE 'timeout' END AS status
FROM (SELECT *, coalesce(nx.ts - ts < INTERVAL '12 hours', false) AS ok FROM n WHERE event_type = 'signup')
""")
def c03_followed_by_within(spark, sf):
    ev = events(spark, sf).select("user_id", "event_id", "event_type", "ts")
    t = F.col("event_type")
    return patterns.followed_by_within(
        ev, ["user_id"], ORDER, _split(ev), t == "signup", t == "purchase", "12 hours", ["event_id", "ts"]
    )


@query("c04_state_machine", """
SELECT user_id, event_id, ts FROM (
  SELECT *, lag(event_type, 1) OVER w AS e2, lag(event_type, 2) OVER w AS e1
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE event_type = 'error' AND e1 = 'error' AND e2 = 'error'
""")
def c04_state_machine(spark, sf):
    ev = events(spark, sf).select("user_id", "event_id", "event_type", "ts")
    t = F.col("event_type")
    sym = F.when(t == "error", 0).when(t == "purchase", 1).otherwise(2)
    r = patterns.state_machine(
        ev, ["user_id"], ORDER, _split(ev), sym, patterns.LOGIN_FAIL_NEXT, patterns.LOGIN_FAIL_EMIT
    )
    return r.filter("alert").select("user_id", "event_id", "ts")


# ---------------------------------------------------------------- sinks -------------------

@query("k04_buffered_groups", """
SELECT event_type, (rn - 1) // 10 AS flush_no, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id
FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events)
GROUP BY ALL
""")
def k04_buffered_groups(spark, sf):
    from tidemark.sinks.buffered import flush_groups

    ev = events(spark, sf).select("event_type", "event_id")
    return flush_groups(ev, ["event_type"], ["event_id"], keyed.range_split(ev, "event_id"), 10)


@query("k04_buffered_stream", """
SELECT buffer, flush_no, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id, CAST(sum(user_id) AS BIGINT) AS users
FROM (SELECT event_id % 8 AS buffer, event_id, user_id,
             (row_number() OVER (PARTITION BY event_id % 8 ORDER BY event_id) - 1) // 10 AS flush_no FROM events)
GROUP BY ALL HAVING count(*) = 10
""")
def k04_buffered_stream(spark, sf):
    """The buffered sink on a file stream of four micro-batches, its rests carried in state."""
    from tidemark.sinks.buffered import buffered_groups
    from tidemark.streaming import replay

    ev = events(spark, sf)
    lo, hi = ev.agg(F.min("event_id"), F.max("event_id")).first()
    part = F.least(floordiv(F.col("event_id") - F.lit(lo or 0), max(((hi or 0) - (lo or 0)) // 4 + 1, 1)), F.lit(3))
    g = replay.finished(buffered_groups(replay.as_stream(ev, part, 4), F.pmod("event_id", F.lit(8)), 10, "event_id"))
    return g.groupBy("buffer", "flush_no").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"), F.sum("user_id").alias("users")
    )


@query("g09_process_timers", """
SELECT user_id, 'arrival' AS kind, ts AS at FROM events
UNION ALL
SELECT DISTINCT user_id, 'timer' AS kind, ts + INTERVAL '1 hour' AS at FROM events
""")
def g09_process_timers(spark, sf):
    """X01 as a user's process function on a file stream whose every seventh row comes with the next file."""
    from tidemark.streaming import basic, process, replay

    ev = events(spark, sf).select("event_id", "user_id", "ts")
    first, last, lo, hi = ev.agg(F.min("ts"), F.max("ts"), F.min("event_id"), F.max("event_id")).first()
    if first is None:
        return timers.event_timer(ev, "user_id", "ts", "1 hour")
    days = (last - first).days + 1
    d = ev.withColumn("_p", floordiv(F.col("event_id") - F.lit(lo), max((hi - lo) // 3 + 1, 1)) + F.when(F.col("event_id") % 7 == 0, 1).otherwise(0))
    end = spark.range(1).select(F.lit(None).cast("bigint").alias("event_id"), F.lit(None).cast("bigint").alias("user_id"), F.lit(last).cast("timestamp_ntz").alias("ts"))
    end = end.withColumn("ts", F.col("ts") + F.make_dt_interval(days=F.lit(2 * days + 2))).withColumn("_p", F.lit(4).cast("bigint"))
    s = basic.event_time(replay.as_stream(d.unionByName(end), F.col("_p"), 5), f"{days} days").withColumn("seq", F.col("event_id"))
    r = process.process(s.filter("user_id is not null or event_id is null"), "user_id", process.EventTimer(3_600_000_000), ["event_id"])
    with process.store(spark):
        out = replay.finished(r)
    # the closing row has no user
    return out.filter("user_id is not null").select("user_id", "kind", F.timestamp_micros("us").cast("timestamp_ntz").alias("at"))


@query("l06_refired_windows", _SQL_URL_VIEWS)
def l06_refired_windows(spark, sf):
    """Allowed lateness on a file stream: every seventh event comes with the next file, late for its window but
    within the lateness, so its window fires again; the last firing of each window is its count.
    A closing row far behind lets all windows fire."""
    from tidemark.streaming import replay, stateful

    ev = events(spark, sf).select("event_id", "event_type", "ts")
    first, last, lo, hi = ev.agg(F.min("ts"), F.max("ts"), F.min("event_id"), F.max("event_id")).first()
    if first is None:
        return windows.window_count(ev, ["event_type"], "ts", "1 hour")
    span = max((hi - lo) // 4 + 1, 1)
    d = ev.withColumn("_p", floordiv(F.col("event_id") - F.lit(lo), span) + F.when(F.col("event_id") % 7 == 0, 1).otherwise(0))
    end = spark.range(1).select(F.lit(None).cast("bigint").alias("event_id"), F.lit(None).cast("string").alias("event_type"), F.lit(last).cast("timestamp_ntz").alias("ts"))
    far = F.make_dt_interval(days=F.lit((last - first).days + 3))
    d = d.unionByName(end.withColumn("ts", F.col("ts") + far).withColumn("_p", F.lit(5).cast("bigint")))
    s = replay.as_stream(d, F.col("_p"), 6)
    lateness = f"{(last - first).days + 1} days"
    fired = replay.finished(stateful.refired_windows(s, "event_type", "1 hour", "0 seconds", lateness, "ts", "event_id"))
    best = fired.filter("event_type is not null and firing > 0").groupBy("event_type", "window_start", "window_end")
    return best.agg(F.max_by("cnt", "firing").alias("cnt"))


# the keyed queries once more with every user above 20 rows cut into slices: same results
for _name in ("a06_running_clicks", "a15_avg_of_5", "w11_over_avg", "x04_value_state_previous", "c01_three_fails", "c02_consecutive", "c03_followed_by_within", "c04_state_machine", "w03_session", "j05_reconcile"):
    if _name in CATALOG:
        CATALOG[f"{_name}_sliced"] = (_sliced(CATALOG[_name][0]), CATALOG[_name][1])
