"""Golden results of FIXTURES.md (inputs are the reference's literal rows), batch forms.

Per-key scans run with two slice widths: one slice for everything, and one slice per
second, so that the cross-slice carry is exercised on every fixture."""

import datetime as dt

import pytest
from conftest import clicks, rows_of
from pyspark.sql import functions as F

from tidemark.functions.text import java_split
from tidemark.functions.time import bucket, epoch_ms, ms_to_ts
from tidemark.operators import aggregate, joins, patterns, topn, transform, windows
from tidemark.sources.csv import from_rows

ORDER = ["ts", "seq"]
SPLITS = ["1 hour", "1 second"]


def _ms(df, *cols):
    return df.select(*[epoch_ms(c).alias(c) if c.endswith(("start", "end", "ts")) else F.col(c) for c in cols])


# --- F1 words ----------------------------------------------------------------------------

def test_f1_word_count(spark):
    # The reference's input file, line by line.
    lines = from_rows(spark, [(1, "hello word"), (2, "hello bigdata"), (3, "hello fink")], "n bigint, line string")
    assert rows_of(aggregate.word_count(lines, "line"), "word", "cnt") == sorted(
        [("hello", 3), ("word", 1), ("bigdata", 1), ("fink", 1)]
    )
    toks = aggregate.tokens(lines, "line")
    run = aggregate.running_count(toks, ["word"], ["n", "pos"], F.col("n"), "cnt")
    got = [(r.word, r.cnt) for r in run.orderBy("n", "pos").collect()]
    assert got == [("hello", 1), ("word", 1), ("hello", 2), ("bigdata", 1), ("hello", 3), ("fink", 1)]


def test_java_split_rules(spark):
    df = from_rows(spark, [(1, "a  b "), (2, ""), (3, "   "), (4, " x")], "n int, line string")
    got = {r.n: r.t for r in df.select("n", java_split(F.col("line")).alias("t")).collect()}
    assert got == {1: ["a", "", "b"], 2: [""], 3: [], 4: ["", "x"]}


# --- F2 / F3 transforms ------------------------------------------------------------------

def test_f2_transforms(spark):
    ev = clicks(spark, [("Mary", "./home", 1000), ("BOb", "./cart", 1000), ("Alice", "./home", 1000)])
    assert rows_of(ev.select("user"), "user") == [("Alice",), ("BOb",), ("Mary",)]
    flat = transform.flatten_fields(ev, ["user", "url", "ts_ms"])
    assert flat.count() == 9
    u = F.col("user")
    cond = transform.emit_when(ev, [(u == "Mary", [F.col("url")]), (u == "BOb", [u, F.col("url"), F.col("ts_ms")])], keep=["seq"])
    assert [r.value for r in cond.orderBy("seq", "field").collect()] == ["./home", "BOb", "./cart", "1000"]
    for name in ("Mary", "BOb", "Alice"):
        assert ev.filter(u == name).count() == 1


def test_f3_url_length(events8):
    got = [r.n for r in events8.orderBy("seq").select(F.length("url").alias("n")).collect()]
    assert got == [6, 6, 13, 12, 13, 13, 13, 13]


# --- F3 aggregates -------------------------------------------------------------------------

def test_f3_max_and_max_by(events8):
    mx = aggregate.max_keep_first(events8, ["user"], ORDER, "ts_ms", ["url"])
    assert rows_of(mx, "user", "url", "ts_ms") == sorted(
        [("Alice", "./prod?id=140", 20000), ("BOb", "./cart", 4000), ("Mary", "./home", 1000)]
    )
    mb = aggregate.max_by_row(events8, ["user"], "ts_ms", "seq", ["url", "ts_ms"])
    assert rows_of(mb, "user", "url", "ts_ms") == sorted(
        [("Alice", "./prod?id=240", 20000), ("BOb", "./prod?id=140", 4000), ("Mary", "./home", 1000)]
    )


@pytest.mark.parametrize("width", SPLITS)
def test_f3_running_forms(events8, width):
    run = aggregate.running_max_keep_first(events8, ["user"], ORDER, bucket("ts", width), "ts_ms", ["url"])
    final_rows = {("Alice", dt.datetime(1970, 1, 1, 0, 0, 20)), ("BOb", dt.datetime(1970, 1, 1, 0, 0, 4)),
                  ("Mary", dt.datetime(1970, 1, 1, 0, 0, 1))}
    last = {r.user: (r.first_url, r.max_ts_ms) for r in run.collect() if (r.user, r.ts) in final_rows}
    assert last == {"Alice": ("./prod?id=140", 20000), "BOb": ("./cart", 4000), "Mary": ("./home", 1000)}
    cnt = aggregate.running_count(events8, ["user"], ORDER, bucket("ts", width), "cnt")
    assert rows_of(cnt.groupBy("user").agg(F.max("cnt")), "user", "max(cnt)") == [("Alice", 3), ("BOb", 4), ("Mary", 1)]


def test_f3_most_active(events8):
    assert rows_of(aggregate.most_active(events8, "user", ORDER), "user", "cnt") == [("BOb", 4)]


def test_f3_most_active_tie_newer_wins(spark):
    ev = clicks(spark, [("a", "u", 1000), ("b", "u", 2000), ("b", "u", 3000), ("a", "u", 4000)])
    assert rows_of(aggregate.most_active(ev, "user", ORDER), "user", "cnt") == [("a", 2)]


def test_f3_tumbling_and_mean(events8):
    c = windows.window_count(events8, ["user"], "ts", "5 seconds")
    assert rows_of(_ms(c, "user", "window_start", "cnt"), "user", "window_start", "cnt") == sorted(
        [("BOb", 0, 4), ("Mary", 0, 1), ("Alice", 5000, 2), ("Alice", 20000, 1)]
    )
    m = windows.window_agg(events8, ["user"], windows.tumbling("ts", "5 seconds"), [F.expr("sum(ts_ms) div count(1)").alias("m")])
    assert rows_of(_ms(m, "user", "window_start", "m"), "user", "window_start", "m") == sorted(
        [("BOb", 0, 3225), ("Mary", 0, 1000), ("Alice", 5000, 5000), ("Alice", 20000, 20000)]
    )


def test_f3_uv_and_url_views(events8):
    w = windows.tumbling("ts", "10 seconds")
    for fn in (aggregate.distinct_per_window, aggregate.distinct_per_window_two_stage):
        uv = fn(events8, [], w, "user")
        assert rows_of(_ms(uv, "window_start", "uv"), "window_start", "uv") == [(0, 3), (20000, 1)]
    views = windows.window_count(events8, ["url"], "ts", "10 seconds")
    assert rows_of(_ms(views, "url", "window_start", "cnt"), "window_start", "url", "cnt") == sorted([
        (0, "./cart", 1), (0, "./home", 1), (0, "./prod?id=040", 1), (0, "./prod?id=100", 1),
        (0, "./prod?id=140", 2), (0, "./prod?id=18", 1), (20000, "./prod?id=240", 1)])
    hand = windows.integer_division_window(events8, ["url"], "ts_ms", 10_000)
    assert rows_of(hand, "url", "window_start", "window_end", "cnt") == rows_of(views, "url", "window_start", "window_end", "cnt")


def test_f3_sliding_session_cumulate(events8):
    s = windows.window_count(events8, [], "ts", "10 seconds", "5 seconds")
    assert rows_of(_ms(s, "window_start", "cnt"), "window_start", "cnt") == [(-5000, 5), (0, 7), (5000, 2), (15000, 1), (20000, 1)]
    ss = windows.session_count(events8, ["user"], "ts", "2 seconds")
    assert rows_of(_ms(ss, "user", "window_start", "window_end", "cnt"), "user", "window_start", "window_end", "cnt") == sorted(
        [("Alice", 5000, 7000, 2), ("Alice", 20000, 22000, 1), ("BOb", 2000, 6000, 4), ("Mary", 1000, 3000, 1)]
    )
    cu = windows.cumulate(events8, ["user"], "ts", "5 seconds", "10 seconds", [F.count(F.lit(1)).alias("cnt")])
    assert rows_of(_ms(cu, "user", "window_start", "window_end", "cnt"), "user", "window_start", "window_end", "cnt") == sorted([
        ("BOb", 0, 5000, 4), ("Mary", 0, 5000, 1), ("Alice", 0, 10000, 2), ("BOb", 0, 10000, 4),
        ("Mary", 0, 10000, 1), ("Alice", 20000, 25000, 1), ("Alice", 20000, 30000, 1)])


@pytest.mark.parametrize("width", SPLITS)
def test_f3_over_avg(events8, width):
    r = windows.rows_average(events8, ["user"], ORDER, bucket("ts", width), "ts_ms", 4, "a")
    got = rows_of(r, "user", "ts_ms", "seq", "a")
    assert got == sorted([("Alice", 5000, 6, 5000), ("Alice", 5000, 8, 5000), ("Alice", 20000, 7, 10000),
                          ("BOb", 2000, 2, 2000), ("BOb", 3000, 3, 2500), ("BOb", 3900, 4, 2966),
                          ("BOb", 4000, 5, 3225), ("Mary", 1000, 1, 1000)])


def test_f12_sql_group_count_and_top2(spark, events8):
    v = events8.select(F.col("user").alias("user_name"), "url", F.col("ts_ms").alias("ts"))
    v.createOrReplaceTempView("f12_clicks")
    got = rows_of(spark.sql("SELECT user_name, COUNT(1) AS c FROM f12_clicks GROUP BY user_name"), "user_name", "c")
    assert got == [("Alice", 3), ("BOb", 4), ("Mary", 1)]
    top = topn.top_n_global(events8, "user", 2)
    assert [(r.user, r.cnt, r.rn) for r in top.orderBy("rn").collect()] == [("BOb", 4, 1), ("Alice", 3, 2)]


# --- F4-F9 joins ----------------------------------------------------------------------------

def _pairs(spark, rows, name):
    return spark.createDataFrame(rows, "k string, ms bigint").withColumn(f"{name}_ts", ms_to_ts("ms")).withColumnRenamed("ms", f"{name}_ms")


def test_f4_window_join_and_cogroup(spark):
    left = _pairs(spark, [("a", 1000), ("b", 1000), ("a", 2000), ("b", 2000)], "l")
    right = _pairs(spark, [("a", 3000), ("b", 4000), ("a", 4500), ("b", 5500)], "r")
    j = joins.window_join(left, right, "k", "l_ts", "r_ts", "5 seconds")
    assert rows_of(j, "k", "l_ms", "r_ms") == sorted(
        [("a", 1000, 3000), ("a", 1000, 4500), ("a", 2000, 3000), ("a", 2000, 4500), ("b", 1000, 4000), ("b", 2000, 4000)]
    )
    lc = left.select("k", F.col("l_ts").alias("ts"), F.col("l_ms").alias("ms"))
    rc = right.select("k", F.col("r_ts").alias("ts"), F.col("r_ms").alias("ms"))
    g = joins.cogroup(lc, rc, "k", "ts", "5 seconds", ["ts"])
    groups = {}
    for r in g.orderBy("pos").collect():
        key = (r.k, int(epoch_ms_py(r.window_start)))
        groups.setdefault(key, ([], []))[0 if r.side == "left" else 1].append(int(epoch_ms_py(r.ts)))
    assert groups == {("a", 0): ([1000, 2000], [3000, 4500]), ("b", 0): ([1000, 2000], [4000]), ("b", 5000): ([], [5500])}


def epoch_ms_py(t):
    return (t - dt.datetime(1970, 1, 1)) / dt.timedelta(milliseconds=1)


@pytest.mark.parametrize("lower,upper", [("-5 seconds", "10 seconds")])
def test_f5_interval_join(spark, events8, lower, upper):
    orders = _pairs(spark, [("Mary", 5000), ("Alice", 5000), ("Bob", 20000), ("Alice", 20000), ("Alice", 51000)], "o")
    c = events8.select(F.col("user").alias("k"), "url", F.col("ts").alias("c_ts"), F.col("ts_ms").alias("c_ms"))
    j = joins.interval_join(orders, c, "k", "o_ts", "c_ts", lower, upper)
    assert rows_of(j, "k", "o_ms", "url", "c_ms") == sorted([
        ("Mary", 5000, "./home", 1000), ("Alice", 5000, "./prod?id=140", 5000),
        ("Alice", 5000, "./prod?id=040", 5000), ("Alice", 20000, "./prod?id=240", 20000)])


def test_f6_unbounded_join(spark):
    a = spark.createDataFrame([("a", 1000), ("b", 2000)], "k string, l bigint")
    b = spark.createDataFrame([("a", 3000), ("b", 4000)], "k string, r bigint")
    assert rows_of(joins.equi_join(a, b, "k", broadcast_max_rows=10), "k", "l", "r") == [("a", 1000, 3000), ("b", 2000, 4000)]


@pytest.mark.parametrize("width", SPLITS)
def test_f7_reconcile(spark, width):
    app = spark.createDataFrame([("order-1", 1000, 1), ("order-2", 2000, 2), ("order-3", 3500, 3)], "order_id string, ms bigint, a_seq bigint")
    app = app.withColumn("a_ts", ms_to_ts("ms")).drop("ms")
    third = spark.createDataFrame([("order-1", 3000, 1), ("order-3", 4000, 2)], "order_id string, ms bigint, t_seq bigint")
    third = third.withColumn("t_ts", ms_to_ts("ms")).drop("ms")
    r = joins.reconcile(app, third, "order_id", "a_ts", "a_seq", "t_ts", "t_seq", "5 seconds", lambda d, k, ts: bucket(ts, width))
    assert rows_of(r, "order_id", "status") == [("order-1", "matched"), ("order-2", "missing_third"), ("order-3", "matched")]


@pytest.mark.parametrize("width", SPLITS)
def test_reconcile_goes_on_behind_a_lonely_row(spark, width):
    """One lonely app payment, then 19 true pairs: 19 matched and 1 lonely. Null keys are one
    key, a row without a time matches nothing."""
    for key in ("o", None):
        app = [(key, 0, 100)] + [(key, (i + 1) * 100_000, i) for i in range(19)] + [("z", None, 7)]
        third = [(key, (i + 1) * 100_000 + 5_000 * (-1) ** i, i) for i in range(19)] + [("z", None, 8)]
        a = spark.createDataFrame(app, "o string, ms bigint, a_id bigint").withColumn("a_ts", ms_to_ts("ms")).drop("ms")
        t = spark.createDataFrame(third, "o string, ms bigint, t_id bigint").withColumn("t_ts", ms_to_ts("ms")).drop("ms")
        r = joins.reconcile(a, t, "o", "a_ts", "a_id", "t_ts", "t_id", "5 seconds", lambda d, k, ts: bucket(ts, width))
        got = rows_of(r.filter("o is null or o <> 'z'"), "status", "a_id", "t_id")
        assert got == [("matched", i, i) for i in range(19)] + [("missing_third", 100, None)]
        assert rows_of(r.filter("o = 'z'"), "status") == [("missing_app",), ("missing_third",)]


@pytest.mark.parametrize("mode,expected", [
    ("all", [("Alice", "login", "pay"), ("Bob", "login", "order")]),
    ("latest", [("Bob", "login", "order")]),
])
def test_f9_rule_join(spark, mode, expected):
    acts = spark.createDataFrame([("Alice", "login", 1), ("Alice", "pay", 2), ("Bob", "login", 3), ("Bob", "order", 4)],
                                 "user_id string, action string, seq bigint")
    rules = spark.createDataFrame([("login", "pay", 1), ("login", "order", 2)], "action1 string, action2 string, version int")
    r = joins.rule_join(acts, rules, "user_id", ["seq"], F.col("seq"), "action", mode)
    assert rows_of(r, "user_id", "action1", "action2") == expected


def test_f8_co_map(spark):
    a = spark.createDataFrame([(1,), (2,), (3,)], "value int")
    b = spark.createDataFrame([(4,), (5,), (6,)], "value bigint")
    r = transform.co_map(a, b, lambda d: F.concat(F.lit("Integer: "), d["value"].cast("string")),
                         lambda d: F.concat(F.lit("Long: "), d["value"].cast("string")))
    assert sorted(x.value for x in r.collect()) == ["Integer: 1", "Integer: 2", "Integer: 3", "Long: 4", "Long: 5", "Long: 6"]


# --- F10 / F11 patterns ---------------------------------------------------------------------

# Fixture F10 (login events).
LOGINS = [
    ("user_1", "192.168.0.1", "fail", 2000),
    ("user_1", "192.168.0.2", "fail", 3000),
    ("user_2", "192.168.1.29", "fail", 4000),
    ("user_1", "171.56.23.10", "fail", 5000),
    ("user_2", "192.168.1.29", "success", 6000),
    ("user_2", "192.168.1.29", "fail", 7000),
    ("user_2", "192.168.1.29", "fail", 8000),
]


def _logins(spark, rows):
    df = spark.createDataFrame([(*r, i + 1) for i, r in enumerate(rows)], "user_id string, host string, event_type string, ms bigint, seq bigint")
    return df.withColumn("ts", ms_to_ts("ms"))


@pytest.mark.parametrize("width", SPLITS)
def test_f10_login_patterns(spark, width):
    ev = _logins(spark, LOGINS)
    sp = bucket("ts", width)
    fail = F.col("event_type") == "fail"
    c1 = patterns.adjacent(ev, ["user_id"], ORDER, sp, fail, 3, ["ms"])
    assert rows_of(c1, "user_id", "ms_1", "ms_2", "ms_3") == [("user_1", 2000, 3000, 5000)]
    c2 = patterns.consecutive(ev, ["user_id"], ORDER, sp, fail, 3, ["ms"])
    assert rows_of(c2, "user_id", "ms") == [("user_1", 5000)]
    sym = F.when(fail, 0).when(F.col("event_type") == "success", 1).otherwise(2)
    c4 = patterns.state_machine(ev, ["user_id"], ORDER, sp, sym, patterns.LOGIN_FAIL_NEXT, patterns.LOGIN_FAIL_EMIT)
    assert rows_of(c4.filter("alert"), "user_id", "ms") == [("user_1", 5000)]


@pytest.mark.parametrize("width", SPLITS)
def test_five_fails_overlap(spark, width):
    ev = _logins(spark, [("u", "h", "fail", 1000 * i) for i in range(1, 6)])
    sp = bucket("ts", width)
    fail = F.col("event_type") == "fail"
    assert patterns.adjacent(ev, ["user_id"], ORDER, sp, fail, 3, ["ms"]).count() == 3
    assert patterns.consecutive(ev, ["user_id"], ORDER, sp, fail, 3, ["ms"]).count() == 3
    sym = F.when(fail, 0).otherwise(2)
    assert patterns.state_machine(ev, ["user_id"], ORDER, sp, sym, patterns.LOGIN_FAIL_NEXT, patterns.LOGIN_FAIL_EMIT).filter("alert").count() == 3


@pytest.mark.parametrize("width", ["1 hour", "1 minute"])
def test_f11_order_timeout(spark, width):
    # Fixture F11 (order events).
    rows = [("user_1", "order_1", "create", 1000), ("user_2", "order_2", "create", 2000),
            ("user_1", "order_1", "modify", 10000), ("user_1", "order_1", "pay", 60000),
            ("user_2", "order_3", "create", 600000), ("user_2", "order_3", "pay", 1200000)]
    df = spark.createDataFrame([(*r, i + 1) for i, r in enumerate(rows)], "user_id string, order_id string, event_type string, ms bigint, seq bigint")
    df = df.withColumn("ts", ms_to_ts("ms"))
    t = F.col("event_type")
    r = patterns.followed_by_within(df, ["order_id"], ORDER, bucket("ts", width), t == "create", t == "pay", "15 minutes", ["seq", "ts"])
    assert rows_of(r, "order_id", "status") == [("order_1", "matched"), ("order_2", "timeout"), ("order_3", "matched")]


# --- boundaries (Q15) ------------------------------------------------------------------------

def test_followed_by_limit_is_strict(spark):
    rows = [("u", "create", 0), ("u", "pay", 15 * 60_000), ("v", "create", 0), ("v", "pay", 15 * 60_000 - 1)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "k string, t string, ms bigint, seq bigint").withColumn("ts", ms_to_ts("ms"))
    r = patterns.followed_by_within(df, ["k"], ORDER, bucket("ts", "1 minute"), F.col("t") == "create", F.col("t") == "pay", "15 minutes", ["seq", "ts"])
    assert rows_of(r, "k", "status") == [("u", "timeout"), ("v", "matched")]


def test_interval_join_bounds_inclusive(spark):
    left = spark.createDataFrame([("a", 10_000)], "k string, ms bigint").withColumn("l_ts", ms_to_ts("ms")).drop("ms")
    right = spark.createDataFrame([("a", 5_000), ("a", 20_000), ("a", 4_999), ("a", 20_001)], "k string, ms bigint")
    right = right.withColumn("r_ts", ms_to_ts("ms"))
    j = joins.interval_join(left, right, "k", "l_ts", "r_ts", "-5 seconds", "10 seconds")
    assert sorted(r.ms for r in j.collect()) == [5_000, 20_000]


def test_session_merges_at_exact_gap(spark):
    df = spark.createDataFrame([("a", 0), ("a", 2_000), ("a", 4_001)], "k string, ms bigint").withColumn("ts", ms_to_ts("ms"))
    s = windows.session_count(df, ["k"], "ts", "2 seconds")
    assert sorted(r.cnt for r in s.collect()) == [1, 2]
