
import random

import pytest
from conftest import SF_MID, SF_SMALL
from pyspark.sql import functions as F

import __spark_entry__ as se
from tidemark.functions.time import bucket
from tidemark.operators import keyed, windows
from tidemark.sources.tables import events

Q = se.queries()


def _set(df, *cols):
    rows = [tuple(r) for r in df.select(*cols).collect()]
    return sorted(rows, key=lambda r: [(v is not None, v) for v in r])  # nulls first


def test_topn_variants_agree(spark):
    cols = ["window_start", "window_end", "event_type", "cnt", "rn"]
    assert _set(Q["t01_topn_sliding"](spark, SF_MID), *cols) == _set(Q["t02_topn_window_all"](spark, SF_MID), *cols)


def test_pattern_variants_agree(spark):
    c1 = {r.event_id_3 for r in Q["c01_three_fails"](spark, SF_MID).collect()}
    c2 = {r.event_id for r in Q["c02_consecutive"](spark, SF_MID).collect()}
    c4 = {r.event_id for r in Q["c04_state_machine"](spark, SF_MID).collect()}
    assert c1 == c2 == c4 and len(c1) > 0


def test_uv_variants_agree(spark):
    cols = ["window_start", "window_end", "uv"]
    assert _set(Q["a10_uv_window"](spark, SF_MID), *cols) == _set(Q["a11_uv_window_two_stage"](spark, SF_MID), *cols)


def test_hand_window_equals_tumbling(spark):
    cols = ["event_type", "window_start", "window_end", "cnt"]
    assert _set(Q["a12_url_views"](spark, SF_MID), *cols) == _set(Q["w13_integer_division_window"](spark, SF_MID), *cols)


def test_sql_tumble_forms_agree(spark):
    a = _set(Q["w07_sql_tumble_end"](spark, SF_MID), "user_name", "window_end", "cnt")
    b = _set(Q["w08_sql_tumble_tvf"](spark, SF_MID), "user_name", "window_end", "cnt")
    assert a == b


def test_window_join_inside_cogroup(spark):
    j = Q["j01_window_join"](spark, SF_MID)
    g = Q["j02_cogroup"](spark, SF_MID)
    pairs = j.groupBy("user_id", "window_start").count()
    sizes = g.filter("n_left > 0 AND n_right > 0").select("user_id", "window_start", (F.col("n_left") * F.col("n_right")).alias("count")).distinct()
    assert _set(pairs, "user_id", "window_start", "count") == _set(sizes, "user_id", "window_start", "count")


def test_union_count_is_sum(spark):
    ev = events(spark, SF_MID)
    u = Q["u01_union"](spark, SF_MID).count()
    assert u == ev.filter("event_type = 'click'").count() + ev.filter("event_type = 'view'").count()


def test_sliding_is_twice_tumbling(spark):
    ev = events(spark, SF_MID)
    slide = windows.window_count(ev, [], "ts", "1 hour", "30 minutes").agg(F.sum("cnt")).first()[0]
    assert slide == 2 * ev.count()


def test_cumulate_last_step_is_tumble(spark):
    ev = events(spark, SF_MID)
    cu = windows.cumulate(ev, ["user_id"], "ts", "15 minutes", "1 hour", [F.count(F.lit(1)).alias("cnt")])
    last = cu.filter(F.col("window_end") == F.col("window_start") + F.expr("INTERVAL 1 HOUR"))
    tum = windows.window_count(ev, ["user_id"], "ts", "1 hour")
    cols = ["user_id", "window_start", "window_end", "cnt"]
    assert _set(last, *cols) == _set(tum, *cols)


@pytest.mark.parametrize("name", ["a06_running_clicks", "c03_followed_by_within", "x04_value_state_previous", "j05_reconcile"])
def test_input_order_does_not_matter(spark, name, tmp_path):
    """Shuffle the rows of the input file: with the (ts, event_id) order given, results stay."""
    import pyarrow.parquet as pq

    t = pq.read_table(f"{SF_SMALL}/events.parquet").to_pandas()
    idx = list(range(len(t)))
    random.Random(7).shuffle(idx)
    d = tmp_path / "sf"
    d.mkdir()
    t.iloc[idx].to_parquet(d / "events.parquet", index=False)
    a = Q[name](spark, SF_SMALL)
    b = Q[name](spark, str(d))
    assert _set(a, *a.columns) == _set(b, *a.columns)


def test_one_hot_key_is_split(spark):
    """A key holding most rows: slice-split scans equal the plain window result."""
    ev = events(spark, SF_MID).withColumn("user_id", F.when(F.col("event_id") % 3 != 0, F.lit(0)).otherwise(F.col("user_id")))
    r = keyed.row_number(ev, ["user_id"], ["ts", "event_id"], bucket("ts", "1 hour"), "rn")
    from pyspark.sql import Window

    ref = ev.withColumn("rn2", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    j = r.join(ref.select("event_id", "rn2"), "event_id")
    assert j.filter(F.col("rn") != F.col("rn2")).count() == 0
    assert r.filter("user_id = 0").agg(F.max("rn")).first()[0] > 6000


def test_null_keys_are_one_group(spark):
    """Rows with a null key form one group across slices, as in a plain window."""
    from pyspark.sql import Window

    ev = events(spark, SF_SMALL).withColumn("user_id", F.when(F.col("user_id") % 5 == 0, F.lit(None)).otherwise(F.col("user_id")))
    order = ["ts", "event_id"]
    w = Window.partitionBy("user_id").orderBy(*order)
    ref = ev.withColumn("rn2", F.row_number().over(w)).withColumn("p2", F.lag("event_id", 2).over(w))
    r = keyed.row_number(ev, ["user_id"], order, bucket("ts", "1 hour"), "rn")
    lg = keyed.lag(ev, ["user_id"], order, bucket("ts", "1 hour"), ["event_id"], 2, "p")
    j = r.join(lg.select("event_id", "p2_event_id"), "event_id").join(ref.select("event_id", "rn2", "p2"), "event_id")
    assert j.count() == ev.count()
    assert j.filter((F.col("rn") != F.col("rn2")) | ~F.col("p2_event_id").eqNullSafe(F.col("p2"))).count() == 0
    assert j.filter(F.col("user_id").isNull()).agg(F.max("rn")).first()[0] > 100


def test_periodic_count_keeps_null_keys(spark):
    """The null key is a key like any other."""
    from tidemark.operators import timers

    ev = events(spark, SF_SMALL)
    some = ev.withColumn("user_id", F.when(F.col("user_id") % 3 == 0, F.lit(None)).otherwise(F.lit(0)).cast("bigint"))
    named = some.withColumn("user_id", F.coalesce("user_id", F.lit(-1).cast("bigint")))
    got = _set(timers.periodic_count(some, "user_id", "ts", "1 day").withColumn("user_id", F.coalesce("user_id", F.lit(-1))), "user_id", "tick", "pv")
    assert got == _set(timers.periodic_count(named, "user_id", "ts", "1 day"), "user_id", "tick", "pv")
    assert any(x[0] == -1 for x in got)


def test_cogroup_keeps_null_keys(spark):
    from tidemark.operators import joins

    ev = events(spark, SF_SMALL).withColumn("user_id", F.when(F.col("event_id") % 2 == 0, F.col("user_id")))
    a, b = ev.filter("event_type = 'click'"), ev.filter("event_type <> 'click'")
    assert joins.cogroup(a, b, "user_id", "ts", "1 day", ["ts", "event_id"]).count() == ev.filter("event_type is not null").count()


@pytest.mark.parametrize("case", ["null_ts", "null_hot_key", "outlier", "one_second", "many_hot"])
def test_hot_slices_match_plain_window(spark, case):
    """Hot keys in slices give the plain window's numbers, lose no row and take several slices."""
    from pyspark.sql import Window

    n = 6000
    d = spark.range(n).select(F.col("id").alias("event_id"), (F.col("id") % 7).alias("user_id"), F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("ts"))
    if case == "null_ts":
        d = d.withColumn("ts", F.when(F.col("event_id") % 5 != 0, F.col("ts")))
    if case == "null_hot_key":
        d = d.withColumn("user_id", F.when(F.col("user_id") < 2, F.col("user_id")))
    if case == "outlier":
        d = d.withColumn("ts", F.when(F.col("event_id") == 0, F.lit("1970-01-01").cast("timestamp_ntz")).otherwise(F.col("ts") + F.expr("INTERVAL 50 YEARS")))
    if case == "one_second":
        d = d.withColumn("ts", F.timestamp_micros(F.col("event_id") * 100).cast("timestamp_ntz"))
    if case == "many_hot":
        d = d.withColumn("user_id", F.col("event_id") % 1500)
    split = keyed.hot_split(d, "user_id", "ts", hot_rows=3)
    slices = d.select("user_id", split.alias("s")).distinct().groupBy("user_id").count()
    assert slices.agg(F.max("count")).first()[0] > (1 if case == "many_hot" else 20)
    if case == "null_hot_key":
        assert slices.filter("user_id is null").first()["count"] > 20
    got = keyed.row_number(d, ["user_id"], ["ts", "event_id"], split, "rn")
    want = d.withColumn("rn", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("bigint"))
    assert sorted(map(tuple, got.select("event_id", "rn").collect())) == sorted(map(tuple, want.select("event_id", "rn").collect()))
    lag = keyed.lag(d, ["user_id"], ["ts", "event_id"], split, ["event_id"], 2)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    ref = d.select("event_id", F.lag("event_id", 2).over(w).alias("x"))
    assert {r["event_id"]: r["prev2_event_id"] for r in lag.collect()} == {r["event_id"]: r["x"] for r in ref.collect()}


def test_hot_key_rows_span_many_tasks(spark):
    """The rows of a key holding 2/3 of the data are processed by many tasks in the
    slice-split scan, by one task in a plain keyed window."""
    from pyspark.sql import Window

    ev = events(spark, SF_MID).withColumn("user_id", F.when(F.col("event_id") % 3 != 0, F.lit(0)).otherwise(F.col("user_id")))
    order = ["ts", "event_id"]
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        split = keyed.row_number(ev, ["user_id"], order, keyed.time_split(ev, "ts"), "rn")
        plain = ev.withColumn("rn", F.row_number().over(Window.partitionBy("user_id").orderBy(*order)))
        # keep rn in the output: an unused window would be pruned and the id read at the scan
        def tasks(df):
            rows = df.filter("user_id = 0").select(F.spark_partition_id().alias("p"), "rn").collect()
            return len({r.p for r in rows})

        assert tasks(plain) == 1
        assert tasks(split) >= 6
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)


def test_hot_split_slices_only_hot_keys(spark):
    """Only the hot key is sliced; results equal the plain window; the per-slice table has
    about one row per cold key."""
    from pyspark.sql import Window

    ev = events(spark, SF_MID).withColumn("user_id", F.when(F.col("event_id") % 3 != 0, F.lit(0)).otherwise(F.col("user_id")))
    order = ["ts", "event_id"]
    sp = keyed.hot_split(ev, "user_id", "ts")
    slices = ev.select("user_id", sp.alias("s")).distinct()
    assert slices.filter("user_id = 0").count() > 50
    assert slices.filter("user_id != 0").count() == ev.filter("user_id != 0").select("user_id").distinct().count()
    r = keyed.row_number(ev, ["user_id"], order, sp, "rn")
    ref = ev.withColumn("rn2", F.row_number().over(Window.partitionBy("user_id").orderBy(*order)))
    j = r.join(ref.select("event_id", "rn2"), "event_id")
    assert j.filter(F.col("rn") != F.col("rn2")).count() == 0


def test_operators_on_empty_input(spark):
    """Sizing jobs, carry tables and timers cope with an input without rows."""
    from tidemark.operators import aggregate, joins, patterns, timers, watermark

    ev = events(spark, SF_SMALL).limit(0)
    order = ["ts", "event_id"]
    t = F.col("event_type")
    for sp in (keyed.time_split(ev, "ts"), keyed.hot_split(ev, "user_id", "ts"), keyed.range_split(ev, "event_id")):
        assert keyed.row_number(ev, ["user_id"], order, sp).count() == 0
        assert keyed.lag(ev, ["user_id"], order, sp, ["event_type"], 2).count() == 0
        assert patterns.followed_by_within(ev, ["user_id"], order, sp, t == "signup", t == "purchase", "1 hour", ["event_id", "ts"]).count() == 0
        assert patterns.state_machine(ev, ["user_id"], order, sp, F.lit(0), patterns.LOGIN_FAIL_NEXT, patterns.LOGIN_FAIL_EMIT).count() == 0
    assert timers.periodic_count(ev, "user_id", "ts", "1 day").count() == 0
    assert aggregate.most_active(ev, "user_id", order).count() in (0, 1)
    assert joins.interval_join(ev.select("user_id", F.col("ts").alias("a")), ev.select("user_id", F.col("ts").alias("b")),
                               "user_id", "a", "b", "-1 hour", "1 hour").count() == 0
    assert watermark.late_route(ev.withColumn("source", F.lit(0)), "source", order, keyed.time_split(ev, "ts"), "ts",
                                "1 hour", "1 hour").count() == 0


def test_running_sum_min_max_match_window(spark):
    """Running sum (null until a value), min and max over slices equal plain windows."""
    from pyspark.sql import Window

    ev = events(spark, SF_SMALL).withColumn("v", F.when(F.col("event_id") % 4 == 0, F.lit(None)).otherwise(F.col("event_id")))
    order = ["ts", "event_id"]
    r = keyed.running(ev, ["user_id"], order, bucket("ts", "1 hour"),
                      {"s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v")})
    w = Window.partitionBy("user_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ref = ev.select("event_id", F.sum("v").over(w).alias("s2"), F.min("v").over(w).alias("lo2"), F.max("v").over(w).alias("hi2"))
    j = r.join(ref, "event_id")
    bad = j.filter(~F.col("s").eqNullSafe(F.col("s2")) | ~F.col("lo").eqNullSafe(F.col("lo2")) | ~F.col("hi").eqNullSafe(F.col("hi2")))
    assert j.count() == ev.count() and bad.count() == 0
