"""Stream = batch: each streaming form, fed the events table one day per micro-batch, must
give the batch form's final result. A sentinel row far in the future closes every window
and fires every timer (Q16); it is removed from the results."""

import datetime as dt
import os
import tempfile
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import __spark_entry__ as se
from tidemark.functions.time import epoch_ms
from tidemark.operators import patterns
from tidemark.sinks.buffered import buffered_groups, buffered_sink
from tidemark.sinks.outputs import to_memory
from tidemark.streaming import basic, stateful

SENTINEL_ID = 10**12


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple(v.replace(tzinfo=None) if isinstance(v, dt.datetime) else v for v in r))
    return sorted(out)


@pytest.fixture(scope="module")
def stream_dir(spark):
    """events of sf0.001 as one parquet file per day (increasing mtimes) + a sentinel file."""
    d = tempfile.mkdtemp(prefix="tm-stream-")
    t = pq.read_table(f"{SF_SMALL}/events.parquet").to_pandas()
    t["day"] = t["ts"].dt.floor("D")
    base = 1_700_000_000
    for i, (_, g) in enumerate(sorted(t.groupby("day"), key=lambda x: x[0])):
        p = f"{d}/part-{i:04d}.parquet"
        pq.write_table(pa.Table.from_pandas(g.drop(columns="day").reset_index(drop=True), preserve_index=False), p)
        os.utime(p, (base + i, base + i))
    s = t.drop(columns="day").iloc[:1].copy()
    s["event_id"], s["user_id"] = SENTINEL_ID, -1
    s["ts"] = t["ts"].max() + dt.timedelta(days=365)
    p = f"{d}/part-9999.parquet"
    pq.write_table(pa.Table.from_pandas(s.reset_index(drop=True), preserve_index=False), p)
    os.utime(p, (base + 9999, base + 9999))
    return d


def _stream(spark, d, delay="0 seconds"):
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d)
    return basic.event_time(raw, delay).withColumnRenamed("event_id", "seq")


def _run(df, name, mode="append"):
    q = to_memory(df, name, mode, checkpoint=tempfile.mkdtemp(prefix="tm-ckpt-"))
    q.awaitTermination()
    return df.sparkSession.table(name)


def _batch(spark, name):
    return se.queries()[name](spark, SF_SMALL)


def test_window_count_stream(spark, stream_dir):
    s = basic.window_counts(_stream(spark, stream_dir), ["event_type"], "et", "1 hour")
    got = _run(s, "tm_a12").filter(F.col("window_start") < dt.datetime(2030, 1, 1))
    b = _batch(spark, "a12_url_views")
    cols = ["event_type", "window_start", "window_end", "cnt"]
    assert _norm(got.select(cols).collect()) == _norm(b.select(cols).collect())


def test_top_n_stream(spark, stream_dir):
    s = basic.top_n(_stream(spark, stream_dir), "event_type", "et", "1 day", "12 hours", 2)
    got = _run(s, "tm_t01").filter(F.col("window_start") < dt.datetime(2030, 1, 1))
    b = _batch(spark, "t01_topn_sliding")
    cols = ["window_start", "window_end", "event_type", "cnt", "rn"]
    assert _norm(got.select(cols).collect()) == _norm(b.select(cols).collect())


def test_followed_by_stream(spark, stream_dir):
    s = stateful.followed_by_within(_stream(spark, stream_dir), "user_id", "event_type", "signup", "purchase", "12 hours")
    got = _run(s, "tm_c03")
    b = _batch(spark, "c03_followed_by_within")
    g = got.select("user_id", F.col("first_seq").alias("e1"), "first_ts", F.col("second_seq").alias("e2"), "second_ts", "status")
    bb = b.select("user_id", F.col("first_event_id").alias("e1"), "first_ts", F.col("second_event_id").alias("e2"), "second_ts", "status")
    assert _norm(g.collect()) == _norm(bb.collect())


def test_group_of_five_stream(spark, stream_dir):
    src = _stream(spark, stream_dir).withColumn("ms", epoch_ms("et"))
    got = _run(stateful.group_of_n_average(src, "user_id", 5, "ms", name="avg_ts_ms"), "tm_a15").filter("user_id >= 0")
    b = _batch(spark, "a15_avg_of_5")
    assert _norm(got.select("user_id", "grp", "avg_ts_ms").collect()) == _norm(b.select("user_id", "grp", "avg_ts_ms").collect())


def test_patterns_stream(spark, stream_dir):
    src = _stream(spark, stream_dir)
    t = F.col("event_type")
    sym = F.when(t == "error", 0).when(t == "purchase", 1).otherwise(2)
    c4 = _run(stateful.state_machine(src, "user_id", sym, patterns.LOGIN_FAIL_NEXT, patterns.LOGIN_FAIL_EMIT), "tm_c04")
    b4 = _batch(spark, "c04_state_machine")
    assert _norm(c4.select("user_id", "seq", "ts").collect()) == _norm(b4.select("user_id", "event_id", "ts").collect())
    c2 = _run(stateful.consecutive(_stream(spark, stream_dir), "user_id", t == "error", 3), "tm_c02")
    b2 = _batch(spark, "c02_consecutive")
    assert _norm(c2.select("user_id", "seq", "ts", "run").collect()) == _norm(b2.select("user_id", "event_id", "ts", "run").collect())


def test_rows_average_stream(spark, stream_dir):
    got = _run(stateful.rows_average(_stream(spark, stream_dir), "user_id", 4), "tm_w11").filter("user_id >= 0")
    b = _batch(spark, "w11_over_avg")
    assert _norm(got.select("user_id", "seq", "avg_ts_ms").collect()) == _norm(b.select("user_id", "event_id", "avg_ts_ms").collect())


@pytest.fixture(scope="module")
def disordered_dir(spark):
    """The same events dealt to four files without regard to time, and the sentinel file: with a
    delay of the whole span no row is late, and each batch brings rows before those of the last."""
    d = tempfile.mkdtemp(prefix="tm-disorder-")
    t = pq.read_table(f"{SF_SMALL}/events.parquet").to_pandas()
    s = t.iloc[:1].copy()
    s["event_id"], s["user_id"], s["ts"] = SENTINEL_ID, -1, t["ts"].max() + dt.timedelta(days=36500)
    for i, g in enumerate([t[t["event_id"] % 4 == j] for j in range(4)] + [s]):
        p = f"{d}/part-{i}.parquet"
        pq.write_table(pa.Table.from_pandas(g.sample(frac=1, random_state=i).reset_index(drop=True), preserve_index=False), p)
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    return d


@pytest.mark.parametrize("name", ["c02", "c03", "c04", "a15", "w11", "w04", "j05"])
def test_rows_across_batches_are_handled_in_event_time(spark, disordered_dir, name):
    src = _stream(spark, disordered_dir, "3650 days")
    t = F.col("event_type")
    if name == "c02":
        got = stateful.consecutive(src, "user_id", t == "error", 3).withColumnRenamed("seq", "event_id")
        b = _batch(spark, "c02_consecutive").select(got.columns)
    elif name == "c03":
        got = stateful.followed_by_within(src, "user_id", "event_type", "signup", "purchase", "12 hours")
        b = _batch(spark, "c03_followed_by_within").select("user_id", "first_event_id", "first_ts", "second_event_id", "second_ts", "status")
    elif name == "c04":
        sym = F.when(t == "error", 0).when(t == "purchase", 1)  # null: the last symbol
        got = stateful.state_machine(src, "user_id", sym, patterns.LOGIN_FAIL_NEXT, patterns.LOGIN_FAIL_EMIT)
        b = _batch(spark, "c04_state_machine").select("user_id", "event_id", "ts")
    elif name == "a15":
        got = stateful.group_of_n_average(src.withColumn("ms", epoch_ms("et")), "user_id", 5, "ms", name="avg_ts_ms")
        b = _batch(spark, "a15_avg_of_5").select("user_id", "grp", "avg_ts_ms")
    elif name == "w11":
        got = stateful.rows_average(src, "user_id", 4)
        b = _batch(spark, "w11_over_avg").select("user_id", "event_id", "avg_ts_ms")
    elif name == "w04":
        got = stateful.count_window(src.withColumn("v", F.col("seq")), "user_id", 5, 3, "v")
        from pyspark.sql import Window

        ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("v", F.col("event_id"))
        w = Window.partitionBy("user_id").orderBy("ts", "event_id")
        b = ev.withColumn("fire_pos", F.row_number().over(w)).withColumn("frame_rows", F.least("fire_pos", F.lit(5)))
        b = b.withColumn("frame_sum", F.sum("v").over(w.rowsBetween(-4, 0))).filter("fire_pos % 3 = 0")
        b = b.select("user_id", "fire_pos", "frame_rows", "frame_sum", (F.col("fire_pos") - F.col("frame_rows") + 1).alias("frame_first"))
    else:
        got = stateful.reconcile(src.filter(t.isin("click", "purchase") | (F.col("user_id") < 0)), "user_id", "event_type", "click", "1 day")
        b = _batch(spark, "j05_reconcile").select("user_id", "app_id", "app_ts", "third_id", "third_ts", "status")
    rows = _run(got, f"tm_disorder_{name}").filter("user_id >= 0").collect()
    key = lambda r: [(v is not None, v) for v in r]
    plain = lambda rs: sorted((tuple(v.replace(tzinfo=None) if isinstance(v, dt.datetime) else v for v in r) for r in rs), key=key)
    assert len(rows) > 0 and plain(rows) == plain(b.collect())


def test_event_timer_stream(spark, stream_dir):
    got = _run(stateful.event_timer(_stream(spark, stream_dir), "user_id", "1 hour"), "tm_x01").filter(F.col("user_id") >= 0)
    b = _batch(spark, "x01_event_timer")
    assert _norm(got.select("user_id", "kind", "at").collect()) == _norm(b.select("user_id", "kind", "at").collect())


def test_interval_join_stream(spark, stream_dir):
    src = _stream(spark, stream_dir, "2 hours")
    buy = src.filter(F.col("event_type") == "purchase").select("user_id", F.col("seq").alias("buy_id"), F.col("et").alias("buy_et"))
    view = src.filter(F.col("event_type") == "view").select(F.col("user_id").alias("v_user"), F.col("seq").alias("view_id"), F.col("et").alias("view_et"))
    view = view.withColumnRenamed("v_user", "user_id")
    j = basic.interval_join(buy, view, "user_id", "buy_et", "view_et", "-30 minutes", "1 hour").select(
        F.col("l.user_id").alias("user_id"), "buy_id", "view_id"
    )
    got = _run(j, "tm_j03")
    b = _batch(spark, "j03_interval_join")
    assert _norm(got.collect()) == _norm(b.select("user_id", "buy_id", "view_id").collect())


def _late_files(spark, steps):
    d = tempfile.mkdtemp(prefix="tm-late-")
    for i, ms_list in enumerate(steps):
        p = f"{d}/step-{i}.txt"
        with open(p, "w") as f:
            for m in ms_list:
                f.write(f"a, /h, {m}\n")
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    return d


def _late_stream(spark, d, bound):
    from tidemark.sources.text import parse_delimited, stream_lines

    lines = stream_lines(spark, d, max_files_per_trigger=1)
    ev = parse_delimited(lines, "user string, url string, ms bigint", trim=True)
    return basic.event_time(ev.withColumn("seq", F.col("ms")), bound, ms="ms")


# Fixture F13 (one file per step).
F13 = [[1000, 12000], [70000], [2000], [90000]]


@pytest.mark.parametrize("bound,mode,expected", [
    ("2 seconds", "append", [(0, 1), (10000, 1), (70000, 1)]),
    ("62 seconds", "append", [(0, 2), (10000, 1)]),
])
def test_late_data_windows(spark, bound, mode, expected):
    s = basic.window_counts(_late_stream(spark, _late_files(spark, F13), bound), ["url"], "et", "10 seconds")
    got = _run(s, f"tm_late_{mode}_{bound[:2]}", mode)
    assert sorted((int(epoch_ms_py(r.window_start)), r.cnt) for r in got.collect()) == expected


def test_late_data_update_mode_refines(spark):
    s = basic.window_counts(_late_stream(spark, _late_files(spark, F13), "62 seconds"), ["url"], "et", "10 seconds")
    got = _run(s, "tm_late_update", "update")
    rows = sorted((int(epoch_ms_py(r.window_start)), r.cnt) for r in got.collect())
    assert (0, 1) in rows and (0, 2) in rows


def test_late_route_side_output(spark):
    s = stateful.late_route(_late_stream(spark, _late_files(spark, F13), "2 seconds"), "url", "10 seconds")
    got = _run(s, "tm_late_route")
    late = [int(epoch_ms_py(r.et)) for r in got.filter(F.col("route") == "late").collect()]
    assert late == [2000]
    assert got.count() == 5


def epoch_ms_py(t):
    return (t.replace(tzinfo=None) - dt.datetime(1970, 1, 1)) / dt.timedelta(milliseconds=1)


def _lines_stream(spark, src):
    lines = spark.readStream.text(src)
    f = F.split("value", ",")
    return lines.select(
        f.getItem(0).alias("url"), f.getItem(1).cast("bigint").alias("n"), F.when(f.getItem(1).cast("bigint") % 2 == 0, F.lit(2**53 + 1)).alias("big"),
        F.timestamp_micros(f.getItem(1).cast("bigint") * 1_000_001).cast("timestamp_ntz").alias("at"), F.lit(0.1).alias("x"), F.array(F.lit(None).cast("int"), F.lit(1)).alias("a"),
    )


def test_buffered_sink_restart(spark):
    """25 rows, restart, 7 rows: three groups of ten, two rows still held back."""
    src, out, ckpt = (tempfile.mkdtemp(prefix=f"tm-buf-{n}-") for n in ("src", "out", "ckpt"))

    def write(batch, epoch_id):
        batch.withColumn("epoch", F.lit(epoch_id)).write.mode("append").parquet(out)

    def run(name, n):
        with open(f"{src}/{name}.txt", "w") as f:
            f.write("".join(f"u,{i}\n" for i in reversed(n)))
        buffered_sink(_lines_stream(spark, src), F.lit(0), 10, "n", write, ckpt).awaitTermination()

    run("a", range(25))
    assert spark.read.parquet(out).count() == 20
    run("b", range(25, 32))
    got = spark.read.parquet(out).orderBy("flush_no", "pos").collect()
    assert [(r["buffer"], r["flush_no"], r["pos"], r["n"]) for r in got] == [(0, i // 10, i % 10, i) for i in range(30)]
    # what was held back over the restart came back as it was
    assert all(r["big"] == (2**53 + 1 if r["n"] % 2 == 0 else None) and r["x"] == 0.1 and r["a"] == [None, 1] for r in got)
    assert all(r["at"] == dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=r["n"] * 1_000_001) for r in got)
    pending = spark.read.format("statestore").load(ckpt).select("value.*").collect()
    assert len(pending) == 1 and len(str(pending[0]).split("\"n\":")) - 1 == 2


def test_buffers_fill_apart(spark, stream_dir):
    g = _run(buffered_groups(_stream(spark, stream_dir).drop("et"), F.pmod("seq", F.lit(3)), 7, "seq"), "tm_k04")
    sizes = g.groupBy("buffer", "flush_no").count().select("count").distinct().collect()
    assert [r[0] for r in sizes] == [7]
    n = spark.read.parquet(f"{SF_SMALL}/events.parquet").groupBy(F.pmod("event_id", F.lit(3)).alias("b")).count().collect()
    n = {r["b"]: r["count"] + (r["b"] == SENTINEL_ID % 3) for r in n}
    assert {r["buffer"]: r["count"] for r in g.groupBy("buffer").count().collect()} == {b: c // 7 * 7 for b, c in n.items()}


@pytest.mark.parametrize("steps,lateness,expected", [
    # rows within [0, 10) s: two on time, then, after 12 s closed the window, one late row (fires again), another
    ([[1000, 5000], [12500], [2000], [3000, 4000], [99000]], "1 minute", [(0, 1, 2), (0, 2, 3), (0, 3, 4), (0, 4, 5), (10000, 1, 1)]),
    # too late for the window: firing 0
    ([[1000], [17000], [2000], [99000]], "3 seconds", [(0, 0, None), (0, 1, 1), (10000, 1, 1)]),
    # in order: one firing each
    ([[1000, 2000], [11000], [22500], [99000]], "1 minute", [(0, 1, 2), (10000, 1, 1), (20000, 1, 1)]),
    # a window first seen after its end, within the lateness
    ([[15000], [1000], [1500], [99000]], "1 minute", [(0, 1, 1), (0, 2, 2), (10000, 1, 1)]),
])
def test_late_rows_fire_their_window_again(spark, steps, lateness, expected):
    from tidemark.sources.text import parse_delimited, stream_lines

    base = 10**9  # Spark has no watermark before 1970
    d = _late_files(spark, [[base + m for m in x] for x in steps])
    ev = parse_delimited(stream_lines(spark, d, max_files_per_trigger=1), "user string, url string, ms bigint", trim=True)
    ev = ev.withColumn("ts", F.timestamp_millis("ms")).withColumn("seq", F.col("ms"))
    s = stateful.refired_windows(ev, "url", "10 seconds", "2 seconds", lateness)
    got = _run(s, "tm_l06_" + str(abs(hash(str(steps)))))
    rows = sorted((int(epoch_ms_py(r.window_start)) - base, r.firing, r.cnt) for r in got.collect())
    rows = [r for r in rows if r[0] < 80_000]
    assert rows == expected


def test_periodic_count_does_not_depend_on_arrival(spark):
    """Rows at 0:30 then 0:00, within the bound: ticks count from the earlier one, as in the batch form."""
    from tidemark.operators import timers

    base = 10**9
    steps = [[base + m for m in x] for x in ([30_000], [0, 95_000], [70_000], [400_000])]
    s = _late_stream(spark, _late_files(spark, steps), "2 minutes")
    got = _run(stateful.periodic_count(s, "user", "1 minute"), "tm_x03_order")
    flat = [(m,) for x in steps for m in x]
    b = spark.createDataFrame(flat, "ms bigint").select(F.lit("a").alias("user"), F.timestamp_millis("ms").cast("timestamp_ntz").alias("ts"))
    until = dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=base + 280_000)  # the last watermark
    want = timers.periodic_count(b, "user", "ts", "1 minute", until)
    assert _norm(got.select("user", "tick", "pv").collect()) == _norm(want.select("user", "tick", "pv").collect())
    assert got.count() == 4


def test_periodic_count_stream(spark, stream_dir):
    got = _run(stateful.periodic_count(_stream(spark, stream_dir), "user_id", "1 day"), "tm_x03")
    until = spark.read.parquet(f"{SF_SMALL}/events.parquet").agg(F.max("ts")).first()[0]
    got = got.filter((F.col("user_id") >= 0) & (F.col("tick") <= F.lit(until)))
    b = _batch(spark, "x03_periodic_pv")
    assert _norm(got.select("user_id", "tick", "pv").collect()) == _norm(b.select("user_id", "tick", "pv").collect())


def test_hand_made_window_stream(spark, stream_dir):
    got = _run(stateful.keyed_window_counts(_stream(spark, stream_dir), "event_type", "1 hour"), "tm_w13")
    got = got.filter(F.col("window_start") < dt.datetime(2030, 1, 1))
    b = _batch(spark, "a12_url_views")
    cols = ["event_type", "window_start", "window_end", "cnt"]
    assert _norm(got.select(cols).collect()) == _norm(b.select(cols).collect())


def test_reconcile_stream_fixture(spark):
    """F7 with a 5 s tolerance; a sentinel row far later expires the lonely payment."""
    d = tempfile.mkdtemp(prefix="tm-bill-")
    # Fixture F7 (app and third-party payments) plus a sentinel.
    steps = [["order-1,app,1000", "order-2,app,2000", "order-1,third,3000"],
             ["order-3,app,3500", "order-3,third,4000"], ["sentinel,app,99000"]]
    for i, lines in enumerate(steps):
        p = f"{d}/s{i}.txt"
        with open(p, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    from tidemark.sources.text import parse_delimited, stream_lines

    ev = parse_delimited(stream_lines(spark, d, max_files_per_trigger=1), "order_id string, src string, ms bigint", trim=False)
    ev = basic.event_time(ev.withColumn("seq", F.col("ms")), "0 seconds", ms="ms")
    got = _run(stateful.reconcile(ev, "order_id", "src", "app", "5 seconds"), "tm_j05")
    assert sorted((r.order_id, r.status) for r in got.filter("order_id != 'sentinel'").collect()) == [
        ("order-1", "matched"), ("order-2", "missing_third"), ("order-3", "matched")]


def test_processing_timer_fires(spark, stream_dir):
    """A processing-time timeout keeps batches coming, so this query runs on a
    processing-time trigger and is stopped; only row counts are reproducible."""
    s = stateful.processing_timer(_stream(spark, stream_dir), "user_id", "1 second")
    q = to_memory(s, "tm_x02", "append", checkpoint=tempfile.mkdtemp(prefix="tm-ckpt-"), trigger={"processingTime": "500 milliseconds"})
    n = spark.read.parquet(f"{SF_SMALL}/events.parquet").count() + 1
    import time

    deadline = time.time() + 120
    try:
        # processAllAvailable would wait for ever: this timeout always asks for another batch
        while time.time() < deadline:
            t = spark.table("tm_x02")
            if t.filter("kind = 'arrival'").count() == n and t.filter("kind = 'timer'").count() > 0:
                break
            time.sleep(1)
    finally:
        q.stop()
    got = spark.table("tm_x02")
    assert got.filter("kind = 'arrival'").count() == n
    assert got.filter("kind = 'timer'").count() > 0


def test_keyed_state_forms_stream(spark, stream_dir):
    got = _run(stateful.keyed_state_forms(_stream(spark, stream_dir), "user_id", "event_type"), "tm_x0x").filter("user_id >= 0")
    g = {r.seq: r for r in got.collect()}
    x4 = {r.event_id: r for r in _batch(spark, "x04_value_state_previous").collect()}
    x5 = {r.event_id: r.list_size for r in _batch(spark, "x05_list_state_size").collect()}
    x6 = {r.event_id: r.map_count for r in _batch(spark, "x06_map_state_counter").collect()}
    x7 = {r.event_id: (r.first_event_type, r.latest_ts) for r in _batch(spark, "x07_reducing_state").collect()}
    x8 = {r.event_id: r.agg for r in _batch(spark, "x08_aggregating_state").collect()}
    assert set(g) == set(x4)
    for i, r in g.items():
        assert (r.prev_event_type, r.prev_seq) == (x4[i].prev_event_type, x4[i].prev_event_id)
        assert r.list_size == x5[i] and r.map_count == x6[i] and r.agg == x8[i]
        assert (r.first_event_type, r.latest_ts.replace(tzinfo=None)) == x7[i]


def test_rule_join_stream(spark, stream_dir):
    from tidemark.plans.catalog import _rules

    got = _run(stateful.rule_join(_stream(spark, stream_dir), _rules(spark), "user_id", "event_type"), "tm_j06")
    b = _batch(spark, "j06_rule_join_all")
    cols = ["user_id", "event_type", "action1", "action2", "version"]
    assert _norm(got.select("seq", *cols).collect()) == _norm(b.select("event_id", *cols).collect())


def test_count_window_stream(spark, stream_dir):
    src = _stream(spark, stream_dir).withColumn("c", F.round(F.col("value") * 100).cast("bigint"))
    got = _run(stateful.count_window(src, "user_id", 10, 2, "c"), "tm_w04").filter("user_id >= 0")
    b = _batch(spark, "w04_count_window")
    cols = ["user_id", "fire_pos", "frame_rows", "frame_sum", "frame_first"]
    assert _norm(got.select(cols).collect()) == _norm(b.select(cols).collect())


def test_distinct_counts_stream_and_watermark(spark, stream_dir):
    s = basic.distinct_counts(_stream(spark, stream_dir), [], "et", "1 hour", "user_id")
    q = to_memory(s, "tm_a10", "append", checkpoint=tempfile.mkdtemp(prefix="tm-ckpt-"))
    q.awaitTermination()
    got = spark.table("tm_a10").filter(F.col("window_start") < dt.datetime(2030, 1, 1))
    b = _batch(spark, "a10_uv_window")
    cols = ["window_start", "window_end", "uv"]
    assert _norm(got.select(cols).collect()) == _norm(b.select(cols).collect())
    # U02 on a stream: the last watermark is the sentinel's event time (delay 0)
    sentinel = spark.read.parquet(stream_dir).agg(F.max("ts")).first()[0]
    assert basic.watermark_ms(q) == int((sentinel - dt.datetime(1970, 1, 1)).total_seconds() * 1000)


def test_distinct_counts_keep_no_set(spark, stream_dir):
    """Members are keys of the first stage; sliding windows too."""
    s = basic.distinct_counts(_stream(spark, stream_dir), ["event_type"], "et", "1 day", "user_id", "12 hours")
    got = _run(s, "tm_a11").filter(F.col("window_start") < dt.datetime(2030, 1, 1))
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet").groupBy("event_type", F.window("ts", "1 day", "12 hours").alias("w")).agg(F.countDistinct("user_id").alias("uv"))
    want = e.select("event_type", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "uv")
    assert _norm(got.select(want.columns).collect()) == _norm(want.collect())


def test_cumulate_stream(spark, stream_dir):
    from tidemark.operators import windows

    s = windows.cumulate(_stream(spark, stream_dir), ["user_id"], "et", "15 minutes", "1 hour", [F.count(F.lit(1)).alias("cnt")])
    s = s.select("user_id", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                 F.col("window_end").cast("timestamp_ntz").alias("window_end"), "cnt")
    got = _run(s, "tm_w10").filter(F.col("user_id") >= 0)
    b = _batch(spark, "w10_cumulate")
    cols = ["user_id", "window_start", "window_end", "cnt"]
    assert _norm(got.select(cols).collect()) == _norm(b.select(cols).collect())


def test_window_join_stream(spark, stream_dir):
    src = _stream(spark, stream_dir, "6 hours")
    c = src.filter(F.col("event_type") == "click").select("user_id", F.col("seq").alias("click_id"), F.col("et").alias("click_et"))
    v = src.filter(F.col("event_type") == "view").select("user_id", F.col("seq").alias("view_id"), F.col("et").alias("view_et"))
    got = _run(basic.window_join(c, v, "user_id", "click_et", "view_et", "6 hours"), "tm_j01")
    b = _batch(spark, "j01_window_join")
    cols = ["user_id", "window_start", "click_id", "view_id"]
    assert _norm(got.select(cols).collect()) == _norm(b.select(cols).collect())


def test_sql_on_a_streaming_view(spark, stream_dir):
    """A stream turned into a view with its row-time column (cut to seconds, F09)
    and a watermark, queried in SQL (the W07 group window), equals the batch query."""
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(stream_dir)
    v = raw.select(F.col("user_id").alias("user_name"), F.col("event_type").alias("url"),
                   F.timestamp_seconds(F.floor(epoch_ms("ts") / 1000)).alias("et")).withWatermark("et", "0 seconds")
    v.createOrReplaceTempView("tm_stream_clicks")
    s = spark.sql("SELECT user_name, CAST(window.end AS TIMESTAMP_NTZ) AS window_end, COUNT(1) AS cnt "
                  "FROM tm_stream_clicks GROUP BY user_name, window(et, '1 hour')")
    got = _run(s, "tm_w07_stream").filter(F.col("user_name") >= 0)
    b = _batch(spark, "w07_sql_tumble_end")
    assert _norm(got.select("user_name", "window_end", "cnt").collect()) == _norm(b.select("user_name", "window_end", "cnt").collect())


def test_unbounded_join_and_running_counts_stream(spark, stream_dir):
    src = _stream(spark, stream_dir).filter(F.col("user_id") >= 0)
    c = src.filter(F.col("event_type") == "click").select("user_id", F.col("seq").alias("click_id"))
    v = src.filter(F.col("event_type") == "view").select("user_id", F.col("seq").alias("view_id"))
    got = _run(basic.unbounded_join(c, v, "user_id"), "tm_j04s")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    bc = ev.filter("event_type = 'click'").select("user_id", F.col("event_id").alias("click_id"))
    bv = ev.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"))
    assert _norm(got.collect()) == _norm(bc.join(bv, "user_id").select(*got.columns).collect())
    counts = _run(basic.running_counts(src, ["user_id"]), "tm_a14s", "update")
    final = counts.groupBy("user_id").agg(F.max("cnt").alias("cnt"))
    b = _batch(spark, "a14_sql_group_count")
    assert _norm(final.collect()) == _norm(b.select("user_id", "cnt").collect())


def test_console_sink(spark, stream_dir):
    from tidemark.sinks.outputs import to_console

    q = to_console(_stream(spark, stream_dir).select("user_id", "event_type").filter("user_id = 1"), "clicks",
                   checkpoint=tempfile.mkdtemp(prefix="tm-ckpt-"))
    q.awaitTermination()
    assert q.lastProgress is not None


def test_streaming_word_count(spark):
    """S02 + A02: a text folder as a bounded stream, Java-style tokens, running counts in
    update mode; the last count per word equals the batch word count (fixture F1)."""
    from tidemark.functions.text import java_split
    from tidemark.operators import aggregate
    from tidemark.sources.csv import from_rows
    from tidemark.sources.text import stream_lines

    d = tempfile.mkdtemp(prefix="tm-words-")
    # The reference's input file, one line per file step.
    for i, line in enumerate(["hello word", "hello bigdata", "hello fink"]):
        p = f"{d}/w{i}.txt"
        with open(p, "w") as f:
            f.write(line + "\n")
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    words = stream_lines(spark, d, max_files_per_trigger=1).select(F.explode(java_split(F.col("value"))).alias("word"))
    got = _run(basic.running_counts(words, ["word"]), "tm_wc", "update").groupBy("word").agg(F.max("cnt").alias("cnt"))
    lines = from_rows(spark, [("hello word",), ("hello bigdata",), ("hello fink",)], "line string")
    b = aggregate.word_count(lines, "line")
    assert _norm(got.collect()) == _norm(b.select("word", "cnt").collect())


def test_cogroup_stream(spark, stream_dir):
    # the sentinel row stays in (it closes the last windows) and is dropped from the results
    src = _stream(spark, stream_dir, "6 hours").filter(F.col("event_type").isin("click", "view") | (F.col("user_id") < 0))
    src = src.withColumn("side", F.when(F.col("event_type") == "click", "left").otherwise("right"))
    members, sizes = stateful.cogroup(src, "user_id", "side", "6 hours")
    m = _run(members, "tm_j02_m").filter(F.col("user_id") >= 0)
    z = _run(sizes, "tm_j02_s").filter(F.col("user_id") >= 0)
    b = _batch(spark, "j02_cogroup")
    assert _norm(m.select("user_id", "window_start", "side", "pos", "seq", "ts").collect()) == _norm(
        b.select("user_id", "window_start", "side", "pos", "event_id", "ts").collect())
    assert _norm(z.select("user_id", "window_start", "window_end", "n_left", "n_right").collect()) == _norm(
        b.select("user_id", "window_start", "window_end", "n_left", "n_right").distinct().collect())


def test_approx_distinct_counts_stream(spark, stream_dir):
    """A10 with exact=False: approx_count_distinct per window, close to the exact count."""
    s = basic.distinct_counts(_stream(spark, stream_dir), [], "et", "1 hour", "user_id", exact=False)
    got = {r.window_start: r.uv for r in _run(s, "tm_a10_approx").collect()}
    exact = {r.window_start: r.uv for r in _batch(spark, "a10_uv_window").collect()}
    assert all(abs(got[w] - n) <= max(1, 0.1 * n) for w, n in exact.items())


@pytest.mark.parametrize("name", ["x01", "x03", "x05"])
def test_user_process_equals_batch_on_disordered_files(spark, disordered_dir, name):
    from tidemark.streaming import process

    src = _stream(spark, disordered_dir, "3650 days")
    ts = F.timestamp_micros("us").cast("timestamp_ntz")
    if name == "x01":
        r = process.process(src, "user_id", process.EventTimer(3_600_000_000), ["seq"]).select("user_id", "kind", ts.alias("at"))
        b = _batch(spark, "x01_event_timer").select("user_id", "kind", "at")
    elif name == "x03":
        r = process.process(src, "user_id", process.PeriodicCount(86_400_000_000), ["seq"]).select("user_id", ts.alias("tick"), "pv")
        b = _batch(spark, "x03_periodic_pv").select("user_id", "tick", "pv")
    else:
        r = process.process(src, "user_id", process.ListAndMap("event_type", 3), ["event_type"])
        from pyspark.sql import Window

        w = Window.partitionBy("user_id").orderBy("ts", "event_id")
        e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
        b = e.select(
            "user_id", F.array_join(F.collect_list("event_type").over(w.rowsBetween(-2, 0)), ",").alias("seen"),
            (F.row_number().over(Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id")) - 1).cast("bigint").alias("before"),
        )
    with process.store(spark):
        got = _run(r, f"tm_process_{name}").filter("user_id >= 0")
        if name == "x03":  # ticks go on until the sentinel's watermark
            until = spark.read.parquet(f"{SF_SMALL}/events.parquet").agg(F.max("ts")).first()[0]
            got = got.filter(F.col("tick") <= F.lit(until))
    assert got.count() > 0 and _norm(got.collect()) == _norm(b.select(got.columns).collect())


def test_user_process_state_survives_a_restart(spark):
    from tidemark.sources.text import parse_delimited, stream_lines
    from tidemark.streaming import process

    base = 10**9
    d, out, ckpt = (tempfile.mkdtemp(prefix=f"tm-proc-{n}-") for n in ("src", "out", "ckpt"))

    def run(step, ms_list):
        with open(f"{d}/s{step}.txt", "w") as f:
            f.write("".join(f"a, /h, {base + m}\n" for m in ms_list))
        ev = parse_delimited(stream_lines(spark, d, max_files_per_trigger=1), "user string, url string, ms bigint", trim=True)
        ev = basic.event_time(ev.withColumn("seq", F.col("ms")), "2 seconds", ms="ms")
        r = process.process(ev, "user", process.PeriodicCount(10_000_000), ["url"])
        with process.store(spark):
            q = r.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
            q.awaitTermination()

    run(0, [0, 3000, 14_000])
    run(1, [15_000, 13_000, 40_000])
    got = [(r["us"] // 1000 - base, r["pv"]) for r in spark.read.parquet(out).orderBy("us").collect()]
    assert got == [(10_000, 2), (20_000, 5), (30_000, 5)]


def test_replayed_parts_are_written_in_parallel(spark):
    """Each part is one micro-batch of as many files as tasks read the table, a part of few rows included."""
    from tidemark.streaming import replay

    df = spark.range(0, 90, 1, 4).withColumnRenamed("id", "n")
    s = replay.as_stream(df, F.when(F.col("n") < 50, 0).when(F.col("n") < 52, 1).otherwise(2), 3)
    q = s.writeStream.format("memory").queryName(f"replay_{uuid.uuid4().hex}").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [p["numInputRows"] for p in q.recentProgress] == [50, 2, 38]
    assert sorted(r.n for r in spark.table(q.name).collect()) == list(range(90))


def test_rows_that_wait_are_not_read_again():
    """While nothing of a key is due its rows are added to those waiting; due timers run in order, equal ones once."""
    import pandas as pd

    from tidemark.streaming import process

    class Fake:
        def __init__(self):
            self.v, self.reads = None, 0

        def exists(self):
            return self.v is not None

        def get(self):
            self.reads += 1
            return self.v if isinstance(self.v, tuple) else iter(self.v or [])

        def appendList(self, x):
            self.v = (self.v or []) + x

        def put(self, x):
            self.v = list(x)

        def update(self, x):
            self.v = x

        def clear(self):
            self.v = None

    class Value(Fake):
        def get(self):
            return self.v

    class Handle:
        def __init__(self):
            self.lists, self.alarms = {}, set()

        def getListState(self, n, _):
            return self.lists.setdefault(n, Fake())

        def getValueState(self, n, _):
            return self.lists.setdefault(n, Value())

        getMapState = getListState

        def registerTimer(self, t):
            self.alarms.add(t)

        def deleteTimer(self, t):
            self.alarms.discard(t)

        def listTimers(self):
            return list(self.alarms)

    class Mark:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = lambda: ms

    h, p = Handle(), process._Processor(process.EventTimer(5000), ["kind", "us"])
    p.init(h)
    batch = lambda us: iter([pd.DataFrame({"us": us, "seq": range(len(us)), "x": ["{}"] * len(us)})])
    for us in ([9000, 20000], [7000], [7000, 30000]):
        assert [x for d in p.handleInputRows(("k",), batch(us), Mark(0)) for x in d.values.tolist()] == []
    assert h.lists["_waiting"].reads == 0 and h.alarms == {7}
    got = [tuple(x) for d in p.handleInputRows(("k",), batch([13000]), Mark(15)) for x in d.values.tolist()]
    assert got == [("k", "arrival", 7000), ("k", "arrival", 7000), ("k", "arrival", 9000), ("k", "timer", 12000), ("k", "arrival", 13000), ("k", "timer", 14000)]
    assert h.alarms == {18}
    got = [tuple(x) for d in p.handleExpiredTimer(("k",), Mark(100), None) for x in d.values.tolist()]
    assert got == [("k", "timer", 18000), ("k", "arrival", 20000), ("k", "timer", 25000), ("k", "arrival", 30000), ("k", "timer", 35000)]
    assert h.alarms == set() and not h.lists["_waiting"].exists() and not h.lists["_timers"].exists()
