"""Operators that split a hot key or window, against plain windows, with nulls, ties and hot keys."""

import contextlib
import io
import random

import pytest
from conftest import SF_SMALL
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.operators import joins, keyed, patterns, topn, user_aggregate, windows
from tidemark.plans.catalog import CATALOG


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    out = []
    for i in range(3000):
        key = rng.choice(["hot", "hot", "hot", None, *"abcdef"])
        sec = rng.choice([rng.randint(0, 40_000), rng.randint(0, 200) * 60])
        out.append((key, None if rng.random() < 0.01 else sec, i, rng.choice(["error", "purchase", "view", None]), rng.randint(-5, 5)))
    d = spark.createDataFrame(out, "k string, sec bigint, id bigint, t string, v bigint")
    return d.withColumn("ts", F.timestamp_seconds("sec").cast("timestamp_ntz")).drop("sec").persist()


def bag(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


AGGS = {"n": ("count", None), "total": ("sum", "v"), "least": ("min", "v"), "most": ("max", "id")}


def plain_aggs():
    return [F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"), F.min("v").alias("least"), F.max("id").alias("most")]


@pytest.mark.parametrize("gap", ["7 seconds", "60 seconds", "10 minutes", "3 hours"])
@pytest.mark.parametrize("split", ["hot", "time", "minute", "one"])
def test_sessions_over_slices(rows, gap, split):
    cut = {
        "hot": lambda: keyed.hot_split(rows, "k", "ts", 50), "time": lambda: keyed.time_split(rows, "ts"),
        "minute": lambda: F.date_trunc("minute", "ts"), "one": lambda: F.lit(0),
    }[split]()
    want = windows.session_agg(rows, ["k"], "ts", gap, AGGS)
    assert bag(windows.session_agg(rows, ["k"], "ts", gap, AGGS, cut)) == bag(want)
    lag = F.lag("ts").over(Window.partitionBy("k").orderBy("ts", "id"))
    d = rows.filter("ts is not null").withColumn("b", F.when(F.col("ts") <= lag + F.expr(f"INTERVAL {gap}"), 0).otherwise(1))
    d = d.withColumn("s", F.sum("b").over(Window.partitionBy("k").orderBy("ts", "id")))
    plain = d.groupBy("k", "s").agg(F.min("ts").alias("a"), (F.max("ts") + F.expr(f"INTERVAL {gap}")).alias("z"), *plain_aggs()).drop("s")
    assert bag(plain) == bag(want)


def test_a_hot_key_has_sessions_in_many_tasks(spark):
    d = spark.range(4000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 30).cast("timestamp_ntz").alias("ts"))
    part = d.groupBy("k", keyed.hot_split(d, "k", "ts", 100).alias("_sl"), windows.session("ts", "20 seconds")).count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = part.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tasks > 4
    whole = windows.session_agg(d, ["k"], "ts", "30 seconds", {"n": ("count", None)}, keyed.hot_split(d, "k", "ts", 100)).collect()
    assert [r["n"] for r in whole] == [4000]  # one session over all slices


@pytest.mark.parametrize("step,size", [("15 minutes", "1 hour"), ("1 minute", "10 minutes"), ("1 hour", "1 hour")])
def test_panes_equal_exploded_windows(rows, step, size):
    got = windows.cumulate(rows, ["k"], "ts", step, size, AGGS)
    want = windows.cumulate(rows, ["k"], "ts", step, size, plain_aggs())
    assert got.columns == want.columns and bag(got) == bag(want)


def test_panes_explode_no_input_rows(spark):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        CATALOG["w10_cumulate"][0](spark, SF_SMALL).explain("simple")
    lines = buf.getvalue().split("\n")
    generate = next(i for i, x in enumerate(lines) if "Generate" in x)
    assert any("HashAggregate" in x for x in lines[generate:]) and not any("Generate" in x for x in lines[generate + 1 :])


@pytest.mark.parametrize("hot", [1, 10, 10**6])
@pytest.mark.parametrize("key", ["k", "id", "t"])
def test_rank_by_count(rows, key, hot):
    c = rows.filter(F.col(key).isNotNull()).groupBy(F.window("ts", "1 hour").alias("w"), key).agg(F.count(F.lit(1)).alias("cnt"))
    c = c.select(F.col("w.start").alias("s"), F.col("w.end").alias("e"), key, "cnt")
    want = topn.rank_within(c, ["s", "e"], [F.col("cnt").desc(), F.col(key)])
    assert bag(topn.rank_by_count(c, ["s", "e"], "cnt", key, hot)) == bag(want)


def test_ranking_cuts_one_window(spark):
    d = spark.range(5000).select("id", F.lit(0).alias("w"), F.lit(1).cast("bigint").alias("cnt"))
    cut = keyed.value_split(d, "id")
    assert d.select(cut.alias("s")).distinct().count() > 20
    for c in (F.col("id").cast("string"), F.concat(F.lit("é"), F.hex("id")), F.timestamp_seconds("id").cast("timestamp_ntz"), -F.col("id")):
        x = d.withColumn("id", c)
        x = x.withColumn("s", keyed.value_split(x, "id"))
        w = Window.orderBy("id")
        assert x.withColumn("p", F.lag("s").over(w)).filter("s < p").count() == 0 and x.select("s").distinct().count() > 5


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("batch", [3, 10_000])
def test_state_machine_against_a_loop(spark, rows, seed, batch):
    rng = random.Random(seed)
    states = rng.choice([1, 2, 3, 7, 15])
    nxt = [[rng.randrange(states) for _ in range(states)] for _ in range(4)]
    out = [[rng.random() < 0.5 for _ in range(states)] for _ in range(4)]
    sym = F.when(F.col("t") == "error", 0).when(F.col("t") == "purchase", 1).when(F.col("t") == "view", 2)
    start, unknown = rng.randrange(states), rng.choice([None, 0, 3])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        cut = keyed.hot_split(rows, "k", "ts", 30)
        got = {r["id"]: (r["state_before"], r["state_after"], r["alert"]) for r in patterns.state_machine(rows, ["k"], ["ts", "id"], cut, sym, nxt, out, start, unknown).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    now, want = {}, {}
    code = {"error": 0, "purchase": 1, "view": 2, None: 3 if unknown is None else unknown}
    for r in sorted(rows.collect(), key=lambda r: (r["ts"] is not None, r["ts"], r["id"])):
        s = now.get(r["k"], start)
        e = nxt[code[r["t"]]][s]
        want[r["id"]] = (s, e, out[code[r["t"]]][s])
        now[r["k"]] = e
    assert got == want


def test_state_machine_has_few_windows(spark):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        CATALOG["c04_state_machine_sliced"][0](spark, SF_SMALL).explain("simple")
    assert buf.getvalue().count("Window ") == 0
    with pytest.raises(ValueError):
        patterns.state_machine(spark.range(1), ["id"], ["id"], F.lit(0), F.lit(0), [[0] * 16], [[False] * 16])


def spread_of():
    class Spread(user_aggregate.UserAggregate):
        acc = "lo bigint, hi bigint, n bigint"
        out = "spread bigint, n bigint"

        def init(self):
            return None, None, 0

        def add(self, acc, rows):
            return self.merge(acc, (min(v := rows.column(0).drop_null().to_pylist(), default=None), max(v, default=None), rows.num_rows))

        def merge(self, a, b):
            both = [[x for x in (a[i], b[i]) if x is not None] for i in (0, 1)]
            return min(both[0], default=None), max(both[1], default=None), a[2] + b[2]

        def finish(self, acc):
            return None if acc[0] is None else acc[1] - acc[0], acc[2]

    return Spread()


@pytest.mark.parametrize("most,spread", [(1, 1), (2, 3), (100_000, 64)])
def test_user_aggregate(rows, most, spread):
    d = rows.repartition(7).withColumn("big", (F.lit(2**53) + F.when(F.col("v") > 0, F.col("id"))).cast("bigint"))
    got = user_aggregate.aggregate(d, ["k", "t"], spread_of(), ["big"], most, spread)
    want = d.groupBy("k", "t").agg((F.max("big") - F.min("big")).alias("spread"), F.count(F.lit(1)).alias("n"))
    assert got.columns == want.columns and bag(got) == bag(want)


def test_user_aggregate_keeps_exact_and_null_keys_and_is_partial(spark):
    schema = StructType([StructField("k", LongType()), StructField("s", StringType()), StructField("v", LongType())])
    d = spark.createDataFrame([(2**53 + 1, "x", 1), (None, "x", 2), (2**53, None, 3), (2**53 + 1, "x", 4)], schema)
    got = {(r["k"], r["s"]): r["m"] for r in user_aggregate.aggregate(d, ["k", "s"], user_aggregate.MeanOf("v", "m"), ["v"]).collect()}
    assert got == {(2**53 + 1, "x"): 2, (None, "x"): 2, (2**53, None): 3}
    assert user_aggregate.aggregate(d.limit(0), ["k"], user_aggregate.MeanOf("v", "m"), ["v"]).count() == 0
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        CATALOG["g04_user_window_mean"][0](spark, SF_SMALL).explain("simple")
    p = buf.getvalue()
    assert p.rindex("Exchange") < p.rindex("MapInArrow")  # the partial stage stands before the first shuffle


def test_reconcile_keeps_large_and_null_keys(spark):
    big = 2**53
    app = spark.createDataFrame([(big + 1, 1, 10), (big, 2, 10), (None, 3, 10), (None, None, 11)], "k bigint, s bigint, id bigint")
    third = spark.createDataFrame([(big + 1, 4, 20), (None, 5, 21)], "k bigint, s bigint, id bigint")
    at = lambda d, n: d.select("k", F.timestamp_seconds("s").cast("timestamp_ntz").alias(f"{n}_ts"), F.col("id").alias(f"{n}_id"))
    for hot in (None, 1):
        got = joins.reconcile(at(app, "a"), at(third, "t"), "k", "a_ts", "a_id", "t_ts", "t_id", "5 seconds", hot_rows=hot)
        assert sorted(((r["k"], r["a_id"], r["t_id"], r["status"]) for r in got.collect()), key=str) == sorted(
            [(big + 1, 10, 20, "matched"), (big, 10, None, "missing_third"), (None, 10, 21, "matched"), (None, 11, None, "missing_third")], key=str)


def test_reconcile_of_hot_keys(rows):
    """Hot keys cut at pauses, against pairing every key in one pass."""
    a, b = rows.filter("v < 0").select("k", F.col("ts").alias("a_ts"), F.col("id").alias("a_id")), rows.filter("v >= 0").select("k", F.col("ts").alias("t_ts"), F.col("id").alias("t_id"))
    for tol in ("5 seconds", "2 minutes"):
        one = joins.reconcile(a, b, "k", "a_ts", "a_id", "t_ts", "t_id", tol, hot_rows=10**9)
        assert bag(joins.reconcile(a, b, "k", "a_ts", "a_id", "t_ts", "t_id", tol, hot_rows=5)) == bag(one)


def test_user_cogroup(spark, rows):
    """Both sides of every key in order and in chunks, unread chunks passed over."""
    a = rows.filter("v < 0").select("k", "ts", "id")
    b = rows.filter("v >= 1").select("k", F.col("ts").alias("ts"), F.col("id").alias("id"), (F.lit(2**53) + F.col("id")).alias("big"))

    def listed(key, sizes, chunks):
        import pyarrow as pa

        ids, most = {"left": [], "right": []}, 0
        for side, r in chunks:
            most = max(most, r.num_rows)
            ids[side] += r.column(r.schema.get_field_index("big" if side == "right" else "id")).to_pylist()
            if key[0] == "a":
                break  # the rest is left unread
        yield pa.RecordBatch.from_pylist([{"k": key[0], "n_left": sizes[0], "n_right": sizes[1], "l": ids["left"], "r": ids["right"], "most": most}])

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = joins.cogroup_apply(a, b, ["k"], ["ts", "id"], listed, "k string, n_left bigint, n_right bigint, l array<bigint>, r array<bigint>, most bigint").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    order = lambda r: (r["ts"] is not None, r["ts"], r["id"])
    want = {}
    for side, d in (("l", a), ("r", b)):
        for r in sorted(d.collect(), key=order):
            want.setdefault(r["k"], {"l": [], "r": []})[side].append(r["id"] if side == "l" else r["big"])
    assert {r["k"] for r in got} == set(want) and len(got) == len(want)
    for r in got:
        w = want[r["k"]]
        assert (r["n_left"], r["n_right"]) == (len(w["l"]), len(w["r"])) and r["most"] <= 100
        if r["k"] != "a":
            assert (r["l"], r["r"]) == (w["l"], w["r"])


def test_user_cogroup_reads_each_side_once(spark):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        CATALOG["g12_user_cogroup"][0](spark, SF_SMALL).explain("simple")
    p = buf.getvalue()
    assert p.count("FileScan") == 2 and p.count("Exchange") == 1


def test_latest_rule_of_equal_versions(spark):
    acts = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("a", "z", 3)], "k string, act string, seq bigint")
    for rules in ([("y", "z", 1), ("x", "y", 1)], [("x", "y", 1), ("y", "z", 1)]):
        r = spark.createDataFrame(rules, "action1 string, action2 string, version int")
        assert [x["seq"] for x in joins.rule_join(acts, r, "k", ["seq"], F.lit(0), "act", "latest").collect()] == [2]


def test_counts_carry_their_keys_once(spark):
    """The rows of a running count are shuffled with their keys in one column, and come back as they were."""
    rows = [("a", 1, 5), (None, 2, 6), ("a", 2, 7), ("b", 2, 8), (None, 3, 9), ("a", 2, 7)]
    df = spark.createDataFrame(rows, "word string, at int, x int")
    d = keyed.row_number(df, ["word"], ["at"], F.col("at"), "cnt")
    assert d.columns == ["word", "at", "x", "cnt"]
    got = sorted(d.collect(), key=str)
    assert got == sorted([("a", 1, 5, 1), ("a", 2, 7, 2), ("a", 2, 7, 3), ("b", 2, 8, 1), (None, 2, 6, 1), (None, 3, 9, 2)], key=str)
    window = next(x for x in d._jdf.queryExecution().optimizedPlan().toString().split("Window [")[1:] if "_i_cnt" in x)
    assert "word" not in window.split("Project [")[1].split("struct(")[0]


def test_only_frequent_words_are_sliced(spark, tmp_path):
    """The table of slices of a02 has a row per word, and a few for words in a large part of the rows."""
    docs = [(i, "the " * 40 + f"w{i % 150} v{i % 150}\nthe") for i in range(300)] + [(None, "the x"), (7, "")]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    d = CATALOG["a02_running_word_count"][0](spark, str(tmp_path))
    rows = d.collect()
    assert len(rows) == 300 * 43 + 3 and len(set(rows)) == len(rows)
    by_word: dict = {}
    for r in sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.line_no, r.pos)):
        by_word[r.word] = by_word.get(r.word, 0) + 1
        assert r.cnt == by_word[r.word]
    assert "_tm_slice, CASE WHEN" in d._jdf.queryExecution().optimizedPlan().toString()
