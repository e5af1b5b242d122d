"""Sources and sinks: text lines, delimited parsing, CSV with DDL, CSV / JDBC / multi sinks."""

import tempfile

from pyspark.sql import functions as F

from tidemark.sinks.outputs import fan_out, labelled, write_csv, write_jdbc
from tidemark.sources.csv import read_csv, register_csv_table
from tidemark.sources.text import lines_of, parse_delimited, read_lines, split_bad


def test_read_lines_and_lines_of(spark):
    d = tempfile.mkdtemp(prefix="tm-text-")
    with open(f"{d}/lines.txt", "w") as f:
        f.write("alpha beta\ngamma\ndelta epsilon\n")
    assert [r.value for r in read_lines(spark, d).collect()] == ["alpha beta", "gamma", "delta epsilon"]
    df = spark.createDataFrame([(1, "a\nb\n"), (2, "c")], "id int, text string")
    assert sorted((r.id, r.line_no, r.line) for r in lines_of(df, "text", keep=["id"]).collect()) == [
        (1, 1, "a"), (1, 2, "b"), (2, 1, "c")]


def test_parse_delimited_and_bad_rows(spark):
    lines = spark.createDataFrame([("Mary, ./home, 1000",), ("Bob,./cart,x",), ("Al,./a,5",)], "value string")
    p = parse_delimited(lines, "user string, url string, ts bigint", trim=True)
    ok, bad = split_bad(p, ["ts"])
    assert sorted(tuple(r) for r in ok.collect()) == [("Al", "./a", 5), ("Mary", "./home", 1000)]
    assert bad.count() == 1
    raw = parse_delimited(lines, "user string, url string", trim=False)
    assert sorted(r.url for r in raw.collect()) == [" ./home", "./a", "./cart"]


def test_csv_table_with_ddl_and_csv_sink(spark):
    d = tempfile.mkdtemp(prefix="tm-csv-")
    with open(f"{d}/clicks.csv", "w") as f:
        f.write("Mary,./home,1000\nBob,./cart,2000\nAlice,./prod,3000\n")
    ddl = "user_name string, url string, ts bigint"
    register_csv_table(spark, "tm_csv_clicks", d, ddl)
    out = spark.sql("SELECT user_name, url FROM tm_csv_clicks WHERE user_name = 'Alice'")
    sink = tempfile.mkdtemp(prefix="tm-csv-out-") + "/out"
    write_csv(out, sink)
    back = read_csv(spark, sink, "user_name string, url string")
    assert [tuple(r) for r in back.collect()] == [("Alice", "./prod")]


def test_jdbc_sink_in_process_derby(spark):
    """K03 against an embedded in-memory Derby database (no server, no port)."""
    url = "jdbc:derby:memory:tmclicks;create=true"
    df = spark.createDataFrame([("Mary", "./home"), ("Bob", "./cart")], "user_name string, url string")
    write_jdbc(df, url, "clicks", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}, mode="overwrite")
    back = spark.read.jdbc(url, "clicks", properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    assert sorted(tuple(r) for r in back.collect()) == [("Bob", "./cart"), ("Mary", "./home")]


def test_fan_out_routes_and_label(spark):
    seen = {}

    def keep(name):
        return lambda b, e: seen.setdefault(name, []).extend(tuple(r) for r in b.select("user").collect())

    df = spark.createDataFrame([("Mary", "Mary"), ("Bob", "Bob"), ("Al", "main")], "user string, route string")
    fan_out({"Mary": keep("Mary"), "Bob": keep("Bob"), "main": keep("main")}, route="route")(df, 0)
    assert seen == {"Mary": [("Mary",)], "Bob": [("Bob",)], "main": [("Al",)]}
    assert labelled(df, "late").columns[0] == "label"
    assert labelled(df, "late").first().label == "late"
    assert df.select(F.spark_partition_id()).count() == 3
