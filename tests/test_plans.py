"""Plan properties that matter at scale, read from ``explain`` output."""

import contextlib
import io
import re

import pytest
from conftest import SF_SMALL

from tidemark.plans.catalog import CATALOG

Q = {name: fn for name, (fn, _) in CATALOG.items()}

# Single-partition steps that only ever see bounded input: the final merge of one partial
# aggregate row per task (A07), and the per-slice table of an un-keyed scan.
BOUNDED_SINGLE = {"a07_most_active", "u02_watermark_trace"}


def plan(spark, name, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        Q[name](spark, SF_SMALL).explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(Q) - BOUNDED_SINGLE))
def test_no_single_partition_exchange(spark, name):
    assert "SinglePartition" not in plan(spark, name, "simple")


@pytest.mark.parametrize("name", ["t01_topn_sliding", "t02_topn_window_all", "w12_row_number", "t04_sql_window_topn"])
def test_top_n_limits_before_the_shuffle(spark, name):
    p = plan(spark, name)
    assert "WindowGroupLimit" in p and "Partial" in p


def test_interval_join_on_key_and_slot(spark):
    p = plan(spark, "j03_interval_join", "simple")
    assert "_slot" in p and ("SortMergeJoin" in p or "BroadcastHashJoin" in p)
    assert "EqualTo(event_type,purchase)" in p and "EqualTo(event_type,view)" in p


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(spark, "p05_filter")
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in p
    a = plan(spark, "a12_url_views")
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in a


def test_keyed_scans_partition_by_key_and_slice(spark):
    for name in ["c01_three_fails", "a15_avg_of_5", "c03_followed_by_within", "j05_reconcile_sliced"]:
        p = plan(spark, name, "simple")
        assert "hashpartitioning(_tm_kv" in p, name
        # no shuffle by the user alone (that would put a hot user's rows in one task)
        assert not re.search(r"hashpartitioning\(user_id#\d+L?, \d+\)", p), name


def test_aggregates_are_partial_before_the_shuffle(spark):
    for name in ["a12_url_views", "w03_session", "a01_word_count", "a10_uv_window"]:
        p = plan(spark, name)
        assert p.count("HashAggregate") >= 2, name
    assert "MergingSessions" in plan(spark, "w03_session")
