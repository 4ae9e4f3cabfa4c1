"""The physical plans are the ones meant: filters at the scan, limits before shuffles, no Python."""

import re

import pytest

from lakeworks.catalog import QUERIES
from lakeworks.operators import windows
from lakeworks.sources.layout import plan_text


def plan(spark, sf, name):
    return plan_text(QUERIES[name](spark, sf), "formatted")


@pytest.mark.parametrize("name,filter_text,schema", [
    ("monthly_status_rollup", "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)",
     "struct<o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz>"),
    ("month_total", "LessThan(o_orderdate,1998-02-01T00:00)", "struct<o_totalprice:double,o_orderdate:timestamp_ntz>"),
    ("recent_kpis", "GreaterThanOrEqual(o_orderdate,2001-07-02T00:00)", "struct<o_totalprice:double,o_orderdate:timestamp_ntz>"),
    ("daily_trip_revenue", "LessThan(l_shipdate,1998-01-08T00:00)", None),
    ("category_weekly", "EqualTo(p_type,PROMO)", None),
    ("star_join_codes", "In(l_linenumber, [2,3])", None)])
def test_filters_and_columns_reach_the_scan(spark, sf, name, filter_text, schema):
    text = plan(spark, sf, name)
    assert filter_text in text
    if schema:
        assert f"ReadSchema: {schema}" in text


@pytest.mark.parametrize("name", ["top_n_per_month", "keep_latest", "dedup", "topk_cosine_batch"])
def test_rank_filters_limit_groups_before_the_shuffle(spark, sf, name):
    assert plan(spark, sf, name).count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", ["order_totals", "top_zones", "topk_cosine", "sample_rows"])
def test_top_k_is_taken_per_task(spark, sf, name):
    assert "TakeOrderedAndProject" in plan(spark, sf, name)


def test_not_exists_is_an_anti_join(spark, sf):
    assert "LeftAnti" in plan(spark, sf, "orders_without_items")


@pytest.mark.parametrize("name", sorted(
    set(QUERIES) - {"embed_chunks", "retrieve_chunks", "sensor_log_index", "topk_cosine_batch", "footer_report", "footer_rows",
                    "topk_ann", "topk_ann_batch"} if QUERIES else []))
def test_no_cross_join_and_no_python(spark, sf, name):
    if name.startswith(("stream_", "version", "stage_lock", "materialised_", "multi_", "event_run", "raw_to", "reconcile_run")):
        pytest.skip("runs jobs of its own; its parts are covered")
    text = plan(spark, sf, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text


def test_only_the_dimension_literals_are_hinted_for_broadcast(spark, sf):
    text = plan(spark, sf, "star_join_all")
    assert text.count("LocalTableScan") >= 2 and "BroadcastHashJoin" in text


def test_a_hot_user_is_cut_into_chunks(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    text = plan_text(windows.previous_event(events, "user_id", "ts", "event_id"), "simple")
    # The events are dealt out by user and hour, once; the other exchanges carry a row per user and hour.
    assert re.match(r"user_id#\d+L, _b#\d+L, \d+\)", text.split("Window [lag(ts")[1].split("hashpartitioning(")[1])
    assert text.count("FileScan") <= 2


def joins_and_exchanges(text, join):
    """Exchanges below the first join of the kind."""
    return text.split(join, 1)[1].count("Exchange")


def test_tables_bucketed_alike_join_without_a_shuffle(spark, sf):
    text = plan_text(QUERIES["bucketed_join"](spark, sf), "simple")
    assert "SortMergeJoin" in text and joins_and_exchanges(text, "SortMergeJoin") == 0
    assert text.count("Bucketed: true") == 2


def test_months_are_pruned_by_the_dimension_at_run_time(spark, sf):
    text = plan_text(QUERIES["quarter_total"](spark, sf), "formatted")
    assert "dynamicpruning" in text.lower()


def test_unique_columns_shuffle_suspects_only(spark, sf):
    lines = plan_text(QUERIES["unique_columns"](spark, sf), "simple").splitlines()
    at = next(i for i, line in enumerate(lines) if "Union" in line)
    depth = lines[at].index("Union")
    # The first branch has the rows that the filter lets through, the second all others, straight from the scan.
    second = next(i for i in range(at + 1, len(lines)) if lines[i][depth:depth + 3] == "+- ")
    clear = [line for i, line in enumerate(lines) if i == second or i > second and line[:depth + 3].isspace()]
    assert any("FileScan" in line for line in clear) and not any("Exchange" in line or "Join" in line for line in clear[:3])
    assert any("Exchange" in line for line in lines[at:second])


def test_the_default_embedding_and_sketches_run_without_python(spark, sf):
    for name in ("embed_ngrams", "sensor_log_index", "weekly_active_users", "monthly_medians"):
        assert "Python" not in plan(spark, sf, name) and "Pandas" not in plan(spark, sf, name)


def test_runs_form_no_pairs(spark, sf):
    for name in ("match_runs", "run_report", "recon_rules_of_runs"):
        text = plan_text(QUERIES[name](spark, sf), "simple")
        assert "_slot" not in text and "NestedLoop" not in text and "Cartesian" not in text


@pytest.mark.parametrize("name", ["topk_cosine_batch", "retrieve_chunks"])
def test_batch_search_joins_cells_and_pairs_no_blocks(spark, sf, name):
    text = plan(spark, sf, name)
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "cell" in text


def test_texts_are_split_once_and_embedded_once(spark, sf):
    text = plan_text(QUERIES["embed_ngrams"](spark, sf), "simple")
    # Once into words and once into characters; an inferred size filter or a word list named per chunk repeats them.
    assert text.count("split(") == 2 and "size(transform" not in text
