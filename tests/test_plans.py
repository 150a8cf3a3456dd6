"""Physical plan shape: pushdown, pruning, broadcast, exchanges, group limits."""

from tessera.plans import registry
from tests.conftest import SF_SMALL

registry.load_all()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_registered_range_scan_pushes_its_key_range(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        p = plan(registry.QUERIES["s8_range_scan_sum"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(ts,2024-01-08T00:00), LessThan(ts,2024-01-15T00:00)]" in p
    assert "event_id" not in p


def test_range_scan_grows_with_the_table(spark):
    week = "ts >= '2024-01-08' and ts < '2024-01-15'"
    rows = [spark.read.parquet(f"/root/testdata/{sf}/events.parquet").where(week).count() for sf in ("sf0.001", "sf0.01")]
    assert rows[1] > 5 * rows[0] > 0


def test_rating_lines_are_split_once(spark):
    df = registry.QUERIES["s1_read_ratings"](spark, SF_SMALL)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_lookup_join_broadcasts_checked_dim(spark):
    df = registry.QUERIES["j4_broadcast_lookup_join"](spark, SF_SMALL)
    assert "BroadcastHashJoin" in plan(df)


def test_copartitioned_join_has_two_exchanges(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = registry.QUERIES["j10_copartitioned_join"](spark, SF_SMALL)
        p = plan(df)
        assert p.count("Exchange hashpartitioning") == 2, p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_k_uses_group_limit(spark):
    df = registry.QUERIES["a6_top_k_per_key"](spark, SF_SMALL)
    assert "WindowGroupLimit" in plan(df)


def test_predict_stays_in_codegen(spark):
    df = registry.QUERIES["r3_predict"](spark, SF_SMALL)
    p = plan(df)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_no_registered_query_plans_a_cross_join(spark):
    bad = {}
    for name, fn in sorted(registry.QUERIES.items()):
        p = plan(fn(spark, SF_SMALL))
        hits = [op for op in ("CartesianProduct", "BroadcastNestedLoopJoin") if op in p]
        if hits:
            bad[name] = hits
    assert bad == {}


def test_bounded_grouping_numbers_ranges_in_the_jvm(spark):
    for name in ("a10_collect_groups", "j2_cogroup_lists", "l3_auc_roc"):
        p = plan(registry.QUERIES[name](spark, SF_SMALL))
        assert "Python" not in p and "Pandas" not in p, name
        assert "_range" in p, name


def test_pair_views_read_their_rows_once(spark):
    p = plan(registry.QUERIES["s7_read_similarity"](spark, SF_SMALL))
    assert "lineitem.parquet" not in p   # both sides of the self-join read the stored order parts


def test_predict_reads_its_ratings_once(spark):
    """One scan of line items, in the job that stores the ratings: the plan reads stored tables only."""
    for name in ("r3_predict", "a5_sum_pair_per_key", "m7_preference_scores"):
        p = plan(registry.QUERIES[name](spark, SF_SMALL))
        assert "lineitem.parquet" not in p and "orders.parquet" not in p, name


def test_bucketed_join_has_no_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = registry.QUERIES["j10_bucketed_join"](spark, SF_SMALL)
        p = plan(df)
        assert "Exchange" not in p and "SortMergeJoin" in p, p
        want = registry.QUERIES["j10_copartitioned_join"](spark, SF_SMALL)
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, want.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bins_are_found_without_interpreted_lambdas(spark):
    for name in ("x4_assign_upper", "x5_discretize"):
        p = registry.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "lambda" not in p, name


def test_pairs_are_not_shuffled_again_for_their_sum(spark):
    p = plan(registry.QUERIES["t2_recent_pair_count"](spark, SF_SMALL))
    assert p.count("Exchange hashpartitioning(item_i") == 1, p
