"""Physical plans: what is pushed down, how often data is shuffled, which join is chosen."""

import pytest
from pyspark.sql import functions as F

from sparkloom.functions import udfs
from sparkloom.operators import aggregates, joins
from sparkloom.plans.explain import exchange_count, operator_count, plan_text
from sparkloom.registry import queries, table
from sparkloom.sources import writers


@pytest.fixture
def no_auto_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_parquet_scan_reads_only_what_it_needs(spark, sf_dir):
    text = plan_text(queries()["src_parquet"](spark, sf_dir), "formatted")
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in text
    assert "GreaterThanOrEqual(l_quantity,45.0)" in text and "IsNotNull(l_quantity)" in text
    assert "Batched: true" in text


@pytest.mark.parametrize("key", ["filter_year_month", "filter_ts_between"])
def test_time_filters_reach_the_scan(spark, sf_dir, key):
    text = plan_text(queries()[key](spark, sf_dir), "formatted")
    assert "GreaterThanOrEqual" in text.split("PushedFilters")[1].split("ReadSchema")[0]


def test_wrapped_filter_is_not_pushed(spark, sf_dir):
    text = plan_text(table(spark, sf_dir, "orders").filter(F.lower("o_orderstatus") == "f"), "formatted")
    assert "EqualTo" not in text


def test_json_scan_is_row_based(spark, sf_dir, out):
    table(spark, sf_dir, "nation").write.json(out)
    text = plan_text(spark.read.json(out).select("n_name"), "formatted")
    assert "ReadSchema: struct<n_name:string>" in text and "Batched: false" in text


def test_partition_filter(spark, sf_dir, out):
    writers.write_partitioned(table(spark, sf_dir, "orders"), out, ["o_orderstatus"])
    text = plan_text(spark.read.parquet(out).filter("o_orderstatus = 'F'"), "formatted")
    assert "PartitionFilters: [isnotnull(o_orderstatus" in text


def test_four_filter_notations_give_one_plan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    forms = [orders.filter(p) for p in (orders.o_totalprice > 5, F.col("o_totalprice") > 5, "o_totalprice > 5",
                                        F.expr("o_totalprice > 5"))]
    assert all(forms[0].sameSemantics(f) for f in forms[1:])


def test_useless_casts_go_and_needed_ones_stay(spark):
    assert "cast" not in plan_text(spark.range(5).select(F.col("id").cast("long").alias("x")))
    assert plan_text(spark.range(5).select(F.col("id").cast("int").cast("long").alias("x"))).count("cast") == 2


def test_constants_are_folded_and_filters_combined(spark, sf_dir):
    assert "6" in plan_text(spark.range(1).select((F.lit(1) + 2 + 3).alias("six")))
    df = (table(spark, sf_dir, "orders").filter("o_totalprice > 5").select("o_orderkey", "o_totalprice")
          .filter("o_orderkey > 7"))
    assert operator_count(df, "Filter") == 1


def test_group_count_has_partial_and_final_step(spark, sf_dir):
    df = queries()["agg_group_count"](spark, sf_dir)
    assert exchange_count(df) == 1 and plan_text(df).count("partial_count") == 1


def test_salted_count_has_two_shuffles(spark, sf_dir):
    assert exchange_count(queries()["agg_salted"](spark, sf_dir)) == 2


def test_global_count_has_no_window(spark, sf_dir):
    text = plan_text(queries()["win_global_count"](spark, sf_dir))
    assert "Window" not in text and "Subquery" in text
    assert "Window" not in plan_text(queries()["win_percent"](spark, sf_dir))


@pytest.mark.parametrize("key", ["join_self_agg", "win_percent", "win_group_row_number", "win_row_number"])
def test_rows_are_not_shuffled_for_a_small_aggregate(spark, sf_dir, key):
    df = queries()[key](spark, sf_dir)
    assert "BroadcastHashJoin" in plan_text(df) and operator_count(df, "Exchange hashpartitioning") <= 1


def test_join_choices(spark, sf_dir, no_auto_broadcast):
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    on = F.col("s_nationkey") == F.col("n_nationkey")
    assert "SortMergeJoin" in plan_text(supplier.join(nation, on))
    assert "BroadcastHashJoin" in plan_text(queries()["join_broadcast"](spark, sf_dir))
    assert "isnotnull(s_nationkey" in plan_text(queries()["join_broadcast"](spark, sf_dir))
    assert "ShuffledHashJoin" in plan_text(joins.shuffle_hash_join(supplier, nation, on))
    assert "SortMergeJoin" in plan_text(joins.sort_merge_join(supplier, nation, on))
    assert "BroadcastNestedLoopJoin" in plan_text(queries()["join_theta"](spark, sf_dir))
    assert "CartesianProduct" in plan_text(queries()["join_cartesian"](spark, sf_dir))
    left, right = spark.range(5).toDF("k"), spark.range(5).withColumnRenamed("id", "k").withColumn("r", F.lit(1))
    assert "SortMergeJoin" in plan_text(joins.null_safe_join(left, right, ["k"]))


def test_udf_predicate_is_a_nested_loop(spark, no_auto_broadcast):
    same = F.udf(lambda a, b: a == b, "boolean")
    left, right = spark.range(3).toDF("a"), spark.range(3).toDF("b")
    text = plan_text(left.join(right, same("a", "b")))
    assert "SortMergeJoin" not in text and ("CartesianProduct" in text or "BroadcastNestedLoopJoin" in text)


def test_one_shared_shuffle_of_the_rows(spark, sf_dir, no_auto_broadcast):
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber")
    once = lines.repartition(10, "l_suppkey")
    counts = once.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    text = plan_text(once.join(counts, "l_suppkey"))
    assert text.count("REPARTITION_BY_NUM") >= 1 and "ENSURE_REQUIREMENTS" not in text
    assert "ENSURE_REQUIREMENTS" not in plan_text(joins.prepartitioned_self_agg(lines, "l_suppkey", 10))
    assert "ENSURE_REQUIREMENTS" not in plan_text(joins.prepartitioned_self_agg(lines, "l_suppkey", 10, ["l_orderkey"], 10**6))
    salted = joins.prepartitioned_self_agg(lines, "l_suppkey", 10, ["l_orderkey"], hot_rows=100)
    shuffles = [l for l in plan_text(salted).splitlines() if "Exchange hashpartitioning" in l]
    # The rows move by the explicit repartitioning only; the other two shuffles move counts, and the
    # list of hot keys is broadcast.
    assert len([l for l in shuffles if "REPARTITION_BY_NUM" not in l]) == 2


def test_repartition_then_sort(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        one = spark.range(0, 100, 1, 3).repartition(1).orderBy("id")
        two = spark.range(0, 100, 1, 3).repartition(2).orderBy("id")
        assert "rangepartitioning" not in plan_text(one) and "rangepartitioning" in plan_text(two)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert exchange_count(spark.range(9).sortWithinPartitions("id")) == 0


def test_topk_is_one_operator(spark, sf_dir):
    for key in ("topk", "limit_ordered", "agg_max_topk"):
        assert "TakeOrderedAndProject" in plan_text(queries()[key](spark, sf_dir))


def test_struct_udf_runs_once(spark, sf_dir):
    text = plan_text(queries()["udf_struct"](spark, sf_dir))
    assert text.count("ArrowEvalPython [") == 1 and text.count("powers(") <= 2


def test_letter_count_combines_before_the_shuffle(spark, sf_dir):
    text = plan_text(aggregates.letter_counts(table(spark, sf_dir, "documents"), "text"))
    assert exchange_count(aggregates.letter_counts(table(spark, sf_dir, "documents"), "text")) == 1
    assert "partial_count" in text


def test_interval_join_is_hashed_on_time_buckets(spark, sf_dir):
    text = plan_text(queries()["interval_join"](spark, sf_dir))
    assert "__bucket" in text and "NestedLoop" not in text and "Cartesian" not in text


def test_coalesce_adds_no_shuffle(spark):
    df = spark.range(0, 100, 1, 8)
    assert exchange_count(df.coalesce(1)) == 0 and exchange_count(df.repartition(1)) == 1


def test_dedup_uses_no_window(spark, sf_dir):
    text = plan_text(queries()["dedup_keys"](spark, sf_dir))
    assert "Window" not in text and "partial_min_by" in text


@pytest.mark.parametrize("key", ["udf_plus_one", "udf_safe_divide", "udf_null_guard", "udf_struct"])
def test_udfs_use_arrow(spark, sf_dir, key):
    text = plan_text(queries()[key](spark, sf_dir))
    assert "ArrowEvalPython" in text and "BatchEvalPython" not in text
    assert udfs.plus_one is not None


def test_json_lines_are_parsed_once(spark, sf_dir):
    assert plan_text(queries()["clean_records"](spark, sf_dir)).count("from_json(") == 1


def test_record_lines_are_split_once(spark, sf_dir):
    text = plan_text(queries()["parse_records"](spark, sf_dir))
    assert text.count("split(") == 1
