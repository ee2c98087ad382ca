import datetime as dt
import json
import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom import scratch
from sparkloom.functions import schema as schemas
from sparkloom.functions import timestamps, udfs
from sparkloom.operators import aggregates, clean, joins, layout, positions
from sparkloom.registry import table

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- cleaning: the golden results of the city example ------------------------------------------

# The input lines and results of the published example.
CITY_LINES = """{ "name": "Moscow", "country": "Rossiya", "continent": "Europe", "population": 12380664 }
{ "name": "Madrid", "country": "Spain" }
{ "name": "Paris", "country": "France", "continent": "Europe", "population": 2196936 }
{ "name": "Berlin", "country": "Germany", "continent": "Europe", "population": 3490105 }
{ "name": "Barselona", "country": "Spain", "continent": "Europe" }
{ "name": "Cairo", "country": "Egypt", "continent": "Africa", "population": 11922948 }
{ "name": "Cairo", "country": "Egypt", "continent": "Africa", "population": 11922948 }
{ "name": "New York", "country": "USA","""


def clean_cities(spark):
    blocks = spark.createDataFrame([(CITY_LINES,)], "block string")
    schema = T.StructType.fromDDL("continent string, country string, name string, population bigint")
    rows = clean.parse_json_blocks(blocks, "block", schema)
    assert rows.count() == 8 and rows.filter("_corrupt_record is not null").count() == 1
    rows = clean.keep_well_formed(rows).na.drop("all")
    rows = rows.na.fill({"continent": "Undefined", "population": 0}).na.replace({"Rossiya": "Russia"}, subset=["country"])
    return clean.dedup_first(rows, ["continent", "country"], ["name", "population"])


def test_clean_cities_golden(spark):
    assert tuples(clean_cities(spark)) == [
        ("Africa", "Egypt", "Cairo", 11922948), ("Europe", "France", "Paris", 2196936),
        ("Europe", "Germany", "Berlin", 3490105), ("Europe", "Russia", "Moscow", 12380664),
        ("Europe", "Spain", "Barselona", 0), ("Undefined", "Spain", "Madrid", 0)]


def test_pivot_golden(spark):
    # The published result of the pivot.
    wide = aggregates.pivot_sum(clean_cities(spark), "country", "continent", F.col("population"))
    assert wide.columns == ["country", "Africa", "Europe", "Undefined"]
    assert tuples(wide) == [
        ("Egypt", 11922948, None, None), ("France", None, 2196936, None), ("Germany", None, 3490105, None),
        ("Russia", None, 12380664, None), ("Spain", None, 0, 0)]


def test_dedup_keeps_null_keys_like_drop_duplicates(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 4), ("a", 3)], "k string, v int")
    assert tuples(clean.dedup_first(df, ["k"], ["v"])) == [("a", 3), (None, 1)]
    assert df.dropDuplicates(["k"]).count() == 2


def test_safe_parsing(spark):
    lines = spark.createDataFrame([("id,name,h",), ("1, a ,2.5",), ("x,b,y",), ("3,c",), ("4,d,",), ("5,e,6,7",)],
                                  "value string")
    schema = T.StructType.fromDDL("id int, name string, h double")
    parsed = clean.parse_records(clean.without_header(lines, "id,name,h"), schema)
    assert tuples(parsed) == [(1, "a", 2.5), (4, "d", None), (None, "b", None)]


def test_separator_is_text_not_a_pattern(spark):
    lines = spark.createDataFrame([("1|2",)], "value string")
    assert clean.parse_records(lines, T.StructType.fromDDL("a int, b int"), separator="|").first() == (1, 2)


def test_ambiguous_reference(spark):
    left, right = spark.range(3), spark.range(3)
    with pytest.raises(AnalysisException, match="AMBIGUOUS_REFERENCE"):
        left.join(right, left.id == right.id).select("id")


# --- positions and windows ----------------------------------------------------------------------

@FEW
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "b", None]), st.integers(-5, 5)), min_size=1, max_size=40))
def test_positions_equal_windows(spark, rows):
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(rows)], "k string, v int, id int").repartition(5)
    naive = df.select("id", F.row_number().over(Window.orderBy("v", "id")).alias("rn"))
    assert tuples(positions.global_row_number(df, ["v", "id"]).select("id", "rn")) == tuples(naive)
    naive = df.select("id", F.row_number().over(Window.partitionBy("k").orderBy("v", "id")).alias("rn"))
    assert tuples(positions.group_row_number(df, ["k"], ["v", "id"]).select("id", "rn")) == tuples(naive)


@FEW
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["x", "y", None])), min_size=1, max_size=40),
       st.integers(1, 12))
def test_rewritten_counts_equal_windows(spark, rows, salts):
    df = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(rows)], "a string, b string, id int")
    by_a = F.count(F.lit(1)).over(Window.partitionBy("a"))
    by_ab = F.count(F.lit(1)).over(Window.partitionBy("a", "b"))
    want = df.select("id", by_a.alias("cnt_a"), by_ab.alias("cnt_ab"))
    assert tuples(aggregates.with_share_of_group(df, "a", "b").select("id", "cnt_a", "cnt_ab")) == tuples(want)
    assert tuples(joins.with_group_count(df, ["a"]).select("id", "n")) == tuples(df.select("id", by_a))
    assert tuples(aggregates.salted_count(df, "a", ["id"], salts)) == tuples(df.groupBy("a").count())
    naive_all = df.select("id", F.count(F.lit(1)).over(Window.partitionBy()).alias("n"))
    assert tuples(aggregates.with_global_count(df).select("id", "n")) == tuples(naive_all)


def test_percent_is_two_decimals(spark):
    df = spark.createDataFrame([("a", "x")] * 2 + [("a", "y")], "a string, b string")
    shares = {r.b: r.share_bp / 100 for r in aggregates.share_of_group(df, "a", "b").collect()}
    assert shares == {"x": 66.66, "y": 33.33}


def test_salt_shrinks_the_largest_group(spark):
    df = spark.range(10_000).withColumn("k", F.when(F.col("id") < 9_000, "hot").otherwise("cold"))
    salt = F.pmod(F.xxhash64("id"), F.lit(10))
    largest = df.groupBy("k", salt.alias("s")).count().agg(F.max("count")).first()[0]
    assert largest < 1_200
    assert tuples(aggregates.salted_count(df, "k", ["id"])) == [("cold", 1_000), ("hot", 9_000)]


def test_long_lists_are_cut_into_rows_and_stay_whole(spark):
    df = spark.range(2_500).selectExpr("if(id < 2400, 'hot', 'cold') as k", "id")
    rows = aggregates.collect_list_chunked(df, ["k"], "id", ["id"], chunk_rows=1_000).collect()
    assert max(len(r["items"]) for r in rows) == 1_000
    hot = sorted((r for r in rows if r.k == "hot"), key=lambda r: r.chunk)
    assert [x for r in hot for x in r["items"]] == list(range(2_400)) and [r.chunk for r in hot] == [0, 1, 2]
    assert [(r.chunk, r.n) for r in rows if r.k == "cold"] == [(0, 100)]
    whole = aggregates.collect_list_chunked(df, ["k"], "id", ["id"], chunk_rows=5_000)
    assert sorted((r.k, r.chunk, r.n, r["items"][-1]) for r in whole.collect()) == [
        ("cold", 0, 100, 2_499), ("hot", 0, 2_400, 2_399)]
    skipped = spark.createDataFrame([("a", 1, None), ("a", 2, "b"), ("a", 3, "c"), ("z", 4, None)], "k string, o int, v string")
    got = aggregates.collect_list_chunked(skipped, ["k"], "v", ["o"], 2).collect()
    assert sorted((r.k, r.chunk, r.n, r["items"]) for r in got) == [("a", 0, 2, ["b", "c"]), ("z", 0, 0, [])]
    nulls = spark.range(10).selectExpr("cast(null as string) as k", "id")
    assert sorted(r.n for r in aggregates.collect_list_chunked(nulls, ["k"], "id", ["id"], 4).collect()) == [2, 4, 4]


@FEW
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "b", None]), st.integers(-3, 3),
                          st.one_of(st.none(), st.integers(0, 9))), min_size=1, max_size=40), st.integers(1, 6))
def test_long_and_short_lists_agree(spark, rows, chunk_rows):
    df = spark.createDataFrame([(k, o, v, i) for i, (k, o, v) in enumerate(rows)], "k string, o int, v int, i int").repartition(3)
    short, mixed, long_ = (aggregates.collect_list_chunked(df, ["k"], "v", ["o", "i"], chunk_rows, n) for n in (100, 4, 0))
    assert tuples(short) == tuples(mixed) == tuples(long_)


# --- joins -----------------------------------------------------------------------------------------

@FEW
@given(st.integers(0, 10_000), st.sampled_from([1, 4, 1_000]), st.sampled_from(["inner", "left", "left_semi", "left_anti"]))
def test_salted_join_equals_plain(spark, seed, hot_rows, how):
    rnd = random.Random(seed)
    left = spark.createDataFrame([(rnd.choice([1, 1, 1, 2, 3, None]), i) for i in range(30)], "k int, l int")
    right = spark.createDataFrame([(rnd.choice([1, 2, 4, None]), i) for i in range(6)], "k int, r int")
    got = joins.salted_join(left, right, ["k"], ["l"], how, hot_rows)
    assert tuples(got) == tuples(left.join(right, ["k"], how))


def test_hot_keys_are_spread_and_others_stay_together(spark):
    df = spark.range(1_000).selectExpr("case when id < 800 then 1 when id < 900 then null else id end as k", "id")
    hot = joins.hot_keys(df, ["k"], 50)
    assert tuples(hot) == [(1, 16), (None, 2)]
    sizes = joins.with_salt(df, hot, ["k"], ["id"]).groupBy("k", "__salt").count()
    assert sizes.filter("k = 1").count() == 16 and sizes.agg(F.max("count")).first()[0] < 90
    assert sizes.filter("k > 1").agg(F.max("__salt")).first()[0] == 0 and sizes.agg(F.sum("count")).first()[0] == 1_000
    counted = joins.prepartitioned_self_agg(df.filter("k is not null"), "k", 5, ["id"], hot_rows=50)
    assert counted.filter("k = 1 and n = 800").count() == 800 and counted.filter("k > 1 and n = 1").count() == 100


def test_salted_join_refuses_outer_right(spark):
    with pytest.raises(ValueError):
        joins.salted_join(spark.range(1), spark.range(1), ["id"], ["id"], how="right")


def test_sliced_join_keeps_all_slices(spark):
    left = spark.createDataFrame([(i % 5, i) for i in range(20)] + [(None, 99)], "k int, l int")
    right = spark.createDataFrame([(i, i) for i in range(4)], "k int, r int")
    for how in ("inner", "left"):
        got = joins.sliced_join(left, right, ["k"], "k", [1, 3], how)
        assert tuples(got) == tuples(left.join(right, ["k"], how))


@FEW
@given(st.integers(0, 10_000))
def test_interval_join_equals_theta(spark, seed):
    rnd = random.Random(seed)
    start = dt.datetime(2024, 1, 1)

    def rows(n):
        return [(rnd.choice([1, 1, 2]), i, start + dt.timedelta(seconds=rnd.choice([0, 1, 3599, 3600, 3601, 7200]) * rnd.randint(0, 3)))
                for i in range(n)]

    left = spark.createDataFrame(rows(12), "k int, l int, lt timestamp_ntz")
    right = spark.createDataFrame(rows(12), "k int, r int, rt timestamp_ntz")
    naive = left.join(right, "k").filter("lt <= rt + interval 3600 seconds and lt >= rt - interval 3600 seconds")
    got = joins.interval_join(left, right, ["k"], "lt", "rt", 3600)
    assert tuples(got.select("l", "r")) == tuples(naive.select("l", "r"))


def test_null_safe_join(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k int, l string")
    right = spark.createDataFrame([(None, "x"), (2, "y")], "k int, r string")
    assert tuples(joins.null_safe_join(left, right, ["k"])) == [(None, "b", "x")]
    assert left.join(right, "k").count() == 0


def test_broadcast_by_the_planned_size(spark):
    hinted = ["hint" in joins.broadcast_if_small(spark.range(n), 1000)._jdf.queryExecution().logical().toString().lower()
              for n in (100, 101, 126, 200_000)]
    assert hinted == [True, True, False, False]


def test_bounded_sides_keep_what_is_declared(spark):
    many = spark.range(300_000)
    assert joins.cartesian(many, spark.range(2), most_right_rows=2).count() == 600_000
    assert joins.theta_join(many, spark.range(3).toDF("k"), F.col("id") < F.col("k"), 3).count() == 3
    for call in (lambda: joins.cartesian(many, spark.range(3), 2),
                 lambda: joins.theta_join(many, spark.range(3).toDF("k"), F.col("id") < F.col("k"), 2)):
        with pytest.raises(ValueError):
            call()


def test_hot_keys_follow_rows_and_partitions(spark):
    df = spark.range(1000).selectExpr("if(id < 700, 0, id) as k", "id")
    assert [(r.k, r["__salts"]) for r in joins.hot_keys(df, ["k"]).collect()] == [(0, 3)]
    even = spark.range(1000).selectExpr("id % 100 as k", "id")
    assert joins.hot_keys(even, ["k"]).count() == 0
    assert joins.hot_keys(df.limit(0), ["k"]).count() == 0


def test_slices_follow_the_data(spark):
    df = spark.range(900).selectExpr("cast(id * id as bigint) as v")
    bounds = joins.slice_bounds(df, "v", 3)
    sizes = [df.filter((F.col("v") >= a) & (F.col("v") < b)).count() for a, b in zip([0, *bounds], [*bounds, 10**9])]
    assert sum(sizes) == 900 and max(sizes) < 320
    assert joins.slice_bounds(df.limit(0), "v", 3) == []


def test_lookup_of_missing_key(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    assert [r[0] for r in df.select(joins.lookup_map(F.col("k"), {"a": 1})).collect()] == [1, None, None]
    assert df.select(joins.lookup_map(F.col("k"), {})).first()[0] is None


# --- scalars, nulls, time -----------------------------------------------------------------------

def test_null_semantics(spark):
    df = spark.createDataFrame([(1675167853, None)], "l1 bigint, l2 bigint")
    assert df.select(F.col("l1") + F.col("l2")).first()[0] is None
    assert df.filter(F.col("l2") > 0).count() == 0 and df.filter(~(F.col("l2") > 0)).count() == 0


def test_month_range_equals_date_format(spark):
    rows = [(dt.datetime(2023, 1, 31, 23, 59, 59),), (dt.datetime(2023, 2, 1),), (dt.datetime(2023, 2, 28, 23),),
            (dt.datetime(2023, 3, 1),), (dt.datetime(2023, 12, 31, 5),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    for year, month in ((2023, 2), (2023, 12)):
        want = df.filter(F.date_format("ts", "yyyy-MM") == f"{year}-{month:02d}")
        assert tuples(df.filter(timestamps.in_month("ts", year, month))) == tuples(want)


def test_now_functions(spark):
    row = spark.range(1).select(F.current_timestamp().alias("t"), F.current_date().alias("d")).first()
    assert isinstance(row.t, dt.datetime) and isinstance(row.d, dt.date)


def test_interval_arithmetic_and_struct_cast_rules(spark):
    row = spark.sql("select timestamp_ntz'2024-01-01 00:30:00' - interval 1 hour as t").first()
    assert row.t == dt.datetime(2023, 12, 31, 23, 30)
    with pytest.raises(AnalysisException):
        spark.sql("select cast(named_struct('a', 1, 'b', 2) as struct<a: int>)").collect()


def test_date_united_with_timestamp_is_midnight(spark):
    a = spark.sql("select timestamp'2024-01-02 10:00:00' as t")
    b = spark.sql("select date_sub(timestamp'2024-01-02 10:00:00', 1) as t")
    assert a.union(b).schema["t"].dataType == T.TimestampType()
    assert dt.datetime(2024, 1, 1) in [r.t for r in a.union(b).collect()]


def test_sliding_window_doubles_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    assert events.select(F.window("ts", "10 minutes", "5 minutes")).count() == 2 * events.count()


def test_shuffle_picks_a_member(spark):
    idents = F.array(*[F.lit(x) for x in ("a", "b", "c")])
    assert {r[0] for r in spark.range(50).select(F.shuffle(idents)[0]).collect()} <= {"a", "b", "c"}


# --- schema tools ---------------------------------------------------------------------------------

NESTED = ("name string, city string, size struct<width: int, round: boolean>, parts array<struct<z: int>>, "
          "notes map<string, struct<w: int>>")


def test_upper_names_everywhere(spark):
    schema = schemas.rename_nested(T.StructType.fromDDL(NESTED), str.upper)
    assert schema == T.StructType.fromDDL(
        "NAME string, CITY string, SIZE struct<WIDTH: int, ROUND: boolean>, PARTS array<struct<Z: int>>, "
        "NOTES map<string, struct<W: int>>")
    df = spark.createDataFrame([("a", "b", (1, True), [(2,)], {"k": (3,)})], NESTED)
    upper = schemas.upper_names(df)
    assert upper.columns == ["NAME", "CITY", "SIZE", "PARTS", "NOTES"]
    assert upper.select("SIZE.WIDTH", F.col("PARTS")[0]["Z"], F.col("NOTES")["k"]["W"]).first() == (1, 2, 3)


def test_schema_access():
    schema = T.StructType.fromDDL(NESTED)
    assert schema["size"].dataType["width"].dataType == T.IntegerType()
    assert schema.fieldNames().index("city") == 1 and schema[0].name == "name"
    assert T.StructType.fromJson(json.loads(schema.json())) == schema
    assert schema.simpleString().startswith("struct<name:string,city:string,size:struct<width:int,round:boolean>")


def test_create_table_text():
    schema = T.StructType.fromDDL("ident string, elevation int")
    assert schemas.create_table_sql(schema, "ks.codes", "ident", schemas.CASSANDRA_TYPES) == \
        "CREATE TABLE IF NOT EXISTS ks.codes (ident text PRIMARY KEY,elevation int);"
    assert schemas.create_table_sql(schema, "codes", "ident", schemas.POSTGRES_TYPES) == \
        "CREATE TABLE IF NOT EXISTS codes (ident VARCHAR (100) PRIMARY KEY,elevation INTEGER);"
    with pytest.raises(KeyError):
        schemas.create_table_sql(T.StructType.fromDDL("a array<int>"), "t", "a", schemas.POSTGRES_TYPES)


def test_json_schema_of_a_whole_column(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"b": {"c": "x"}, "l": [1]}',), ("broken",), (None,)], "j string")
    ddl = schemas.infer_json_schema(df, "j")
    rows = df.select(F.from_json("j", ddl).alias("s")).select("s.a", "s.b.c", F.col("s.l")[0].alias("l")).collect()
    assert rows[0].a == 1 and rows[1].c == "x" and rows[1].l == 1


# --- UDFs ---------------------------------------------------------------------------------------------

def test_udf_total_and_null_rules(spark):
    df = spark.createDataFrame([(1,), (0,), (4,), (None,)], "x bigint")
    got = df.select(udfs.divide_two_by("x").alias("u"), udfs.safe_divide_two_by(F.col("x")).alias("e")).collect()
    assert [tuple(r) for r in got] == [(2, 2), (None, None), (0, 0), (None, None)]
    null = F.lit(None).cast("string")
    assert spark.range(1).select(udfs.describe_pair(null, F.lit(1))).first()[0] == "None:1"
    assert spark.range(1).select(udfs.describe_guarded(null, F.lit(1))).first()[0] is None


def test_host_name_udf(spark):
    assert len({r[0] for r in spark.range(20).select(udfs.host_name()).collect()}) == 1


def test_counting_while_running(spark):
    seen = Observation()
    rows = spark.range(100).observe(seen, F.sum(F.when(F.col("id") % 2 == 0, 1)).alias("even")).collect()
    assert len(rows) == 100 and seen.get["even"] == 50
    counter = spark.sparkContext.accumulator(0)
    spark.range(10).foreachPartition(lambda part: counter.add(sum(1 for _ in part)))
    assert counter.value == 10


def test_partition_functions(spark):
    df = spark.range(0, 100, 1, 4)
    per_part = layout.partition_counts(df)
    assert sorted(r.n for r in per_part.collect()) == [25] * 4

    def sizes(batches):
        yield from (pd.DataFrame({"n": [len(b)]}) for b in batches)

    assert df.mapInPandas(sizes, "n long").agg(F.sum("n")).first()[0] == 100
    ids = [r[0] for r in df.select(F.monotonically_increasing_id()).collect()]
    assert ids[:25] == list(range(25)) and ids[25] == 1 << 33


# --- layout ------------------------------------------------------------------------------------------

def test_repartition_forms(spark):
    df = spark.range(1_000)
    assert all(abs(r.n - 250) <= 1 for r in layout.partition_counts(df.coalesce(1).repartition(4)).collect())
    skewed = df.repartition(10, F.when(F.col("id") < 900, 1).otherwise(2))
    assert sorted(r.n for r in layout.partition_counts(skewed).collect()) == [100, 900]
    assert spark.range(0, 10, 1, 8).coalesce(2).rdd.getNumPartitions() == 2


def test_sort_within_partitions(spark):
    df = spark.range(0, 100, 1, 4).orderBy(F.rand(1)).repartition(4).sortWithinPartitions("id")
    per = df.select("id", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("m")).collect()
    for p in range(4):
        ids = [r.id for r in sorted((r for r in per if r.p == p), key=lambda r: r.m)]
        assert ids == sorted(ids)


def test_null_order(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "x int")
    assert [r.x for r in df.orderBy("x").collect()] == [None, 1, 2]
    assert [r.x for r in df.orderBy(F.desc("x")).collect()] == [2, 1, None]


def test_cache_is_filled_by_count(spark):
    df = layout.cached(spark.range(100).withColumn("x", F.col("id") * 2))
    assert df.is_cached and df.storageLevel.useMemory
    df.unpersist()
    assert not df.is_cached


def test_reproducible_sample(spark):
    df = spark.range(10_000)
    one, two = layout.reproducible_sample(df, ["id"], 20), layout.reproducible_sample(df.repartition(7), ["id"], 20)
    assert tuples(one) == tuples(two) and 1_800 < one.count() < 2_200
    assert df.sample(fraction=0.1, seed=3).count() == df.sample(fraction=0.1, seed=3).count()


def test_checkpoint_and_freeze_cut_lineage(spark):
    scratch.scratch_root(spark)
    df = spark.range(100).withColumn("r", F.rand())
    kept = df.checkpoint()
    assert tuples(kept) == tuples(kept)
    frozen = scratch.freeze(spark, df, "test")
    assert tuples(frozen) == tuples(frozen) and frozen.count() == 100


def test_scratch_folder_comes_from_the_session(spark, tmp_path):
    root = scratch.scratch_root(spark)
    assert scratch.new_dir(spark, "x").startswith(root) and scratch.new_dir(spark, "x") != scratch.new_dir(spark, "x")
    named = _Session("spark://host:1", {scratch.SETTING: str(tmp_path)})
    assert scratch.scratch_root(named) == str(tmp_path)
    with pytest.raises(RuntimeError):
        scratch.scratch_root(_Session("spark://host:1", {}))


class _Session:
    """Just enough of a session on a cluster to ask where its scratch folder is."""

    def __init__(self, master, settings):
        self.conf = settings
        self.sparkContext = self
        self.master, self.applicationId = master, "app-test"

    def getConf(self):
        return self.conf

    def getCheckpointDir(self):
        return "set"


def test_pivot_loses_no_value(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "new", 3), (2, None, 4)], "k int, c string, v int")
    wide = aggregates.pivot_sum(df, "k", "c", F.col("v"))
    assert sorted(tuple(r) for r in wide.select("k", "a", "new", "null").collect()) == [(1, 2, 3, None), (2, None, None, 4)]
    with pytest.raises(ValueError):
        aggregates.pivot_sum(df, "k", "c", F.col("v"), most_values=2)
    with pytest.raises(Exception, match="unlisted"):
        aggregates.pivot_sum(df, "k", "c", F.col("v"), values=["a", None]).collect()


def test_udfs_beside_nulls_and_at_the_edge(spark):
    big = spark.createDataFrame([(2**53 + 1,), (None,), (3_000_000,)], "x bigint").coalesce(1)
    assert [r[0] for r in big.select(udfs.plus_one("x")).collect()] == [2**53 + 2, None, 3_000_001]
    some = big.filter("x is null or x < 4000000").coalesce(1)
    with pytest.raises(Exception, match="overflow"):
        some.select(udfs.powers("x")).collect()
    small = spark.createDataFrame([(2_000_000,), (None,), (-3,)], "x bigint").coalesce(1)
    assert [tuple(r[0]) for r in small.select(udfs.powers("x")).collect()] == [
        (2_000_000, 4 * 10**12, 8 * 10**18), (None, None, None), (-3, 9, -27)]
    assert [r[0] for r in spark.createDataFrame([(0,), (1,), (-2,), (None,), (5,)], "x bigint").coalesce(1)
            .select(udfs.divide_two_by("x")).collect()] == [None, 2, -1, None, 0]


def test_guarded_udf_is_not_called_on_nulls(spark):
    def strict(x):
        assert x.null_count == 0
        return x.cast("string")

    guarded = udfs.null_guarded(strict, T.StringType())
    df = spark.createDataFrame([(1,), (None,), (3,)], "x bigint").coalesce(1)
    assert [r[0] for r in df.select(guarded("x")).collect()] == ["1", None, "3"]
    assert [r[0] for r in df.filter("x is null").select(guarded("x")).collect()] == [None]


def test_json_schema_of_nothing_and_odd_names(spark):
    for rows in ([], [(None,)]):
        df = spark.createDataFrame(rows, "j string")
        ddl = schemas.infer_json_schema(df, "j")
        assert ddl == "STRUCT<>" and df.select(F.from_json("j", ddl)).count() == len(rows)
    df = spark.createDataFrame([('{"OBJECT<": 1, "n": null}',), ('{"b": [{"c": 2}]}',)], "j string")
    ddl = schemas.infer_json_schema(df, "j")
    rows = df.select(F.from_json("j", ddl).alias("v")).select("v.*")
    assert rows.schema["n"].dataType == T.StringType() and [r["OBJECT<"] for r in rows.collect()] == [1, None]


def test_scratch_notices_changed_inputs_and_lost_copies(spark, tmp_path):
    source, writes = str(tmp_path / "in"), []

    def write(path):
        writes.append(path)
        spark.read.parquet(f"{source}/t.parquet").write.parquet(path)

    spark.range(3).write.parquet(f"{source}/t.parquet")
    first = scratch.stage_once(spark, source, "copy", write)
    assert scratch.stage_once(spark, source, "copy", write) == first
    spark.range(5).write.mode("append").parquet(f"{source}/t.parquet")
    second = scratch.stage_once(spark, source, "copy", write)
    assert second != first and spark.read.parquet(second).count() == 8
    files, at = scratch._file_system(spark, second)
    files.delete(at, True)
    third = scratch.stage_once(spark, source, "copy", write)
    assert len(writes) == 3 and spark.read.parquet(third).count() == 8


def test_queries_leave_the_callers_settings_alone(spark, sf_dir):
    from sparkloom import registry
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        before = dict(spark.conf.getAll)
        df = registry.queries()["agg_group_count"](spark, sf_dir)
        assert dict(spark.conf.getAll) == before
        assert df.sparkSession.conf.get("spark.sql.session.timeZone") == "UTC"
        assert df.sparkSession.conf.get("spark.sql.shuffle.partitions") == before["spark.sql.shuffle.partitions"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
