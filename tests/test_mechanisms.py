"""Adaptive skew splitting, work by partition, observed writes, conforming schemas, scratch and the driver contract."""

import os
import sys

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from sparkloom import registry, scratch
from sparkloom.functions import schema as schemas
from sparkloom.operators import joins, partitionwise
from sparkloom.plans import adaptive
from sparkloom.plans.explain import operator_count
from sparkloom.registry import table
from sparkloom.session import skew_settings
from sparkloom.sources import writers

# --- adaptive skew splitting -------------------------------------------------------------------------


def test_skewed_join_is_split(spark, sf_dir, tmp_path):
    """The lines lie in eight files, so the hot key's partition has eight pieces that tasks can share."""
    table(spark, sf_dir, "lineitem").repartition(8).write.parquet(f"{tmp_path}/lineitem.parquet")
    table(spark, sf_dir, "part").write.parquet(f"{tmp_path}/part.parquet")
    df = registry.queries()["join_skew_aqe"](spark, str(tmp_path))
    reads = adaptive.skew_reads(df)
    assert reads and max(max(r.readers.values()) for r in reads) > 2
    assert "skew=true" in adaptive.final_plan_text(df)
    assert df.count() == table(spark, sf_dir, "lineitem").count()


def test_even_join_is_not_split(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    df = joins.sort_merge_join(lines, orders, ["l_orderkey"])
    assert adaptive.skew_reads(df) == [] and "skew=true" not in adaptive.final_plan_text(df)


def test_skew_settings_follow_the_size():
    prefix = "spark.sql.adaptive."
    large, small = skew_settings(100 << 40, 1000), skew_settings(1 << 20, 8)
    assert large[prefix + "skewJoin.skewedPartitionThresholdInBytes"] == str(256 << 20)
    assert large[prefix + "advisoryPartitionSizeInBytes"] == str(64 << 20)
    assert small[prefix + "skewJoin.skewedPartitionThresholdInBytes"] == str((1 << 20) // 8)
    assert skew_settings(0, 0)[prefix + "advisoryPartitionSizeInBytes"] == str(16 << 10)


# --- work by partition -------------------------------------------------------------------------------


def _resource():
    """A class that tasks get by value: it leaves a file when it is opened and one when it is closed."""
    class Noted:
        def __init__(self, folder):
            self.name = f"{folder}/{os.getpid()}-{os.urandom(4).hex()}"
            open(f"{self.name}.open", "w").close()

        def close(self):
            open(f"{self.name}.closed", "w").close()

    return Noted


def _noted(folder):
    names = os.listdir(folder)
    return [sum(n.endswith(kind) for n in names) for kind in (".open", ".closed")]


def test_a_resource_per_partition(spark, tmp_path):
    Noted, folder = _resource(), str(tmp_path)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        df = spark.range(100, numPartitions=5)
        got = partitionwise.map_partitions(df, "id bigint", lambda: Noted(folder),
                                           lambda resource, batch: batch + 1, Noted.close)
        assert sorted(r.id for r in got.collect()) == list(range(1, 101))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert _noted(tmp_path) == [5, 5]


def test_resources_are_closed_on_failure_and_on_a_limit(spark, tmp_path):
    Noted, failing, limited = _resource(), f"{tmp_path}/failing", f"{tmp_path}/limited"
    os.mkdir(failing), os.mkdir(limited)

    def fail(resource, batch):
        raise ValueError("no more")

    with pytest.raises(Exception, match="no more"):
        partitionwise.map_partitions(spark.range(3, numPartitions=1), "id bigint", lambda: Noted(failing), fail,
                                     Noted.close).collect()
    opened, closed = _noted(failing)
    assert opened == closed >= 1
    some = partitionwise.map_partitions(spark.range(100_000, numPartitions=1), "id bigint", lambda: Noted(limited),
                                        lambda resource, batch: batch, Noted.close).limit(1)
    assert len(some.collect()) == 1
    opened, closed = _noted(limited)
    assert opened == closed >= 1


def test_rows_sent_by_partition(spark, tmp_path):
    Noted, folder = _resource(), str(tmp_path)

    def send(resource, batch):
        with open(f"{resource.name}.rows", "a") as out:
            out.writelines(f"{i}\n" for i in batch["id"])

    assert partitionwise.for_each_partition(spark.range(50, numPartitions=4), lambda: Noted(folder), send, Noted.close) == 50
    assert partitionwise.for_each_partition(spark.range(0), lambda: Noted(folder), send, Noted.close) == 0
    sent = [int(x) for n in os.listdir(folder) if n.endswith(".rows") for x in open(f"{folder}/{n}")]
    assert sorted(sent) == list(range(50)) and _noted(folder) == [4, 4]


# --- observed writes, conforming schemas -------------------------------------------------------------


def test_a_write_is_observed_in_one_pass(spark, sf_dir, out):
    orders = table(spark, sf_dir, "orders")
    seen_runs = orders.sparkSession.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen_runs.add(batch.num_rows)
            yield batch

    counted = orders.select("o_orderkey").mapInArrow(count, "o_orderkey bigint")
    seen = writers.write_observed(counted, out, n=F.count(F.lit(1)), top=F.max("o_orderkey"))
    assert seen == {"n": orders.count(), "top": orders.agg(F.max("o_orderkey")).first()[0]}
    assert seen_runs.value == seen["n"] == spark.read.parquet(out).count()
    assert operator_count(counted, "FileScan") + operator_count(counted, "Scan") == 1


def test_observed_write_of_no_rows(spark, out):
    assert writers.write_observed(spark.range(0), out, n=F.count(F.lit(1)), top=F.max("id")) == {"n": 0, "top": None}


def test_conform_errors(spark):
    df = spark.createDataFrame([(1, "a", 2.5)], "k int, s string, x double")
    assert schemas.conform(df, "x double, k bigint").schema.simpleString() == "struct<x:double,k:bigint>"
    assert schemas.conform(df, "more string, k bigint").first() == (None, 1)
    for target in ("k bigint, more string not null", "k int not null"):
        with pytest.raises(AnalysisException):
            schemas.conform(df, target)
    for target, place in (("x int", "x: double to int"), ("k smallint", "k: int to smallint"), ("s struct<a: int>", "s: "),
                          ("x float", "x: "), ("k decimal(9,0)", "k: ")):
        with pytest.raises(ValueError, match=place):
            schemas.conform(df, target)


def test_conform_nested(spark):
    df = spark.createDataFrame([([(1, "a")], {"k": 2})], "l array<struct<n: int, t: string>>, m map<string, int>")
    got = schemas.conform(df, "m map<string, bigint>, l array<struct<t: string, n: bigint, d: date>>")
    assert got.schema.simpleString() == "struct<m:map<string,bigint>,l:array<struct<t:string,n:bigint,d:date>>>"
    assert got.first().asDict(recursive=True) == {"m": {"k": 2}, "l": [{"t": "a", "n": 1, "d": None}]}
    with pytest.raises(ValueError, match=r"l\[\]\.n: int to tinyint"):
        schemas.conform(df, "l array<struct<n: tinyint>>")
    with pytest.raises(ValueError, match="m values"):
        schemas.conform(df, "m map<string, string>")


# --- scratch, bounded sides, the contract ------------------------------------------------------------


def test_listing_key_sees_deep_changes(spark, tmp_path):
    deep = tmp_path / "t" / "a=1" / "b=2" / "c=3"
    deep.mkdir(parents=True)
    (deep / "f").write_text("1")
    before = scratch.listing_key(spark, str(tmp_path))
    assert before == scratch.listing_key(spark, str(tmp_path))
    (deep / "f").write_text("22")
    assert scratch.listing_key(spark, str(tmp_path)) != before


def test_only_own_folders_are_deleted(spark, tmp_path):
    path = scratch.new_dir(spark, "gone")
    spark.range(3).write.parquet(path)
    assert scratch.delete_path(spark, path) and not scratch.path_exists(spark, path)
    with pytest.raises(ValueError):
        scratch.delete_path(spark, str(tmp_path))
    assert tmp_path.exists()


def test_qualified_paths(spark, tmp_path):
    assert scratch.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    assert scratch.qualified(spark, f"file:{tmp_path}/a") == f"file:{tmp_path}/a"


def test_a_bounded_side_is_computed_once(spark):
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    right = spark.range(7).mapInArrow(count, "id bigint").withColumnRenamed("id", "r")
    assert joins.theta_join(spark.range(5), right, F.col("id") < F.col("r"), 10).count() == 20
    assert runs.value == 7
    with pytest.raises(ValueError):
        joins.cartesian(spark.range(5), spark.range(7).toDF("r"), 6)


def test_other_queries_stay_without_a_package_of_the_optional_ones(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("sparkloom.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)
    with pytest.warns(UserWarning, match="left out"):
        found = entry_module.queries()
    with pytest.warns(UserWarning):
        oracles = entry_module.oracle_sql()
    assert set(registry.queries()) <= set(found) and set(registry.oracle_sql()) <= set(oracles)
    assert "op3_token_counts" not in found
