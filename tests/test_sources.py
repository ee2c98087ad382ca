import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.operators.layout import file_partitions
from sparkloom.registry import table
from sparkloom.sources import connectors, files, inserts, writers


def data_files(path, suffix):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(suffix))


def test_local_rows_and_empty_tables(spark):
    words = spark.createDataFrame([(c,) for c in ("one", "two", "three")], "value string")
    assert words.count() == 3 and words.first().value == "one" and len(words.take(2)) == 2
    empty = spark.createDataFrame([], "name string, count bigint")
    assert empty.isEmpty() and empty.columns == ["name", "count"]


def test_range_partitions(spark):
    ids = spark.range(0, 30, 3, numPartitions=5)
    assert ids.rdd.getNumPartitions() == 5 and ids.count() == 10


def test_header_read_as_data_and_data_read_as_header(spark, sf_dir, out):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").coalesce(1)
    writers.write_csv(orders, out)
    plain = spark.read.csv(out)
    assert plain.columns == ["_c0", "_c1"]
    assert files.csv_headerless(spark, out, ["k", "s"]).count() == orders.count()
    # One row of each file is taken for a header.
    assert spark.read.option("header", True).csv(out).count() == orders.count() - 1


def test_schema_from_header_line(spark, sf_dir, out):
    writers.write_csv(table(spark, sf_dir, "nation"), out, header=True)
    schema = files.schema_from_header(spark, out)
    assert schema.fieldNames() == ["n_nationkey", "n_name", "n_regionkey"]
    assert {f.dataType for f in schema.fields} == {T.StringType()}
    assert files.csv_declared(spark, out, schema).count() == 25


def test_sampling_ratio_infers_same_types(spark, sf_dir, out):
    orders = table(spark, sf_dir, "orders").drop("o_orderdate")
    writers.write_csv(orders, out, header=True)
    assert files.csv_inferred(spark, out, 0.1).schema == files.csv_inferred(spark, out).schema


def test_declared_schema_order_matters(spark, out):
    spark.createDataFrame([(1, "a")], "id int, s string").coalesce(1).write.csv(out, header=True)
    assert files.csv_declared(spark, out, "s string, id int").first() == ("1", None)


def test_gzip_is_one_partition(spark, sf_dir, out):
    writers.write_csv(table(spark, sf_dir, "orders").repartition(1), out, header=True, compression="gzip")
    assert len(data_files(out, ".csv.gz")) == 1
    df = files.csv_inferred(spark, out)
    assert df.rdd.getNumPartitions() == 1 and df.repartition(4).rdd.getNumPartitions() == 4
    assert df.count() == 1500


def test_mixed_directory(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1}\n')
    (tmp_path / "b.txt").write_text("not json\n")
    everything = spark.read.json(str(tmp_path))
    assert set(everything.columns) == {"_corrupt_record", "id"}
    assert files.read_glob(spark, "json", str(tmp_path), "*.json").collect()[0].id == 1
    assert files.read_glob(spark, "text", str(tmp_path), "*.txt").first().value == "not json"
    assert spark.read.json(str(tmp_path / "*.json")).columns == ["id"]


def test_only_corrupt_column_is_an_error(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1}\n{"id": \n')
    df = files.json_permissive(spark, str(tmp_path), T.StructType.fromDDL("id int"))
    assert df.filter("_corrupt_record is not null").collect() == [(None, '{"id": ')]
    with pytest.raises(AnalysisException):
        df.select("_corrupt_record").collect()


def test_root_file_of_partitioned_directory_is_not_seen(spark, tmp_path):
    (tmp_path / "part-0.json").write_text('{"id": 1}\n')
    (tmp_path / "country=US").mkdir()
    (tmp_path / "country=US" / "part-0.json").write_text('{"id": 2}\n')
    assert [r.id for r in spark.read.json(str(tmp_path)).collect()] == [2]


def test_incompatible_evolution_is_refused(spark, out):
    spark.createDataFrame([(1, "red")], "size int, color string").write.parquet(out)
    spark.createDataFrame([(2, "green", 1.5)], "size int, color string, price double").write.mode("append").parquet(out)
    merged = files.parquet_merged(spark, out)
    assert merged.columns == ["size", "color", "price"]
    assert [r.price for r in merged.orderBy("size").collect()] == [None, 1.5]
    spark.createDataFrame([(3.0, "red")], "size double, color string").write.mode("append").parquet(out)
    with pytest.raises(Exception, match="CANNOT_MERGE_SCHEMAS"):
        files.parquet_merged(spark, out).collect()


def test_missing_paths(spark, out):
    spark.range(3).write.parquet(out)
    assert files.parquet_existing(spark, [out, out + "-missing"]).count() == 3
    assert files.parquet_existing(spark, [out + "-x"], T.StructType.fromDDL("id bigint")).isEmpty()
    with pytest.raises(ValueError):
        files.parquet_existing(spark, [out + "-x"])


def test_other_errors_are_raised(spark, tmp_path):
    (tmp_path / "broken.parquet").write_text("this is not parquet")
    with pytest.raises(Exception):
        files.parquet_existing(spark, [str(tmp_path / "broken.parquet")]).collect()


def test_text_write_needs_one_string_column(spark, out):
    with pytest.raises(AnalysisException):
        spark.range(3).write.text(out)
    with pytest.raises(AnalysisException):
        spark.range(3).selectExpr("'a' as a", "'b' as b").write.text(out)


def test_partition_columns_live_in_paths(spark, sf_dir, out):
    writers.write_partitioned(table(spark, sf_dir, "orders"), out, ["o_orderstatus"])
    inside = spark.read.parquet(data_files(out, ".parquet")[0])
    assert "o_orderstatus" not in inside.columns
    assert "o_orderstatus" in spark.read.parquet(out).columns
    # Small keys get a file each.
    assert len(data_files(out, ".parquet")) == 3


def test_no_success_file(spark, out):
    writers.write_quietly(spark.range(3), out)
    assert not os.path.exists(os.path.join(out, "_SUCCESS")) and spark.read.parquet(out).count() == 3


def test_files_behind_a_scan(spark, out):
    spark.range(0, 10_000, 1, 10).write.parquet(out)
    df = spark.read.parquet(out)
    found = file_partitions(df).collect()
    assert len(found) == 10 and sum(r.n for r in found) == 10_000 and all(r.file_size > 0 for r in found)
    assert all(r.file_block_start == 0 and r.file_block_length == r.file_size for r in found)
    assert files.source_files(df).count() == 10


def test_settings_list(spark):
    keys = [r.key for r in files.settings_like(spark, "parquet").collect()]
    assert keys and all("parquet" in k for k in keys)
    assert spark.sql("select 1 as one").first().one == 1


def test_connector_options():
    assert connectors.jdbc_partitioned_options("jdbc:x", "t", "id", 0, 100, 4) == {
        "url": "jdbc:x", "dbtable": "t", "partitionColumn": "id", "lowerBound": "0", "upperBound": "100",
        "numPartitions": "4"}
    assert connectors.elastic_options("h:9200", wan_only=True) == {
        "es.nodes": "h:9200", "es.nodes.wan.only": "true", "es.batch.write.refresh": "false"}
    assert connectors.elastic_index("logs", "date") == "logs-{date}"
    assert connectors.cassandra_options("ks", "t") == {"keyspace": "ks", "table": "t"}
    assert connectors.cassandra_session_settings("h")["spark.cassandra.output.consistency.level"] == "ANY"
    with pytest.raises(ValueError):
        connectors.cassandra_session_settings("h", "SOME")
    assert connectors.kafka_stream_options("h:9092", "t", max_offsets=5, min_partitions=20) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "5", "minPartitions": "20"}
    ranged = connectors.kafka_range_options("h:9092", "t", {0: 1000}, {0: 1008})
    assert ranged["startingOffsets"] == '{"t": {"0": 1000}}' and ranged["endingOffsets"] == '{"t": {"0": 1008}}'
    with pytest.raises(ValueError):
        connectors.kafka_range_options("h:9092", "t", {0: 1}, {1: 2})


def test_jdbc_predicates_cover_all_rows_once(spark):
    df = spark.range(1000).selectExpr("case when id < 900 then id % 7 when id < 990 then id * 1000 end as k")
    predicates = connectors.jdbc_predicates("k", connectors.balanced_cuts(df, "k", 4))
    sizes = [df.filter(p).count() for p in predicates]
    assert sum(sizes) == 1000
    assert connectors.jdbc_predicates("k", []) == ["1 = 1"]
    strided = [df.filter(p).count() for p in connectors.jdbc_predicates("k", [247_500, 495_000, 742_500])]
    assert sum(strided) == 1000 and max(strided) > max(sizes)


def test_kafka_schema_and_encoding(spark):
    schema = T.StructType.fromDDL(connectors.KAFKA_SCHEMA)
    assert schema.fieldNames() == ["key", "value", "topic", "partition", "offset", "timestamp", "timestampType"]
    sent = connectors.kafka_encode(spark.range(2), "t", F.col("id"))
    assert [tuple(r) for r in sent.orderBy("key").collect()] == [("0", '{"id":0}', "t"), ("1", '{"id":1}', "t")]
    assert connectors.kafka_encode(spark.range(1), "t").columns == ["value", "topic"]


def test_insert_rendering(spark):
    # The published example of the statement format.
    df = spark.sql("select timestamp_micros(1716453864131000) as timestamp, 2L as value")
    assert inserts.render_inserts(df, "foo").first().statement == \
        "INSERT INTO TABLE foo (timestamp, value) VALUE (ts:1716453864131000, 2L)"
    assert inserts.render_inserts(spark.sql("select \"it's\" as s, cast(null as bigint) as n"), "foo").first().statement == \
        "INSERT INTO TABLE foo (s, n) VALUE ('it''s', NULL)"
    with pytest.raises(TypeError):
        inserts.render_inserts(spark.sql("select 1.5D as x"), "foo")
