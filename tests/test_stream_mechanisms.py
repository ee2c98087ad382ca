"""Restarts, the table source, de-duplication within the watermark, the progress table, the sink's manifests."""

import datetime as dt
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sparkloom.registry import table
from sparkloom.streaming import control, custom, runner, staging, stateful, table_source
from tests.test_streaming import NOON, one_file_per_batch, write_files


# --- de-duplication within the watermark ---------------------------------------------------------------


@pytest.mark.parametrize("salting", [(), (["id"], 3)])
def test_repeats_within_the_delay_go_and_later_ones_come_back(spark, out, salting):
    at = lambda minutes: NOON + dt.timedelta(minutes=minutes)
    write_files(spark, out, [
        [("a", at(0), 1), ("a", at(3), 2)],    # the same batch, another time
        [("a", at(8), 3), ("b", at(9), 4)],    # another batch, within the delay of the first
        [("c", at(60), 5)],                    # the watermark passes a's and b's time and delay
        [("d", at(61), 6)],
        [("a", at(62), 7), ("b", at(63), 8), ("c", at(64), 9)],  # a and b have been let go, c has not
        [("e", at(20), 10)],                   # late
    ], "k string, ts timestamp, id int")
    stream = one_file_per_batch(spark, out, "k string, ts timestamp, id int")
    once = stateful.dedup_within_watermark(stream, ["k"], "ts", "10 minutes", *salting)
    assert sorted(r.k for r in runner.append_result(once).collect()) == ["a", "a", "b", "b", "c", "d"]


# --- staging -------------------------------------------------------------------------------------------


def test_every_staged_file_has_a_task_of_its_own(spark):
    cuts = staging.Cuts(rows=480, slices=8, rows_per_file=10)
    assert cuts.files == 6
    dealt = staging.dealt_to_files(spark.range(1, 481).withColumnRenamed("id", "__rn"), cuts)
    tasks = dealt.groupBy(F.spark_partition_id()).agg(F.count_distinct("__slice", "__file").alias("files"), F.count("__rn").alias("n"))
    assert sorted((r.files, r.n) for r in tasks.collect()) == [(1, 10)] * 48


# --- restart from a checkpoint -------------------------------------------------------------------------


def test_a_restarted_query_has_its_state_and_reads_nothing_twice(spark, tmp_path):
    incoming, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "c"))
    schema = "id int, k string"

    def more(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(incoming)
        stream = spark.readStream.schema(schema).parquet(incoming)
        query = runner.append_more(stateful.dedup(stream, ["k"]), out, checkpoint)
        return sum(p["numInputRows"] for p in query.recentProgress)

    assert more((1, "a"), (2, "b")) == 2
    assert more((3, "a"), (4, "c"), (5, "b")) == 3
    assert more((6, "c")) == 1
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [(1, "a"), (2, "b"), (4, "c")]


def test_a_failed_batch_is_repeated_after_the_restart(spark, tmp_path):
    incoming, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "c"))
    write_files(spark, incoming, [[(k,)] for k in range(5)], "id int")
    fails = {2}

    def write(batch, batch_id):
        runner.per_batch_writer(out)(batch, batch_id)
        if batch_id in fails:  # after the write: the batch is not committed
            fails.remove(batch_id)
            raise RuntimeError("lost")

    def run():
        return runner.run_available(one_file_per_batch(spark, incoming, "id int").writeStream.foreachBatch(write), checkpoint)

    with pytest.raises(StreamingQueryException):
        run()
    run()
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [(k, k) for k in range(5)]


# --- the table source ----------------------------------------------------------------------------------


@pytest.fixture
def stored(spark, sf_dir, tmp_path):
    """The events table in three files."""
    path = str(tmp_path / "stored")
    table(spark, sf_dir, "events").select("event_id", "ts", "event_type").repartition(3).write.parquet(path)
    return path


def _ids(df):
    return sorted(r.event_id for r in df.select("event_id").collect())


def test_table_source_reads_all_in_bounded_batches(spark, sf_dir, stored, tmp_path):
    stream = table_source.stream_table(spark, stored, str(tmp_path / "log"), 130, 50)
    assert stream.schema == spark.read.parquet(stored).schema
    out = str(tmp_path / "out")
    query = runner.run_until_drained(stream.writeStream.foreachBatch(runner.per_batch_writer(out)), str(tmp_path / "c"))
    sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert sizes == [130] * 7 + [90]
    want = spark.read.parquet(stored)
    assert _ids(spark.read.parquet(out)) == _ids(want)
    assert spark.read.parquet(out).drop("batch_id").exceptAll(want).count() == 0


def test_table_source_restarts_in_the_middle(spark, stored, tmp_path):
    """A batch fails after it was planned; the next run repeats it, and nothing is lost or read twice. Rows that
    come with new files are taken too, and a logged offset that Spark never saw does no harm."""
    out, log, checkpoint = (str(tmp_path / n) for n in ("out", "log", "c"))
    fails = {3}

    def write(batch, batch_id):
        if batch_id in fails:
            fails.remove(batch_id)
            raise RuntimeError("lost")
        runner.per_batch_writer(out)(batch, batch_id)

    def run():
        stream = table_source.stream_table(spark, stored, log, 100, 40)
        return runner.run_until_drained(stream.writeStream.foreachBatch(write), checkpoint)

    with pytest.raises(StreamingQueryException):
        run()
    assert spark.read.parquet(out).count() == 300
    ahead = table_source.TableFilesReader({"path": f"file://{stored}", "offsetLog": f"file://{log}", "rowsPerBatch": "100"},
                                          spark.read.parquet(stored).schema)
    ahead.latestOffset()  # logged, then the process is lost before Spark knows of it
    run()
    assert _ids(spark.read.parquet(out)) == _ids(spark.read.parquet(stored))
    new = spark.createDataFrame([(10**9 + k, None, "late") for k in range(5)], spark.read.parquet(stored).schema)
    new.coalesce(1).write.mode("append").parquet(stored)
    query = run()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 5
    assert _ids(spark.read.parquet(out)) == _ids(spark.read.parquet(stored))


def test_table_source_partitions_follow_the_offsets(spark, stored, tmp_path):
    options = {"path": f"file://{stored}", "offsetLog": f"file://{tmp_path}/log", "rowsPerBatch": "400",
               "rowsPerPartition": "150"}
    schema = spark.read.parquet(stored).schema
    reader = table_source.TableFilesReader(options, schema)
    start, end = reader.initialOffset(), reader.latestOffset()
    parts = reader.partitions(start, end)
    assert [p.last - p.first for p in parts] == [150, 150, 33, 67] or sum(p.last - p.first for p in parts) == 400
    assert max(p.last - p.first for p in parts) <= 150
    again = table_source.TableFilesReader(options, schema)
    assert again.partitions(start, end) == parts
    rows = [i for p in parts for b in reader.read(p) for i in b.column("event_id").to_pylist()]
    assert len(rows) == len(set(rows)) == 400
    assert again.latestOffset() != end and reader.partitions(end, end) == []
    with pytest.raises(ValueError):
        table_source.TableFilesReader({"path": "x"}, schema)


def test_offset_log_keeps_the_newest(tmp_path):
    log = table_source.OffsetLog(f"file://{tmp_path}")
    assert log.last() is None
    for k in range(50):
        log.add({"time": k, "file": "f", "row": k})
    assert table_source.OffsetLog(f"file://{tmp_path}").last()["time"] == 49
    assert len(os.listdir(tmp_path)) == 20
    table_source.OffsetLog(f"file://{tmp_path}").add({"time": 50, "file": "f", "row": 0})
    assert log.last()["time"] == 50


# --- the progress table, the sink ----------------------------------------------------------------------


def test_progress_of_all_batches_is_kept(spark, out, tmp_path):
    at = lambda minutes: NOON + dt.timedelta(minutes=minutes)
    write_files(spark, out, [[("a", at(0)), ("b", at(1))], [("a", at(90))], [("d", at(91))], [("c", at(0))]], "k string, ts timestamp")
    log = control.ProgressTable(spark, str(tmp_path / "progress"))
    spark.streams.addListener(log)
    try:
        counts = stateful.windowed(one_file_per_batch(spark, out, "k string, ts timestamp"), ["k"], "ts", "10 minutes",
                                   "5 minutes", F.count(F.lit(1)).alias("n"))
        writer = counts.writeStream.outputMode("update").queryName("kept").foreachBatch(
            runner.per_batch_writer(str(tmp_path / "o")))
        log.wait(runner.run_available(writer, str(tmp_path / "c")))
    finally:
        spark.streams.removeListener(log)
    rows = log.table().filter("input_rows > 0").orderBy("batch_id").collect()
    assert [r.input_rows for r in rows] == [2, 1, 1, 1] and {r.name for r in rows} == {"kept"}
    assert rows[0].state_rows == 2 and sum(r.late_rows for r in log.table().collect()) == 1
    assert max(r.watermark for r in rows).replace(tzinfo=None) == at(86)
    assert all(r.trigger_ms > 0 and r.at is not None for r in rows)


def test_a_batch_stays_listed_while_it_is_committed_again(spark, tmp_path, monkeypatch):
    """The second attempt's manifest is there before the first one goes; left-overs of both do not count twice."""
    writer = custom.StatementsWriter(f"file://{tmp_path}")
    for name in "yz":
        (tmp_path / f"part-00000-{name}.sql").write_text(f"INSERT {name}\n")
    writer.commit([custom.WrittenFile("part-00000-y.sql", 1)], 0)
    first = [f for f in os.listdir(tmp_path) if f.startswith("batch-")]
    kept = (tmp_path / first[0]).read_text()
    writer.commit([custom.WrittenFile("part-00000-z.sql", 1)], 0)
    assert len([f for f in os.listdir(tmp_path) if f.startswith("batch-")]) == 1
    (tmp_path / first[0]).write_text(kept)  # as if the process had been lost before the old one went
    assert [r.statement for r in custom.committed_statements(spark, str(tmp_path)).collect()] == ["INSERT z"]
    stream_path = str(tmp_path / "q")
    frame = spark.readStream.format("rate").load().selectExpr("cast(value as string) as statement")
    assert custom.write_statements(frame, stream_path) is not None
