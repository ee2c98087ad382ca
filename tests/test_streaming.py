import datetime as dt
import os
import time

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from sparkloom.registry import table
from sparkloom.sources import inserts
from sparkloom.streaming import batch_writers, control, custom, runner, stateful
from sparkloom.streaming.staging import Cuts, stage_arrivals, stream_arrivals

NOON = dt.datetime(2024, 5, 1, 12)


@pytest.fixture
def arrivals(spark, sf_dir, out):
    return stage_arrivals(table(spark, sf_dir, "events"), "ts", out)


def write_files(spark, path, batches, schema):
    """One file per batch, in the order given."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.02)


def one_file_per_batch(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_slices_cover_the_table_in_time_order(spark, sf_dir, arrivals):
    events = table(spark, sf_dir, "events")
    assert spark.read.parquet(arrivals.path).count() == events.count()
    files = sorted((os.path.join(arrivals.path, f) for f in os.listdir(arrivals.path) if f.endswith(".parquet")),
                   key=os.path.getmtime)
    spans = [spark.read.parquet(f).agg(F.min("ts"), F.max("ts")).first() for f in files]
    assert len(files) == 4 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_slices_with_several_files_stay_one_batch(spark, sf_dir, out, tmp_path):
    staged = stage_arrivals(table(spark, sf_dir, "events"), "ts", out, slices=3, rows_per_file=150)
    assert staged.files_per_slice > 1
    sizes = {}
    writer = batch_writers.counted(runner.per_batch_writer(str(tmp_path / "w")), lambda b, n: sizes.update({b: n}))
    runner.run_available(stream_arrivals(spark, staged).writeStream.foreachBatch(writer), str(tmp_path / "c"))
    rows = table(spark, sf_dir, "events").count()
    per_slice = -(-rows // 3)
    assert [sizes[k] for k in sorted(sizes)] == [per_slice, per_slice, rows - 2 * per_slice]


def test_bursts_do_not_make_large_slices(spark, out):
    """Nine rows of ten at one instant, rows without a time, and a last slice that lacks files."""
    rows = [(NOON, k) for k in range(900)] + [(NOON + dt.timedelta(hours=k), 1000 + k) for k in range(1, 91)]
    rows += [(None, 2000 + k) for k in range(5)]
    staged = stage_arrivals(spark.createDataFrame(rows, "ts timestamp_ntz, k int"), "ts", out, slices=7,
                            rows_per_file=40, order=["k"])
    cuts = Cuts(995, 7, 40)
    assert staged.files_per_slice == cuts.files == 4 and cuts.files_of(6) == 4
    files = sorted(f for f in os.listdir(out) if f.endswith(".parquet"))
    counts = [spark.read.parquet(f"{out}/{f}").count() for f in files]
    assert len(files) == 28 and sum(counts) == 995 and max(counts) <= 40
    assert [sum(counts[4 * s:4 * s + 4]) for s in range(7)] == [143] * 6 + [137]
    assert spark.read.parquet(*[f"{out}/{f}" for f in files[-4:]]).filter("ts is null").count() == 5
    assert [Cuts(10, 4, 2).files_of(s) for s in range(4)] == [2, 2, 2, 1]


def test_empty_table_and_rows_without_time(spark, sf_dir, out, tmp_path):
    schema = "ts timestamp_ntz, k string"
    empty = stage_arrivals(spark.createDataFrame([], schema), "ts", out)
    counts = stream_arrivals(spark, empty).groupBy("k").count()
    assert runner.append_result(stream_arrivals(spark, empty)).count() == 0
    assert runner.complete_result(counts).count() == 0 and runner.update_result(counts, ["k"]).count() == 0
    for name, rows in (("n", [(NOON, "a"), (None, "b")]), ("m", [(None, "a"), (None, "b")])):
        staged = stage_arrivals(spark.createDataFrame(rows, schema), "ts", str(tmp_path / name))
        assert sorted(r.k for r in runner.append_result(stream_arrivals(spark, staged)).collect()) == ["a", "b"]


def test_stream_is_not_a_static_frame(spark, arrivals):
    stream = stream_arrivals(spark, arrivals)
    assert stream.isStreaming
    with pytest.raises(AnalysisException):
        stream.count()


def test_file_stream_needs_a_schema(spark, arrivals):
    with pytest.raises(Exception, match="[Ss]chema"):
        spark.readStream.parquet(arrivals.path)


def test_rate_source_and_memory_sink(spark, tmp_path):
    stream = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 5).option("numPartitions", 2).load())
    assert stream.columns == ["timestamp", "value"]
    query = (stream.writeStream.format("memory").queryName("rate_rows")
             .trigger(processingTime="2 seconds").start())
    assert query.isActive and query.name == "rate_rows"
    with pytest.raises(Exception, match="rate_rows"):
        stream.writeStream.format("memory").queryName("rate_rows").start()
    deadline = time.time() + 60
    while query.lastProgress is None or query.lastProgress["batchId"] < 1:
        assert time.time() < deadline
        time.sleep(0.1)
    assert control.stop_gracefully(query) and not query.isActive
    assert control.progress_rows(query)[0][1] == 5
    assert spark.table("rate_rows").count() % 5 == 0


def test_console_sink(spark, arrivals, tmp_path):
    query = (stream_arrivals(spark, arrivals).select("event_id").writeStream.format("console")
             .option("numRows", 2).option("truncate", False).option("checkpointLocation", str(tmp_path / "c"))
             .trigger(availableNow=True).start())
    assert query.awaitTermination(120)
    assert "ConsoleTable" in query.lastProgress["sink"]["description"]
    assert [n for _, n in control.progress_rows(query) if n] and query.exception() is None


def test_listener_sees_the_query(spark, arrivals, tmp_path):
    log = control.ProgressLog()
    spark.streams.addListener(log)
    try:
        runner.run_available(stream_arrivals(spark, arrivals).writeStream.format("noop"), str(tmp_path / "c"))
        deadline = time.time() + 30
        while not any(e[0] == "ended" for e in log.events) and time.time() < deadline:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    assert log.events[0][0] == "started" and log.events[-1] == ("ended", None)
    assert sum(e[2] for e in log.events if e[0] == "progress") == 1000


def test_two_queries_cannot_share_a_checkpoint(spark, tmp_path):
    """The later query takes over; the earlier one is stopped."""
    def start():
        return (spark.readStream.format("rate").load().writeStream.format("noop")
                .option("checkpointLocation", str(tmp_path / "c")).start())

    first = start()
    second = start()
    try:
        assert first.id == second.id and first.runId != second.runId
        assert not first.isActive and second.isActive
    finally:
        control.stop_all(spark)


def test_restart_continues_from_the_checkpoint(spark, out, tmp_path):
    schema, target, checkpoint = "id bigint", str(tmp_path / "t"), str(tmp_path / "c")
    write_files(spark, out, [[(1,)], [(2,)]], schema)

    def run():
        runner.run_available(one_file_per_batch(spark, out, schema).writeStream.format("parquet").option("path", target),
                             checkpoint)

    run()
    run()
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [1, 2]
    write_files(spark, out, [[(3,)]], schema)
    run()
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [1, 2, 3]


def test_stop_all_and_marker_file(spark, tmp_path):
    query = spark.readStream.format("rate").load().writeStream.format("noop") \
        .option("checkpointLocation", str(tmp_path / "c")).start()
    marker = tmp_path / "stop"
    assert not control.stop_gracefully(query, timeout=1, marker=str(marker))
    assert query.isActive
    marker.write_text("")
    assert control.stop_gracefully(query, timeout=60, marker=str(marker))
    spark.readStream.format("rate").load().writeStream.format("noop").start()
    assert control.stop_all(spark) == 1 and not spark.streams.active


def test_restart_after_failure(spark, out, tmp_path):
    write_files(spark, out, [[(1,)], [(2,)]], "id bigint")
    target, state = str(tmp_path / "t"), {"failures": 1}

    def write(batch, batch_id):
        if batch_id == 1 and state["failures"]:
            state["failures"] -= 1
            raise ValueError("first try of batch 1")
        runner.per_batch_writer(target)(batch, batch_id)

    def start():
        return (one_file_per_batch(spark, out, "id bigint").writeStream.foreachBatch(write)
                .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())

    assert control.run_with_restarts(start) == 1
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [1, 2]
    state["failures"] = 99
    write_files(spark, out, [[(3,)]], "id bigint")
    with pytest.raises(StreamingQueryException):
        control.run_with_restarts(lambda: one_file_per_batch(spark, out, "id bigint").writeStream
                                  .foreachBatch(lambda b, i: 1 / 0).option("checkpointLocation", str(tmp_path / "d"))
                                  .trigger(availableNow=True).start(), restarts=1)


def test_repeated_batch_replaces_itself(spark, out):
    batch = spark.createDataFrame([("0xAb",), ("0xBc",), ("x",)], "ident string")
    write = batch_writers.fan_out(out, batch_writers.third_letter("ident"))
    write(batch, 0)
    write(batch, 0)
    write(batch, 1)
    rows = spark.read.parquet(out)
    assert rows.count() == 6
    assert sorted((r.name or "", r.batch_id, r.n) for r in
                  rows.groupBy("name", "batch_id").agg(F.count(F.lit(1)).alias("n")).collect()) == [
        ("", 0, 1), ("", 1, 1), ("A", 0, 1), ("A", 1, 1), ("B", 0, 1), ("B", 1, 1)]
    assert os.path.isdir(os.path.join(out, "name=A", "batch_id=0"))


def test_several_sinks_share_a_batch_and_errors_surface(spark, tmp_path):
    batch = spark.range(10)
    paths = [str(tmp_path / n) for n in "ab"]
    batch_writers.to_all([runner.per_batch_writer(p) for p in paths])(batch, 0)
    assert [spark.read.parquet(p).count() for p in paths] == [10, 10]
    assert not batch.is_cached

    def broken(df, batch_id):
        raise ValueError("no")

    with pytest.raises(ValueError):
        batch_writers.to_all([broken, runner.per_batch_writer(paths[0])])(batch, 1)


LATE = [[(NOON, "a")], [(NOON - dt.timedelta(hours=12), "b")], [(NOON - dt.timedelta(hours=12), "c")],
        [(NOON - dt.timedelta(hours=12), "d")]]


def test_late_rows_are_judged_by_the_watermark_before(spark, out):
    """The first old row still counts; the ones after it are dropped."""
    write_files(spark, out, LATE, "ts timestamp, k string")
    stream = one_file_per_batch(spark, out, "ts timestamp, k string")
    counts = stateful.windowed(stream, ["k"], "ts", "10 minutes", "10 minutes", F.count(F.lit(1)).alias("n"))
    got = runner.update_result(counts, ["k", "window_start", "window_end"])
    assert sorted(r.k for r in got.collect()) == ["a", "b"]
    stream = one_file_per_batch(spark, out, "ts timestamp, k string")
    got = runner.append_result(stateful.dedup_with_watermark(stream, ["k"], "ts", "10 minutes"))
    assert sorted(r.k for r in got.collect()) == ["a", "b"]


def test_state_is_off_the_heap(spark, arrivals, tmp_path):
    unique = stateful.dedup(stream_arrivals(spark, arrivals), ["user_id", "event_type"])
    query = (unique.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    state = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    assert state and all(any("rocksdb" in name for name in s["customMetrics"]) for s in state)


def test_state_settings_bound_the_partitions(spark):
    from sparkloom.session import child_session, state_settings
    cores = spark.sparkContext.defaultParallelism
    many = child_session(spark, {"spark.sql.shuffle.partitions": "5000"})
    assert state_settings(many)["spark.sql.shuffle.partitions"] == str(2 * cores)
    assert state_settings(spark)["spark.sql.shuffle.partitions"] == "4"


@pytest.mark.parametrize("sizes", [(100, 1, 100, 1), (1, 1, 95, 7)])
def test_bursty_times_give_even_batches(spark, out, tmp_path, sizes):
    rows = [(NOON + dt.timedelta(hours=h, seconds=k), h * 1000 + k) for h, n in enumerate(sizes) for k in range(n)]
    rows.append((NOON + dt.timedelta(hours=len(sizes)) - dt.timedelta(seconds=1), 99_999))
    per_slice = -(-len(rows) // 4)
    staged = stage_arrivals(spark.createDataFrame(rows, "ts timestamp_ntz, k int"), "ts", out, slices=4, rows_per_file=10)
    assert staged.files_per_slice > 1
    seen = {}
    runner.run_available(stream_arrivals(spark, staged).writeStream.foreachBatch(
        batch_writers.counted(runner.per_batch_writer(str(tmp_path / "w")), lambda b, n: seen.update({b: n}))),
        str(tmp_path / "c"))
    assert [seen[k] for k in sorted(seen)] == [per_slice] * 3 + [len(rows) - 3 * per_slice]
    batches = spark.read.parquet(str(tmp_path / "w")).groupBy("batch_id").agg(F.min("ts"), F.max("ts")).orderBy("batch_id")
    spans = [(r[1], r[2]) for r in batches.collect()]
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_late_data_does_not_depend_on_file_counts(spark, sf_dir, monkeypatch):
    import __spark_entry__ as entry_module
    from check_oracle import compare, connect
    from sparkloom.streaming import staging
    monkeypatch.setattr(staging.stage_arrivals, "__defaults__", (None, 40, ()))
    monkeypatch.setattr("sparkloom.scratch._staged", {})
    df = entry_module.queries()["st_late_data"](spark, sf_dir)
    assert compare(connect(sf_dir), entry_module.oracle_sql()["st_late_data"], df) is None


def test_slices_grow_with_the_rows():
    from sparkloom.streaming import staging
    assert staging.slices_for(10) == 4 and staging.slices_for(10**9) == 20


def test_one_sided_join_keeps_early_clicks(spark, tmp_path):
    clicks = [(NOON, "u", 1), (NOON + dt.timedelta(hours=3), "u", 2), (NOON + dt.timedelta(hours=9), "u", 3)]
    buys = [(NOON + dt.timedelta(hours=2), "u", 10), (NOON + dt.timedelta(hours=8), "u", 11)]
    write_files(spark, str(tmp_path / "l"), [clicks[:2], clicks[2:]], "lt timestamp, k string, l int")
    write_files(spark, str(tmp_path / "r"), [buys[:1], buys[1:]], "rt timestamp, k string, r int")
    left = one_file_per_batch(spark, str(tmp_path / "l"), "lt timestamp, k string, l int")
    right = one_file_per_batch(spark, str(tmp_path / "r"), "rt timestamp, k string, r int")
    for join, want in ((stateful.join_not_after, [(1, 10), (1, 11), (2, 10), (2, 11), (3, 11)]),
                       (stateful.join_interval, [(2, 10), (3, 11)])):
        got = runner.append_result(join(left, right, "k", "lt", "rt", 3600, "20 hours", "20 hours").select("l", "r"))
        assert sorted(tuple(r) for r in got.collect()) == want
        salted = runner.append_result(join(left, right, "k", "lt", "rt", 3600, "20 hours", "20 hours", ["l"], 3)
                                      .select("l", "r"))
        assert sorted(tuple(r) for r in salted.collect()) == want


def test_append_without_watermark_is_refused(spark, arrivals):
    counts = stream_arrivals(spark, arrivals).groupBy("event_type").count()
    with pytest.raises(AnalysisException):
        counts.writeStream.outputMode("append").format("noop").start()


def test_sliding_stream_window_equals_batch(spark, sf_dir, arrivals):
    counts = stateful.windowed(stream_arrivals(spark, arrivals), [], "ts", "2 hours", "30 days",
                               F.count(F.lit(1)).alias("n"), slide="1 hour")
    got = runner.update_result(counts, ["window_start", "window_end"])
    want = (table(spark, sf_dir, "events").groupBy(F.window("ts", "2 hours", "1 hour").alias("w"))
            .agg(F.count(F.lit(1)).alias("n")))
    assert sorted((r.window_start, r.n) for r in got.collect()) == sorted((r.w.start, r.n) for r in want.collect())


def test_zone_less_time_cannot_have_a_watermark(spark, sf_dir, out):
    table(spark, sf_dir, "events").write.parquet(out)
    stream = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(out)
    with pytest.raises(AnalysisException):
        stream.withWatermark("ts", "1 hour").groupBy("ts").count().writeStream.format("noop").start()


def test_salted_dedup_drops_the_same_late_rows(spark, out):
    rows = [[(NOON, "a"), (NOON, "a")], [(NOON - dt.timedelta(hours=12), "b")] * 5,
            [(NOON - dt.timedelta(hours=12), "c"), (NOON, "a")], [(NOON + dt.timedelta(hours=1), "d")] * 3]
    schema = "ts timestamp, k string"
    write_files(spark, out, [[(t, k, i * 10 + j) for j, (t, k) in enumerate(batch)] for i, batch in enumerate(rows)],
                schema + ", id int")

    def run(*salting):
        stream = one_file_per_batch(spark, out, schema + ", id int")
        unique = stateful.dedup_with_watermark(stream, ["k"], "ts", "10 minutes", *salting)
        return sorted(r.k for r in runner.append_result(unique).collect())

    assert run() == ["a", "b", "d"] and run(["id"], 3) == ["a", "b", "d"]


# --- custom source and sink --------------------------------------------------------------------------

def test_custom_source(spark, tmp_path):
    custom.register(spark)
    with pytest.raises(Exception):
        spark.readStream.format(custom.SOURCE_NAME).load().isStreaming
    stream = (spark.readStream.schema("id INT, value STRING").format(custom.SOURCE_NAME)
              .option("batches", 3).load())
    target, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    query = (stream.writeStream.foreachBatch(runner.per_batch_writer(target))
             .option("checkpointLocation", checkpoint).trigger(processingTime="200 milliseconds").start())
    deadline = time.time() + 90
    while time.time() < deadline:
        done = [b for b in (query.recentProgress or []) if b["numInputRows"] > 0]
        if sum(b["numInputRows"] for b in done) >= 18:
            break
        time.sleep(0.2)
    assert control.stop_gracefully(query)
    rows = spark.read.parquet(target)
    assert sorted((r.id, r.value) for r in rows.collect()) == [(i, f"value-{i}") for i in range(18)]
    assert rows.filter("batch_id = 0").count() % 6 == 0


def test_custom_source_partitions_follow_the_offsets():
    reader = custom.NumberedReader({"partitions": "2", "rows": "3"})
    assert reader.initialOffset() == {"batch": 0} and reader.latestOffset() == {"batch": 1}
    parts = reader.partitions({"batch": 0}, {"batch": 2})
    assert [(p.batch, p.index) for p in parts] == [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert [i for p in parts for i, _ in reader.read(p)] == list(range(12))
    assert list(reader.partitions({"batch": 5}, {"batch": 5})) == [] and reader.latestOffset() == {"batch": 6}


def test_custom_sink(spark, sf_dir, arrivals, tmp_path):
    custom.register(spark)
    target = str(tmp_path / "sink")
    stream = inserts.render_inserts(stream_arrivals(spark, arrivals).select("event_id", "ts", "event_type"), "foo")
    runner.run_available(stream.writeStream.format(custom.SINK_NAME).option("path", target), str(tmp_path / "c"))
    want = inserts.render_inserts(table(spark, sf_dir, "events").select("event_id", "ts", "event_type"), "foo")
    got = sorted(r.statement for r in custom.committed_statements(spark, target).collect())
    assert got == sorted(r.statement for r in want.collect())
    assert custom.committed_statements(spark, f"file://{target}").count() == len(got)
    with pytest.raises(Exception):
        runner.run_available(stream_arrivals(spark, arrivals).writeStream.format(custom.SINK_NAME)
                             .option("path", target), str(tmp_path / "c2"))


def test_custom_sink_leaves_uncommitted_files_out(spark, tmp_path):
    writer = custom.StatementsWriter(f"file://{tmp_path}")
    (tmp_path / "part-00000-x.sql").write_text("INSERT 1\n")
    writer.abort([custom.WrittenFile("part-00000-x.sql", 1), None], 0)
    assert not (tmp_path / "part-00000-x.sql").exists()
    for name in "yzw":
        (tmp_path / f"part-00000-{name}.sql").write_text(f"INSERT {name}\n")
    writer.commit([custom.WrittenFile("part-00000-y.sql", 1)], 0)
    writer.commit([custom.WrittenFile("part-00000-z.sql", 1)], 0)  # the batch is repeated
    assert [r.statement for r in custom.committed_statements(spark, str(tmp_path)).collect()] == ["INSERT z"]
