import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.operators.curate import CURATED, curate, current_revision
from tickloom.operators.ingest import classify, dead_letters, price_rows, split_counts
from tickloom.operators.parse import parse_ticks
from tickloom.plans import adapters as A
from tickloom.session import work_folder
from tickloom.sources.readers import file_messages
from tickloom.sources.tables import Batch, PipelineTables
from tickloom.sources.writers import read_batches, replayable
from tickloom.streaming.ingest import ingest_batch
from tickloom.streaming.jobs import curated_batch, curation_job, merged_curation_job
from tickloom.streaming.merge import current_windows, merge_batch
from tickloom.streaming.windows import STATE_STORE, curated_stream, run_to_end, to_sink, use_disk_state

T = dt.datetime(2026, 1, 1)
CURATED_DDL = (
    "batch_time timestamp, symbol string, avg_price double, min_price double, max_price double, "
    "total_volume bigint, event_count bigint, latest_event_time timestamp"
)
DDL = "topic string, partition int, offset bigint, arrival timestamp, value binary"


def tick(symbol, volume, second):
    name = "null" if symbol is None else f'"{symbol}"'
    stamp = (T + dt.timedelta(seconds=second)).isoformat() + "+00:00"
    return f'{{"symbol": {name}, "price": 2.0, "open": 2, "high": 2, "low": 2, "volume": {volume}, "event_time": "{stamp}"}}'


def deliver(spark, folder, payloads, first=0):
    rows = [("t", 0, first + n, T, bytearray(p, "utf-8")) for n, p in enumerate(payloads)]
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(folder)


RUNS = {
    "a": [tick("A", 10, 10), tick("A", 20, 59), tick("A", 5, 60), "junk", tick(None, 7, 0)],
    "b": [tick("A", 1, 30), tick("A", 9, 540)],
    "c": [tick("A", 100, 30), tick("A", 100, 430), tick("A", 50, 390)],
    "d": [tick("A", 100, 400 + 20), tick("A", 3, 440)],
}
UPDATES = {
    "a": [(1, "A", 30, 2), (1, None, 7, 1), (2, "A", 5, 1)],
    "b": [(1, "A", 31, 3), (10, "A", 9, 1)],
    "c": [(8, "A", 100, 1)],
    "d": [(8, "A", 203, 3)],
}


def stream_of(spark, folder, sink, mode):
    ticks = parse_ticks(file_messages(spark, f"{folder}/topic", ddl=DDL))
    return to_sink(curated_stream(ticks), replayable(sink), f"{folder}/{mode}", mode, drain=True)


def test_update_sequence(spark):
    """Revisions per run, late rows dropped by the watermark of the run before."""
    folder = work_folder(spark, "sequence")
    seen = set()
    for run, payloads in RUNS.items():
        deliver(spark, f"{folder}/topic", payloads)
        run_to_end(stream_of(spark, folder, f"{folder}/sink", "update"))
        rows = read_batches(spark, f"{folder}/sink", CURATED_DDL).collect()
        fresh = [r for r in rows if r.batch_id not in seen]
        seen |= {r.batch_id for r in rows}
        got = [((r.batch_time - T).total_seconds() / 60, r.symbol, r.total_volume, r.event_count) for r in fresh]
        assert sorted(got, key=str) == sorted([(float(m), *rest) for m, *rest in UPDATES[run]], key=str), run

    current = current_revision(read_batches(spark, f"{folder}/sink", CURATED_DDL)).collect()
    assert {(r.symbol, r.total_volume) for r in current} == {("A", 31), (None, 7), ("A", 5), ("A", 9), ("A", 203)}


def test_window_state_on_disk(spark):
    folder = work_folder(spark, "disk")
    use_disk_state(spark)
    try:
        for run in "ab":
            deliver(spark, f"{folder}/topic", RUNS[run])
            run_to_end(stream_of(spark, folder, f"{folder}/sink", "update"))
    finally:
        spark.conf.unset(STATE_STORE[0])
    current = current_revision(read_batches(spark, f"{folder}/sink", CURATED_DDL)).collect()
    assert {(r.symbol, r.total_volume) for r in current} == {("A", 31), (None, 7), ("A", 5), ("A", 9)}


def test_append_writes_closed_windows_once(spark):
    folder = work_folder(spark, "append")
    for payloads in RUNS.values():
        deliver(spark, f"{folder}/topic", payloads)
        run_to_end(stream_of(spark, folder, f"{folder}/sink", "append"))
    rows = read_batches(spark, f"{folder}/sink", CURATED_DDL).collect()
    got = sorted([((r.batch_time - T).total_seconds() / 60, r.symbol, r.total_volume) for r in rows], key=str)
    assert got == sorted([(1.0, "A", 31), (1.0, None, 7), (2.0, "A", 5)], key=str)


def rounded(curated):
    return curated.withColumn("avg_price", F.round("avg_price", 9)).select(*CURATED)


def test_stream_equals_batch_when_nothing_is_late(spark, sf_dir):
    folder, tables = new_tables(spark, "agree")
    messages = A.tick_messages(A.stream_table(spark, sf_dir, "events"))
    run_to_end(curation_job(messages, curated_batch(tables), f"{folder}/cp", drain=True))
    revisions = tables.read(spark, "stock_prices_curated").select("batch_id", *CURATED)
    streamed = rounded(current_revision(revisions))
    batch = rounded(curate(parse_ticks(A.tick_messages(A.read_table(spark, sf_dir, "events")))))
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


# Committed batches


def new_tables(spark, label):
    folder = work_folder(spark, label)
    return folder, PipelineTables(f"t_{folder.rsplit('-', 1)[-1]}", f"{folder}/tables").create(spark)


SERVED = ("stock_prices", "dead_letter_events", "pipeline_metrics", "pipeline_alerts")
STAMPED = ("inserted_at", "created_at")


def contents(spark, tables, names=SERVED):
    frames = {name: tables.read(spark, name) for name in names}
    return {n: sorted(map(str, f.drop(*STAMPED).collect())) for n, f in frames.items()}


def messages_of(spark, payloads, first=0):
    rows = [("t", 0, first + n, T, bytearray(p, "utf-8")) for n, p in enumerate(payloads)]
    return classify(spark.createDataFrame(rows, DDL))


PAYLOADS = [tick("A", n, n) for n in range(160)] + ["junk"] * 40


def test_replayed_batch_leaves_the_tables_unchanged(spark):
    _, tables = new_tables(spark, "again")
    write = ingest_batch(tables)
    write(messages_of(spark, PAYLOADS[:120]), 0)
    write(messages_of(spark, PAYLOADS[120:], 120), 1)
    before = contents(spark, tables)
    write(messages_of(spark, PAYLOADS[120:], 120), 1)
    assert contents(spark, tables) == before
    assert len(before["stock_prices"]) == 160 and len(before["dead_letter_events"]) == 40
    reports = tables.committed(spark, "reports").orderBy("processed").collect()
    assert [(r.processed, r.inserted, r.batch_id) for r in reports] == [(50, 50, 0), (100, 100, 0), (150, 150, 1)]


@pytest.mark.parametrize("stop_at", ["ingested", "reports", "raised_alerts", "totals", "commits"])
def test_a_batch_that_stopped_half_way_is_not_seen(spark, monkeypatch, stop_at):
    _, tables = new_tables(spark, "stopped")
    write = ingest_batch(tables)
    write(messages_of(spark, PAYLOADS[:120]), 0)
    before = contents(spark, tables)
    put, commit = Batch.write, Batch.commit

    def failing_write(batch, table, rows):
        put(batch, table, rows)
        if table == stop_at:
            raise RuntimeError("lost")

    def failing_commit(batch, **counts):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Batch, "write", failing_write)
        if stop_at == "commits":
            patch.setattr(Batch, "commit", failing_commit)
        with pytest.raises(RuntimeError, match="lost"):
            write(messages_of(spark, PAYLOADS[120:], 120), 1)
    assert contents(spark, tables) == before
    write(messages_of(spark, PAYLOADS[120:], 120), 1)
    whole = contents(spark, tables)
    assert len(whole["stock_prices"]) == 160 and len(whole["dead_letter_events"]) == 40
    assert tables.committed(spark, "reports").count() == 3 and commit is Batch.commit


def test_a_second_query_adds_to_the_first(spark):
    """A new checkpoint counts its batches from 0 again; the rows of the old one stay."""
    folder, tables = new_tables(spark, "second")
    deliver(spark, f"{folder}/topic", PAYLOADS)
    for checkpoint in ("one", "other"):
        rows = classify(file_messages(spark, f"{folder}/topic", ddl=DDL))
        run_to_end(to_sink(rows, ingest_batch(tables), f"{folder}/{checkpoint}", "append", drain=True))
    commits = tables.commits(spark).collect()
    assert len({r.run for r in commits}) == 2 and {r.batch_id for r in commits} == {0}
    assert tables.read(spark, "stock_prices").count() == 320
    assert sorted(r.processed for r in tables.committed(spark, "reports").collect()) == [50, 50, 100, 100, 150, 150]


def test_a_replay_on_another_day_replaces_the_batch(spark):
    _, tables = new_tables(spark, "days")
    days = [dt.datetime(2026, 1, 1, 23, 59), dt.datetime(2026, 1, 2, 0, 1)]
    for day in days:
        ingest_batch(tables, stamp=lambda _, day=day: day)(messages_of(spark, PAYLOADS), 0)
    rows = tables.read(spark, "stock_prices")
    assert rows.count() == 160 and {r.inserted_at for r in rows.select("inserted_at").distinct().collect()} == {days[1]}


def test_commits_count_what_was_split(spark, sf_dir):
    """Counted during the only write; nothing is cached."""
    _, tables = new_tables(spark, "counted")
    classified = classify(A.tick_messages(A.read_table(spark, sf_dir, "events")))
    ingest_batch(tables, health=False)(classified, 0)
    counts = tables.commits(spark).first()["counts"]
    by_status = {r.status: r.n for r in split_counts(classified).groupBy("status").agg(F.sum("messages").alias("n")).collect()}
    assert {s: counts[s] for s in by_status} == by_status and counts["messages"] == sum(by_status.values())
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()


def test_a_user_may_insert_without_a_stamp(spark):
    _, tables = new_tables(spark, "default")
    spark.sql(f"INSERT INTO {tables.name('ingested')} (symbol, price, day, run, batch_id, outcome) VALUES ('A', 1.5, DATE'2026-01-01', 'r', 0, 'inserted')")
    assert tables.read(spark, "stock_prices").count() == 0
    spark.sql(f"INSERT INTO {tables.name('commits')} (day, run, batch_id) VALUES (DATE'2026-01-01', 'r', 0)")
    row = tables.read(spark, "stock_prices").first()
    assert (row.symbol, row.price) == ("A", 1.5) and row.inserted_at is not None
    tables.create(spark)
    assert tables.read(spark, "stock_prices").count() == 1
    with pytest.raises(ValueError, match="no column"):
        tables.batch(spark, 1).write("reports", spark.range(1))


def test_counts_and_cooldown_survive_batches(spark):
    """Two batches a minute apart: the alert of the first silences the second, not the third."""
    _, tables = new_tables(spark, "carry")
    write = ingest_batch(tables)
    bad = '{"symbol": "A"}'
    for number, second in enumerate((0, 60, 130)):
        rows = [
            ("t", 0, 100 * number + n, T + dt.timedelta(seconds=second, milliseconds=n), bytearray(bad if n < 20 else tick("A", 1, n), "utf-8"))
            for n in range(50)
        ]
        write(classify(spark.createDataFrame(rows, DDL)), number)
    reports = tables.committed(spark, "reports").orderBy("processed").collect()
    assert [(r.processed, r.inserted, r.failed) for r in reports] == [(50, 30, 20), (100, 60, 40), (150, 90, 60)]
    raised = tables.committed(spark, "raised_alerts").orderBy("raised_at").collect()
    assert [(r.batch_id, (r.raised_at - T).seconds) for r in raised] == [(0, 0), (2, 130)]
    assert {r.reason for r in raised} == {"failure-threshold-reached"}


def test_batch_without_alerts_or_reports(spark):
    _, tables = new_tables(spark, "quiet")
    write = ingest_batch(tables)
    empty = spark.createDataFrame([], DDL)
    one = spark.createDataFrame([("t", 0, 1, T, bytearray(tick("A", 1, 1), "utf-8"))], DDL)
    for number, rows in enumerate((one, empty, one.withColumn("offset", F.lit(2).cast("bigint")))):
        write(classify(rows), number)
    assert tables.read(spark, "stock_prices").count() == 2
    totals = tables.committed(spark, "totals").where("batch_id = 2").first()
    assert (totals.processed, totals.inserted, totals.raised_at) == (2, 2, None)


# The maintained table of windows


def ticks_of(spark, payloads, first=0):
    rows = [("t", 0, first + n, T, bytearray(p, "utf-8")) for n, p in enumerate(payloads)]
    messages = spark.createDataFrame(rows, DDL).withColumn("payload", F.col("value").cast("string"))
    return parse_ticks(messages, keep=("topic", "partition", "offset", "arrival", "payload")).drop("open", "high", "low")


def windows_of(spark, tables):
    return sorted(((r.batch_time - T).total_seconds() / 60, str(r.symbol), r.total_volume, r.event_count) for r in current_windows(tables, spark).collect())


def test_late_ticks_are_kept_and_counts_add_up(spark):
    _, tables = new_tables(spark, "late")
    write, sent = merge_batch(tables), 0
    for number, payloads in enumerate(RUNS.values()):
        write(ticks_of(spark, payloads, sent), number)
        sent += len(payloads)
    # Run c: second 30 is late (540 seen), 390 too; run d: 420 and 440 close at 480, which is not past 540 - 120.
    assert windows_of(spark, tables) == sorted([(1, "A", 31, 3), (1, "None", 7, 1), (2, "A", 5, 1), (8, "A", 203, 3), (10, "A", 9, 1)])
    late = tables.read(spark, "dead_letter_events").collect()
    assert {(r.source_offset, r.error_message) for r in late} == {(7, "late"), (9, "late")}
    assert all('"symbol": "A"' in r.payload for r in late)
    counts = [r["counts"] for r in tables.commits(spark).collect()]
    assert sum(c["messages"] for c in counts) == sent == sum(c["on_time"] + c["late"] + c["untimed"] for c in counts)
    assert sum(c["untimed"] for c in counts) == 1


def test_a_merged_batch_that_runs_again_adds_nothing(spark, monkeypatch):
    _, tables = new_tables(spark, "merge")
    write, runs = merge_batch(tables), [RUNS["a"], RUNS["b"], RUNS["d"]]
    for number, payloads in enumerate(runs[:2]):
        write(ticks_of(spark, payloads), number)
    before = windows_of(spark, tables)
    put = Batch.write

    def failing(batch, table, rows):
        put(batch, table, rows)
        if table == "window_heads":
            raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Batch, "write", failing)
        with pytest.raises(RuntimeError, match="lost"):
            write(ticks_of(spark, runs[2]), 2)
    assert windows_of(spark, tables) == before
    for _ in range(2):
        write(ticks_of(spark, runs[2]), 2)
        assert windows_of(spark, tables) == sorted([*before, (8, "A", 103, 2)])


@pytest.mark.parametrize("other", [{"parts": 4}, {"parts": 2, "width": "1 hour"}])
def test_another_layout_is_refused(spark, other):
    """Windows of another length, or in other buckets, would stand beside the ones they belong to."""
    _, tables = new_tables(spark, "layout")
    merge_batch(tables, parts=2)(ticks_of(spark, RUNS["a"]), 0)
    with pytest.raises(ValueError, match="begun with"):
        merge_batch(tables, **other)(ticks_of(spark, RUNS["b"]), 1)
    merge_batch(tables, parts=2)(ticks_of(spark, RUNS["b"]), 1)
    assert windows_of(spark, tables) == [(1, "A", 31, 3), (1, "None", 7, 1), (2, "A", 5, 1), (10, "A", 9, 1)]


def test_only_touched_buckets_are_written(spark):
    _, tables = new_tables(spark, "buckets")
    write = merge_batch(tables, watermark="30 days", parts=4)
    days = [tick(f"S{n}", 1, 86_400 * (n % 3)) for n in range(60)]
    write(ticks_of(spark, days), 0)
    write(ticks_of(spark, [tick("S1", 5, 86_400)]), 1)
    versions = tables.committed(spark, "windows").select("window_day", "part", "batch_id").distinct().collect()
    assert sum(r.batch_id == 1 for r in versions) == 1 and sum(r.batch_id == 0 for r in versions) > 4
    held = {r.symbol: r.total_volume for r in current_windows(tables, spark).collect()}
    assert len(held) == 60 and held["S1"] == 6 and sum(held.values()) == 65


def test_maintained_table_equals_a_full_pass(spark, sf_dir):
    """Ticks in three runs by arrival, with a watermark that drops nothing."""
    folder, tables = new_tables(spark, "full")
    messages = A.in_parts(A.tick_messages(A.read_table(spark, sf_dir, "events")), "arrival", 3)
    A.write_topic(messages.withColumnRenamed("arrival", "timestamp"), f"{folder}/topic")
    topic = A.topic_stream(spark, f"{folder}/topic", DDL.replace("arrival", "timestamp"))
    run_to_end(merged_curation_job(topic, tables, f"{folder}/cp", "1 hour", "6 hours", drain=True))
    assert tables.commits(spark).count() == 3
    full = rounded(curate(parse_ticks(messages), "1 hour"))
    held = rounded(current_windows(tables, spark))
    assert held.exceptAll(full).count() == 0 and full.exceptAll(held).count() == 0


def test_part_of_a_topic_is_many_files_and_one_batch(spark):
    """A large part is written and read by many tasks; one with fewer rows than lanes is a batch of its own all the same."""
    folder = work_folder(spark, "lanes")
    sizes = {0: 2000, 1: 1, 4: 3}
    rows = [("t", 0, n, T, bytearray(b"{}"), part) for part, size in sizes.items() for n in range(size)]
    topic_ddl = DDL.replace("arrival", "timestamp")
    assert A.write_topic(spark.createDataFrame(rows, f"{topic_ddl}, part int"), f"{folder}/topic") == [0, 1, 4]
    filled = spark.read.parquet(f"{folder}/topic/part=0").groupBy(F.input_file_name()).count().collect()
    assert len(filled) == A.LANES and max(r["count"] for r in filled) < 2 * 2000 / A.LANES
    seen = {}

    def write(batch, batch_id):
        seen[batch_id] = batch.count()

    run_to_end(to_sink(A.topic_stream(spark, f"{folder}/topic", topic_ddl), write, f"{folder}/cp", "append", drain=True))
    assert seen == {0: 2000, 1: 1, 2: 3}


@pytest.mark.parametrize("rows", [0, 3])
def test_empty_batch_is_skipped(spark, rows):
    folder = work_folder(spark, "skip")
    replayable(folder)(spark.range(rows), 4)
    found = read_batches(spark, folder, "id bigint")
    assert found.columns == ["id", "batch_id"]
    assert found.where("batch_id = 4").count() == rows


def test_split_in_one_pass(spark, sf_dir):
    classified = classify(A.tick_messages(A.read_table(spark, sf_dir, "events"))).persist()
    good, bad = price_rows(classified).count(), dead_letters(classified).count()
    assert good + bad == A.read_table(spark, sf_dir, "events").count() and bad > 0
    classified.unpersist()


def test_health_may_be_switched_on_later(spark, sf_dir):
    """Counting starts with the first batch that reports health."""
    classified = classify(A.tick_messages(A.read_table(spark, sf_dir, "events").limit(60)))
    _, tables = new_tables(spark, "later")
    ingest_batch(tables, health=False)(classified, 0)
    ingest_batch(tables)(classified, 1)
    assert tables.committed(spark, "totals").first().processed == 60
