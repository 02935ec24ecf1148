"""Rules with state against plain Python, and the parts that keep state between runs."""

import json
import random
import time
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sessionlens.operators import conflict, dedup, fold, keystore, late, lookups, report, serve, serving, validate
from sessionlens.plans import pipeline
from sessionlens.sources import files, projection, sinks
from sessionlens.streaming import pipeline as stream
from sessionlens.streaming import progress
from sessionlens.streaming.commits import CommitLog, Snapshots

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


@pytest.mark.parametrize(("ttl", "chunk"), [(3600, 256), (0, 3), (50, 2), (100_000, 256)])
def test_ttl_against_a_loop(spark, monkeypatch, ttl, chunk):
    monkeypatch.setattr(fold, "CHUNK", chunk)
    rng = random.Random(ttl)
    spans = {"hot": 60 * (ttl + 1), "few": 3 * (ttl + 1), "far": 10**9}
    rows = [(i, (k := rng.choice(["hot", "hot", "few", "far"])), rng.choice(["Start", "Stop"]), rng.randrange(spans[k]) if rng.random() > 0.02 else None) for i in range(3000)]
    rows += [(5000, None, "Start", 5), (5001, None, "Start", 5)]
    df = spark.createDataFrame(rows, "seq long, acct_session_id string, acct_status_type string, at long").withColumn("event_ts", F.timestamp_seconds("at")).repartition(7)
    last, want = {}, {}
    for seq, k, s, at in sorted(rows, key=lambda r: (r[3] is None, r[3] or 0, r[0])):
        if at is None or k is None:
            want[seq] = False
            continue
        fresh = (k, s) not in last or at - last[k, s] > ttl
        last[k, s] = at if fresh else last[k, s]
        want[seq] = not fresh
    got = dedup.mark_ttl(df, ttl)
    assert {r.seq: r.is_duplicate for r in got.collect()} == want and got.columns == [*df.columns, "is_duplicate"]
    assert not any(x in plan_of(got) for x in ("Python", "Arrow", "Pandas"))


def slot_machine(rows):
    """Sequence numbers of conflict B, by a loop over each imsi's records."""
    out, slot = set(), {}
    for seq, imsi, session, status, at, is_a in sorted(rows, key=lambda r: (r[4] is None, r[4] or 0, r[0])):
        if is_a or imsi is None:
            continue
        if status == "Start":
            if slot.get(imsi) is None:
                slot[imsi] = session
            elif slot[imsi] != session:
                out.add(seq)
        elif status == "Stop" and slot.get(imsi) == session:
            slot[imsi] = None
    return out


@pytest.mark.parametrize(("sessions", "chunk"), [(3, 256), (40, 2), (400, 50)])
def test_slots_against_a_loop(spark, monkeypatch, sessions, chunk):
    monkeypatch.setattr(fold, "CHUNK", chunk)
    rng = random.Random(sessions)
    rows = []
    for i in range(4000):
        imsi = rng.choice(["hot", "hot", "hot", "a", "b", None])
        near = rng.randrange(max(1, i * sessions // 4000), max(2, i * sessions // 4000 + 3))
        rows.append((i, imsi, f"s{near}", rng.choice(["Start", "Stop", "Stop", "Interim-Update"]), rng.choice([i, i, i // 5 * 5, None]) if i % 50 == 0 else i, rng.random() < 0.05))
    df = spark.createDataFrame(rows, "seq long, imsi string, acct_session_id string, acct_status_type string, at long, is_a boolean").withColumn("event_ts", F.timestamp_seconds("at")).repartition(6)
    got = conflict.mark_b(df)
    assert {r.seq for r in got.where("is_b").collect()} == slot_machine(rows) and got.count() == len(rows)
    assert not any(x in plan_of(got) for x in ("Python", "Arrow", "Pandas"))


def test_calm_pieces_are_apart(spark):
    """A long history without overlaps is cut at every session, so nothing of it is folded."""
    rows = [(2 * i + k, "one", f"s{i}", ("Start", "Stop")[k], 2 * i + k, False) for i in range(500) for k in (0, 1)]
    df = spark.createDataFrame(rows, "seq long, imsi string, acct_session_id string, acct_status_type string, at long, is_a boolean").withColumn("event_ts", F.timestamp_seconds("at"))
    assert conflict.overlaps(df).count() == 0


def test_pages_at_any_depth(spark):
    rows = spark.range(1_200_000).select((F.col("id") * 7919 % 1_200_007).alias("k"), F.lit("x").alias("kind"))
    order = [r.k for r in rows.orderBy("k").collect()]
    for number in (1, 150, 201, 20_500, 24_000, 24_001):
        got = lookups.page(rows, ["k"], number, 50)
        assert [r.k for r in got.orderBy("k").collect()] == order[(number - 1) * 50 : number * 50]
        assert all((r.total, r.pages) == (1_200_000, 24_000) for r in got.collect())
    ranked = lookups.Ranked(rows, ["k"], 9)
    assert sorted(r.k for r in ranked.between(399_990, 800_010).collect()) == order[399_990:800_010] and "PushedFilters: [" in plan_of(ranked.between(0, 5))
    ranked.delete()
    empty = lookups.Ranked(rows.limit(0), ["k"])
    assert empty.total == 0 and empty.between(0, 50).count() == 0


def test_key_store(spark, tmp_path):
    store = keystore.KeyStore(spark, "keys_of_a_test", str(tmp_path / "keys"), 8)
    key = lambda n: spark.range(n).select(F.concat(F.lit("s"), F.col("id")).alias("acct_session_id"), F.when(F.col("id") % 2 == 0, "Start").otherwise("Stop").alias("acct_status_type"), F.timestamp_seconds("id").alias("first_seen_at"))
    store.add(key(300))
    store.add(key(500).where("first_seen_at >= timestamp_seconds(300)"))
    records = key(600).withColumn("seq", F.monotonically_increasing_id()).withColumn("event_ts", F.col("first_seen_at"))
    marked = dedup.mark_long_term(records, store.keys())
    assert marked.where("is_duplicate").count() == 500
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = plan_of(dedup.mark_long_term(records, store.keys())).splitlines()
        scan = next(i for i, x in enumerate(lines) if "keys_of_a_test" in x or "Bucketed: true" in x)
        join = next(i for i, x in enumerate(lines) if "Join" in x)
        depth = lambda x: len(x) - len(x.lstrip(" :+-*(0123456789)"))
        above = [x for i, x in enumerate(lines[:scan]) if i > join and depth(x) < depth(lines[scan]) and x.lstrip().startswith("+-")]
        assert "Bucketed: true" in lines[scan] and not any("Exchange" in x for x in above)
        again = keystore.KeyStore(spark, "same_keys_again", str(tmp_path / "keys"), 8)
        assert again.keys().count() == 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_batches_are_whole(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "out"))
    rows = lambda n: spark.range(n)

    def fails(folder):
        rows(1).write.parquet(folder)
        raise OSError("killed between two sinks")

    log.write(0, {"a": rows(3).write.parquet, "b": rows(4).write.parquet}, ["b"])
    with pytest.raises(OSError):
        log.write(1, {"a": rows(5).write.parquet, "b": fails}, ["b"])
    count = lambda: (log.read("a", "id long").count(), log.read("b", "id long").count())
    assert count() == (3, 4) and log.batches() == [0]
    assert spark.read.parquet(str(tmp_path / "out" / "b")).count() == 4  # what a file stream would see
    assert log.write(1, {"a": rows(5).write.parquet, "b": rows(6).write.parquet}, ["b"]) and count() == (8, 10)
    assert not log.write(1, {"a": fails, "b": fails}, ["b"]) and count() == (8, 10)
    assert log.sweep() == 2 and count() == (8, 10) and log.read("c", "id long").count() == 0


def test_a_move_is_finished_later(spark, tmp_path, monkeypatch):
    log = CommitLog(spark, str(tmp_path))
    monkeypatch.setattr(CommitLog, "_publish", lambda self, folders: (_ for _ in ()).throw(OSError("killed before the move")))
    with pytest.raises(OSError):
        log.write(0, {"b": spark.range(4).write.parquet}, ["b"])
    monkeypatch.undo()
    assert log.read("b", "id long").count() == 4 and not (tmp_path / "b").exists()
    assert not log.write(0, {"b": spark.range(9).write.parquet}, ["b"]) and spark.read.parquet(str(tmp_path / "b")).count() == 4


def test_pinned_versions(spark, tmp_path):
    table = Snapshots(spark, str(tmp_path))
    assert table.publish(spark.range(3)) == 1
    assert table.pinned("r", 7).count() == 3
    assert table.publish(spark.range(9)) == 2
    assert table.pinned("r", 7).count() == 3 and table.pinned("r", 8).count() == 9 and table.pinned("other", 7).count() == 9
    assert table.read().count() == 9 and table.read(1).count() == 3


def parts(spark):
    d = projection.dims(spark, SF)
    return {"tac": d.tac, "subscribers": d.subscribers, "countries": d.countries, "prefixes": d.prefixes}


def test_replayed_batch_reads_what_it_read(spark, tmp_path):
    raw = projection.accounting(spark, SF)
    known = Snapshots(spark, str(tmp_path / "subscribers"))
    known.publish(parts(spark)["subscribers"])
    write = stream.check_writer(str(tmp_path / "out"), parts(spark) | {"subscribers": known})
    write(raw, 0)
    first = CommitLog(spark, str(tmp_path / "out")).read("valid", spark.read.parquet(str(tmp_path / "out" / "valid")).schema).count()
    known.publish(parts(spark)["subscribers"].limit(0))
    again = stream.check_writer(str(tmp_path / "again"), parts(spark) | {"subscribers": known})
    again(raw, 0)  # the batch's pin holds, under another path too
    assert spark.read.parquet(str(tmp_path / "again" / "valid")).count() == first > 0
    again(raw, 1)
    assert spark.read.parquet(str(tmp_path / "again" / "valid")).where("batch LIKE '1-%'").count() == 0


def test_stages_with_pinned_tables(spark, tmp_path):
    """Two stages over three batches: the same valid records and accepted ones as in one batch run; counts add up; progress is kept."""
    raw = projection.accounting(spark, SF)
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    log = progress.ProgressLog(spark, str(tmp_path / "log"))
    spark.streams.addListener(log)
    try:
        for k in range(3):
            raw.where(F.col("seq") % 3 == k).repartition(1).drop("seq").write.mode("append").json(folder)
            source = files.file_stream(spark, folder)
            assert progress.unread_files(spark, folder, f"{tmp_path}/c/checks").where("length > 0").count() == 1
            stream.start_checked(source, parts(spark), out, f"{tmp_path}/c").awaitTermination()
            assert progress.unread_files(spark, folder, f"{tmp_path}/c/checks").where("length > 0").count() == 0
        schema = spark.read.parquet(f"{out}/valid").drop("batch").schema
        histories = projection.sim_history(spark, SF), projection.device_history(spark, SF)
        stream.start_valid(spark, out, schema, *histories, f"{tmp_path}/c").awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
    finally:
        spark.streams.removeListener(log)
    annotated = late.mark_late(validate.annotate(validate.normalised(raw), projection.dims(spark, SF)))
    checks = CommitLog(spark, out)
    assert checks.batches() == [0, 1, 2]
    assert checks.read("valid", schema).count() == validate.valid(annotated).count()
    chain = CommitLog(spark, f"{out}/chain")
    marked_schema = spark.read.parquet(*chain.folders("marked")).schema
    marked = chain.read("marked", marked_schema)
    assert marked.count() == dedup.drop_ttl(validate.valid(annotated)).count()
    kept = lambda df: {(str(r.day), r.name): r.n for r in df.collect()}
    assert kept(report.merged_counts(chain.read("counts", "day date, name string, n long"))) == kept(report.batch_counts(marked))
    sessions = serving.merged_sessions(chain.read("sessions", "msisdn string, acct_session_id string, started timestamp, stopped timestamp"))
    as_of = F.timestamp_seconds(F.lit(1706659200))
    asked = marked.select(F.col("msisdn").alias("phone_number")).distinct()
    answers = lambda df: {(r.phone, r.verified) for r in df.collect()}
    assert answers(serving.verified_numbers(asked, sessions, as_of)) == answers(serve.number_verify(asked, marked, as_of))
    assert answers(serving.verified_numbers(asked, serving.still_needed(sessions, as_of), as_of)) == answers(serve.number_verify(asked, marked, as_of))
    rows, waits = [], 0
    while sum(r.status == "STOPPED" for r in rows) < 4 and waits < 50:  # events come after the fact
        rows, waits = progress.progress_table(spark, str(tmp_path / "log")).collect(), waits + 1
        time.sleep(0.2)
    assert {r.query for r in rows if r.status == "ACTIVE"} == {"checks", "chain"} and sum(r.status == "STOPPED" for r in rows) == 4
    assert sum(r.input_rows for r in rows if r.query == "checks") == raw.count()


def test_backlog_after_an_outage(spark, tmp_path):
    """STR-1: a backlog read in pieces, long after its time: by arrival the stream keeps what a batch keeps, by a short clock it doesn't.
    State goes once arrivals are past it; rows behind the watermark are dropped and counted; those without an arrival stay."""
    rng = random.Random(8)
    delays = {f"k{k}": rng.randrange(3600) for k in range(40)}
    at = [(k, rng.randrange(86_400)) for k in delays for _ in range(rng.choice([1, 30]))]
    rows = [(k, "Start", t, t + delays[k]) for k, t in at] + [(k, "Start", t, t + delays[k]) for k, t in at[:50]]
    rows.sort(key=lambda r: r[3])
    rows = [(i, *r) for i, r in enumerate(rows)]
    schema = "seq long, acct_session_id string, acct_status_type string, at long, arrived long"
    timed = lambda df: df.withColumn("event_ts", F.timestamp_seconds("at")).withColumn("ingest_ts", F.timestamp_seconds("arrived"))
    want = {r.seq for r in dedup.drop_ttl(timed(spark.createDataFrame(rows, schema))).collect()}
    folder = str(tmp_path / "in")

    def step(part, name, **how):
        """The rows that one more file adds to a stream that was down, and its last progress."""
        if part:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        live = timed(spark.readStream.schema(schema).parquet(folder))
        q = stream.dedup_stream(live, **how).writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", f"{tmp_path}/{name}-c").trigger(availableNow=True).start()
        q.awaitTermination()
        return progress.row_of(json.loads(q.lastProgress.json))

    got = lambda name: {r.seq for r in spark.read.parquet(str(tmp_path / name)).collect()}
    cut = [0, len(rows) // 3, 2 * len(rows) // 3, len(rows)]
    for lo, hi in zip(cut, cut[1:], strict=False):
        dropped = step(rows[lo:hi], "arrival", disorder=1)["dropped"]
        assert dropped == 0
        step([], "clock", keep_ms=1)
    assert got("arrival") == want
    assert got("clock") != want  # a forgotten key starts anew: other rows of it are kept from there on
    day = 86_400 * 10
    step([(9001, "far", "Start", day, day)], "arrival", disorder=1)
    last = step([(9002, "far", "Start", day + 5000, day + 5000), (9003, "old", "Start", 5, 5), (9004, "none", "Start", 7, None)], "arrival", disorder=1)
    assert last["dropped"] == 1 and got("arrival") == want | {9001, 9002, 9004}
    left = spark.read.format("statestore").option("path", f"{tmp_path}/arrival-c").option("stateVarName", "last").load()
    assert {r.id for r in left.select("key.acct_session_id").toDF("id").collect()} == {"far"}


def test_behind_of_topics():
    source = {"endOffset": {"t": {"0": 5, "1": 7}}, "latestOffset": json.dumps({"t": {"0": 9, "1": 7, "2": 3}})}
    assert progress.behind(source) == 7
    assert progress.behind({"endOffset": {"logOffset": 3}, "latestOffset": {"logOffset": 4}}) is None and progress.behind({"endOffset": None, "latestOffset": None}) is None


def test_connector_options(monkeypatch, spark):
    """SRC-3, SRC-11, SNK-1 as far as they go without their connectors: what would be asked of them."""
    asked = defaultdict(dict)

    class Fake:
        def __init__(self, kind):
            self.kind = kind

        def format(self, name):
            asked[self.kind]["format"] = name
            return self

        def options(self, **options):
            asked[self.kind] |= options
            return self

        def load(self):
            return spark.createDataFrame([("{}", 0, 1)], "value string, partition int, offset long")

        save = load

    class Session:
        readStream, read = Fake("topic"), Fake("jdbc")

    assert files.topic_stream(Session, "h:9", "t").columns[-1] == "seq"
    assert asked["topic"]["format"] == "kafka" and asked["topic"]["subscribe"] == "t" and asked["topic"]["startingOffsets"] == "earliest" and asked["topic"]["failOnDataLoss"] == "false"
    files.read_jdbc(Session, "jdbc:x", "people", "id", 1, 100, 7)
    assert asked["jdbc"] == {"format": "jdbc", "url": "jdbc:x", "dbtable": "people", "partitionColumn": "id", "lowerBound": "1", "upperBound": "100", "numPartitions": "7"}
    monkeypatch.setattr(type(spark.range(1)), "write", property(lambda self: Fake("sink")))
    sinks.write_topic(spark.createDataFrame([("+84", "x")], "msisdn string, imei string"), "h:9", "clean")
    assert asked["sink"]["format"] == "kafka" and asked["sink"]["topic"] == "clean" and asked["sink"]["kafka.acks"] == "1"


def test_outputs_can_go(spark):
    out = pipeline.process(projection.accounting(spark, SF), projection.dims(spark, SF), projection.sim_history(spark, SF), projection.device_history(spark, SF))
    assert "MapInArrow" not in plan_of(out.stored)
    folder = Path(out.marked.scratch_path.removeprefix("file:"))
    assert folder.exists()
    out.delete()
    assert not folder.exists()
