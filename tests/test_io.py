import json

import pytest
from pyspark.sql import functions as F

from sessionlens.operators import conflict, dedup, report, validate
from sessionlens.plans import pipeline
from sessionlens.schemas import RAW_COLUMNS
from sessionlens.sources import files, projection, sinks
from sessionlens.streaming import pipeline as stream

SF = "/root/testdata/sf0.001"


def parts(spark):
    return projection.dims(spark, SF), projection.sim_history(spark, SF), projection.device_history(spark, SF)


def texts(df, *columns):
    return sorted(map(str, (df.select(*columns) if columns else df).collect()))


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "r.csv")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(" msisdn , acct_status_type,other\n +31650000001 , Start ,1,overflow\n")
    got = files.read_csv(spark, str(tmp_path / "in")).first()
    assert (got.msisdn, got.acct_status_type, got.imsi) == ("+31650000001", "Start", None)
    made = projection.order_sessions(spark, SF)
    sinks.write_csv(made, path)
    assert files.count_csv(spark, path) == made.count()


def test_order_of_files(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text("acct_session_id\n" + "".join(f"{name}{i:05d}\n" for i in range(20_000)))
    got = files.read_csv(spark, str(tmp_path)).repartition(7).orderBy("seq").select("acct_session_id").collect()
    assert [r[0] for r in got] == [f"{name}{i:05d}" for name in "ab" for i in range(20_000)]


def test_messages(spark):
    raw = projection.order_sessions(spark, SF).drop("seq").limit(50)
    back = files.decode(sinks.to_messages(raw, "msisdn"))
    assert texts(back) == texts(raw)
    bad = files.decode(spark.createDataFrame([("{",)], "value string")).first()
    assert all(x is None for x in bad)
    assert files.topic_options("h:1", "t")["maxOffsetsPerTrigger"] == "20000"
    topic = sinks.to_messages(raw).select("value", F.lit(2).alias("partition"), F.monotonically_increasing_id().alias("offset"))
    assert files.decode_topic(topic).columns == [*RAW_COLUMNS, "seq"]
    assert files.decode_topic(topic.limit(1)).first().seq.split("/")[0] == "2".zfill(19)


def test_written_messages(spark, tmp_path):
    raw = projection.order_sessions(spark, SF).drop("seq").limit(50)
    sinks.write_messages(raw, str(tmp_path / "m"))
    back = files.decode(spark.read.schema("key string, value string").json(str(tmp_path / "m")))
    assert texts(back) == texts(raw)


def test_registries(spark, tmp_path):
    (tmp_path / "t.csv").write_text("tac_code,manufacturer,band_support\n000001,A,GSM;LTE\n000001,B,NR\n")
    got = files.read_tac(spark, str(tmp_path / "t.csv")).collect()
    assert [(r.manufacturer, r.band_support) for r in got] == [("B", ["NR"])]
    (tmp_path / "s.csv").write_text("imsi,msisdn,data_enabled,roaming_enabled,volte_enabled,registered_at\n1,+1,true,False,TRUE,2026-01-01T00:00:00+00:00Z\n")
    got = files.read_subscribers(spark, str(tmp_path / "s.csv")).first()
    assert got.service_profile.asDict() == {"data_enabled": True, "roaming_enabled": False, "volte_enabled": True} and got.registered_at is not None
    (tmp_path / "d.csv").write_text("msisdn,imei,assigned_at\n+1,9,1767225600\n+1,8,never\n")
    assert [(r.imei, r.assigned_at is None) for r in files.read_devices(spark, str(tmp_path / "d.csv")).orderBy("imei").collect()] == [("8", True), ("9", False)]
    (tmp_path / "c.csv").write_text("country_code,country_name\n84,Vietnam\n")
    (tmp_path / "p.csv").write_text("country_code,prefix\n84,97\n84,97\n")
    countries, prefixes = files.read_number_plan(spark, str(tmp_path / "c.csv"), str(tmp_path / "p.csv"))
    assert countries.count() == 1 and prefixes.count() == 1


def test_clean_sink(spark, tmp_path):
    out = pipeline.process(projection.accounting(spark, SF), *parts(spark))
    clean = sinks.clean_projection(out.clean)
    sinks.write_clean(clean, str(tmp_path / "c"))
    back = spark.read.parquet(str(tmp_path / "c"))
    assert back.count() == clean.count() and "event_month" in back.columns
    plan = back.where("event_month = '2024-01'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_month" in plan


def test_seen_keys(spark):
    """A second run over the same records stores nothing and logs all."""
    first = pipeline.process(projection.accounting(spark, SF), *parts(spark))
    keys = spark.createDataFrame(first.new_keys().collect(), first.new_keys().schema)
    again = pipeline.process(projection.accounting(spark, SF), *parts(spark), seen=keys)
    assert again.stored.count() == 0 and again.duplicate_log(F.col("ingest_ts")).count() == first.clean.count()


def test_report(spark, tmp_path):
    out = pipeline.process(projection.accounting(spark, SF), *parts(spark))
    path = str(tmp_path / "sub" / "report.html")
    sections = out.report() | {"<Odd>": spark.sql("SELECT '<b>&' AS x")}
    report.html_report(spark, sections, path, {"valid": {"status": "STOPPED"}})
    page = (tmp_path / "sub" / "report.html").read_text()
    assert page.count("<h2>") == 10 and "&lt;b&gt;&amp;" in page and "<b>" not in page and "STOPPED" in page
    assert f"<td>{out.stored.count()}</td>" in page
    with pytest.raises(ValueError):
        report.html_page({"Long": spark.range(2000)})


def run(queries):
    for q in queries:
        q.awaitTermination(180)
        assert q.exception() is None
        json.dumps(stream.progress(q), default=str)


def test_streams_equal_batch(spark, tmp_path):
    """Files of messages through both streams in three batches, each of whole sessions and subscribers, against the batch chain."""
    raw = projection.accounting(spark, SF).withColumn("user", F.substring_index(F.substring("acct_session_id", 6, 99), "_", 1))
    dims, sim, dev = parts(spark)
    at = {k: str(tmp_path / k) for k in ("in", "out", "chk", "store")}
    # A batch holds every record of its subscribers, so conflicts within batches are all conflicts.
    group = F.pmod(F.xxhash64("imsi", "msisdn"), F.lit(3))
    one = raw.where("msisdn LIKE '+3165%' AND imsi = concat('452010', lpad(user, 9, '0'))")
    for i in range(3):
        one.where(group == i).select(*RAW_COLUMNS).coalesce(1).write.mode("append").json(at["in"])
    queries = stream.start(files.file_stream(spark, at["in"], files_per_trigger=1), dims, sim, dev, at["out"], at["chk"])
    run(queries)
    assert sum(p["numInputRows"] > 0 for p in queries[1].recentProgress) == 3
    run([stream.start_storage(stream.clean_message_stream(spark, at["out"]), at["store"], at["chk"])])
    batch = spark.read.schema(", ".join(f"{c} string" for c in RAW_COLUMNS)).json(at["in"]).select("*", files.file_order(True))
    out = pipeline.process(batch, dims, sim, dev)
    read = lambda name, where="out": spark.read.parquet(f"{at[where]}/{name}").drop("batch", "event_month")
    assert texts(read("clean")) == texts(sinks.clean_projection(out.clean)) and out.clean.count() > 100
    assert read("conflict_log").count() == out.conflicts.count()
    assert read("invalid_log").count() == validate.invalid(out.annotated).count()
    assert texts(read("stored", "store")) == texts(sinks.clean_projection(out.stored))
    assert texts(read("duplicate_log", "store")) == texts(out.duplicate_log(F.col("ingest_ts")))


def test_state_expires_and_tables_are_reread(spark, tmp_path):
    """STR-4: a key's state goes once it is old enough; SRC-10: a reference table that grew counts from the next batch on."""
    at = {k: str(tmp_path / k) for k in ("in", "out", "chk", "sub")}
    spark.createDataFrame([("1",)], "imsi string").write.parquet(at["sub"])

    def batch(session, imsi):
        row = (session, "Start", f"17672256{session}", imsi, "a")
        spark.createDataFrame([row], "acct_session_id string, acct_status_type string, event_timestamp string, imsi string, seq string").coalesce(1).write.mode("append").json(at["in"])
        live = spark.readStream.schema("acct_session_id string, acct_status_type string, event_timestamp string, imsi string, seq string").json(at["in"])
        known = live.join(spark.read.parquet(at["sub"]).distinct(), "imsi", "left_semi").withColumn("event_ts", F.timestamp_seconds(F.col("event_timestamp").cast("long")))
        q = stream.dedup_stream(known, keep_ms=1).writeStream.format("parquet").option("path", at["out"]).option("checkpointLocation", at["chk"]).trigger(availableNow=True).start()
        run([q])
        return sum(s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"][-1:] if p["numInputRows"])

    assert batch("10", "1") == 1
    assert batch("20", "2") <= 1  # unknown yet
    spark.createDataFrame([("2",)], "imsi string").write.mode("append").parquet(at["sub"])
    batch("30", "2")
    assert {r.acct_session_id for r in spark.read.parquet(at["out"]).collect()} == {"10", "30"}
    left = spark.read.format("statestore").option("path", at["chk"]).option("stateVarName", "last").load().count()
    assert left < 2


def test_observed(spark):
    records = validate.annotate(validate.normalised(projection.accounting(spark, SF)), projection.dims(spark, SF))
    df, seen = stream.observed(records)
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["total"] == 1000


def test_chain_carries_what_is_asked_for(spark):
    """F2 to F17: every record's text columns went through all windows and tables, though no output of the query had them."""
    whole = pipeline.process(projection.accounting(spark, SF), *parts(spark))
    narrow = pipeline.process(projection.accounting(spark, SF), *parts(spark), carry=["framed_ip"])
    assert set(narrow.annotated.columns) == {*pipeline.OWN, "framed_ip"}
    for name in ("annotated", "marked", "stored", "repeated", "conflicts", "swaps"):
        a, b = getattr(whole, name), getattr(narrow, name)
        assert set(b.columns) <= set(a.columns)
        assert a.select(*b.columns).exceptAll(b).isEmpty() and b.exceptAll(a.select(*b.columns)).isEmpty()


def test_outputs_without_tables(spark, monkeypatch):
    """who reads one output needs neither table; hot sessions and keys that are folded go the longer way."""
    again = projection.accounting(spark, SF)
    raw = again.unionByName(again.where("seq % 3 = 0").withColumn("seq", F.col("seq") + 1_000_000))
    whole = pipeline.process(raw, *parts(spark))
    of = lambda df: sorted((r.seq, r.is_a, r.is_b, r.previous_imsi or "", r.previous_imei or "") for r in df.collect())
    want, seen = of(conflict.mark_conflicts(dedup.drop_ttl(validate.valid(whole.annotated)))), files.materialised(whole.new_keys().limit(20), "seen")
    assert of(whole.marked) == want
    assert whole.stored_keys.count() == whole.stored.count() > 0
    for hot in (500_000, 2):
        monkeypatch.setattr(dedup, "HOT", hot)
        lean = pipeline.process(raw, *parts(spark), seen=seen, carry=(), write=())
        assert of(lean.marked) == want and "FileScan parquet" in lean.marked._jdf.queryExecution().executedPlan().toString()
        assert lean.stored_keys.count() == lean.stored.count() < len(want) and bool(dedup.hot_buckets(raw)) == (hot == 2)
        lean.delete()
    whole.delete()
