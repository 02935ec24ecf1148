import random

import pytest
from pyspark.sql import functions as F

from sessionlens.operators import conflict, dedup, lookups, report, serve, swap

AS_OF = 1767225600


def records(spark, rows):
    """(session, status, epoch or None, msisdn, imsi, imei)"""
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "acct_session_id string, acct_status_type string, ev long, msisdn string, imsi string, imei string, seq long")
    return df.withColumn("event_ts", F.timestamp_seconds("ev"))


def row(session="S", status="Start", at=0, msisdn="m", imsi="i", imei="e"):
    return session, status, at, msisdn, imsi, imei


def test_ttl_boundaries(spark):
    rows = [row(at=0), row(at=3600), row(at=3601), row(at=7000), row(status="Stop", at=1), row(at=None)]
    got = {r.seq: r.is_duplicate for r in dedup.mark_ttl(records(spark, rows)).collect()}
    assert got == {0: False, 1: True, 2: False, 3: True, 4: False, 5: False}


def test_ttl_against_model(spark):
    rng = random.Random(5)
    rows = [row(f"S{rng.randrange(6)}", rng.choice(["Start", "Stop"]), rng.randrange(40_000)) for _ in range(300)]
    last, want = {}, {}
    for at, seq, k in sorted((r[2], i, r[:2]) for i, r in enumerate(rows)):
        want[seq] = k in last and at - last[k] <= 3600
        if not want[seq]:
            last[k] = at
    assert {r.seq: r.is_duplicate for r in dedup.mark_ttl(records(spark, rows)).collect()} == want


def test_ttl_folds_long_keys_only(spark):
    """A key within the ttl needs its first time only, so what is folded is the other keys' seconds."""
    rows = [row(f"S{i}", at=1000 + i) for i in range(50)] + [row(f"S{i}", at=4600 + i) for i in range(50)] + [row("L", at=x) for x in (0, 3600, 3601, 9000)]
    rows += [(None, "Start", 5, "m", "i", "e"), (None, "Start", 6, "m", "i", "e")]
    plan = dedup.accepted_times(records(spark, rows))._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "Union" in plan
    marked = {r.seq: r.is_duplicate for r in dedup.mark_ttl(records(spark, rows)).collect()}
    assert [marked[i] for i in range(106)] == [False] * 50 + [True] * 50 + [False, True, False, False] + [False, False]


def test_long_term(spark):
    rows = [row(at=0), row(at=93600), row(status="Stop", at=1), row("T", at=5)]
    seen = spark.createDataFrame([("T", "Start")], "acct_session_id string, acct_status_type string")
    marked = dedup.mark_long_term(records(spark, rows), seen)
    assert {r.seq: r.is_duplicate for r in marked.collect()} == {0: False, 1: True, 2: False, 3: True}
    assert {r.session_id for r in dedup.duplicate_log(marked, F.col("event_ts")).collect()} == {"S", "T"}
    assert dedup.new_keys(marked).count() == 2


def test_conflict_a(spark):
    rows = [row(at=0, imsi="1"), row(status="Stop", at=5, imsi="2"), row(status="Interim-Update", at=6, msisdn="x", imsi="1"), row(at=7, imsi="9"), row(status="Stop", at=8, imsi="1")]
    got = [r.is_a for r in conflict.mark_a(records(spark, rows)).orderBy("seq").collect()]
    assert got == [False, True, True, False, False]


def test_conflict_b(spark):
    rows = [row("A", at=0), row("A", at=1), row("B", at=2), row("B", "Stop", 3), row("C", at=4), row("A", "Stop", 5), row("C", at=6)]
    got = [r.is_b for r in conflict.mark_conflicts(records(spark, rows)).orderBy("seq").collect()]
    assert got == [False, False, True, False, True, False, False]


def test_conflict_b_against_model(spark):
    rng = random.Random(8)
    rows = [row(f"S{rng.randrange(12)}", rng.choice(["Start", "Stop", "Interim-Update"]), rng.randrange(100), imsi=f"i{rng.randrange(3)}") for _ in range(300)]
    marked = conflict.mark_conflicts(records(spark, rows)).collect()
    is_a, slot, want = {r.seq: r.is_a for r in marked}, {}, {}
    for _, seq in sorted((r[2], i) for i, r in enumerate(rows)):
        session, status, _, _, imsi, _ = rows[seq]
        opened = slot.get(imsi)
        want[seq] = not is_a[seq] and status == "Start" and opened is not None and opened != session
        if is_a[seq]:
            continue
        if status == "Start" and opened is None:
            slot[imsi] = session
        elif status == "Stop" and opened == session:
            slot[imsi] = None
    assert {r.seq: r.is_b for r in marked} == want


def test_swaps_need_history(spark):
    rows = [row("A", at=0, imsi="1"), row("A", "Stop", 1, imsi="1"), row("B", at=10, imsi="2"), row("B", "Stop", 11, imsi="2"), row("C", at=20, imsi="3")]
    marked = conflict.mark_conflicts(records(spark, rows))
    assert [r.is_c for r in marked.orderBy("seq").collect()] == [False, False, True, False, True]
    history = spark.createDataFrame([("m", "1", 5), ("m", "2", 9)], "msisdn string, imsi string, at long").withColumn("assigned_at", F.timestamp_seconds("at"))
    got = swap.confirmed(marked, history, "imsi").collect()
    assert [(r.old_imsi, r.new_imsi, r.old_imei, r.swap_type, r.source) for r in got] == [("1", "2", None, "SIM_SWAP", "RADIUS_CONFLICT_C")]
    assert swap.confirmed(marked, history.where("imsi = '2'"), "imsi").count() == 0


DAY = 86400
SWAPS = [("+31650000001", AS_OF - DAY), ("+31650000002", AS_OF - 7 * DAY), ("+31650000003", AS_OF - 31 * DAY), ("+31650000005", AS_OF - 30), ("+31650000006", AS_OF - 30 * DAY + 60), ("+31650000007", None), ("+31650000008", AS_OF - 30 * DAY - 5), ("+31650000010", AS_OF - 30 * DAY)]


@pytest.mark.parametrize("kind", ["SIM_SWAP", "DEVICE_SWAP"])
def test_swap_check(spark, kind):
    swaps = spark.createDataFrame([(n, kind, at) for n, at in SWAPS], "msisdn string, swap_type string, at long").withColumn("confirmed_at", F.timestamp_seconds("at"))
    asks = [(f"+3165000000{i}", 30) for i in range(1, 9)] + [("+31650000010", 30), ("+31650000001", 0), ("+31650000001", None), ("31650", 30), (None, 30), ("+31650000001", -1)]
    asked = spark.createDataFrame(asks, "phone_number string, max_age int").withColumn("n", F.monotonically_increasing_id())
    got = [(r.swapped, r.request_error) for r in serve.swap_check(asked, swaps, kind, F.timestamp_seconds(F.lit(AS_OF))).orderBy("n").collect()]
    bad = (None, "INVALID_ARGUMENT")
    assert got == [(x, None) for x in (True, True, False, False, True, True, False, False, True, False, False)] + [bad] * 3


def test_number_verify(spark):
    rows = [
        row("A", at=AS_OF - 3600, msisdn="+31650000001"), row("B", at=AS_OF - 7200, msisdn="+31650000002"), row("B", "Stop", AS_OF - 3600, msisdn="+31650000002"), row("C", at=AS_OF - 10, msisdn="+31650000003"),
        row("C", "Stop", AS_OF - 10, msisdn="+31650000003"), row("D", at=AS_OF - DAY, msisdn="+31650000004"), row("E", at=AS_OF - DAY - 1, msisdn="+31650000005"), row("F", "Stop", AS_OF - 9, msisdn="+31650000006"), row("F", at=AS_OF - 5, msisdn="+31650000006"),
    ]
    asks = spark.createDataFrame([(f"+3165000000{i}",) for i in range(1, 8)] + [("12",)], "phone_number string").withColumn("n", F.monotonically_increasing_id())
    got = [r.verified for r in serve.number_verify(asks, records(spark, rows), F.timestamp_seconds(F.lit(AS_OF))).orderBy("n").collect()]
    assert got == [True, False, False, True, False, True, False, None]


def test_histories(spark):
    rows = spark.createDataFrame([("m", "a", 1), ("m", "b", 5), ("m", "c", 9), ("n", "x", 2)], "k string, v string, at long")
    got = {(r.k, r.v): (r.unassigned_at, r.is_current, r.swap_reason, r.swap_count, r.latest_swap_at) for r in lookups.identity_history(rows, "k", "v", "at").collect()}
    assert got["m", "a"] == (5, False, "initial_activation", 2, 9)
    assert got["m", "c"] == (None, True, "customer_request", 2, 9)
    assert got["n", "x"] == (None, True, "initial_activation", 0, None)
    newest = lookups.number_history(rows, "k", "v", "at", to_date=F.lit(5), limit=1).where("k = 'm'").collect()
    assert [(r.v, r.unassigned_at) for r in newest] == [("b", 9)]
    assert [(r.latest, r.previous) for r in lookups.latest_two(rows, "k", "v", "at").collect()] == [("c", "b")]
    assert {r.k: r.v for r in lookups.last_per_key(rows, "k", ["at"]).collect()} == {"m": "c", "n": "x"}


def test_pages_and_totals(spark):
    rows = spark.createDataFrame([(f"{i:02d}", "Acme" if i % 2 else "Other") for i in range(10)], "tac_code string, manufacturer string")
    got = lookups.page(rows, ["tac_code"], 2, 2, {"manufacturer": "acme"}).collect()
    assert [(r.tac_code, r.total, r.pages) for r in got] == [("05", 5, 3), ("07", 5, 3)]
    with pytest.raises(ValueError):
        lookups.page(rows, ["tac_code"], 0)
    asked = spark.createDataFrame([("01",), ("01",), ("99",)], "tac_code string")
    looked = lookups.batch_lookup(asked, "tac_code", rows, "tac_code")
    assert lookups.lookup_totals(looked, asked, "tac_code").first()[:] == (3, 2, 1)
    asked = spark.createDataFrame([("x",), ("000001",)], "tac_code string")
    assert sorted(r.http_status for r in lookups.tac_lookup(asked, rows).collect()) == [404, 422]
    unnamed = spark.createDataFrame([("000001", None)], "tac_code string, manufacturer string")
    assert sorted(r.http_status for r in lookups.tac_lookup(asked, unnamed).collect()) == [200, 422]
    assert lookups.page(rows, ["tac_code"], 1_000_000).count() == 0


def test_batches_with_totals(spark):
    profiles = spark.createDataFrame([("i1", "m1", "old", 1), ("i1", "m2", "new", 2), ("i2", "m1", "moved", 3), (None, None, "none", 4)], "imsi string, msisdn string, name string, at int")
    asks = [("imsi", "i1"), ("msisdn", "m1"), ("imsi", "m1"), ("email", "i1"), ("imsi", "i1"), ("imsi", None)]
    asked = spark.createDataFrame([(i, *a) for i, a in enumerate(asks)], "n int, type string, value string")
    got = lookups.subscriber_batch(asked, profiles, ["at"]).orderBy("n").collect()
    assert [(r.found, r.name) for r in got] == [(True, "new"), (True, "moved"), (False, None), (False, None), (True, "new"), (False, None)]
    rows = spark.createDataFrame([("a", "x", 1), ("a", "y", 2)], "k string, v string, at long")
    asked = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    got = lookups.history_batch(asked, rows, "k", "v", "at")
    assert sorted((r.k, r.v or "", r.found) for r in got.collect()) == [("a", "x", True), ("a", "y", True), ("b", "", False)]
    assert lookups.lookup_totals(got, asked, "k").first()[:] == (3, 2, 1)


def test_default_age(spark):
    swaps = spark.createDataFrame([("+31650000001", "SIM_SWAP", AS_OF - 29 * DAY), ("+31650000002", "SIM_SWAP", AS_OF - 31 * DAY)], "msisdn string, swap_type string, at long").withColumn("confirmed_at", F.timestamp_seconds("at"))
    asked = spark.createDataFrame([("+31650000001",), ("+31650000002",)], "phone_number string")
    got = serve.swap_check(asked, swaps, "SIM_SWAP", F.timestamp_seconds(F.lit(AS_OF))).orderBy("phone").collect()
    assert [(r.swapped, r.max_age) for r in got] == [(True, 30), (False, 30)]


def test_rates(spark):
    counts = spark.sql("select 1 as total")
    assert str(report.with_rate(counts, spark.range(3)).first().rate) == "33.33"
    assert str(report.with_rate(counts, spark.range(0)).first().rate) == "0.00"


def test_by_session_tells_what_no_fold_must(spark):
    """keys were moved three times and joined with all their records to find duplicates."""
    rng = random.Random(12)
    rows = [row(f"S{rng.randrange(200)}", rng.choice(["Start", "Stop"]), rng.choice([None, *range(0, 60_000, 7)])) for _ in range(900)] + [(None, "Start", 5, "m", "i", "e")] * 2 + [row("T", None, 5)] * 2
    rows += [row("open", at=x) for x in (0, 3600, 7300, 7400)]
    df = records(spark, rows)
    met = dedup.by_session(df)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    got, want = ({r.seq: r.is_duplicate for r in x.collect()} for x in (met, dedup.mark_ttl(df)))
    assert len(got) == len(rows) and all(x is None or x == want[k] for k, x in got.items())
    assert [got[i] for i in range(len(rows) - 4, len(rows))] == [False, True, False, None] and sum(x is None for x in got.values()) < len(rows) / 4


def test_slot_of_a_session_without_stop_is_not_folded(spark):
    """an imsi whose open session never stops had its whole history folded."""
    rows = [row("A", at=0)] + [row(f"B{i}", s, i) for i in range(1, 300) for s in ("Start", "Stop")] + [row("A", at=400)]
    rows += [row("C", at=0, imsi="j"), row("D", at=1, imsi="j"), row("C", "Stop", 2, imsi="j"), row("E", at=3, imsi="j"), row("F", at=4, imsi="j"), row("E", at=5, imsi="j")]
    got = [r.is_b for r in conflict.mark_conflicts(records(spark, rows)).orderBy("seq").collect()]
    assert got == [False] + [True, False] * 299 + [False] + [False, True, False, False, True, False]


def test_conflict_rate_in_one_read(spark):
    rows = [row("A", at=0), row("A", at=1), row("A", "Stop", 2, imsi="2"), row("B", at=3), row("C", "Stop", 4, imsi="5"), (None, "Stop", 9, "m", "6", "e")]
    marked = conflict.mark_conflicts(records(spark, rows))
    assert [r.is_b for r in marked.orderBy("seq").collect()] == [False, False, False, True, False, False]
    want = report.with_rate(report.conflict_section(conflict.conflict_log(marked)), dedup.mark_long_term(conflict.clean(marked)).where("NOT is_duplicate"))
    got = report.conflict_rate(marked, dedup.KEY)
    assert got.first() == want.first() and got.dtypes == want.dtypes
    none = report.conflict_rate(marked.limit(0), dedup.KEY).first()
    assert (none.total, str(none.rate)) == (0, "0.00")
