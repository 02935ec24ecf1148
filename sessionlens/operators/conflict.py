"""Session and identity conflicts (WIN-1 to WIN-4), over all given records as one batch.

A: a record that is no Start whose imsi or msisdn differs from the first of its session. B: a Start of another session
while the imsi has one open; A records neither open nor close. C, D: the imsi (imei) differs from that of the number's
previous record without A or B. A and B leave the clean records, C and D stay and are candidates for swaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.functions.columns import by_hash
from sessionlens.operators.fold import ordered_fold

#: The texts of the conflict log.
DETAILS_A = "Session %s: IMSI/MSISDN thay đổi sau Start"
DETAILS_B = "IMSI %s: 2+ Start chưa Stop"


def mark_a(records: DataFrame, seq: str = "seq", counted: Column | None = None, **any_of: Column) -> DataFrame:
    """records plus is_a. counted: which records may be the first of their session (all); any_of: further columns by name,
    whether this holds for any record of the session."""
    session = Window.partitionBy(*by_hash("acct_session_id")).orderBy(F.col("event_ts").asc_nulls_last(), seq).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = {c: F.first(F.col(c) if counted is None else F.when(counted, F.col(c)), ignorenulls=True).over(session) for c in ("imsi", "msisdn")}
    rows = records.select("*", *[x.alias(f"__{c}") for c, x in first.items()], *[F.max(x).over(session).alias(c) for c, x in any_of.items()])
    differs = F.coalesce(F.col("imsi") != F.col("__imsi"), F.lit(False)) | F.coalesce(F.col("msisdn") != F.col("__msisdn"), F.lit(False))
    return rows.withColumn("is_a", (F.col("acct_status_type") != "Start") & differs).drop("__imsi", "__msisdn")


def overlaps(records: DataFrame, seq: str = "seq") -> DataFrame:
    """imsi and __pos of every Start of another session while the imsi has one open. records: with is_a.

    A Start may be open until the next Stop of its session. Where no Start before may still be open, the slot is empty
    whatever came before; so an imsi's history is cut there, by a running maximum. A piece begins with the Start that takes
    the slot. If its session never stops, all Starts of others are found; only pieces whose first session stops, with Starts
    of several sessions, are folded, each by itself.
    """
    status = F.col("acct_status_type")
    rows = records.where(~F.col("is_a") & status.isin("Start", "Stop") & F.col("imsi").isNotNull())
    rows = rows.select("imsi", F.col("acct_session_id").alias("session"), (status == "Start").alias("start"), _position(seq).alias("pos"))
    rows = rows.repartition("imsi")  # once for the sessions' windows and the imsi's
    after = Window.partitionBy(*by_hash("imsi"), F.xxhash64("session"), "session").orderBy(F.desc("pos.late"), F.desc("pos.at"), F.desc("pos.seq")).rowsBetween(Window.unboundedPreceding, -1)
    stop = F.last(F.when(~F.col("start"), F.col("pos")), ignorenulls=True).over(after)
    never = F.struct(F.lit(2).alias("late"), F.col("pos.at"), F.col("pos.seq"))
    rows = rows.withColumn("open_to", F.when(F.col("start"), F.coalesce(stop, never)))
    own = Window.partitionBy(*by_hash("imsi")).orderBy("pos.late", "pos.at", "pos.seq")
    reach = F.max("open_to").over(own.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("new", reach.isNull() | (reach < F.col("pos")))
    opener = F.last(F.when(F.col("new"), F.struct("pos", "session", F.col("open_to.late").alias("late"))), ignorenulls=True)
    rows = rows.withColumn("opener", opener.over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    settled = F.col("opener.late") == 2
    rows = rows.where(F.when(settled, F.col("start") & (F.col("session") != F.col("opener.session"))).otherwise(True))
    started = F.when(~F.coalesce(settled, F.lit(False)) & F.col("start"), F.col("session"))
    event = F.when(~F.coalesce(settled, F.lit(False)), F.struct("pos", "start", "session"))
    gathered = F.array_sort(F.collect_list(event)).alias("events")
    pieces = rows.groupBy("imsi", F.col("opener.pos").alias("piece")).agg(F.min(started).alias("a"), F.max(started).alias("b"), gathered, F.collect_list(F.when(settled, F.col("pos"))).alias("settled"))

    def step(slot: Column, x: Column) -> Column:
        return F.when(x.start, F.coalesce(slot, x.session)).when(slot == x.session, F.lit(None)).otherwise(slot)

    found = ordered_fold(F.col("events"), F.lit(None).cast("string"), step, lambda slot, x: F.when(x.start & (slot != x.session), x.pos), rows.schema["pos"].dataType.simpleString())
    return pieces.select("imsi", F.explode(F.when(F.col("a") != F.col("b"), found).otherwise(F.col("settled"))).alias("__pos"))


def _position(seq: str) -> Column:
    """Sorts as records without a time last, then by time and arrival."""
    return F.struct(F.col("event_ts").isNull().cast("int").alias("late"), F.coalesce(F.unix_micros("event_ts"), F.lit(0).cast("bigint")).alias("at"), F.col(seq).alias("seq"))


def mark_b(records: DataFrame, seq: str = "seq") -> DataFrame:
    """records with is_a plus is_b: one slot for an open session an imsi; only Starts and Stops without A count.

    records are read twice: give a table, or the plan runs twice.
    """
    found = overlaps(records, seq).select("imsi", F.col("__pos.late").alias("__late"), F.col("__pos.at").alias("__at"), F.col("__pos.seq").alias("__seq"), F.lit(True).alias("__b")).hint("shuffle_hash")
    own = records.withColumn("__p", _position(seq)).select("*", F.col("__p.late").alias("__late"), F.col("__p.at").alias("__at"), F.col("__p.seq").alias("__seq"))
    out = own.join(found, ["imsi", "__late", "__at", "__seq"], "left")
    is_b = F.col("__b").isNotNull() & ~F.col("is_a") & (F.col("acct_status_type") == "Start")
    return out.withColumn("is_b", is_b).select(*[records[c] for c in records.columns], "is_b")


def mark_cd(records: DataFrame, seq: str = "seq") -> DataFrame:
    """records with is_a and is_b plus previous_imsi, previous_imei, is_c, is_d."""
    legit = ~F.col("is_a") & ~F.col("is_b")
    # Rows with and without A or B are apart, so a record looks back on legitimate ones only.
    number = Window.partitionBy(*by_hash("msisdn"), legit).orderBy(F.col("event_ts").asc_nulls_last(), seq)
    out = records
    for c in ("imsi", "imei"):
        out = out.withColumn(f"previous_{c}", F.when(legit, F.lag(c).over(number)))
    for kind, c in (("is_c", "imsi"), ("is_d", "imei")):
        out = out.withColumn(kind, F.coalesce(F.col(f"previous_{c}") != F.col(c), F.lit(False)))
    return out


def mark_conflicts(records: DataFrame, seq: str = "seq") -> DataFrame:
    return mark_cd(mark_b(mark_a(records, seq), seq), seq)


def clean(marked: DataFrame) -> DataFrame:
    """FLT-2, PRJ-7."""
    return marked.where(~F.col("is_a") & ~F.col("is_b")).drop("is_a", "is_b", "is_c", "is_d", "previous_imsi", "previous_imei")


def conflict_log(marked: DataFrame) -> DataFrame:
    """SNK-5's rows, A before B. PRJ-8, PRJ-9."""
    kind = F.when(F.col("is_a"), "A").otherwise("B")
    text = F.when(F.col("is_a"), F.format_string(DETAILS_A, "acct_session_id")).otherwise(F.format_string(DETAILS_B, "imsi"))
    return marked.where(F.col("is_a") | F.col("is_b")).select(F.col("acct_session_id").alias("session_id"), kind.alias("conflict_type"), text.alias("details"), F.concat(F.lit("CONFLICT_"), kind).alias("error_code"))
