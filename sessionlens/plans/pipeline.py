"""The whole chain: normalise, validate, late, duplicates, conflicts, swaps, long-term duplicates; and its outputs.

Two tables are written on the way, the annotated records and the marked ones, as all outputs read one or both: the rules'
joins run once, whatever is asked for. Who asks for one output, and reads it once, has them left out (process, write).
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.operators import conflict, dedup, late, report, swap, validate
from sessionlens.sources.files import delete, materialised


#: What the chain itself reads of a validated record.
OWN = ("seq", "acct_status_type", "acct_session_id", "msisdn", "imsi", "imei", "event_ts", "ingest_ts", "error_code")


@dataclass(frozen=True)
class Outputs:
    """Every record is in one of annotated's errors, short-term duplicates (dropped), conflicts or clean; clean is stored or repeated."""

    annotated: DataFrame
    marked: DataFrame
    clean: DataFrame
    conflicts: DataFrame
    swaps: DataFrame
    stored: DataFrame
    repeated: DataFrame
    #: The distinct keys of stored, for who counts them.
    stored_keys: DataFrame
    #: Folders of the tables that the outputs read.
    tables: tuple[str, ...]

    def delete(self) -> None:
        """Deletes the tables that the outputs read, once these are written elsewhere."""
        for path in self.tables:
            delete(self.marked.sparkSession, path)

    def duplicate_log(self, detected_at: Column) -> DataFrame:
        return dedup.duplicate_log(self.repeated.withColumn("is_duplicate", F.lit(True)), detected_at)

    def new_keys(self) -> DataFrame:
        """What a later run takes as seen, besides what this one did."""
        return dedup.new_keys(self.stored.withColumn("is_duplicate", F.lit(False)))

    def report(self) -> dict[str, DataFrame]:
        """The report's sections; logs are dated by arrival."""
        at = F.col("ingest_ts")
        return report.sections(self.annotated, self.conflicts, self.stored, self.duplicate_log(at), validate.invalid_log(self.annotated, at))


def process(raw: DataFrame, dims: validate.Dims, sim_history: DataFrame, device_history: DataFrame, ttl: int = dedup.TTL, late_after: int = late.THRESHOLD, seen: DataFrame | None = None, carry: Collection[str] | None = None, write: Collection[str] = ("annotated", "marked")) -> Outputs:
    """raw: the raw columns and seq, as readers give them; seen: keys stored before (acct_session_id, acct_status_type).

    carry: the columns that outputs have besides OWN; all of them if None. A table that is written has no unread columns
    that Spark could prune, and every window moves whole rows, so callers that need few columns say which.
    write: which of the annotated and the marked records are written as tables. One that isn't is a plan that runs at each
    read, so leave out what is read once or not at all.
    """
    records = validate.normalised(raw)
    wanted = lambda df: df if carry is None else df.select(*[c for c in df.columns if c in OWN or c in carry])
    annotated = wanted(late.mark_late(validate.annotate(records, dims), late_after))
    if "annotated" in write:
        annotated = materialised(annotated, "annotated")
        once, parts = _once(validate.valid(annotated), annotated, ttl)
    else:
        once, parts = _once(wanted(validate.passing(records, dims, late.is_late(late_after))), raw, ttl)
    marked = conflict.mark_cd(conflict.mark_b(once))
    tables = [annotated.scratch_path] if "annotated" in write else []
    if "marked" in write:
        marked = materialised(marked, "marked")
        tables.append(marked.scratch_path)
        for path in parts:
            delete(raw.sparkSession, path)
    else:
        tables += parts
    clean = conflict.clean(marked)
    kept = dedup.mark_long_term(clean, seen)
    stored, repeated = (kept.where(x).drop("is_duplicate") for x in (~F.col("is_duplicate"), F.col("is_duplicate")))
    keys = clean.select(*dedup.KEY).distinct()
    keys = keys if seen is None else keys.join(seen.select(*dedup.KEY), dedup.KEY, "left_anti")
    return Outputs(annotated, marked, clean, conflict.conflict_log(marked), swap.swap_events(marked, sim_history, device_history), stored, repeated, keys, tuple(tables))


def _once(records: DataFrame, sessions: DataFrame, ttl: int) -> tuple[DataFrame, list[str]]:
    """(records without short-term duplicates, with is_a; the folders of the tables that they are in).

    Most sessions are settled where they meet, in one exchange. Those with a key that only a fold decides, and hot ones, which
    one task should not take, go the longer way of drop_ttl. sessions: any records with these sessions, to count them.
    """
    columns, hot, parts = records.columns, dedup.hot_buckets(sessions), []
    if hot:  # read twice
        records = materialised(records, "valid")
        parts.append(records.scratch_path)
    met = conflict.mark_a(dedup.by_session(records.where(~dedup.in_buckets(hot)), ttl), counted=~F.col("is_duplicate"), is_open=F.col("is_duplicate").isNull())
    first = materialised(met.where(F.col("is_open") | ~F.col("is_duplicate")).drop("is_duplicate"), "once")
    parts.append(first.scratch_path)
    once, rest = first.where(~F.col("is_open")).drop("is_open"), first.where("is_open").select(*columns)
    if hot:
        rest = rest.unionByName(records.where(dedup.in_buckets(hot)))
    if not rest.isEmpty():
        folded = materialised(conflict.mark_a(dedup.drop_ttl(rest, ttl)), "folded")
        parts.append(folded.scratch_path)
        once = once.unionByName(folded)
    return once, parts


def counts(out: Outputs) -> DataFrame:
    """AGG-12: one row a stage, from the two tables."""
    marked = out.marked
    flags = marked.agg(F.count(F.lit(1)).alias("deduplicated"), F.count_if(~F.col("is_a") & ~F.col("is_b")).alias("clean"), F.count_if(F.col("is_a") | F.col("is_b")).alias("conflict_ab"), F.count_if("is_c").alias("conflict_c"), F.count_if("is_d").alias("conflict_d"))
    code = F.col("error_code")
    first = out.annotated.agg(F.count(F.lit(1)).alias("total"), F.count_if(code.isNull() | (code == "ERR_LATE_ARRIVAL")).alias("valid"), F.count_if(code.isNotNull() & (code != "ERR_LATE_ARRIVAL")).alias("invalid"), F.count_if(code == "ERR_LATE_ARRIVAL").alias("late"))
    names = first.columns + flags.columns
    both = first.join(F.broadcast(flags))  # one row each
    return both.select(F.explode(F.array(*[F.struct(F.lit(n).alias("stage"), F.col(n).alias("n")) for n in names])).alias("x")).select("x.*")


def invalid_rows(out: Outputs, created_at: Column) -> DataFrame:
    """SET-1: validation failures and late arrivals."""
    return validate.invalid_log(out.annotated, created_at)
