"""The ordered chain of data-quality rules (VAL-R1 to VAL-R6): the first rule that fails names the record's error.

All lookups are joins: the number plan and the device types, both bounded, are broadcast, the subscribers
if Catalyst finds them small, and no rule calls out.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.functions.columns import E164_RECORD, apart, luhn_ok, parse_ts, tac_of, trimmed
from sessionlens.operators.lookups import number_plan

MANDATORY = ("acct_status_type", "acct_session_id", "msisdn", "imsi", "imei", "event_timestamp")
STATUSES = ("Start", "Stop", "Interim-Update")
#: 2000-01-01 and 2100-01-01, both valid.
FIRST_EPOCH, LAST_EPOCH = 946684800, 4102444800
BYPASSED = "WARN_RULE_BYPASSED"


@dataclass(frozen=True)
class Dims:
    """Reference tables: TAC registry (tac_code), subscribers (imsi), number plan; and which of them are out of service."""

    tac: DataFrame
    subscribers: DataFrame
    countries: DataFrame
    prefixes: DataFrame
    unavailable: frozenset[str] = field(default_factory=frozenset)


def normalised(raw: DataFrame) -> DataFrame:
    """PRJ-1: raw records with event_ts and ingest_ts (TIMESTAMP, null if neither format fits)."""
    return raw.withColumn("event_ts", parse_ts(F.col("event_timestamp"))).withColumn("ingest_ts", parse_ts(F.col("ingest_timestamp")))


def annotate(records: DataFrame, dims: Dims) -> DataFrame:
    """Normalised records with error_code, error_details (null where valid) and warn_code. VAL-SEQ, VAL-BATCH, VAL-W.

    A reference table that is out of service leaves its rule undecided: the record passes it with a warning.
    """
    out = _with_small_tables(records, dims)
    if "subscribers" not in dims.unavailable:
        out = out.join(_known(dims), trimmed(F.col("imsi")) == F.col("__imsi"), "left")
    rules = _rules(dims.unavailable)
    first = _first_failure(rules)
    code = F.get(F.array(*[F.lit(code) for _, code, _ in rules]), first)
    details = F.get(F.array(*[F.lit(text) for _, _, text in rules]), first)
    if "plan" not in dims.unavailable:  # this rule's text is the plan's own
        details = F.coalesce(details, F.when(first.isNotNull(), apart(F.col("plan_detail"))))
    out = out.select("*", code.alias("error_code"), details.alias("error_details"))
    # The warning stands only where the chain came to a rule that could not be asked.
    reached = _reached(dims.unavailable)
    out = out.withColumn("warn_code", F.when(reached, F.lit(BYPASSED)))
    return out.drop("__imsi", "__tac", "plan_valid", "plan_detail")


def passing(records: DataFrame, dims: Dims, *refused: Column) -> DataFrame:
    """valid(annotate(records, dims)) with the columns of records, where nobody asks for the others; without those refused.

    What a record and the small tables say is asked first, so only records that pass move to meet the subscribers.
    """
    # One predicate, as single ones would be pushed down to the scan, which may have few splits; apart, as it is a large one.
    rules = _rules(dims.unavailable | {"subscribers"}) + [(x, "", None) for x in refused]
    out = _with_small_tables(records, dims).where(apart(_first_failure(rules)).isNull()).select(*records.columns)
    if "subscribers" not in dims.unavailable:
        out = out.join(_known(dims), trimmed(F.col("imsi")) == F.col("__imsi"), "left_semi")
    return out


def _with_small_tables(records: DataFrame, dims: Dims) -> DataFrame:
    out = records
    if "plan" not in dims.unavailable:
        out = number_plan(out, "msisdn", dims.countries, dims.prefixes).drop("country_code", "country_name", "subscriber_number", "operator", "plan_error")
    if "tac" not in dims.unavailable:
        tac = dims.tac.select(F.col("tac_code").alias("__tac")).where(F.col("__tac").rlike("^[0-9]{6}$")).distinct()
        # Six digits: at most a million codes, whatever the registry's size. As a shuffle, records of one device type meet in one task.
        out = out.join(F.broadcast(tac), tac_of(trimmed(F.col("imei"))) == F.col("__tac"), "left")
    return out


def _known(dims: Dims) -> DataFrame:
    """Each imsi once. A task hashes its share of them, so the records needn't be sorted."""
    return dims.subscribers.select(F.col("imsi").alias("__imsi")).distinct().hint("shuffle_hash")


def _first_failure(rules: list[tuple[Column, str, str | None]]) -> Column:
    """The number of the first rule that fails: one plain CASE, which stops at that rule."""
    first = F.lit(None).cast("int")
    for i, (fails, _, _) in reversed(list(enumerate(rules))):
        first = F.when(fails, F.lit(i)).otherwise(first)
    return first


def _rules(unavailable: frozenset[str]) -> list[tuple[Column, str, str | None]]:
    """(fails, error code, details) in order; details are None where the number plan has them. Codes and texts are fixed values."""
    text = {c: trimmed(F.col(c)) for c in (*MANDATORY, "ingest_timestamp")}
    out_of_bounds = F.col("event_ts").isNotNull() & ~F.unix_seconds("event_ts").between(FIRST_EPOCH, LAST_EPOCH)
    rules: list[tuple[Column, str, str | None]] = [(text[c] == "", "ERR_MISSING_FIELD", f"{c} is required") for c in MANDATORY]
    rules.append((~text["msisdn"].rlike(E164_RECORD), "ERR_INVALID_MSISDN", "Violate E.164 regex"))
    if "plan" not in unavailable:
        rules.append((~F.col("plan_valid"), "ERR_INVALID_MSISDN", None))
    if "subscribers" not in unavailable:
        rules.append((F.col("__imsi").isNull(), "ERR_IMSI_NOT_IN_HLR", "IMSI not found in HLR"))
    rules += [
        (~text["imei"].rlike("^[0-9]{15}$"), "ERR_IMEI_LUHN_FAIL", "IMEI must be 15 digits"),
        (~luhn_ok(text["imei"]), "ERR_IMEI_LUHN_FAIL", "Luhn check fail"),
    ]
    if "tac" not in unavailable:
        rules.append((F.col("__tac").isNull(), "ERR_IMEI_TAC_UNKNOWN", "Unknown TAC"))
    rules += [
        (~text["acct_status_type"].isin(*STATUSES), "ERR_INVALID_STATUS", "Invalid status type"),
        (out_of_bounds, "ERR_INVALID_TIMESTAMP", "event_timestamp out of bounds"),
        (F.col("event_ts").isNull(), "ERR_INVALID_TIMESTAMP", "Timestamp format error: event_timestamp"),
        (F.col("ingest_ts").isNull(), "ERR_INVALID_TIMESTAMP", "Timestamp format error: ingest_timestamp"),
    ]
    return rules


def _reached(unavailable: frozenset[str]) -> Column:
    """Whether a rule without its table came up before any rule failed."""
    order = ["ERR_MISSING_FIELD", "ERR_INVALID_MSISDN", "ERR_IMSI_NOT_IN_HLR", "ERR_IMEI_LUHN_FAIL", "ERR_IMEI_TAC_UNKNOWN"]
    place = {"plan": 1, "subscribers": 2, "tac": 4}
    if not unavailable:
        return F.lit(False)
    first = min(place[x] for x in unavailable)
    before = order[: first + (first == 1)]
    return F.col("error_code").isNull() | ~F.col("error_code").isin(*before)


def valid(annotated: DataFrame) -> DataFrame:
    """FLT-1."""
    return annotated.where(F.col("error_code").isNull())


def invalid(annotated: DataFrame) -> DataFrame:
    return annotated.where(F.col("error_code").isNotNull())


def error_counts(annotated: DataFrame) -> DataFrame:
    return annotated.groupBy(F.coalesce("error_code", F.lit("OK")).alias("error_code")).agg(F.count(F.lit(1)).alias("n"))


def invalid_log(annotated: DataFrame, created_at: Column) -> DataFrame:
    """SNK-4's rows, of records with an error."""
    return invalid(annotated).select(F.col("acct_session_id").alias("session_id"), "msisdn", "error_code", F.col("error_details").alias("details"), created_at.alias("created_at"))
