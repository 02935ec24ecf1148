"""Every query of the package by name, over the driver's tables, with the SQL that gives the same rows.

Times are epoch seconds and rates decimals, so that values compare alike in both engines.
"""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens.functions.columns import epoch, tac_of
from sessionlens.operators import dedup, keystore, late, lookups, report, serve, serving, swap, validate
from sessionlens.plans import oracle
from sessionlens.plans import pipeline as chain
from sessionlens.sources import files, projection, sinks

Query = Callable[[SparkSession, str], DataFrame]


def _as_of() -> Column:
    return F.timestamp_seconds(F.lit(oracle.AS_OF))


def _annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = validate.normalised(projection.accounting(spark, sf_dir))
    return late.mark_late(validate.annotate(records, projection.dims(spark, sf_dir)))


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.valid(_annotated(spark, sf_dir))


def _outputs(spark: SparkSession, sf_dir: str, *carry: str, write: Collection[str] = ("annotated", "marked")) -> chain.Outputs:
    """carry: the columns that the query shows besides those the chain needs; write: the tables that it reads more than once."""
    raw, dims = projection.accounting(spark, sf_dir), projection.dims(spark, sf_dir)
    return chain.process(raw, dims, projection.sim_history(spark, sf_dir), projection.device_history(spark, sf_dir), carry=carry, write=write)


def _swaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both kinds read the candidates, a small part of the marked records, so only these are written."""
    candidates = files.materialised(_outputs(spark, sf_dir, write=()).marked.where("is_c OR is_d"), "candidates")
    return swap.swap_events(candidates, projection.sim_history(spark, sf_dir), projection.device_history(spark, sf_dir))


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    phone = F.when(k % 29 == 0, "12345").otherwise(F.concat(F.lit(" "), projection.msisdn_of(k)))
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(k.alias("request_id"), phone.alias("phone_number"), F.when(k % 17 != 0, (k % 40).cast("int")).alias("max_age"))


def val_first_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _annotated(spark, sf_dir).select("seq", F.coalesce("error_code", F.lit("OK")).alias("error_code"))


def val_error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.error_counts(_annotated(spark, sf_dir))


def e164_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = projection.dims(spark, sf_dir)
    numbers = projection.accounting(spark, sf_dir).select("msisdn").distinct()
    return lookups.number_plan(numbers, "msisdn", dims.countries, dims.prefixes).select("msisdn", "plan_valid", "plan_error", "country_code", "subscriber_number", "operator")


def late_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _annotated(spark, sf_dir).where("error_code = 'ERR_LATE_ARRIVAL'").select("seq", late.delay().alias("delay"), F.col("error_details").alias("details"))


def late_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late.delay_buckets(_annotated(spark, sf_dir))


def dedup_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.mark_ttl(files.materialised(_valid(spark, sf_dir), "valid")).select("seq", "is_duplicate")


def dedup_long_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup.mark_long_term(_valid(spark, sf_dir)).where("NOT is_duplicate")
    return kept.select("seq", F.col("acct_session_id").alias("sess"), F.col("acct_status_type").alias("status"))


def dup_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicate_log(dedup.mark_long_term(_valid(spark, sf_dir)), epoch(F.col("event_ts")))


def _conflict(flag: str, *columns: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _outputs(spark, sf_dir, write=()).marked.where(flag).select("seq", *[F.col(c).alias("sess" if c == "acct_session_id" else c) for c in columns])

    return query


def conflict_log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outputs(spark, sf_dir, write=()).conflicts


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select("o_custkey", "o_orderkey", epoch(F.col("o_orderdate").cast("timestamp")).alias("at"))


def identity_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.identity_history(_orders(spark, sf_dir), "o_custkey", "o_orderkey", "at")


def msisdn_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.number_history(_orders(spark, sf_dir), "o_custkey", "o_orderkey", "at", from_date=F.lit(820454400))


def latest_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.last_per_key(_orders(spark, sf_dir), "o_custkey", ["at", "o_orderkey"])


def swap_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    swaps = _swaps(spark, sf_dir)
    return swaps.withColumn("detected_at", epoch(F.col("detected_at"))).withColumn("confirmed_at", epoch(F.col("confirmed_at")))


def _swap_query(kind: str, date: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = serve.swap_check(_requests(spark, sf_dir), _swaps(spark, sf_dir), kind, _as_of())
        answer = epoch(F.col("latest_change")).alias("latest_change") if date else F.col("swapped")
        return out.select("request_id", "phone", "max_age", "request_error", answer)

    return query


def active_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = dedup.drop_ttl(files.materialised(_valid(spark, sf_dir), "valid"))
    return serve.active_sessions(sessions, _as_of()).select("seq", "msisdn", F.col("acct_session_id").alias("sess"), epoch(F.col("event_ts")).alias("ev"))


def number_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = dedup.drop_ttl(files.materialised(_valid(spark, sf_dir), "valid"))
    return serve.number_verify(_requests(spark, sf_dir), sessions, _as_of()).select("request_id", "phone", "request_error", "verified")


def _deltas(spark: SparkSession, sf_dir: str, of: Callable[[DataFrame], DataFrame], rows: DataFrame) -> DataFrame:
    """The deltas of three batches, written and read as a serving table's are."""
    folder = files.scratch_folder(spark, "deltas")
    for k in range(3):
        of(rows.where(F.pmod(F.xxhash64("msisdn", "event"), F.lit(3)) == k).drop("event")).write.mode("append").parquet(folder)
    return spark.read.parquet(folder)


def sim_swap_served(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The swap check from the serving table: no rule, window or history in its plan."""
    swaps = files.materialised(_swaps(spark, sf_dir), "swaps")
    table = serving.latest_swaps(_deltas(spark, sf_dir, serving.latest_swaps, swaps.withColumn("event", F.col("detected_at"))))
    out = serve.swap_check(_requests(spark, sf_dir), table, "SIM_SWAP", _as_of())
    return out.select("request_id", "phone", "max_age", "request_error", "swapped", epoch(F.col("latest_change")).alias("latest_change"))


def number_verify_served(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number verification from merged session states."""
    records = files.materialised(dedup.drop_ttl(files.materialised(_valid(spark, sf_dir), "valid")), "records")
    table = serving.merged_sessions(_deltas(spark, sf_dir, serving.session_delta, records.withColumn("event", F.col("seq"))))
    return serving.verified_numbers(_requests(spark, sf_dir), table, _as_of()).select("request_id", "phone", "request_error", "verified")


def rpt_imei(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _outputs(spark, sf_dir, write=("annotated",))
    return report.with_rate(report.imei_section(validate.invalid(out.annotated)), out.stored_keys)


def rpt_duplicates_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.duplicates_hourly(_outputs(spark, sf_dir, write=()).duplicate_log(F.col("ingest_ts")))


def chain_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean records that storage had already, logged when they came."""
    return _outputs(spark, sf_dir, write=()).duplicate_log(epoch(F.col("ingest_ts")))


def csv_chain_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain from CSV files as the package writes and reads them."""
    raw = projection.accounting(spark, sf_dir)
    folder = files.scratch_folder(spark, "csv")
    sinks.write_csv(raw.orderBy("seq"), folder)
    out = chain.process(files.read_csv(spark, folder), projection.dims(spark, sf_dir), projection.sim_history(spark, sf_dir), projection.device_history(spark, sf_dir))
    files.delete(spark, folder)
    return chain.counts(out)


def e164_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = projection.dims(spark, sf_dir)
    return lookups.plan_batch(projection.accounting(spark, sf_dir), "msisdn", dims.countries, dims.prefixes)[1]


def _history_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, every eleventh under a key without orders; every fifth asks twice."""
    k = F.col("c_custkey")
    key = F.when(k % 11 == 0, k + 1_000_000).otherwise(k).alias("o_custkey")
    asked = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return asked.select(key).unionByName(asked.where(k % 5 == 0).select(key))


def history_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.history_batch(_history_requests(spark, sf_dir), _orders(spark, sf_dir), "o_custkey", "o_orderkey", "at")


def history_batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.lookup_totals(history_batch(spark, sf_dir), _history_requests(spark, sf_dir), "o_custkey")


def _subscriber_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    kind = F.when(k % 3 == 0, "imsi").when(k % 3 == 1, "msisdn").otherwise("email")
    number = F.when(k % 7 == 0, k + 1_000_000).otherwise(k)
    value = F.when(k % 3 == 0, projection.imsi_of(number)).otherwise(projection.msisdn_of(number))
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(k.alias("request_id"), kind.alias("type"), value.alias("value"))


def subscriber_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = projection.sim_history(spark, sf_dir).withColumn("assigned_at", epoch(F.col("assigned_at")))
    return lookups.subscriber_batch(_subscriber_requests(spark, sf_dir), profiles.withColumn("at", F.col("assigned_at")), ["at"])


def subscriber_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of requests of two key types, every fourth asked twice: how many rows were found."""
    asked = _subscriber_requests(spark, sf_dir)
    requests = asked.unionByName(asked.where("request_id % 4 = 0"))
    profiles = projection.sim_history(spark, sf_dir).withColumn("at", F.col("assigned_at"))
    return lookups.lookup_totals(lookups.subscriber_batch(requests, profiles, ["at"]), requests, "type", "value")


def order_page_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page in the middle of all orders by date, wherever that is, by rank."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", epoch(F.col("o_orderdate").cast("timestamp")).alias("at"))
    ranked = lookups.Ranked(orders, ["at", "o_orderkey"])
    first = ranked.total // 2
    return ranked.between(first, first + 50).select("o_orderkey", "o_custkey", "at", F.lit(ranked.total).cast("long").alias("total"))


def dedup_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over one key store: the odd records after the even ones, whose keys the store has."""
    records = files.materialised(_valid(spark, sf_dir), "valid")
    path = files.scratch_folder(spark, "keys")
    store = keystore.KeyStore(spark, f"keys_{path.rpartition('-')[2]}", path, max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    store.add(dedup.new_keys(dedup.mark_long_term(records.where("seq % 2 = 0"))))
    return dedup.mark_long_term(records.where("seq % 2 = 1"), store.keys()).select("seq", "is_duplicate")


def rpt_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's counts from three parts' partial counts, each part kept apart until the last step."""
    marked = _outputs(spark, sf_dir, write=("marked",)).marked
    part = lambda k: report.batch_counts(marked.where(F.col("seq") % 3 == k))
    return report.merged_counts(part(0).unionByName(part(1)).unionByName(part(2))).withColumn("day", epoch(F.col("day").cast("timestamp")))


def rpt_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.conflict_rate(_outputs(spark, sf_dir, write=()).marked, dedup.KEY)


def rpt_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _outputs(spark, sf_dir, write=("annotated",))
    return report.with_rate(report.code_section(out.annotated, "ERR_LATE_ARRIVAL"), out.stored_keys)


def rpt_missing_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.missing_top(validate.invalid_log(_annotated(spark, sf_dir), F.col("ingest_ts")))


def tac_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.page(projection.tac_registry(spark, sf_dir), ["tac_code"], 2, 10, {"manufacturer": "BRAND#12"}).select("tac_code", "manufacturer", "device_type", "total", "pages")


def _tac_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.accounting(spark, sf_dir).select(tac_of(F.col("imei")).alias("tac_code"))


def tac_batch_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    tac = projection.tac_registry(spark, sf_dir).withColumnRenamed("tac_code", "code")
    return lookups.batch_lookup(_tac_requests(spark, sf_dir), "tac_code", tac, "code").select("tac_code", "manufacturer", "device_type", "found")


def tac_lookup_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = _tac_requests(spark, sf_dir)
    tac = projection.tac_registry(spark, sf_dir).withColumnRenamed("tac_code", "code")
    return lookups.lookup_totals(lookups.batch_lookup(requests, "tac_code", tac, "code"), requests, "tac_code")


def clean_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["acct_status_type", "acct_session_id", "acct_session_time", "event_timestamp", "ingest_timestamp", "msisdn", "imsi", "imei", "framed_ip", "late_arrival"]
    out = sinks.clean_projection(_outputs(spark, sf_dir, "acct_session_time", "rat_type", "framed_ip", "nas_ip", "mcc_mnc", write=()).clean, "seq").select("seq", *columns)
    return out.withColumn("event_timestamp", epoch(F.col("event_timestamp"))).withColumn("ingest_timestamp", epoch(F.col("ingest_timestamp")))


def clean_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages written and parsed again."""
    clean = _outputs(spark, sf_dir, write=()).clean.select("seq", "msisdn", "acct_session_id", "imei")
    read = sinks.to_messages(clean, "msisdn").select(F.col("key").alias("message_key"), F.from_json("value", "seq long, acct_session_id string, imei string").alias("d"))
    return read.select("d.seq", "message_key", "d.acct_session_id", "d.imei")


def pipeline_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain.counts(_outputs(spark, sf_dir))


def gen_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts and stops of sessions made from orders."""
    rows = validate.normalised(projection.order_sessions(spark, sf_dir))
    session = F.substring("acct_session_id", 6, 10).cast("long")
    at = lambda status: F.max(F.when(F.col("acct_status_type") == status, epoch(F.col("event_ts"))))
    return rows.groupBy(session.alias("session"), "msisdn", "imsi").agg(at("Start").alias("start_at"), at("Stop").alias("stop_at")).select("session", "start_at", "stop_at", "msisdn", "imsi")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline_counts(spark, sf_dir)


def queries() -> dict[str, Query]:
    own = (
        val_first_error, val_error_counts, e164_plan, late_split, late_buckets, dedup_ttl, dedup_long_term, dup_log, conflict_log_rows, identity_history, msisdn_history, latest_profile, swap_verified,
        active_sessions, number_verify, sim_swap_served, number_verify_served, rpt_imei, rpt_duplicates_hourly, rpt_conflict, rpt_late, rpt_missing_top5, chain_duplicates, csv_chain_counts, e164_totals, history_batch, history_batch_totals, subscriber_batch, subscriber_totals, order_page_deep, dedup_seen, rpt_batch_counts, tac_page, tac_batch_lookup, tac_lookup_totals, clean_projection, clean_json, pipeline_counts, gen_sessions,
    )
    return {f.__name__: f for f in own} | {
        "conflict_a": _conflict("is_a", "acct_session_id", "imsi", "msisdn"),
        "conflict_b": _conflict("is_b", "acct_session_id", "imsi"),
        "conflict_c": _conflict("is_c", "msisdn", "previous_imsi", "imsi"),
        "conflict_d": _conflict("is_d", "msisdn", "previous_imei", "imei"),
        "sim_swap_check": _swap_query("SIM_SWAP", False),
        "sim_swap_retrieve_date": _swap_query("SIM_SWAP", True),
        "device_swap_check": _swap_query("DEVICE_SWAP", False),
        "device_swap_retrieve_date": _swap_query("DEVICE_SWAP", True),
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracle.QUERIES)
