"""Accounting records and reference tables from a generic event log, customers, parts and orders.

The raw records are strings, as they come from a file or a topic, with timestamps in both formats; so the whole chain runs
on them. `seq` is the arrival order. A fixed share of the events carries each kind of fault: blank and malformed numbers,
numbers of unknown countries and operators, unreadable, missing and impossible times, unknown subscribers and devices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens.functions.columns import apart, luhn_digit
from sessionlens.operators.validate import Dims

#: A small number plan of our own choice: country names, and operator prefixes by country.
COUNTRIES = [("31", "Netherlands"), ("351", "Portugal"), ("420", "Czechia"), ("52", "Mexico"), ("7", "Kazakhstan")]
PREFIXES = [("31", str(p)) for p in range(61, 70)] + [("351", "91"), ("420", "601"), ("420", "777"), ("7", "70")]


def _padded(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def imsi_of(number: Column) -> Column:
    return F.concat(F.lit("452010"), _padded(number, 9))


def msisdn_of(number: Column) -> Column:
    return F.concat(F.lit("+3165"), _padded(number, 7))


def imei_body(tac: Column, serial: Column) -> Column:
    return F.concat(_padded(tac, 6), F.lit("00"), _padded(serial % 1000000, 6))


def with_digit(body: Column) -> Column:
    return F.concat(body, luhn_digit(body))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq and the twelve raw columns."""
    e, u = F.col("event_id"), F.col("user_id")
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    delay = F.when(e % 20 == 3, 3600).when(e % 20 == 5, 3601).when(e % 20 == 7, 10800).otherwise(2)
    status = F.when(F.col("event_type").isin("signup", "click"), "Start").when(F.col("event_type") == "purchase", "Stop").when(F.col("event_type") == "view", "Interim-Update").otherwise("Accounting-On")
    abroad = F.when(e % 101 == 0, F.concat(F.lit("+999"), _padded(u, 8))).when(e % 103 == 0, F.concat(F.lit("+3110"), _padded(u, 7)))
    msisdn = F.when(e % 211 == 0, "").when(e % 97 == 0, "090abc").otherwise(F.coalesce(abroad, msisdn_of(u)))
    subscriber = F.when(e % 50 == 0, u + 100000).when(e % 37 == 0, (u + 1) % 100).otherwise(u)
    body = imei_body(F.when(e % 41 == 0, F.lit(999999)).otherwise(u % 40), u * 7919 + F.when(e % 43 == 0, 1).otherwise(0))
    digit = luhn_digit(body)
    imei = F.concat(body, F.when(e % 53 == 0, ((digit.cast("int") + 1) % 10).cast("string")).otherwise(digit))
    iso = lambda c: F.date_format(F.timestamp_seconds(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    text = lambda c: F.when(e % 2 == 0, c.cast("string")).otherwise(iso(c))
    wrong = F.when(e % 61 == 0, e % 4)
    columns = {
        "acct_status_type": status,
        "acct_session_id": F.concat(F.lit("SESS_"), u.cast("string"), F.lit("_"), F.floor(e / 300).cast("string")),
        "acct_session_time": (e % 3600).cast("string"),
        "event_timestamp": F.when(wrong == 0, "soon").when(wrong == 1, "946684799").when(wrong == 3, " ").otherwise(text(at)),
        "ingest_timestamp": F.when(wrong == 2, "later").otherwise(text(at + delay)),
        "msisdn": msisdn,
        "imsi": imsi_of(subscriber),
        "imei": imei,
        "rat_type": F.lit("E-UTRAN"),
        "framed_ip": F.when(e % 10 == 0, "").otherwise(F.concat_ws(".", F.lit("10.100"), (F.floor(u / 256) % 256).cast("string"), (u % 256).cast("string"))),
        "nas_ip": F.lit("192.168.1.1"),
        "mcc_mnc": F.lit("452-01"),
    }
    # The file is compressed and has few splits, and the rules cost more than the rows: these are dealt over all cores first.
    dealt = events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type").repartition(2 * spark.sparkContext.defaultParallelism, "event_id")
    return dealt.select(apart(e).alias("seq"), *[c.alias(n) for n, c in columns.items()])


def tac_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return part.select(_padded(F.col("p_partkey"), 6).alias("tac_code"), F.col("p_brand").alias("manufacturer"), F.col("p_name").alias("model"), F.col("p_type").alias("device_type"))


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return customer.select(imsi_of(F.col("c_custkey")).alias("imsi"), msisdn_of(F.col("c_custkey")).alias("msisdn"))


def _constants(spark: SparkSession, rows: list[tuple[str, str]], *names: str) -> DataFrame:
    """A table that is part of the plan: no Python worker makes its rows."""
    return spark.range(1).select(F.inline(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r, strict=True)]) for r in rows])))


def dims(spark: SparkSession, sf_dir: str, unavailable: frozenset[str] = frozenset()) -> Dims:
    countries = _constants(spark, COUNTRIES, "country_code", "country_name")
    prefixes = _constants(spark, PREFIXES, "country_code", "prefix")
    return Dims(tac_registry(spark, sf_dir), subscribers(spark, sf_dir), countries, prefixes, unavailable)


def sim_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """msisdn, imsi, assigned_at: every customer's first SIM, and a second one for every fifth."""
    k = F.col("c_custkey")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey")
    first = customer.select(msisdn_of(k).alias("msisdn"), imsi_of(k).alias("imsi"), F.timestamp_seconds(F.lit(1700000000) + k).alias("assigned_at"))
    second = customer.where(k % 5 == 0).select(msisdn_of(k).alias("msisdn"), imsi_of((k + 1) % 100).alias("imsi"), F.timestamp_seconds(F.lit(1704000000) + k * 1000).alias("assigned_at"))
    return first.unionByName(second)


def device_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """msisdn, imei, assigned_at: every customer's first device, and a second one for every fourth."""
    k = F.col("c_custkey")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey")
    imei = lambda step: with_digit(imei_body(k % 40, k * 7919 + step))
    first = customer.select(msisdn_of(k).alias("msisdn"), imei(0).alias("imei"), F.timestamp_seconds(F.lit(1700000000) + k).alias("assigned_at"))
    second = customer.where(k % 4 == 0).select(msisdn_of(k).alias("msisdn"), imei(1).alias("imei"), F.timestamp_seconds(F.lit(1704000000) + k * 1000).alias("assigned_at"))
    return first.unionByName(second)


def order_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records of one session an order: a Start at its date and a Stop later, seq among them. GEN-1's shape from a table."""
    k, who = F.col("o_orderkey"), F.col("o_custkey")
    at = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    lasts = 60 + k % 3600
    both = F.explode(F.array(F.struct(F.lit("Start").alias("status"), F.lit(0).cast("long").alias("after")), F.struct(F.lit("Stop").alias("status"), lasts.alias("after"))))
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select("*", both.alias("x"))
    after, event = F.col("x.after"), at + F.col("x.after")
    columns = {
        "acct_status_type": F.col("x.status"),
        "acct_session_id": F.concat(F.lit("SESS_"), _padded(k, 10)),
        "acct_session_time": after.cast("string"),
        "event_timestamp": event.cast("string"),
        "ingest_timestamp": (event + 2).cast("string"),
        "msisdn": msisdn_of(who),
        "imsi": imsi_of(who),
        "imei": with_digit(imei_body(who % 40, k)),
        "rat_type": F.lit("E-UTRAN"),
        "framed_ip": F.lit(""),
        "nas_ip": F.lit("192.168.1.1"),
        "mcc_mnc": F.lit("452-01"),
    }
    return rows.select((k * 2 + (after > 0).cast("long")).alias("seq"), *[c.alias(n) for n, c in columns.items()])
