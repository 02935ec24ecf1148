"""Lookups against reference tables: device types, number plan, subscribers, identity histories, pages of a list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.functions.columns import E164_PLAN, trimmed
from sessionlens.sources.files import delete, materialised

#: Rows from a list's start up to which a page is a plain top-k; further ones go by the index of ranks.
SHALLOW = 10_000


def number_plan(df: DataFrame, number: str, countries: DataFrame, prefixes: DataFrame) -> DataFrame:
    """LKP-3, JOIN-7: adds plan_valid, plan_error, plan_detail, country_code, country_name, subscriber_number, operator.

    The shortest country code of 1 to 3 digits and the shortest operator prefix of 2 or 3 digits win: equi-joins on
    each length, never a prefix comparison of all pairs. The plan has a few hundred countries and a few thousand prefixes of
    2 or 3 digits, so it is broadcast whatever Spark takes its size for: as a shuffle, records of one country meet in one task.
    """
    n = trimmed(F.col(number))
    out = df.withColumn("__n", F.when(n.rlike(E164_PLAN), F.substring(n, 2, 15)))
    for k in (1, 2, 3):
        cc = countries.select(F.col("country_code").alias(f"__cc{k}"), F.col("country_name").alias(f"__cn{k}")).where(F.length(f"__cc{k}") == k).distinct()
        out = out.join(F.broadcast(cc), F.substring("__n", 1, k) == F.col(f"__cc{k}"), "left")
    code = F.coalesce("__cc1", "__cc2", "__cc3")
    out = out.withColumn("country_code", code).withColumn("country_name", F.coalesce("__cn1", "__cn2", "__cn3"))
    out = out.withColumn("subscriber_number", F.expr("substring(__n, length(country_code) + 1)"))
    for k in (2, 3):
        op = prefixes.select(F.col("country_code").alias(f"__oc{k}"), F.col("prefix").alias(f"__op{k}")).where(F.length(f"__op{k}") == k).distinct()
        out = out.join(F.broadcast(op), (F.col("country_code") == F.col(f"__oc{k}")) & (F.substring("subscriber_number", 1, k) == F.col(f"__op{k}")), "left")
    prefix = F.coalesce("__op2", "__op3")
    # Each failed check with its code and text, in order.
    checks = [
        (F.col("__n").isNull(), "INVALID_FORMAT", "Number must start with '+' followed by 10-15 digits"),
        (F.col("country_code").isNull(), "UNKNOWN_COUNTRY", "Country code is not supported by ITU database"),
        (F.length("subscriber_number") < 7, "INVALID_FORMAT", "Subscriber number part is too short"),
        (prefix.isNull(), "UNKNOWN_OPERATOR", "Unknown network operator prefix"),
    ]
    error = F.coalesce(*[F.when(c, F.lit(e)) for c, e, _ in checks])
    detail = F.coalesce(*[F.when(c, F.lit(d)) for c, _, d in checks])
    out = out.withColumn("plan_error", error).withColumn("plan_detail", detail).withColumn("plan_valid", F.col("plan_error").isNull())
    for c, value in (("operator", F.concat(F.lit("Operator_"), prefix)), ("country_code", F.col("country_code")), ("country_name", F.col("country_name")), ("subscriber_number", F.col("subscriber_number"))):
        out = out.withColumn(c, F.when(F.col("plan_valid"), value))
    return out.drop("__n", *[f"__{a}{k}" for a in ("cc", "cn", "oc", "op") for k in (1, 2, 3)])


def last_per_key(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """LKP-7, WIN-9: the last row of each key; a partial aggregation, so a frequent key costs no sort."""
    others = [c for c in rows.columns if c != key]
    last = F.max_by(F.struct(*others), F.struct(*order)).alias("last")
    return rows.groupBy(key).agg(last).select(key, *[F.col(f"last.{c}").alias(c) for c in others])


def batch_lookup(requests: DataFrame, key: str, table: DataFrame, table_key: str) -> DataFrame:
    """LKP-2, LKP-11, JOIN-5, JOIN-6: one row a distinct requested key, with found and the table's columns."""
    keys = requests.select(F.col(key)).distinct()
    marked = table.withColumnRenamed(table_key, "__key").withColumn("__found", F.lit(True))
    out = keys.join(marked, keys[key] == marked["__key"], "left").withColumn("found", F.coalesce("__found", F.lit(False)))
    return out.drop("__found", "__key")


def lookup_totals(looked_up: DataFrame, requests: DataFrame, *keys: str) -> DataFrame:
    """AGG-10: total counts the request's rows, repeats too; found and not_found are such rows. looked_up has a row or more a key.

    Both sides are added up by key before they meet; a null key meets a null key.
    """
    asked = requests.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.lit(False).alias("f"))
    known = looked_up.groupBy(*keys).agg(F.lit(0).cast("long").alias("n"), F.max("found").alias("f"))
    both = asked.unionByName(known).groupBy(*keys).agg(F.sum("n").alias("n"), F.max("f").alias("found"))
    count = lambda which: F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0)).cast("long")
    return both.agg(count(F.lit(True)).alias("total"), count(F.col("found")).alias("found"), count(~F.col("found")).alias("not_found"))


def plan_batch(requests: DataFrame, number: str, countries: DataFrame, prefixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """LKP-4: (the plan's answer for each distinct number; total, valid_count and invalid_count of the request's rows)."""
    answers = number_plan(requests.select(number).distinct(), number, countries, prefixes)
    totals = lookup_totals(answers.select(number, F.col("plan_valid").alias("found")), requests, number)
    return answers, totals.withColumnsRenamed({"found": "valid_count", "not_found": "invalid_count"})


def subscriber_batch(requests: DataFrame, subscribers: DataFrame, order: list[str]) -> DataFrame:
    """LKP-11: requests (type, value) plus found and the profile: each row's own key type, imsi or msisdn; any other finds nothing.

    Of several profiles of a key the last one in the given order wins. One join a key type, on keys that are unique there.
    """
    out, others = None, [c for c in subscribers.columns if c not in order]
    for kind in ("imsi", "msisdn"):
        last = last_per_key(subscribers.where(F.col(kind).isNotNull()).withColumn("__value", F.col(kind)), "__value", order)
        own = last.select(F.lit(kind).alias("__type"), "__value", F.struct(*others).alias("__profile"))
        out = own if out is None else out.unionByName(own)
    met = requests.join(out, (F.col("type") == F.col("__type")) & (F.col("value") == F.col("__value")), "left")
    return met.select(*[requests[c] for c in requests.columns], F.col("__type").isNotNull().alias("found"), *[F.col(f"__profile.{c}").alias(c) for c in others])


def history_batch(requests: DataFrame, rows: DataFrame, key: str, value: str, at: str) -> DataFrame:
    """LKP-10: the identity histories of the requested keys, a row an entry, with found; a key without any has one row."""
    asked = requests.select(key).distinct()
    own = identity_history(rows.join(asked, key, "left_semi"), key, value, at).withColumn("__found", F.lit(True))
    return asked.join(own, key, "left").withColumn("found", F.coalesce("__found", F.lit(False))).drop("__found")


def tac_lookup(requests: DataFrame, tac: DataFrame) -> DataFrame:
    """LKP-1: status 422 unless the code is six digits, 404 if it is unknown, else 200 and the record."""
    looked = requests.join(tac.withColumn("__found", F.lit(True)), "tac_code", "left")
    known = F.coalesce("__found", F.lit(False))
    status = F.when(~F.coalesce(F.col("tac_code").rlike("^[0-9]{6}$"), F.lit(False)), 422).when(known, 200).otherwise(404)
    return looked.withColumn("http_status", status).drop("__found")


class Ranked:
    """A list in order, stored by rank, so that any page is a read of its own rows.

    Rows are dealt by range of the order and sorted there; a row's number is its range and its place in it, which is also how
    the files are sorted. Counts a range (one row a partition) turn a rank into numbers, and the scan skips what lies outside.
    """

    def __init__(self, rows: DataFrame, order: list[str], parts: int | None = None) -> None:
        spark = rows.sparkSession
        dealt = rows.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order)
        self.rows = materialised(dealt.withColumn("__at", F.monotonically_increasing_id()), "ranked")
        counts = self.rows.groupBy(F.shiftright("__at", 33).alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
        self.counts = [(r.part, r.n) for r in sorted(counts)]
        self.total = sum(n for _, n in self.counts)
        self.delete = lambda: delete(spark, self.rows.scratch_path)

    def between(self, first: int, after: int) -> DataFrame:
        """The rows of ranks first to after - 1 (from 0)."""
        wanted, before = F.lit(False), 0
        for part, n in self.counts:
            lo, hi = max(first - before, 0), min(after - before, n)
            if lo < hi:
                wanted = wanted | F.col("__at").between((part << 33) + lo, (part << 33) + hi - 1)
            before += n
        return self.rows.where(wanted).drop("__at")


def page(rows: DataFrame, order: list[str], page_number: int = 1, page_size: int = 50, filters: dict[str, str] | None = None) -> DataFrame:
    """LKP-5, LKP-6: a page of the rows that match the filters (case-insensitive), with total and pages on each row.

    Up to SHALLOW rows a page is a top-k. Beyond, the list is ranked, at any depth; who asks for many pages keeps a Ranked.
    """
    if page_number < 1 or not 1 <= page_size <= 200:
        raise ValueError("page >= 1 and 1 <= page_size <= 200")
    for c, value in (filters or {}).items():
        if value is not None:
            rows = rows.where(F.lower(c) == value.lower())
    first, after = (page_number - 1) * page_size, page_number * page_size
    pages = lambda total: F.ceil(total / page_size).cast("long")
    if after > SHALLOW:
        ranked = Ranked(rows, order)
        return ranked.between(first, after).withColumn("total", F.lit(ranked.total).cast("long")).withColumn("pages", pages(F.col("total")))
    total = rows.agg(F.count(F.lit(1)).alias("total")).withColumn("pages", pages(F.col("total")))
    return rows.orderBy(*order).offset(first).limit(page_size).join(F.broadcast(total))  # one row


def identity_history(rows: DataFrame, key: str, value: str, at: str) -> DataFrame:
    """LKP-8, WIN-6: adds unassigned_at, is_current, swap_reason, swap_count and latest_swap_at, oldest first a key."""
    ordered = Window.partitionBy(key).orderBy(at, value)
    whole = Window.partitionBy(key)
    n = F.count(F.lit(1)).over(whole)
    nxt = F.lead(at).over(ordered)
    return rows.select(
        "*",
        nxt.alias("unassigned_at"),
        (F.row_number().over(ordered) == n).alias("is_current"),
        F.when(F.row_number().over(ordered) == 1, "initial_activation").otherwise("customer_request").alias("swap_reason"),
        (n - 1).alias("swap_count"),
        F.when(n > 1, F.max(at).over(whole)).alias("latest_swap_at"),
    )


def number_history(rows: DataFrame, key: str, value: str, at: str, from_date: Column | None = None, to_date: Column | None = None, limit: int = 20) -> DataFrame:
    """LKP-9, WIN-7: newest first a key; unassigned_at is the newer row's date, is_current marks the newest, both computed
    before the date filter; limit a key; total is a key's rows after the limit."""
    newest = Window.partitionBy(key).orderBy(F.desc(at), F.desc(value))
    out = rows.withColumn("unassigned_at", F.lag(at).over(newest)).withColumn("is_current", F.row_number().over(newest) == 1)
    if from_date is not None:
        out = out.where(F.col(at) >= from_date)
    if to_date is not None:
        out = out.where(F.col(at) <= to_date)
    out = out.withColumn("position", F.row_number().over(newest)).where(F.col("position") <= limit)
    return out.withColumn("total", F.count(F.lit(1)).over(Window.partitionBy(key)))


def latest_two(rows: DataFrame, key: str, value: str, at: str) -> DataFrame:
    """WIN-8: key, latest, previous, assigned_at, entries of keys with two entries or more."""
    ordered, whole = Window.partitionBy(key).orderBy(at, value), Window.partitionBy(key)
    marked = rows.select(key, F.col(value).alias("latest"), F.lag(value).over(ordered).alias("previous"), F.col(at).alias("assigned_at"), F.row_number().over(ordered).alias("n"), F.count(F.lit(1)).over(whole).alias("entries"))
    return marked.where((F.col("n") == F.col("entries")) & (F.col("entries") >= 2)).drop("n")
