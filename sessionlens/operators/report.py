"""The data-quality report (AGG-1 to AGG-6): a row or a few for each section, from the logs."""

from __future__ import annotations

from html import escape
from string import Template

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def rate(n: Column, total: Column) -> Column:
    """Percent with two digits, half up; 0 where there is nothing to divide by."""
    share = F.round(n.cast("decimal(20,0)") * 100 / total.cast("decimal(20,0)"), 2)
    return F.when(total > 0, share).otherwise(F.lit(0)).cast("decimal(20,2)")


def with_rate(counts: DataFrame, sessions: DataFrame) -> DataFrame:
    """A one-row table with its rate against the stored sessions."""
    total = sessions.agg(F.count(F.lit(1)).alias("stored"))
    return counts.join(F.broadcast(total)).withColumn("rate", rate(F.col("total"), F.col("stored"))).drop("stored")  # one row each


def imei_section(invalid: DataFrame) -> DataFrame:
    own = invalid.where(F.col("error_code").startswith("ERR_IMEI"))
    count = lambda code: F.count_if(F.col("error_code") == code)
    return own.agg(count("ERR_IMEI_LUHN_FAIL").alias("luhn_fail"), count("ERR_IMEI_TAC_UNKNOWN").alias("tac_unknown"), F.count(F.lit(1)).alias("total"))


def duplicates_hourly(duplicates: DataFrame) -> DataFrame:
    return duplicates.groupBy(F.hour("detected_at").alias("hour")).agg(F.count(F.lit(1)).alias("n")).orderBy("hour")


def conflict_section(conflicts: DataFrame) -> DataFrame:
    kind = lambda k: F.count_if(F.col("conflict_type") == k).alias(f"type_{k.lower()}")
    return conflicts.agg(kind("A"), kind("B"), kind("C"), F.count(F.lit(1)).alias("total"))


def conflict_rate(marked: DataFrame, key: list[str]) -> DataFrame:
    """with_rate(conflict_section(conflict_log), stored) in one read of the marked records: they are counted by key (where the
    clean ones are stored once), and the counts added up."""
    a, b = F.col("is_a"), F.col("is_b") & ~F.col("is_a")
    keys = marked.groupBy(*key).agg(F.count_if(a).alias("a"), F.count_if(b).alias("b"), F.max(~a & ~F.col("is_b")).cast("bigint").alias("s"))
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    out = keys.agg(n("a").alias("type_a"), n("b").alias("type_b"), F.lit(0).cast("bigint").alias("type_c"), n(F.col("a") + F.col("b")).alias("total"), n("s").alias("stored"))
    return out.withColumn("rate", rate(F.col("total"), F.col("stored"))).drop("stored")


def code_section(invalid: DataFrame, code: str) -> DataFrame:
    return invalid.where(F.col("error_code") == code).agg(F.count(F.lit(1)).alias("total"))


def missing_top(invalid: DataFrame, n: int = 5) -> DataFrame:
    own = invalid.where(F.col("error_code") == "ERR_MISSING_FIELD")
    return own.groupBy("details").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "details").limit(n)


#: Counts that batches keep and a report adds up (AGG-1 to AGG-6): name, and which rows count.
COUNTED = {
    "kept": lambda: F.lit(True),
    "clean": lambda: ~F.col("is_a") & ~F.col("is_b"),
    "type_a": lambda: F.col("is_a"),
    "type_b": lambda: F.col("is_b") & ~F.col("is_a"),
    "swaps_c": lambda: F.col("is_c"),
    "swaps_d": lambda: F.col("is_d"),
}


def batch_counts(marked: DataFrame) -> DataFrame:
    """day (of arrival), name, n: what a batch adds to the report, a few rows."""
    names = F.explode(F.filter(F.array(*[F.when(which(), F.lit(k)) for k, which in COUNTED.items()]), lambda x: x.isNotNull())).alias("name")
    return marked.select(F.to_date("ingest_ts").alias("day"), names).groupBy("day", "name").agg(F.count(F.lit(1)).alias("n"))


def merged_counts(partial: DataFrame) -> DataFrame:
    """The batches' counts added up; the same as batch_counts of all their records together."""
    return partial.groupBy("day", "name").agg(F.sum("n").alias("n"))


PAGE = Template("<!DOCTYPE html><html><head><meta charset='utf-8'><title>Data quality</title></head><body><h1>Data quality</h1>$sections</body></html>")


#: Rows that a section may have: sections are aggregates.
SECTION_ROWS = 1000


def sections(annotated: DataFrame, conflicts: DataFrame, stored: DataFrame, duplicates: DataFrame, invalid_log: DataFrame) -> dict[str, DataFrame]:
    """All sections of the report, by title; rates are shares of the stored sessions."""
    wrong = annotated.where(F.col("error_code").isNotNull())
    log_total = duplicates.agg(F.count(F.lit(1)).alias("total"))
    return {
        "Stored sessions": stored.agg(F.count(F.lit(1)).alias("total")),
        "IMEI errors": with_rate(imei_section(wrong), stored),
        "Duplicates": with_rate(log_total, stored),
        "Duplicates by hour": duplicates_hourly(duplicates),
        "Conflicts": with_rate(conflict_section(conflicts), stored),
        "Late arrivals": with_rate(code_section(wrong, "ERR_LATE_ARRIVAL"), stored),
        "Missing fields": with_rate(code_section(wrong, "ERR_MISSING_FIELD"), stored),
        "Fields missing most": missing_top(invalid_log),
    }


def html_page(sections: dict[str, DataFrame], progress: dict[str, dict] | None = None) -> str:
    """The sections as tables, and a stream's progress by query. A section of more than SECTION_ROWS rows is an error."""
    tables = {}
    for title, df in sections.items():
        rows = df.limit(SECTION_ROWS + 1).collect()
        if len(rows) > SECTION_ROWS:
            raise ValueError(f"section {title} has more than {SECTION_ROWS} rows")
        tables[title] = (df.columns, rows)
    if progress:
        names = sorted({k for p in progress.values() for k in p})
        tables["Streams"] = (["query", *names], [[q, *[p.get(k) for k in names]] for q, p in progress.items()])
    row = lambda tag, cells: "<tr>" + "".join(f"<{tag}>{escape(str(x))}</{tag}>" for x in cells) + "</tr>"
    parts = [f"<h2>{escape(title)}</h2><table>{row('th', head)}{''.join(row('td', r) for r in rows)}</table>" for title, (head, rows) in tables.items()]
    return PAGE.substitute(sections="".join(parts))


def html_report(spark: SparkSession, sections: dict[str, DataFrame], path: str, progress: dict[str, dict] | None = None) -> None:
    """SNK-9: writes the page where path says, through Hadoop's file systems. A failure is raised, never filled in."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(html_page(sections, progress), "utf-8"))
    finally:
        out.close()
