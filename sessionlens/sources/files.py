"""Readers: CSV records and registries, JSON payloads, streams from files or a topic (SRC-1 to SRC-11).

Readers of records add `seq`, the arrival order, as text that sorts: the chain takes it where event times tie. A batch of
files has it by file and row; a topic by partition and offset. A stream of files knows no row numbers, so rows of one file
come by the hash of their values there; content=True gives batches that order too.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlens.functions.columns import padded, parse_ts, place
from sessionlens.schemas import RAW, RAW_COLUMNS


def file_order(content: bool) -> Column:
    """Where a row of a file source came from."""
    row = padded(F.hex(F.xxhash64(*RAW_COLUMNS)), 16) if content else padded(F.monotonically_increasing_id())
    return place(F.col("_metadata.file_path"), padded(F.col("_metadata.file_block_start")), row).alias("seq")


def read_table(spark: SparkSession, path: str, schema: T.StructType, *others: Column) -> DataFrame:
    """A CSV with header; blanks around names and values are dropped, columns beyond the header's are ignored.

    Columns go by name, so files may order them as they like.
    """
    raw = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).option("mode", "PERMISSIVE").csv(path)
    names = {c.strip(): c for c in raw.columns}
    own = raw.select(*[(F.col(f"`{names[f.name]}`") if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema], "_metadata")
    return own.select(*[f.name for f in schema], *others)


def read_csv(spark: SparkSession, path: str, content: bool = False) -> DataFrame:
    """SRC-1: raw records and seq."""
    return read_table(spark, path, RAW, file_order(content))


def count_csv(spark: SparkSession, path: str) -> int:
    """SRC-2."""
    return read_csv(spark, path).count()


def decode(messages: DataFrame, schema: T.StructType = RAW, column: str = "value", *others: Column) -> DataFrame:
    """SRC-5: JSON payloads as columns, after others as they are; text that is no JSON gives nulls."""
    return messages.select(F.from_json(F.col(column).cast("string"), schema).alias("d"), *others).select("d.*", *[c for c in messages.select(*others).columns])


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder in the one that driver and executors share (spark.checkpoint.dir; a temporary one in local runs without it)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="sessionlens-")
    return f"{path.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialised(df: DataFrame, label: str) -> DataFrame:
    """df as a table in the shared folder: what reads it more than once doesn't run its plan again, and lost executors reread it."""
    spark, path = df.sparkSession, scratch_folder(df.sparkSession, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def delete(spark: SparkSession, path: str) -> bool:
    """Deletes a folder or file through Hadoop's file systems."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def topic_options(servers: str, topic: str, max_offsets: int | None = 20_000) -> dict[str, str]:
    """SRC-3, SRC-4: options of a topic source: from the earliest offset, going on over lost data, so many offsets a trigger."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", "failOnDataLoss": "false", "kafka.metadata.max.age.ms": "10000"}
    return options | ({"maxOffsetsPerTrigger": str(max_offsets)} if max_offsets else {})


def topic_stream(spark: SparkSession, servers: str, topic: str, schema: T.StructType = RAW, max_offsets: int | None = 20_000) -> DataFrame:
    """Needs Spark's Kafka connector on the class path; load() names it if it is missing."""
    return decode_topic(spark.readStream.format("kafka").options(**topic_options(servers, topic, max_offsets)).load(), schema)


def decode_topic(messages: DataFrame, schema: T.StructType = RAW) -> DataFrame:
    """Records and seq of a topic's messages (value, partition, offset)."""
    return decode(messages, schema, "value", place(padded(F.col("partition")), padded(F.col("offset"))).alias("seq"))


def file_stream(spark: SparkSession, path: str, kind: str = "json", schema: T.StructType = RAW, files_per_trigger: int | None = None) -> DataFrame:
    """Records and seq of the files that come into a folder."""
    reader = spark.readStream.format(kind).schema(schema)
    if kind == "csv":
        reader = reader.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
    reader = reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader
    return reader.load(path).select("*", file_order(True))


def read_tac(spark: SparkSession, path: str) -> DataFrame:
    """SRC-6: the TAC registry; bands as an array; the last row of a code in file order wins."""
    text = T.StructType([T.StructField(c, T.StringType()) for c in ("tac_code", "manufacturer", "model", "device_type", "operating_system", "band_support", "approved_date", "status")])
    rows = read_table(spark, path, text, F.monotonically_increasing_id().alias("__at"))
    last = F.row_number().over(Window.partitionBy("tac_code").orderBy(F.desc("__at"))) == 1
    return rows.withColumn("__last", last).where("__last").drop("__at", "__last").withColumn("band_support", F.split(F.coalesce("band_support", F.lit("")), ";"))


def read_subscribers(spark: SparkSession, path: str) -> DataFrame:
    """SRC-7: every row (numbers and imsis may repeat), flags as a struct of booleans, times with a doubled zone read too."""
    flags = ("data_enabled", "roaming_enabled", "volte_enabled")
    names = ("imsi", "msisdn", "status", "mcc", "mnc", "operator", *flags, "registered_at", "last_updated")
    rows = read_table(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in names]))
    profile = F.struct(*[(F.lower(F.coalesce(c, F.lit(""))) == "true").alias(c) for c in flags])
    return rows.select("imsi", "msisdn", "status", "mcc", "mnc", "operator", profile.alias("service_profile"), parse_ts(F.col("registered_at")).alias("registered_at"), parse_ts(F.col("last_updated")).alias("last_updated"))


def read_devices(spark: SparkSession, path: str) -> DataFrame:
    """SRC-8."""
    rows = read_table(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in ("msisdn", "imei", "assigned_at")]))
    return rows.withColumn("assigned_at", parse_ts(F.col("assigned_at")))


def read_number_plan(spark: SparkSession, countries: str, prefixes: str) -> tuple[DataFrame, DataFrame]:
    """SRC-9."""
    text = lambda *names: T.StructType([T.StructField(c, T.StringType()) for c in names])
    return read_table(spark, countries, text("country_code", "country_name")), read_table(spark, prefixes, text("country_code", "prefix")).distinct()


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int) -> DataFrame:
    """SRC-11: a table of a database in parallel ranges of a numeric key. Needs the driver's jar on the class path."""
    options = {"url": url, "dbtable": table, "partitionColumn": key, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(parts)}
    return spark.read.format("jdbc").options(**options).load()
