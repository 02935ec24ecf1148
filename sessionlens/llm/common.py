"""What the operators of this subpackage share: scratch tables, hashes and word patterns in SQL."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: `[^\x20\x09-\x0D]+`: runs of anything but ASCII white space.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


_local: dict[str, str] = {}
#: Written tables of the blocks that are open, innermost last.
_open: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where it is unset, in local mode only."""
    path, app = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.applicationId
    if not path:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = _local.setdefault(app, "file://" + tempfile.mkdtemp(prefix="sessionlens-"))
    return f"{path.rstrip('/')}/sessionlens-{app}"


def scratch(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def local_path(uri: str) -> str:
    """The POSIX path of a shared folder, for files that Python workers memory-map. The folder must be mounted on every node."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    if "://" in uri:
        raise ValueError(f"memory-mapped arrays need a mounted shared folder in spark.checkpoint.dir, not {uri}")
    return uri


def written(df: DataFrame, label: str) -> DataFrame:
    """Cuts lineage: writes df as Parquet in the shared folder and reads it again. A lost executor costs a reread, not a recomputation."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    if _open:
        _open[-1].append(path)
    release_shuffles(spark)
    return out


@contextmanager
def disposable(spark: SparkSession) -> Iterator[Callable[..., None]]:
    """Deletes the tables written in the block at its end, but for those named to keep(), which the block around it owns then.

    A table may go once all that was made of it is written too. After an error nothing is deleted.
    """
    own: list[str] = []
    _open.append(own)
    kept: set[str] = set()
    try:
        yield lambda *tables: kept.update(t.scratch_path for t in tables)
    except BaseException:
        _open.pop()
        raise
    _open.pop()
    for path in own:
        if path in kept:
            if _open:
                _open[-1].append(path)
        else:
            delete(spark, path)


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def delete(spark: SparkSession, uri: str) -> None:
    """Deletes a scratch folder through Hadoop's file system API."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hash128(*cols: Column) -> Column:
    """16 bytes of SHA-256 over one string column, or over several joined by lengths; equal only for equal values. Null counts as empty."""
    if len(cols) == 1:
        text = F.coalesce(cols[0], F.lit(""))
    else:
        text = F.concat_ws("\x1f", *[F.concat(F.length(c := F.coalesce(x.cast("string"), F.lit("\x00"))), F.lit(":"), c) for x in cols])
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def own_columns(df: DataFrame, *names: str) -> DataFrame:
    """Exactly the named columns: whatever else a table holds, under whatever name, can't clash with an operator's own."""
    return df.select(*[df[n] for n in names])


def ensure_dir(path: str) -> str:
    os.makedirs(path, exist_ok=True)
    return path


#: Copies of a row that one row makes at once.
COPIES = 4096


def repeated(rows: DataFrame, times: str, few: bool = False) -> DataFrame:
    """rows without times (long), each so often, with __copy (long, from 0). Rows of very many copies are dealt out first.

    few: no row has more than COPIES.
    """
    each = lambda df, base, n: df.withColumn("__copy", F.explode(F.sequence(F.lit(0).cast("long"), n - 1))).withColumn("__copy", F.col("__copy") + base)
    times_ = F.col(times)
    out = each(rows.where((times_ > 0) & (times_ <= COPIES)), F.lit(0), times_).drop(times)
    if few:
        return out
    blocks = rows.where(times_ > COPIES).withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(times_ / COPIES) - 1)))
    blocks = blocks.repartition(partitions(rows.sparkSession), "__block")
    many = each(blocks, F.col("__block") * COPIES, F.least(F.lit(COPIES).cast("long"), times_ - F.col("__block") * COPIES))
    return out.unionByName(many.drop(times, "__block"))


#: Texts that a Python worker gets at a time. Whole texts vary too much for a number of rows to bound its memory.
BATCH_BYTES = 16 << 20


def with_package(spark: SparkSession) -> None:
    """Settings that the operators need: Arrow batches of bounded size, shuffle files that go early, and the package's path.

    Workers import the package from where the driver has it; clusters without a shared install use --py-files.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    # What an action shuffled goes when it ends: everything that is used again is written to the shared folder.
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)
