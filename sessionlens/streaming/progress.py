"""STR-12, STR-13: progress of streams as a table, and how far a stream is behind its source."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from sessionlens.streaming.commits import Folder

SCHEMA = "query string, run string, batch long, at string, input_rows long, input_rows_per_second double, processed_rows_per_second double, batch_ms long, state_rows long, dropped long, behind long, status string, error string"


def behind(source: dict) -> int | None:
    """Records of a topic between where the stream is and the topic's end, by partition; None for sources without offsets."""
    latest, end = source.get("latestOffset"), source.get("endOffset")
    read = lambda x: json.loads(x) if isinstance(x, str) else x
    try:
        latest, end = read(latest), read(end)
    except ValueError:
        return None
    if not isinstance(latest, dict) or not all(isinstance(x, dict) for x in latest.values()):
        return None
    return sum(n - ((end or {}).get(topic) or {}).get(part, 0) for topic, parts in latest.items() for part, n in parts.items())


def row_of(progress: dict) -> dict:
    """One row of SCHEMA from a query's progress."""
    lags = [x for x in map(behind, progress.get("sources", [])) if x is not None]
    return {
        "query": progress.get("name") or progress["id"], "run": progress["runId"], "batch": progress["batchId"], "at": progress["timestamp"], "input_rows": progress.get("numInputRows"),
        "input_rows_per_second": progress.get("inputRowsPerSecond"), "processed_rows_per_second": progress.get("processedRowsPerSecond"), "batch_ms": (progress.get("durationMs") or {}).get("triggerExecution"),
        "state_rows": sum(x.get("numRowsTotal", 0) for x in progress.get("stateOperators", [])), "dropped": sum(x.get("numRowsDroppedByWatermark", 0) for x in progress.get("stateOperators", [])),
        "behind": sum(lags) if lags else None, "status": "ACTIVE", "error": None,
    }


class ProgressLog(StreamingQueryListener):
    """Writes a file a batch, and one when a query ends. Add it with spark.streams.addListener."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.folder = Folder(spark, path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = row_of(json.loads(event.progress.json))
        self.folder.put(f"progress/{row['run']}-{row['batch']:020d}.json", json.dumps(row))

    def onQueryTerminated(self, event) -> None:
        row = {"query": str(event.id), "run": str(event.runId), "status": "FAILED" if event.exception else "STOPPED", "error": event.exception}
        self.folder.put(f"progress/{event.runId}-end.json", json.dumps(row))


def progress_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows that a ProgressLog wrote."""
    return spark.read.schema(SCHEMA).json(f"{path.rstrip('/')}/progress")


def unread_files(spark: SparkSession, folder: str, checkpoint: str, source: int = 0) -> DataFrame:
    """path, length of the files in a file stream's folder that its checkpoint doesn't list as read yet. Only names are read."""
    there = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")
    log = Folder(spark, f"{checkpoint.rstrip('/')}/sources")
    if not log.names(str(source)):
        return there
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    lines = spark.read.text(f"{log.path}/{source}").select(plain(F.get_json_object("value", "$.path")).alias("__path")).where("__path IS NOT NULL")
    return there.join(lines, plain(F.col("path")) == F.col("__path"), "left_anti")
