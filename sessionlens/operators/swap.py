"""JOIN-8: SIM and device swaps, confirmed against identity histories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.operators.lookups import latest_two

KINDS = {"imsi": ("SIM_SWAP", "RADIUS_CONFLICT_C", "is_c"), "imei": ("DEVICE_SWAP", "RADIUS_CONFLICT_D", "is_d")}


def confirmed(marked: DataFrame, history: DataFrame, identity: str, at: str = "assigned_at") -> DataFrame:
    """swap_event rows of conflict C (identity imsi) or D (imei) candidates.

    A candidate is confirmed if the number's history has two entries or more and the candidate's identity is the latest;
    the old one is that before it. Several records may confirm one swap. history: msisdn, the identity, at.
    """
    kind, source, flag = KINDS[identity]
    last = latest_two(history.select(F.col("msisdn").alias("__msisdn"), identity, at), "__msisdn", identity, at)
    found = marked.where(F.col(flag)).join(last, (F.col("msisdn") == F.col("__msisdn")) & (F.col(identity) == F.col("latest")))
    none = F.lit(None).cast("string")
    pairs = {f"{age}_{i}": (F.col("previous" if age == "old" else "latest") if i == identity else none) for i in KINDS for age in ("old", "new")}
    return found.select("msisdn", *[c.alias(n) for n, c in pairs.items()], F.lit(kind).alias("swap_type"), F.col("event_ts").alias("detected_at"), F.col("assigned_at").alias("confirmed_at"), F.lit(source).alias("source"))


def swap_events(marked: DataFrame, sim_history: DataFrame, device_history: DataFrame) -> DataFrame:
    """SET-2: both kinds."""
    return confirmed(marked, sim_history, "imsi").unionByName(confirmed(marked, device_history, "imei"))
