"""Streaming forms of three batch reports. Sources and sinks are the caller's; the functions
transform streaming (or batch) DataFrames and start queries with explicit checkpoints."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def dedupe_sessions(stream: DataFrame, key: str, ts: str, delay: str = "1 day") -> DataFrame:
    """Append-only ingest: each session once; keys are remembered for the watermark delay."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def hourly_counts(stream: DataFrame, ts: str, keys=(), delay: str = "1 hour") -> DataFrame:
    """Tumbling hourly counts with weekday and hour; closed windows are appended."""
    counts = (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, "1 hour").alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("n_events"))
    )
    start = F.col("w.start")
    return counts.select(
        start.alias("hour_start"), (F.weekday(start.cast("date")) + 1).alias("weekday_no"),
        F.hour(start).alias("hour_no"), *keys, "n_events",
    )


def contact_cap_alerts(
    stream: DataFrame, key: str, ts: str, session: str, k: int = 3, days: int = 30,
    delay: str = "1 hour",
) -> DataFrame:
    """Alert on a contact whose k previous contacts of the customer all lie fewer than
    ``days`` days back; contacts are ordered by time and id.

    A contact that arrives late is compared with earlier contacts only, and contacts after it
    that it brings under the limit alert then. Each contact alerts once, with the distance
    known at that time; contacts at or before the watermark are dropped by Spark.

    State per customer: the k last contacts up to the watermark (no later row can come between
    them) and those after it, so it is bounded by k and the contacts within ``delay``. It is
    dropped when the watermark passes the end of the window. The source's rate limit bounds a
    micro-batch; of a customer's rows in it three numbers each are held."""
    kind = dict(stream.dtypes)[key]
    out = f"{key} {kind}, {session} bigint, {ts} timestamp, days_{k} int"
    kept_ms = (days + 1) * 86_400_000
    kept = ("__at", "__id", "__day", "__told")

    def step(keys, chunks, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        known = [np.array(x, "int64") for x in state.get] if state.exists else [np.zeros(0, "int64")] * 4
        parts = [[c[name].to_numpy("int64") for name in kept[:3]] for c in chunks]
        new = [np.concatenate(x) for x in zip(*parts)]
        at, sid, day, told = (np.concatenate(x) for x in zip(known, [*new, np.zeros_like(new[0])]))
        order = np.lexsort((sid, at))
        at, sid, day, told = at[order], sid[order], day[order], told[order]
        gap = np.full(len(at), days)
        gap[k:] = day[k:] - day[:-k]
        hit = (gap < days) & (told == 0)
        told[hit] = 1
        watermark = state.getCurrentWatermarkMs()
        first = max(int(np.searchsorted(at, watermark * 1000, side="right")) - k, 0)
        state.update(tuple(x[first:].tolist() for x in (at, sid, day, told)))
        state.setTimeoutTimestamp(max(int(at[-1]) // 1000, watermark) + kept_ms)
        if hit.any():
            yield pd.DataFrame({
                key: [keys[0]] * int(hit.sum()), session: sid[hit], ts: pd.to_datetime(at[hit], unit="us", utc=True),
                f"days_{k}": gap[hit].astype("int32")})

    return (
        stream.where(F.col(ts).isNotNull()).withWatermark(ts, delay)
        .select(key, ts, F.unix_micros(ts).alias("__at"),
                F.coalesce(F.col(session).cast("bigint"), F.lit(-1)).alias("__id"),
                F.unix_date(F.col(ts).cast("date")).cast("bigint").alias("__day"))
        .groupBy(key)
        .applyInPandasWithState(
            step, out, ", ".join(f"{c} array<bigint>" for c in kept), "append", GroupStateTimeout.EventTimeTimeout
        )
    )


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Process everything available into Parquet, then stop (exactly-once file sink)."""
    query = (
        stream.writeStream.format("parquet").outputMode(mode)
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
