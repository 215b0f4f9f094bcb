"""Streams: an asset's life as state by key, and an inbox that takes each content once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from catalith.operators.state import MOVES, TERMINAL

OUT = "asset_id long, event_id long, state string, accepted boolean, reason string"
STATE = "state string, failures int"


def step(state: str | None, failures: int, event: str, cap: int) -> tuple[str | None, int, bool, str | None]:
    """(state, failures, accepted, reason) after an event.

    A terminal state takes nothing more (late). A failure is counted first: under the cap the asset is received again (retry),
    from the cap on it has failed. Other moves must be legal; the first is to received.
    """
    if state in TERMINAL:
        return state, failures, False, "late"
    if event == "failed" and state is not None:
        failures += 1
        return ("failed", failures, True, "cap") if failures >= cap else ("received", failures, True, "retry")
    if (state is None and event == "received") or (state, event) in MOVES:
        return event, failures, True, None
    return state, failures, False, "illegal"


def fold(rows: pd.DataFrame, state: str | None, failures: int, cap: int) -> tuple[pd.DataFrame, str | None, int]:
    out = []
    for r in rows.sort_values(["ts", "event_id"]).itertuples():
        state, failures, ok, reason = step(state, failures, r.state, cap)
        out.append((r.asset_id, r.event_id, r.state, ok, reason))
    return pd.DataFrame(out, columns=["asset_id", "event_id", "state", "accepted", "reason"]), state, failures


def follow(events: DataFrame, cap: int = 3) -> DataFrame:
    """A stream of (asset_id, event_id, ts, state): each event with whether it is accepted. The state of a key is one row."""

    def work(key: tuple, parts: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        state, failures = held.get if held.exists else (None, 0)
        rows = pd.concat(list(parts))
        out, state, failures = fold(rows, state, failures, cap)
        held.update((state, failures))
        yield out

    return events.groupBy("asset_id").applyInPandasWithState(work, OUT, STATE, "append", GroupStateTimeout.NoTimeout)


def follow_batch(events: DataFrame, cap: int = 3) -> DataFrame:
    """The same over a table."""
    return events.groupBy("asset_id").applyInPandas(lambda rows: fold(rows, None, 0, cap)[0], OUT)


def inbox(files: DataFrame, delay: str | None = None) -> DataFrame:
    """A stream of (fs_path, text[, ts]): each content once, by its hash; delay bounds how long hashes are kept."""
    rows = files.withColumn("file_hash", F.sha2(F.col("text").cast("binary"), 256))
    if delay:
        return rows.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["file_hash"])
    return rows.dropDuplicates(["file_hash"])


def drain(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Runs a stream on what is there now, and stops when nothing is left."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run_until(stream: DataFrame, path: str, checkpoint: str, seconds: float, every: str = "1 second") -> None:
    """Runs a stream for so long and stops it after its batch. Timers by the clock need this: to them there is always more to come, so
    a drain doesn't end."""
    q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
    try:
        q.awaitTermination(int(seconds))
    finally:
        q.stop()


def micro_batches(stream: DataFrame, process, path: str, checkpoint: str) -> None:
    """Runs process (frame -> (good rows, dead letters)) on each micro-batch; one bad row stops nothing. A batch that is run
    again overwrites its own folder."""

    def one(df: DataFrame, number: int) -> None:
        df = df.persist()
        good, dead = process(df)
        good.write.mode("overwrite").parquet(f"{path}/good/batch={number}")
        dead.write.mode("overwrite").parquet(f"{path}/dead/batch={number}")
        df.unpersist()

    stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(one).start().awaitTermination()
