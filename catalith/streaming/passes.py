"""One pass of the batch: stuck assets go back, the oldest received ones are processed, each with its own outcome."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.operators import state
from catalith.sources.numbering import written

#: What becomes of assets in a pass.
OUTCOMES = ("registered", "deferred", "skipped", "failed_retry", "failed_terminal", "reset", "reset_isolated")


class Pass:
    """assets after a pass, the events it adds (asset_id, state, reason), what became of each asset (asset_id, outcome), and counts."""

    def __init__(self, assets: DataFrame, events: DataFrame, told: DataFrame):
        self.assets, self.events, self.told = assets, events, told

    def report(self) -> DataFrame:
        """One row with a count for each outcome, 0 where there is none."""
        return state.outcome_report(self.told, list(OUTCOMES))


def run(assets: DataFrame, events: DataFrame, process: Callable[[DataFrame], DataFrame], now: Column, *, limit: int, cap: int, older_than_s: int | None = None) -> Pass:
    """assets: (asset_id, status, created_at, updated_at, ...); events: (asset_id, state); process: the picked rows to (asset_id, outcome, reason)
    with registered, deferred or failed; what it leaves out was taken by someone else and is skipped, which isn't a failure.

    With older_than_s assets that are stuck go back to received first, those with cap attempts before to failed, so they can be picked in the
    same pass. Then the limit oldest received ones are processed; no failure stops the others. A failure is recorded and counted with those
    before: from cap on the asset has failed for good, under it it stays under way (routing) and the next pass's reset takes it up.
    """
    had = state.failure_counts(events)
    told, rows, added = [], assets, []
    if older_than_s is not None:
        back = written(state.reset_stuck(state.stuck(assets, now, older_than_s), events, cap), "reset")
        told.append(back.select("asset_id", F.when(F.col("reset_event"), "reset").otherwise("reset_isolated").alias("outcome")))
        added.append(back.select("asset_id", F.when(F.col("reset_event"), "reset").otherwise("failed").alias("state"), F.col("status_reason").alias("reason")))
        rows = rows.join(back.select("asset_id", F.col("status").alias("_to")), "asset_id", "left")
        rows = rows.withColumns({"status": F.coalesce("_to", "status"), "updated_at": F.when(F.col("_to").isNotNull(), now).otherwise(F.col("updated_at"))}).drop("_to")
    rows = written(rows, "assets")
    picked = written(state.received_batch(rows, limit), "picked")
    done = written(picked.select("asset_id").join(process(picked).select("asset_id", "outcome", "reason"), "asset_id", "left").join(had.select("asset_id", "failures"), "asset_id", "left"), "done")
    over = F.coalesce("failures", F.lit(0)) + 1 >= cap
    outcome = F.when(F.col("outcome").isNull(), "skipped").when(F.col("outcome") != "failed", F.col("outcome")).when(over, "failed_terminal").otherwise("failed_retry")
    ends = F.when(F.col("outcome").isin("registered", "deferred"), F.col("outcome")).when((F.col("outcome") == "failed") & over, "failed").when(F.col("outcome") == "failed", "routing")
    told.append(done.select("asset_id", outcome.alias("outcome")))
    added.append(done.filter("outcome is not null").select("asset_id", F.col("outcome").alias("state"), "reason"))
    after = rows.join(done.select("asset_id", ends.alias("_to")), "asset_id", "left")
    after = after.withColumns({"status": F.coalesce("_to", "status"), "updated_at": F.when(F.col("_to").isNotNull(), now).otherwise(F.col("updated_at"))}).drop("_to")
    one, two = told[0], added[0]
    for t, e in zip(told[1:], added[1:], strict=True):
        one, two = one.unionByName(t), two.unionByName(e)
    return Pass(after, two, one)
