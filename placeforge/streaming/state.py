"""Micro-batch state machines on Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENTS = "job_id long, event string, error string, ts timestamp"
STATE = "status string, attempts int, last_error string"
OUT = "job_id long, status string, attempts int, last_error string"


def job_states(events: DataFrame, max_attempts: int = 3) -> DataFrame:
    """T1 as a stream: the state of each job after its events add, claim, complete, fail, retry, in time order.

    One small state for each job; events that do not fit the state are left out.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        status, attempts, error = state.get if state.exists else ("", 0, None)
        rows = pd.concat(list(batches)).sort_values(["ts", "event"], kind="stable")
        for event, message in zip(rows["event"], rows["error"], strict=True):
            if event == "add" and not status:
                status = "pending"
            elif event == "claim" and status == "pending" and attempts < max_attempts:
                status, attempts = "processing", attempts + 1
            elif event == "complete" and status == "processing":
                status, error = "completed", None
            elif event == "fail" and status == "processing":
                status, error = ("pending" if attempts < max_attempts else "failed"), message
            elif event == "retry" and status == "processing":
                status, attempts = "pending", max(0, attempts - 1)
        state.update((status, int(attempts), error))
        yield pd.DataFrame({"job_id": [key[0]], "status": [status], "attempts": [int(attempts)], "last_error": [error]})

    return events.groupBy("job_id").applyInPandasWithState(step, OUT, STATE, "update", GroupStateTimeout.NoTimeout)


def windowed_counts(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by job type and window, with a watermark for late events."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event").agg(F.count("*").alias("n"))


def deliver_pages(source: DataFrame, sink, checkpoint: str):
    """Hands each micro-batch to sink(rows, page id); the checkpoint moves only after the sink returns.

    The page id is the batch number, so a replay after a crash repeats the same
    page under the same id, and an idempotent sink sees it once.
    """
    return source.writeStream.foreachBatch(lambda rows, page: sink(rows, page)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
