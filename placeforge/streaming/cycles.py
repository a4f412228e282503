"""Refresh cycles of record sources as keyed state: ids, cursor, pending page, version ledger, cadence."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

EVENTS = "source string, kind string, object_id long, version string, ts timestamp"
OUT = "source string, cycle long, object_id long, outcome string, cursor long, total long"
CADENCE_HOURS = 24


class Cycles(StatefulProcessor):
    """State of one source.

    Events, in the order of ts, kind and id: `id` (an id that discovery found),
    `record` (a fetched record with its version) and `ack` (the sink has taken
    the pending page). An id opens a cycle if none is open and the cadence since
    the last one is over, else it joins the open one or is `deferred`. A record
    of the cycle is `pending` the first time and `replayed` while it waits; an
    ack moves the cursor over all pending ones, which are `published`, or
    `unchanged` if the ledger has their version already. A record that the cycle
    does not ask for, or has taken, is `late`. Once the cursor is at the end the
    cycle is `complete`, and a timer says `due` when the cadence is over.
    """

    def __init__(self, hours: float = CADENCE_HOURS):
        self.cadence = int(hours * 3_600_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", "cycle long, open boolean, cursor long, total long, completed_at long")
        self.ids = handle.getMapState("ids", "object_id long", "taken boolean")
        self.waiting = handle.getMapState("pending", "object_id long", "version string")
        self.ledger = handle.getMapState("versions", "object_id long", "version string")

    def _load(self) -> list:
        found = self.head.get() if self.head.exists() else None
        return list(found) if found is not None else [0, False, 0, 0, None]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        cycle, is_open, cursor, total, completed = self._load()
        out: list[tuple] = []
        say = lambda i, outcome: out.append((key[0], cycle, i, outcome, cursor, total))
        events = pd.concat(list(rows)).sort_values(["ts", "kind", "object_id"], kind="stable", key=lambda c: c.map({"id": 0, "record": 1, "ack": 2}) if c.name == "kind" else c)
        for kind, number, version, ts in zip(events["kind"], events["object_id"], events["version"], events["ts"], strict=True):
            now = int(ts.timestamp() * 1000)
            one = None if pd.isna(number) else int(number)
            if kind == "id":
                if not is_open and (completed is None or now - completed >= self.cadence):
                    cycle, is_open, cursor, total, completed = cycle + 1, True, 0, 0, None
                    self.ids.clear()
                if not is_open:
                    say(one, "deferred")
                elif not self.ids.containsKey((one,)):
                    self.ids.updateValue((one,), (False,))
                    total += 1
            elif kind == "record":
                if not is_open or not self.ids.containsKey((one,)) or self.ids.getValue((one,))[0]:
                    say(one, "late")
                else:
                    again = self.waiting.containsKey((one,))
                    if not again:
                        self.waiting.updateValue((one,), (version,))
                    say(one, "replayed" if again else "pending")
            elif kind == "ack":
                page = sorted((k[0], v[0]) for k, v in self.waiting.iterator())
                self.waiting.clear()
                for i, v in page:
                    known = self.ledger.getValue((i,))[0] if self.ledger.containsKey((i,)) else None
                    self.ledger.updateValue((i,), (v,))
                    self.ids.updateValue((i,), (True,))
                    cursor += 1
                    say(i, "unchanged" if known == v else "published")
                if is_open and cursor == total:
                    is_open, completed = False, now
                    self.handle.registerTimer(now + self.cadence)
                    say(None, "complete")
        self.head.update((cycle, is_open, cursor, total, completed))
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        cycle, is_open, cursor, total, _ = self._load()
        yield self._frame([] if is_open else [(key[0], cycle, None, "due", cursor, total)])

    def _frame(self, out: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(out, columns=["source", "cycle", "object_id", "outcome", "cursor", "total"])
        return frame.astype({"object_id": "Int64", "cycle": "int64", "cursor": "int64", "total": "int64"})


def cycles(events: DataFrame, late: str = "1 hour", hours: float = CADENCE_HOURS) -> DataFrame:
    """T6 as a stream of EVENTS; needs the RocksDB state store. A source's state grows with its ids, never with its events."""
    return events.withWatermark("ts", late).groupBy("source").transformWithStateInPandas(Cycles(hours), OUT, "append", "eventTime")
