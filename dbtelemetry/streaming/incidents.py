"""Incident state of the streaming job: one map of incidents and event-time timers a merge key.

The processor takes a key's reports in queue order and applies the merge
rule of :mod:`dbtelemetry.streaming.merge_fold` to the incidents it keeps:
a report (t, w) updates every incident whose first report is at or after
``t - (w + slack)``, or opens a new one. Every incident is an entry of a
map state; only entries that a batch changes are written.

* An incident that no report has touched for ``idle`` (the server's
  reporting interval plus slack) is closed by its timer. It stays in the
  map: a later report whose wait reaches back to it opens it again.
* ``retain`` after its last report a closed incident leaves the state. A
  report that still reaches back to it goes to the side output.
* Reports older than the watermark go to the side output.

Rows of a batch that only carry the clock (``clock`` set) move the
watermark; the reports themselves have no event time for Spark to drop
them by, so each of them is merged or in the side output.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql.streaming import StatefulProcessor

# Change kinds. ``late`` rows are the side output: ``closed_at`` holds the high-water mark they missed.
INSERT, UPDATE, CLOSE, LATE = "insert", "update", "close", "late"
COLUMNS = ["server_name", "incident_id", "change", "event_date", "wait_time", "closed_at", "arrival_date"]
_EPOCH = dt.datetime(1970, 1, 1)


def _time(micros: int) -> dt.datetime:
    return _EPOCH + dt.timedelta(microseconds=int(micros))


class IncidentProcessor(StatefulProcessor):
    """State: ``incidents`` (number -> id, first time, wait, last touched, open) and ``key`` (last number, latest first time, server)."""

    def __init__(self, slack_micros: int, idle_ms: int, retain_ms: int, lateness_ms: int):
        self.slack, self.idle, self.retain, self.lateness = slack_micros, idle_ms, retain_ms, lateness_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.incidents = handle.getMapState(
            "incidents", "number long", "id string, first long, wait long, touched long, open boolean")
        self.key = handle.getValueState("key", "number long, latest long, server string")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # A key's rows come in chunks in no particular order; queue order is over all of them.
        # Narrow columns of one micro-batch, bounded by the trigger.
        frame = pd.concat(list(rows))
        frame = frame[frame["report_id"].notna()].sort_values(["arrived", "report_id"])
        if not len(frame):
            return
        watermark = timerValues.getCurrentWatermarkInMs()
        held = {n[0]: list(v) for n, v in self.incidents.iterator()} if self.incidents.exists() else {}
        number, latest, server = self.key.get() if self.key.exists() else (0, None, None)
        opened, changed, out = {}, set(), []
        for rid, t, w, alone, srv, day in zip(frame["report_id"], frame["t"], frame["w"], frame["alone"], frame["server_name"],
                                              frame["arrival_date"], strict=True):
            srv = None if pd.isna(srv) else srv
            if alone:  # a report with a NULL in its key is an incident by itself
                when, wait = None if pd.isna(t) else _time(t), None if pd.isna(w) else int(w)
                out += [(srv, rid, c, when, wait, None, day) for c in (INSERT, CLOSE)]
                continue
            t, w, server = int(t), int(w), srv
            since = t - (w * 1000 + self.slack)
            hits = [n for n, v in held.items() if v[1] >= since]
            if t // 1000 < watermark or (not hits and latest is not None and latest >= since):
                out.append((srv, rid, LATE, _time(t), w, _time((watermark + self.lateness) * 1000), day))
                continue
            if not hits:
                number += 1
                held[number] = [rid, t, w, t, True]
                opened[number] = day
                latest = t if latest is None else max(latest, t)
            for n in hits:
                v = held[n]
                v[2], v[3], v[4] = w, max(v[3], t), True
                changed.add(n)
        for n in sorted(opened.keys() | changed):
            rid, first, wait, _, _ = held[n]
            self.incidents.updateValue((n,), tuple(held[n]))
            out.append((server, rid, INSERT if n in opened else UPDATE, _time(first), wait, None, opened.get(n)))
        if opened or changed:
            self.key.update((number, latest, server))
            self._timers(held)
        if out:
            yield pd.DataFrame(out, columns=COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        held = {n[0]: list(v) for n, v in self.incidents.iterator()} if self.incidents.exists() else {}
        server = self.key.get()[2] if self.key.exists() else None
        out = []
        for n in sorted(held):
            rid, first, wait, touched, is_open = held[n]
            if is_open and self._ends(touched, self.idle) <= now:
                held[n][4] = False
                self.incidents.updateValue((n,), tuple(held[n]))
                out.append((server, rid, CLOSE, _time(first), wait, _time(self._ends(touched, self.idle) * 1000), None))
            if not held[n][4] and self._ends(touched, self.retain) <= now:
                self.incidents.removeKey((n,))
                del held[n]
        if held:
            self._timers(held, now)
        else:
            self.key.clear()
        if out:
            yield pd.DataFrame(out, columns=COLUMNS)

    @staticmethod
    def _ends(touched: int, after_ms: int) -> int:
        return touched // 1000 + 1 + after_ms

    def _timers(self, held: dict, now: int = -1) -> None:
        """One timer for every open incident's close and every closed one's end; others are deleted."""
        want = {self._ends(v[3], self.idle if v[4] else self.retain) for v in held.values()}
        there = set(self.handle.listTimers())
        for t in there - want:
            if t > now:
                self.handle.deleteTimer(t)
        for t in want - there:
            self.handle.registerTimer(t)
