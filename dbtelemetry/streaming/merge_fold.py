"""The report-merge fold of the blocked-process job.

Per merge key, reports are taken in queue order. A report (t, w) matches
every stored incident whose first-report time ``t0 >= t - (w + slack)``;
if any matches, all matching incidents take wait ``w``, else the report
opens a new incident (t, w).

Kept exactly, with small state:

* "does any incident match" only needs the largest ``t0`` so far;
* an update touches the incidents with ``t0 >= thr`` and is applied to the
  incidents that exist at that moment. An update is dominated by a later
  one with a threshold no larger, so the live updates form a stack with
  increasing threshold and sequence; the final wait of an incident is the
  last stack entry with ``thr <= t0`` if that entry is newer than the
  incident, else its own wait.

So no report is compared with every earlier report, and a long-running
block (the same threshold again and again) keeps a stack of one entry.
"""

from __future__ import annotations

import bisect
import json


class KeyFold:
    """Fold state of one merge key."""

    __slots__ = ("max_t0", "seq", "incidents", "stamp_thr", "stamp_seq", "stamp_w", "stamp_t", "last_t")

    def __init__(self):
        self.max_t0 = None
        self.seq = 0
        self.incidents = []          # [t0, own_wait, created_seq, report_id]
        self.stamp_thr = []          # increasing
        self.stamp_seq = []          # increasing
        self.stamp_w = []
        self.stamp_t = []            # report time of each update
        self.last_t = None

    def step(self, t: int, w: int, report_id, slack: int) -> bool:
        """Apply one report (times in microseconds); True when it opens an incident."""
        self.seq += 1
        self.last_t = t if self.last_t is None else max(self.last_t, t)
        thr = t - (w * 1000 + slack)
        if self.max_t0 is not None and self.max_t0 >= thr:
            while self.stamp_thr and self.stamp_thr[-1] >= thr:
                self.stamp_thr.pop()
                self.stamp_seq.pop()
                self.stamp_w.pop()
                self.stamp_t.pop()
            self.stamp_thr.append(thr)
            self.stamp_seq.append(self.seq)
            self.stamp_w.append(w)
            self.stamp_t.append(t)
            return False
        self.incidents.append([t, w, self.seq, report_id])
        self.max_t0 = t if self.max_t0 is None else max(self.max_t0, t)
        return True

    def _latest_update(self, t0: int, created: int):
        """Index of the newest update that reached an incident, or -1."""
        i = bisect.bisect_right(self.stamp_thr, t0) - 1
        return i if i >= 0 and self.stamp_seq[i] > created else -1

    def final_waits(self):
        """Yield (report_id of the first report, t0, final wait) per incident."""
        for t0, own, created, rid in self.incidents:
            i = self._latest_update(t0, created)
            yield rid, t0, (self.stamp_w[i] if i >= 0 else own)

    def close_before(self, limit: int):
        """Remove and return (report_id, t0, wait) of incidents last touched before ``limit``.

        An incident is touched when it opens and by every update that reaches
        it. Under the streaming job's lateness bound (a continuing block
        reports again within the lateness), an incident untouched for longer
        is over. Updates that reach no open incident any more are dropped,
        so a busy key keeps only its recent incidents. ``max_t0`` is kept,
        so a late report still cannot open a spurious incident.
        """
        done, keep = [], []
        for inc in self.incidents:
            t0, own, created, rid = inc
            i = self._latest_update(t0, created)
            touched = self.stamp_t[i] if i >= 0 else t0
            if touched < limit:
                done.append((rid, t0, self.stamp_w[i] if i >= 0 else own))
            else:
                keep.append(inc)
        if done:
            self.incidents = keep
            oldest = min((inc[2] for inc in keep), default=self.seq + 1)
            live = [j for j, sq in enumerate(self.stamp_seq) if sq > oldest]
            self.stamp_thr = [self.stamp_thr[j] for j in live]
            self.stamp_seq = [self.stamp_seq[j] for j in live]
            self.stamp_w = [self.stamp_w[j] for j in live]
            self.stamp_t = [self.stamp_t[j] for j in live]
        return done

    # State for the streaming processor: a JSON text.
    def dumps(self) -> str:
        return json.dumps([self.max_t0, self.seq, self.incidents, self.stamp_thr, self.stamp_seq, self.stamp_w,
                           self.stamp_t, self.last_t])

    @classmethod
    def loads(cls, text: str) -> "KeyFold":
        f = cls()
        (f.max_t0, f.seq, f.incidents, f.stamp_thr, f.stamp_seq, f.stamp_w, f.stamp_t,
         f.last_t) = json.loads(text)
        return f


def fold_sorted_partitions(batches, slack_micros: int):
    """``mapInArrow`` body: Arrow record batches sorted by (key, queue order).

    Only the four fold columns become Python values; the rest of each
    report (its XML among them) stays in Arrow, and the rows that open an
    incident are taken out with ``take`` and emitted with ``__w`` replaced
    by the incident's final wait. The reports are read once and never
    joined back. State is carried across batches: a key larger than one
    batch streams through, and only the open key's incident rows are held.
    """
    import pyarrow as pa

    current, fold = None, None
    finals: dict = {}
    pending: list = []  # Arrow tables of incident-opening rows not yet emitted

    def flush():
        if fold is not None:
            for rid, _t0, w in fold.final_waits():
                finals[rid] = w

    def emit(table):
        rids = table.column("__rid").to_pylist()
        waits = pa.array([finals.pop(r) for r in rids], type=table.schema.field("__w").type)
        return table.set_column(table.schema.get_field_index("__w"), "__w", waits)

    for batch in batches:
        if batch.num_rows == 0:
            continue
        starts = []
        for i, (k, t, w, rid) in enumerate(zip(batch.column("__key").to_pylist(), batch.column("__t").to_pylist(),
                                               batch.column("__w").to_pylist(), batch.column("__rid").to_pylist())):
            if k != current:
                flush()
                current, fold = k, KeyFold()
            if fold.step(int(t), int(w), rid, slack_micros):
                starts.append(i)
        if starts:
            pending.append(pa.Table.from_batches([batch.take(pa.array(starts, type=pa.int64()))]))
        if not pending:
            continue
        rows = pa.concat_tables(pending)
        open_mask = pa.compute.equal(rows.column("__key"), current)
        done = rows.filter(pa.compute.invert(open_mask))
        kept = rows.filter(open_mask)
        pending = [kept] if kept.num_rows else []
        if done.num_rows:
            yield from emit(done).to_batches()
    flush()
    if pending:
        yield from emit(pa.concat_tables(pending)).to_batches()


# ---------------------------------------------------------------- independent episodes
#
# A key's reports in queue order split into independent episodes at every
# position p with  min(thr[p:]) > max(t[:p]):  report p must open an incident
# (the latest start is at most max(t[:p]) < thr[p]), no later report can match
# an earlier incident (its threshold exceeds every earlier start), and later
# decisions no longer depend on anything before p. Folding each episode on its
# own is therefore exact, and the episodes of one key fold in parallel. The
# cut itself is window expressions, see ``blocked_process``.
