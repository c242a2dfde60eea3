"""Liveness of the sources of running queries, from the progress that Spark reports."""

from __future__ import annotations

import json
import threading
import time
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

STATUS_SCHEMA = (
    "query STRING, messages_seen LONG, triggers LONG, quiet_triggers LONG, behind LONG, "
    "dropped_groups LONG, status STRING"
)
# Statuses: no message ever, none for some triggers, some waiting but not read, ended.
EMPTY, LIVE, QUIET, STALLED, STOPPED, FAILED = "empty", "live", "quiet", "stalled", "stopped", "failed"


@dataclass(frozen=True)
class Pulse:
    """What was seen of one query."""

    messages: int = 0
    triggers: int = 0
    quiet: int = 0
    behind: int = 0
    dropped: int = 0
    last_batch: int = -1
    ended: str | None = None

    def status(self, patience: int) -> str:
        if self.ended:
            return self.ended
        if self.quiet >= patience and self.behind > 0:
            return STALLED
        if self.messages == 0:
            return EMPTY
        return QUIET if self.quiet >= patience else LIVE


def offsets_behind(source: dict[str, Any]) -> int:
    """Messages of a source that are there but not read yet, where it tells."""
    metrics = source.get("metrics") or {}
    for name in ("maxOffsetsBehindLatest", "numFilesOutstanding"):
        if name in metrics:
            return int(float(metrics[name]))
    return 0


class Liveness(StreamingQueryListener):
    """Follows all queries of a session: ``spark.streams.addListener(Liveness())``.

    A query is ``stalled`` when messages wait and none was read in ``patience`` triggers,
    ``quiet`` when none came in that many, ``empty`` when none ever came. Rows that a
    windowed query dropped as late are counted as Spark counts them: once for each window,
    key and task.
    """

    def __init__(self, patience: int = 3) -> None:
        self.patience = patience
        self._pulses: dict[str, Pulse] = {}
        self._names: dict[str, str] = {}
        self._lock = threading.Lock()

    def _change(self, name: str, **values: Any) -> None:
        self._pulses[name] = replace(self._pulses.get(name, Pulse()), **values)

    def onQueryStarted(self, event: Any) -> None:
        with self._lock:
            name = event.name or str(event.id)
            self._names[str(event.id)] = name
            self._change(name, ended=None, quiet=0)

    def onQueryProgress(self, event: Any) -> None:
        with self._lock:
            self._progress(json.loads(event.progress.json))

    def _progress(self, progress: dict[str, Any]) -> None:
        name = progress.get("name") or progress["id"]
        before = self._pulses.get(name, Pulse())
        rows, batch = int(progress.get("numInputRows") or 0), int(progress["batchId"])
        dropped = sum(int(s.get("numRowsDroppedByWatermark") or 0) for s in progress.get("stateOperators", []))
        self._change(
            name,
            messages=before.messages + rows,
            triggers=before.triggers + 1,
            quiet=0 if rows else before.quiet + 1,
            behind=sum(map(offsets_behind, progress.get("sources", []))),
            dropped=before.dropped + (dropped if batch > before.last_batch else 0),
            last_batch=max(batch, before.last_batch),
        )

    def onQueryIdle(self, event: Any) -> None:
        with self._lock:
            name = self._names.get(str(event.id))
            if name is not None:
                before = self._pulses[name]
                self._change(name, triggers=before.triggers + 1, quiet=before.quiet + 1)

    def onQueryTerminated(self, event: Any) -> None:
        with self._lock:
            name = self._names.get(str(event.id))
            if name is not None:
                self._change(name, ended=FAILED if event.exception else STOPPED)

    def wait_for_end(self, name: str, seconds: float = 30.0) -> bool:
        """Whether the end of a query was reported in time; reports come after the fact."""
        for _ in range(int(seconds * 20)):
            if self.pulse(name).ended:
                return True
            time.sleep(0.05)
        return False

    def pulse(self, name: str) -> Pulse:
        with self._lock:
            return self._pulses.get(name, Pulse())

    def status(self, name: str) -> str:
        return self.pulse(name).status(self.patience)

    def table(self, spark: SparkSession) -> DataFrame:
        """One row for each query seen."""
        with self._lock:
            rows = [
                (name, p.messages, p.triggers, p.quiet, p.behind, p.dropped, p.status(self.patience))
                for name, p in sorted(self._pulses.items())
            ]
        return spark.createDataFrame(rows, STATUS_SCHEMA)
