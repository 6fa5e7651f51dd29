"""Source health from streaming query events (feeds E1 ``source_status``).

One streaming query per (tenant, source), named ``tenant::source``. The
listener turns start, progress and termination events into report rows;
``reports`` gives them as a DataFrame for ``source_status``. Reports are
small driver-side metadata: of each source the newest report, the newest with
an error and the newest with data, which is all that its status depends on.
"""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

REPORT_SCHEMA = (
    "tenant_id string, source_id string, ts timestamp, running boolean, healthy boolean, "
    "error string, n_records long, config string"
)


def _split(name: str | None) -> tuple[str, str]:
    n = name or ""
    if "::" in n:
        t, s = n.split("::", 1)
        return t, s
    return "", n


class SourceStatusListener(StreamingQueryListener):
    def __init__(self) -> None:
        self._rows: dict[tuple, tuple] = {}  # by (tenant, source, what it is the newest of)
        self._names: dict[str, str] = {}
        self._configs: dict[str, str] = {}
        self._lock = threading.Lock()

    def _add(self, name, running, healthy, error, n, config="{}"):
        t, s = _split(name)
        with self._lock:
            row = (t, s, dt.datetime.now(dt.timezone.utc), running, healthy, error, n, config)
            for what, holds in (("state", True), ("error", error is not None), ("data", n > 0)):
                if holds:
                    self._rows[t, s, what] = row

    def onQueryStarted(self, event) -> None:
        self._names[str(event.id)] = event.name
        self._add(event.name, True, True, None, 0)

    def onQueryProgress(self, event) -> None:
        import json

        p = event.progress
        config = json.dumps(
            {"sources": [src.description for src in p.sources], "sink": p.sink.description if p.sink else None},
            sort_keys=True,
        )
        self._configs[str(p.id)] = config
        self._add(p.name, True, True, None, int(p.numInputRows), config)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        err = event.exception
        qid = str(event.id)
        self._add(self._names.get(qid), False, err is None, err, 0, self._configs.get(qid, "{}"))

    def reports(self, spark: SparkSession) -> DataFrame:
        with self._lock:
            rows = list(dict.fromkeys(self._rows.values()))
        return spark.createDataFrame(rows, REPORT_SCHEMA)

    def flush(self, spark: SparkSession, path: str) -> None:
        """Append the collected reports to a table and start a new buffer."""
        with self._lock:
            rows, self._rows = list(dict.fromkeys(self._rows.values())), {}
        if rows:
            spark.createDataFrame(rows, REPORT_SCHEMA).write.mode("append").parquet(path)


def late_rows(query: StreamingQuery, recent: bool = False) -> int:
    """Rows dropped as later than the watermark: in the last trigger, or over the recent ones.

    Spark filters late rows in its stateful operators with the watermark of
    the previous trigger (so a jump in event time takes effect one trigger later).
    """
    progress = list(query.recentProgress) if recent else [query.lastProgress or {}]
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for p in progress for op in (p or {}).get("stateOperators", []))
