"""Bounded rings on a stream (B4, stream form).

``stream_rings`` is the general form: the newest ``capacity`` events of each
key, or of the whole stream, as a stream of changes. It has two stages, so that
no task sees all events of a noisy source or of the stream: rows are spread
over ``salts`` partial rings of each key, which pass on only what enters them,
and a second state merges those few rows and tells what entered and what left.

``stream_ring`` emits whole rings. Each (tenant, source) keeps its newest ``capacity`` events in keyed list
state (RocksDB-backed). Every micro-batch emits the current ring of the
sources it touched (output mode ``update``), so a sink that replaces rows by
key holds the "latest events" view. State per key is bounded by
``capacity``; keys spread over the shuffle partitions of the stateful
operator.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _RingProcessor(StatefulProcessor):
    def __init__(self, capacity: int, key_cols: list[str], value_schema: T.StructType, order_cols: list[str]):
        self.capacity = capacity
        self.key_cols = key_cols
        self.value_schema = value_schema
        self.order_cols = order_cols

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getListState("ring", self.value_schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = [f.name for f in self.value_schema.fields]
        held = pd.DataFrame(list(self.ring.get()), columns=names) if self.ring.exists() else pd.DataFrame(columns=names)
        cur = held
        for r in rows:  # trimmed chunk by chunk: a burst on one key is never held whole
            cur = pd.concat([cur, r[names]], ignore_index=True) if len(cur) else r[names]
            cur = cur.sort_values(self.order_cols, kind="stable").tail(self.capacity)
        cur = cur.reset_index(drop=True)
        self.ring.put([tuple(x) for x in cur.itertuples(index=False, name=None)])
        out = cur.copy()
        for k, v in zip(self.key_cols, key):
            out.insert(0, k, v)
        out["ring_pos"] = range(len(out), 0, -1)  # 1 = newest
        yield out

    def close(self) -> None:
        pass


def stream_ring(
    df: DataFrame,
    order: Sequence[str],
    capacity: int = 5000,
    key: Sequence[str] = ("tenant_id", "source_id"),
) -> DataFrame:
    """Keep and emit the newest ``capacity`` rows per key of a streaming DataFrame.

    Output: key columns, the other columns, ``ring_pos`` (1 = newest).
    Uses ``transformWithStateInPandas``; the RocksDB state store provider is
    selected when the session has none set.
    """
    spark = df.sparkSession
    conf = "spark.sql.streaming.stateStore.providerClass"
    if ROCKSDB not in (spark.conf.get(conf, "") or ""):
        spark.conf.set(conf, ROCKSDB)
    key = list(key)
    value_schema = T.StructType([f for f in df.schema.fields if f.name not in key])
    out_schema = T.StructType(
        [df.schema[k] for k in key] + list(value_schema.fields) + [T.StructField("ring_pos", T.LongType())]
    )
    proc = _RingProcessor(capacity, key, value_schema, list(order))
    return df.groupBy(*key).transformWithStateInPandas(proc, out_schema, "Update", "None")


class _EnteringProcessor(_RingProcessor):
    """Keeps the newest rows of a key; passes on the rows that entered, and, if ``leaving``, those that left."""

    def __init__(self, capacity, key_cols, value_schema, order_cols, leaving: bool):
        super().__init__(capacity, key_cols, value_schema, order_cols)
        self.leaving = leaving

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = [f.name for f in self.value_schema.fields]
        held = pd.DataFrame(list(self.ring.get()), columns=names, dtype=object) if self.ring.exists() else pd.DataFrame(columns=names, dtype=object)
        cur = held.assign(__new=False)
        for r in rows:
            more = r[names].astype(object)
            cur = pd.concat([cur, more.where(more.notna(), None).assign(__new=True)])
            cur = cur.reset_index(drop=True)
            best = cur[self.order_cols].infer_objects().sort_values(self.order_cols, kind="stable", na_position="first").index[-self.capacity :]
            cur = cur.loc[best]
        new = cur["__new"].astype(bool)
        if new.any():
            self.ring.put([tuple(x) for x in cur[names].itertuples(index=False, name=None)])
        out = [cur.loc[new, names].assign(ring_change=ENTERS)]
        if self.leaving:
            kept = {tuple(x) for x in cur.loc[~new, names].itertuples(index=False, name=None)}
            gone = [x for x in held.itertuples(index=False, name=None) if tuple(x) not in kept]
            out.append(pd.DataFrame(gone, columns=names, dtype=object).assign(ring_change=LEAVES))
        both = pd.concat([o for o in out if len(o)]) if any(len(o) for o in out) else out[0]
        for k, v in zip(self.key_cols, key):
            both.insert(0, k, v)
        yield both


#: What a row of ``stream_rings`` tells.
ENTERS, LEAVES = "enters", "leaves"


def stream_rings(
    df: DataFrame,
    order: Sequence[str],
    capacity: int = 5000,
    key: Sequence[str] = ("tenant_id", "source_id"),
    salts: int = 16,
) -> DataFrame:
    """Changes of the ring of the newest ``capacity`` rows of each ``key``; of one ring over all rows with an empty ``key``.

    Output (append mode): the columns of ``df`` and ``ring_change``: ``enters``
    or ``leaves``. Rows that enter and leave within a micro-batch don't show.
    A sink that inserts and deletes by these holds the rings. ``order`` has to
    tell rows apart. A partial ring holds ``capacity`` rows, the merging state
    of a key as many, and a micro-batch hands it at most ``salts * capacity``.
    """
    spark = df.sparkSession
    conf = "spark.sql.streaming.stateStore.providerClass"
    if ROCKSDB not in (spark.conf.get(conf, "") or ""):
        spark.conf.set(conf, ROCKSDB)
    key, order = list(key), list(order)
    whole = df.withColumn("__ring", F.lit(0)) if not key else df
    keys = key or ["__ring"]
    salted = whole.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))

    def stage(rows: DataFrame, keys: list[str], leaving: bool) -> DataFrame:
        values = T.StructType([f for f in rows.schema.fields if f.name not in keys])
        schema = T.StructType([*[rows.schema[k] for k in reversed(keys)], *values.fields, T.StructField("ring_change", T.StringType())])
        return rows.groupBy(*keys).transformWithStateInPandas(_EnteringProcessor(capacity, keys, values, order, leaving), schema, "Append", "None")

    partial = stage(salted, [*keys, "__salt"], False).drop("__salt", "ring_change")
    return stage(partial, keys, True).select(*df.columns, "ring_change")


# The survey's name for the stream form of B4.
stream_tail = stream_ring
