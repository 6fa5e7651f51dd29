"""Datagram envelope (A4) for payloads landed in files or a message bus.

The reference reads UDP itself; on a cluster datagrams are landed durably
first (files, Kafka) and this turns landed rows into the event envelope.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signals.functions.text import decode_replace, py_strip
from signals.operators.sequence import MAX_ROWS, arrival_sequence


def datagram_envelope(
    df: DataFrame,
    payload_col: str = "payload",
    received_col: str = "received_at",
    id_col: str = "payload_id",
    ip_col: str = "remote_ip",
    port_col: str = "remote_port",
    key: Sequence[str] = ("tenant_id", "source_id"),
    bucket: str = "minute",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Landed payloads -> (raw_data, offset=0, received_at, seq, remote_addr) (A4).

    ``raw_data`` is the UTF-8 decode with U+FFFD for bad bytes, stripped of
    whitespace at both ends. ``seq`` is the 1-based arrival counter per key,
    ordered by (received_at, payload id), computed without a hot task (see
    ``arrival_sequence`` for ``bucket`` and ``max_rows``).
    ``remote_addr`` is a struct (ip, port), null when no address was landed.
    """
    out = df.withColumns(
        {
            "raw_data": py_strip(decode_replace(F.col(payload_col))),
            "offset": F.lit(0).cast("bigint"),
            "remote_addr": F.when(
                F.col(ip_col).isNotNull(),
                F.struct(F.col(ip_col).alias("ip"), F.col(port_col).cast("int").alias("port")),
            ),
        }
    )
    return arrival_sequence(out, list(key), [received_col, id_col], out="seq", bucket=bucket, max_rows=max_rows)
