"""Streaming check of chained logs: each event follows the one before it in its log.

An extension for logs that arrive as a stream: the batch operator is ``ledger.verify_chain``.
The state is one (sequence, digest) for each log.  Events of one log inside a micro-batch are
taken by their sequence; an event whose number was passed already is out of order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_OUT = "log string, sequence long, sequence_ok boolean, link_ok boolean"
_STATE = "sequence long, digest string"


def verify(events: DataFrame) -> DataFrame:
    """(log, sequence, sequence_ok, link_ok) of streamed events (log, sequence, digest, previous)."""

    def follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, digest = state.get if state.exists else (0, None)
        rows = pd.concat(list(batches)).sort_values("sequence", kind="stable")
        out = []
        for number, own, previous in zip(rows["sequence"], rows["digest"], rows["previous"], strict=True):
            previous = None if previous is None or previous != previous else previous
            out.append((key[0], int(number), int(number) == last + 1, previous == digest))
            if int(number) > last:
                last, digest = int(number), own
        state.update((last, digest))
        yield pd.DataFrame(out, columns=[part.split()[0] for part in _OUT.split(", ")])

    slim = events.selectExpr("cast(log as string) log", "cast(sequence as long) sequence", "digest", "previous")
    return slim.groupBy("log").applyInPandasWithState(follow, _OUT, _STATE, "append", GroupStateTimeout.NoTimeout)
