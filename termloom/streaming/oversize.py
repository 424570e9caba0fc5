"""The length rule on mail that keeps arriving: number and length of an archive's messages as state."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.oversize import FACTOR, WARM_UP

# the function travels with the query, so executors need no extra files
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_KEPT = "group string, place long, length long"


def _judge(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The messages of one archive in one batch, in order, after those of the batches before."""
    count, total, last = state.get if state.exists else (0, 0, None)
    rows = pd.concat(list(frames)).sort_values("place")
    if last is not None:
        # a message that has been judged before, as after a restart of the source
        rows = rows[rows["place"] > last]
    length = rows["length"].fillna(0).astype("int64")
    counts = pd.Series(range(count + 1, count + len(rows) + 1), index=rows.index)
    totals = total + length.cumsum()
    kept = ~((counts > WARM_UP) & (length > FACTOR * totals // counts))
    if len(rows):
        state.update((int(counts.iloc[-1]), int(totals.iloc[-1]), int(rows["place"].iloc[-1])))
    yield rows[kept][["group", "place", "length"]]


def stream_kept_sizes(messages: DataFrame, group: str, place: str, length: str) -> DataFrame:
    """(group, place, length) of the messages of a stream that the running length rule keeps.

    ``place`` is a whole number that orders the messages of a group, and batches have to bring
    them in that order; within a batch any order will do. A message is dropped if it is longer
    than four times the mean of its group's messages so far, itself and dropped ones included,
    from the 101st on. A null length counts as a message of no length. The state of a group is
    three numbers; only places and lengths of a batch are gathered, never texts.
    """
    lean = messages.select(
        F.col(group).cast("string").alias("group"), F.col(place).cast("long").alias("place"), F.col(length).cast("long").alias("length")
    )
    return lean.groupBy("group").applyInPandasWithState(
        _judge, _KEPT, "count long, total long, last long", "append", GroupStateTimeout.NoTimeout
    )
