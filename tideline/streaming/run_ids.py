"""Regime runs over a stream: state per entity keeps its last time, regime and run."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tideline.settings import ARROW

#: The state store that state variables need.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


class RunIds(StatefulProcessor):
    """Gives each row of an entity the regime before it and the number of its run."""

    def __init__(self, entity: str, time: str):
        self.entity, self.time = entity, time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "at long, regime string, run long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = pd.concat(list(rows)).sort_values(self.time, kind="stable").reset_index(drop=True)
        ticks = now[self.time].astype("datetime64[us]").astype("int64")
        state = self.last.get() if self.last.exists() else None
        # A row from before the last one seen would change runs that have been told already.
        late = ticks <= state[0] if state else pd.Series(False, index=now.index)
        on_time = now[~late]
        before = on_time["regime"].shift(1)
        if len(on_time) and state:
            before.iloc[0] = state[1]
        changed = before.notna() & (before != on_time["regime"])
        run = changed.cumsum() + (state[2] if state else 0)
        out = now.assign(regime_prev=None, is_transition=None, transition=None, regime_group_id=pd.NA, late=late)
        out.loc[on_time.index, "regime_prev"] = before.where(before.notna(), None)
        out.loc[on_time.index, "is_transition"] = changed
        out.loc[on_time.index, "transition"] = [
            r if pd.isna(p) else p + ARROW + r for p, r in zip(before, on_time["regime"])
        ]
        out["regime_group_id"] = run.reindex(now.index).astype("Int64")
        if len(on_time):
            self.last.update((int(ticks[on_time.index[-1]]), on_time["regime"].iloc[-1], int(run.iloc[-1])))
        yield out

    def close(self) -> None:
        pass


def stream_run_ids(labels: DataFrame, entity: str = "symbol", time: str = "Date") -> DataFrame:
    """A stream of labels with ``regime_prev, is_transition, transition, regime_group_id, late``.

    The same values as over all rows at once, as long as an entity's rows come in the order of
    time from one micro-batch to the next; within one they may come in any order. A row that is
    not after the last one its entity had in earlier batches is returned with ``late`` and no
    run. Rows without an entity, a time or a regime are left out. State is one row per entity and
    outlives a restart from the same checkpoint; a task holds an entity's rows of one batch, which
    the source's rate bounds. Needs the settings in ``STATE_STORE``; append mode.
    """
    known = labels.where(" AND ".join(f"`{c}` IS NOT NULL" for c in (entity, time, "regime")))
    schema = T.StructType(
        [*known.schema.fields, T.StructField("regime_prev", T.StringType()), T.StructField("is_transition", T.BooleanType()),
         T.StructField("transition", T.StringType()), T.StructField("regime_group_id", T.LongType()),
         T.StructField("late", T.BooleanType())]
    )
    return known.groupBy(entity).transformWithStateInPandas(
        statefulProcessor=RunIds(entity, time), outputStructType=schema, outputMode="Append", timeMode="None"
    )
