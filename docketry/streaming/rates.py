"""Rates of a stream of polls: the growth of a running count over the last sixty polls of each key.

The state of a key is its last polls and whether its rate is an alert. Polls of a micro-batch are taken
in order of time; what is older than the last poll of its key came too late: it is told so, has no rate
and leaves the state alone. A task holds the polls of one key of one micro-batch, and sixty more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import fixed

POLLS = 60
OUTPUTS = ("n", "per_minute", "alert", "changed", "late")
_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def rates_of(at: np.ndarray, n: np.ndarray, polls: int = POLLS) -> np.ndarray:
    """Growth a minute over the last polls, up to each one; NaN where no time has passed. ``at`` is in microseconds."""
    first = np.maximum(np.arange(len(at)) - (polls - 1), 0)
    seconds, grown = (at - at[first]) / 1e6, n - n[first]
    return np.divide(grown, seconds, out=np.full(len(at), np.nan), where=seconds > 0) * 60


class Rates(StatefulProcessor):
    """Sixty polls a key, in order."""

    def __init__(self, key: str, reference: float | None, polls: int, counted: bool):
        self.key, self.reference, self.polls, self.counted = key, reference, polls, counted

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getListState("polls", "at long, tie long, n long")
        self.mark = handle.getValueState("mark", "alert boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True).sort_values(["at", "tie"], kind="stable", ignore_index=True)
        held = pd.DataFrame(list(self.last.get()), columns=["at", "tie", "n"], dtype="int64")
        late = np.zeros(len(new), bool)
        if len(held):
            at, tie, before = (int(x) for x in held.iloc[-1])
            late = ((new["at"] < at) | ((new["at"] == at) & (new["tie"] <= tie))).to_numpy()
        else:
            before = 0
        good = new[~late]
        n = good["n"].to_numpy("int64") if self.counted else before + np.arange(1, len(good) + 1)
        at = np.concatenate([held["at"].to_numpy("int64"), good["at"].to_numpy("int64")])
        rate = rates_of(at, np.concatenate([held["n"].to_numpy("int64"), n]), self.polls)[len(held) :]
        out = pd.DataFrame({"key": key[0], "at": new["at"], "tie": new["tie"], "n": None, "per_minute": None, "alert": None, "changed": False, "late": late})
        rows_of = np.flatnonzero(~late)
        out["n"] = pd.Series(n, index=rows_of, dtype="Int64").reindex(out.index)
        out["per_minute"] = pd.Series(rate, index=rows_of).reindex(out.index)
        if self.reference is not None:
            alert, changed = self._alerts(rate)
            out["alert"] = pd.Series(alert, index=rows_of, dtype="boolean").reindex(out.index)
            out.loc[rows_of, "changed"] = changed
        if len(good):
            tail = pd.DataFrame({"at": good["at"].to_numpy("int64"), "tie": good["tie"].to_numpy("int64"), "n": n})
            kept = pd.concat([held, tail]).tail(self.polls - 1 or 1)
            self.last.put([tuple(int(x) for x in r) for r in kept.itertuples(index=False)])
        for lo in range(0, len(out), 10_000):
            yield out.iloc[lo : lo + 10_000]

    def _alerts(self, rate: np.ndarray) -> tuple[list, np.ndarray]:
        """Whether each rate is off the reference, and whether that is a change; polls without a rate change nothing."""
        known = ~np.isnan(rate)
        alert = np.abs(rate[known] - self.reference) / self.reference > fixed.DRIFT_AT
        before = bool(self.mark.get()[0]) if self.mark.exists() else False
        changed = np.zeros(len(rate), bool)
        changed[known] = alert != np.concatenate([[before], alert[:-1]])
        if len(alert):
            self.mark.update((bool(alert[-1]),))
        marks = np.full(len(rate), None, object)
        marks[known] = alert
        return list(marks), changed

    def close(self) -> None:
        pass


def trailing_rates(polls: DataFrame, at: str, key: str, tie: str, count: str | None = None, reference: float | None = None, polls_back: int = POLLS) -> DataFrame:
    """(key, at, tie, n, per_minute, alert, changed, late) of each poll of a stream.

    ``tie`` is a long that orders polls of one time and tells them apart; ``count`` is a running count, by
    default the number of polls. ``alert`` is null without a reference rate or a rate. Polls without a
    time are left out. The session's state store is set to RocksDB, which such state needs.
    """
    polls.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _STATE_STORE)
    counted = F.lit(None).cast("long") if count is None else F.col(count).cast("long")
    plain = polls.select(F.col(key).alias("key"), F.unix_micros(F.col(at).cast("timestamp")).alias("at"), F.col(tie).cast("long").alias("tie"), counted.alias("n"))
    schema = T.StructType([T.StructField("key", polls.schema[key].dataType), T.StructField("at", T.LongType()), T.StructField("tie", T.LongType())])
    schema = schema.add("n", T.LongType()).add("per_minute", T.DoubleType()).add("alert", T.BooleanType()).add("changed", T.BooleanType()).add("late", T.BooleanType())
    made = plain.where("at is not null").groupBy("key").transformWithStateInPandas(Rates(key, reference, polls_back, count is not None), schema, "append", "none")
    return made.withColumn("at", F.timestamp_micros("at")).withColumnsRenamed({"key": key, "at": at, "tie": tie})
