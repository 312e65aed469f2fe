"""The stateful operators on unbounded input: tracking, and first sightings of signatures."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import DEFAULTS, Settings
from ..operators.tracking import ASSIGNED, Live, assigned


def tracked(observations: DataFrame, settings: Settings = DEFAULTS, *, idle_ms: int | None = None) -> DataFrame:
    """``tracking.track`` for a stream: the tracks of each side that may go on are the state.

    With ``idle_ms`` a side that is silent so long forgets its tracks; how many there were stays, so that keys
    are never given twice. Frames of one recording have to arrive in order, as its reader emits them; a batch
    may hold several.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        live = pickle.loads(state.get[0]) if state.exists else Live()
        if state.hasTimedOut:
            state.update((pickle.dumps(Live(live.opened)),))
            return
        live, rows = assigned(key, pd.concat(list(batches)), live, settings)
        state.update((pickle.dumps(live),))
        if idle_ms:
            state.setTimeoutDuration(idle_ms)
        yield rows

    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout
    return observations.groupBy("video", "side").applyInPandasWithState(step, ASSIGNED, "tracks binary", "append", timeout)


def first_sightings(pouches: DataFrame, *, time: str = "seen_at", delay: str = "1 hour") -> DataFrame:
    """Each signature once, forgotten after the delay without it."""
    return pouches.withWatermark(time, delay).dropDuplicatesWithinWatermark(["signature"])


def quality_by_minute(frames: DataFrame, *, time: str = "captured_at", delay: str = "10 minutes") -> DataFrame:
    """Mean quality and count of each recording by minute, for watching an acquisition."""
    return frames.withWatermark(time, delay).groupBy(F.window(time, "1 minute"), "video").agg(F.avg("quality_score").alias("mean_quality"), F.count("*").alias("n"))


def dead_letters(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that went well and rows with an ``error``; one bad input doesn't end a run."""
    return rows.where("error is null").drop("error"), rows.where("error is not null")
