"""The sampled history of progress as a stream: a point, the readings of all associations at one time, is kept if ten
minutes have passed since the last kept one. That depends on what was kept, so it is state and not a window; late and
repeated points fall. There is one clock for all associations, since a chart needs their readings at the same times;
the readings of one trigger are a few a minute."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from brandbook.operators.progress import FINEST

OUTPUT = "association string, t bigint, done bigint, pending bigint"


def _keep(every: int):
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).drop(columns="clock").sort_values(["t", "association"], kind="stable")
        times = []
        for t in rows["t"].unique():
            if last is None or t - last >= every:
                last = int(t)
                times.append(t)
        if last is not None:
            state.update((last,))
        yield rows[rows["t"].isin(times)]

    return run


def sampled(readings: DataFrame, every: int = FINEST) -> DataFrame:
    """Of a stream ``readings(association, t, done, pending)`` those that are kept; readings of nothing never are."""
    rows = readings.select("association", F.col("t").cast("bigint"), F.col("done").cast("bigint"), F.col("pending").cast("bigint")).where("association is not null and t is not null")
    return rows.withColumn("clock", F.lit(0)).groupBy("clock").applyInPandasWithState(_keep(every), OUTPUT, "last bigint", "append", GroupStateTimeout.NoTimeout)


def stale(heartbeats: DataFrame, within: str = "300 seconds") -> DataFrame:
    """Of a stream ``heartbeats(association, at timestamp)`` the latest of each association in windows, for alerts
    on what has gone silent; late ones fall by the watermark."""
    return heartbeats.withWatermark("at", within).groupBy(F.window("at", within), "association").agg(F.max("at").alias("last"), F.count("*").alias("beats"))
