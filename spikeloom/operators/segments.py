"""Change points of a daily series (K12): exact segmentation with a penalty.

The days of a series are cut into segments of constant level so that the squared error plus a penalty
per segment is least over all ways to cut. Counts vary more the higher they are, so levels are compared
as 2 * sqrt(n + 3/8), which varies by about 1 at every level; in whole thousandths, so sums are exact.
Series are small tables (one row per day); each is solved by itself, so many series are solved side by side.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


SCALE = 1000


def even(counts: np.ndarray) -> np.ndarray:
    """Counts as values of about equal variance, SCALE squared."""
    return np.floor(SCALE * 2 * np.sqrt(counts + 0.375) + 0.5)


def best_cuts(values: np.ndarray, penalty: float) -> list[int]:
    """Starts of the segments of the cheapest cut, the first 0; of equal costs the earlier last cut counts. Starts that can
    never be best again are left out on the way, which does not change the result."""
    s1, s2 = (np.append(0.0, np.cumsum(v)) for v in (values, values * values))
    n = len(values)
    best, last = np.zeros(n + 1), np.zeros(n + 1, np.int64)
    open_ = np.zeros(1, np.int64)
    for j in range(1, n + 1):
        total = s1[j] - s1[open_]
        cost = best[open_] + (s2[j] - s2[open_] - total * total / (j - open_))
        at = int(cost.argmin())
        best[j], last[j] = cost[at] + penalty, open_[at]
        open_ = np.append(open_[cost <= best[j] + 1e-6 * (1 + abs(best[j]))], j)
    cuts, j = [], n
    while j > 0:
        j = int(last[j])
        cuts.append(j)
    return cuts[::-1]


def change_points(daily: DataFrame, day: str, n: str, series: str, factor: float = 3.0) -> DataFrame:
    """(series, first_day, last_day, days, mean) of the segments of each series of counts; days without a row count as 0. The
    penalty of a segment is ``factor`` * ln(days) variances."""
    kind = daily.schema[series].dataType.simpleString()
    schema = f"{series} {kind}, first_day timestamp_ntz, last_day timestamp_ntz, days long, mean double"
    ends = daily.groupBy(series).agg(F.to_date(F.min(day)).alias("lo"), F.to_date(F.max(day)).alias("hi")).where("lo IS NOT NULL")
    spine = ends.select(F.col(series).alias("__s"), F.explode(F.sequence("lo", "hi")).alias("__d"))
    spine = spine.withColumn("__d", F.col("__d").cast("timestamp_ntz"))
    same = F.col("__s").eqNullSafe(F.col(series)) & (F.col("__d") == F.col(day))
    whole = spine.join(daily.select(series, day, n), same, "left").select(F.col("__s").alias(series), F.col("__d").alias(day), F.coalesce(n, F.lit(0)).alias(n))

    def solve(t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values(day)
        v = t[n].to_numpy(np.float64)
        cuts = best_cuts(even(v), factor * SCALE * SCALE * math.log(max(2, len(v))))
        ends = [*cuts[1:], len(v)]
        d = t[day].to_numpy()
        return pd.DataFrame({series: t[series].iloc[0], "first_day": d[cuts], "last_day": [d[e - 1] for e in ends],
                             "days": [e - c for c, e in zip(cuts, ends)], "mean": [round(float(v[c:e].mean()), 6) for c, e in zip(cuts, ends)]})
    return whole.groupBy(series).applyInPandas(solve, schema)
