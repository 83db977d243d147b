"""Churn of spike users as data (K7): a share of those who join in the peak fall silent within a month.

Whether a user churns, and after how many days, are seeded draws on the key; their later activity is cut
from the given rows. Everyone else's activity stays as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spikeloom.functions.draws import draw_int, draw_int_sql, draw_uniform, draw_uniform_sql
from spikeloom.params import GrowthParams


def spike_lifetimes(users: DataFrame, key: str, joined: str, peak_start: str, peak_end: str, p: GrowthParams) -> DataFrame:
    """(key, ends_at) of the spike users who churn: 1 to ``churn_days`` - 1 whole days after they joined."""
    j = F.col(joined)
    spike = users.where((j >= F.lit(peak_start).cast("timestamp_ntz")) & (j < F.lit(peak_end).cast("timestamp_ntz")))
    spike = spike.where(draw_uniform(p.seed, "churn", key) < F.lit(p.churn_share))
    days = draw_int(draw_uniform(p.seed, "lifetime", key), 1, p.churn_days)
    return spike.select(key, F.timestamp_add("DAY", days.cast("int"), j).cast("timestamp_ntz").alias("ends_at"))


def spike_lifetimes_sql(users: str, peak_start: str, peak_end: str, p: GrowthParams) -> str:
    days = draw_int_sql(draw_uniform_sql(p.seed, "lifetime", "id"), 1, p.churn_days)
    return f"""(SELECT id, created_at + to_days(CAST({days} AS INTEGER)) AS ends_at FROM {users}
   WHERE created_at >= TIMESTAMP '{peak_start}' AND created_at < TIMESTAMP '{peak_end}'
     AND {draw_uniform_sql(p.seed, 'churn', 'id')} < {p.churn_share!r})"""


def cut_activity(activity: DataFrame, act_key: str, act_ts: str, lifetimes: DataFrame, key: str) -> DataFrame:
    """Activity without what churned users would have done after their end. ``lifetimes`` has one row per churned user, so a
    user with very much activity is one row on that side, and adaptive execution splits the other."""
    ends = lifetimes.select(F.col(key).alias("__k"), F.col("ends_at").alias("__end"))
    j = activity.join(ends, F.col(act_key) == F.col("__k"), "left")
    return j.where(F.col("__end").isNull() | F.col(act_ts).isNull() | (F.col(act_ts) < F.col("__end"))).drop("__k", "__end")
