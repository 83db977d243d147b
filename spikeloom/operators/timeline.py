"""Timelines (A3, D1-D5, G3): day source, rate curve, exact scaling, row expansion, dense ids.

The pattern: everything about volume is decided on a small per-day table (one row per day of
the window, a bound set by the parameters, never by the data), and big tables are then
*generated* from it. Ids and positions are arithmetic on that table (prefix sums), so no
step sorts or numbers the big rows, and a day holding a third of all rows is cut into chunks
that spread over many tasks.
"""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spikeloom.functions.draws import draw_uniform
from spikeloom.params import GrowthParams, Timeline

WEIGHT_SCALE = 1_000_000_000  # integer weights: round(w * 1e9), in 128-bit arithmetic


def row_source(spark: SparkSession, n: int, rows_per_part: int = 1_000_000) -> DataFrame:
    """A1 (and A2 re-aimed): ids 1..n over ceil(n / rows_per_part) partitions; no cross join of
    constant ranges cut by a limit."""
    parts = max(1, math.ceil(n / rows_per_part), spark.sparkContext.defaultParallelism if n > 0 else 1)
    return spark.range(1, n + 1, 1, parts)


def day_source(spark: SparkSession, start: date | str, n_days: int) -> DataFrame:
    """A3: one row per day: ``day`` 0..n-1 and its ``day_date`` (midnight timestamp)."""
    return spark.range(0, n_days, 1, 1).select(
        F.col("id").alias("day"),
        F.date_add(F.lit(str(start)).cast("date"), F.col("id").cast("int")).cast("timestamp_ntz")
        .alias("day_date"))


def period_col(day: Column, tl: Timeline) -> Column:
    return (F.when(day < F.lit(tl.pre_days), F.lit("pre"))
            .when(day < F.lit(tl.pre_days + tl.peak_days), F.lit("peak"))
            .otherwise(F.lit("post")))


def period_sql(day: str, tl: Timeline) -> str:
    return (f"(CASE WHEN {day} < {tl.pre_days} THEN 'pre' WHEN {day} < {tl.pre_days + tl.peak_days} "
            f"THEN 'peak' ELSE 'post' END)")


def rate_curve(days: DataFrame, tl: Timeline, day: str = "day", out: str = "expected") -> DataFrame:
    """Expected rows per day: flat base, then base * m^(k/peak) for k = 1..peak, then
    base * m * e^(-decay * days after the peak). Rounded to 6 places."""
    d = F.col(day)
    pre, peak = tl.pre_days, tl.peak_days
    base, m = float(tl.base_per_day), float(tl.viral_multiplier)
    curve = (F.when(d < F.lit(pre), F.lit(base))
             .when(d < F.lit(pre + peak),
                   F.lit(base) * F.pow(F.lit(m), (d - F.lit(pre) + F.lit(1)) / F.lit(float(peak))))
             .otherwise(F.lit(base * m) * F.exp(F.lit(-float(tl.decay)) * (d - F.lit(pre + peak)))))
    return days.withColumn(out, F.round(curve, 6))


def rate_curve_sql(day: str, tl: Timeline) -> str:
    pre, peak = tl.pre_days, tl.peak_days
    base, m = float(tl.base_per_day), float(tl.viral_multiplier)
    return (f"round(CASE WHEN {day} < {pre} THEN {base!r} "
            f"WHEN {day} < {pre + peak} THEN {base!r} * pow({m!r}, ({day} - {pre} + 1) / {float(peak)!r}) "
            f"ELSE {base * m!r} * exp({-float(tl.decay)!r} * ({day} - {pre + peak})) END, 6)")


def scale_to_total(small: DataFrame, weight: str, n, key: str, out: str = "n_rows") -> DataFrame:
    """D4 without truncation: integer counts proportional to ``weight`` summing to exactly ``n``
    (largest remainder, ties by ``key``). Weights count from 1e-9 up and up to 1e9, n up to 1e12:
    products are 38-digit decimals, so nothing is rounded and any engine agrees. A null weight counts as 0; where
    all weights are 0 there is nothing to follow and every count is 0; a negative weight (or one that is
    no number) is an error.

    ``small`` is a per-day (or per-group) table: the windows below run on it in one partition.
    ``n`` is an int or a scalar Column (e.g. a count subquery).
    """
    n_c = (n if isinstance(n, Column) else F.lit(int(n))).cast("decimal(18,0)")
    v = F.coalesce(F.col(weight).cast("double"), F.lit(0.0))
    refused = F.raise_error(F.concat(F.lit("scale_to_total: no weight: "), v.cast("string"))).cast("double")
    v = F.when((v >= 0) & (v < float("inf")), v).otherwise(refused)
    w = small.withColumn("__w", F.round(v * F.lit(WEIGHT_SCALE)).cast("decimal(19,0)"))
    whole = Window.partitionBy(F.lit(0))
    w = (w.withColumn("__wsum", F.sum("__w").over(whole).cast("decimal(28,0)"))
          .withColumn("__wn", (F.col("__w") * n_c).cast("decimal(38,0)"))
          .withColumn("__floor", F.when(F.col("__wsum") > 0, F.expr("__wn div __wsum").cast("bigint")).otherwise(F.lit(0).cast("bigint")))
          .withColumn("__rem", F.when(F.col("__wsum") > 0, F.expr("__wn % __wsum"))))
    w = w.withColumn("__deficit", n_c.cast("bigint") - F.sum("__floor").over(whole))
    w = w.withColumn("__rank", F.row_number().over(
        Window.partitionBy(F.lit(0)).orderBy(F.col("__rem").desc(), F.col(key))))
    one_more = (F.col("__wsum") > 0) & (F.col("__rank") <= F.col("__deficit"))
    w = w.withColumn(out, F.col("__floor") + one_more.cast("bigint"))
    return w.drop("__w", "__wsum", "__wn", "__floor", "__rem", "__deficit", "__rank")


def scale_to_total_sql(src: str, weight: str, n: str, key: str, out: str = "n_rows") -> str:
    """DuckDB twin; ``src`` is a table expression with ``weight`` and ``key``."""
    return f"""(SELECT * EXCLUDE (__w, __wsum, __wn, __floor, __rem, __deficit, __rank),
        CAST(__floor + CAST(__rank <= __deficit AS BIGINT) AS BIGINT) AS {out}
   FROM (SELECT *, CAST({n} - sum(__floor) OVER () AS BIGINT) AS __deficit,
                row_number() OVER (ORDER BY __rem DESC, {key}) AS __rank
           FROM (SELECT *, CAST(__wn // __wsum AS BIGINT) AS __floor, __wn % __wsum AS __rem
                   FROM (SELECT *, CAST(sum(__w) OVER () AS HUGEINT) AS __wsum, __w * CAST({n} AS HUGEINT) AS __wn
                           FROM (SELECT *, CAST(round({weight} * {WEIGHT_SCALE}) AS HUGEINT) AS __w
                                   FROM {src})))))"""


def with_prefix(small: DataFrame, count: str, order: str, out: str = "start") -> DataFrame:
    """Rows before this one (exclusive running sum), on a small table."""
    w = Window.partitionBy(F.lit(0)).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return small.withColumn(out, F.coalesce(F.sum(count).over(w), F.lit(0)).cast("bigint"))


def expand_counts(small: DataFrame, count: str, chunk_rows: int, offset: str = "offset",
                  partitions: int | None = None) -> DataFrame:
    """Each row of ``small`` becomes ``count`` rows numbered ``offset`` 0..count-1.

    Rows with a large count are first cut into chunks of at most ``chunk_rows`` (a tiny table),
    the chunks are spread round-robin over ``partitions`` tasks (default: the session's number of
    shuffle partitions) and only then expanded: a day that holds a third of all rows is generated
    by many tasks at once. Count 0 vanishes. No job runs while the plan is built.
    """
    c = F.col(count)
    if partitions is None:
        partitions = int(small.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = (small.where(c > 0)
              .withColumn("__chunk", F.explode(F.sequence(
                  F.lit(0).cast("bigint"), ((c - 1) / F.lit(chunk_rows)).cast("bigint")))))
    chunks = chunks.repartition(int(partitions))
    lo = F.col("__chunk") * F.lit(chunk_rows)
    hi = F.least(lo + F.lit(chunk_rows), c) - F.lit(1)
    return chunks.withColumn(offset, F.explode(F.sequence(lo, hi))).drop("__chunk")


def expand_counts_sql(src: str, count: str, offset: str = "offset") -> str:
    return f"(SELECT * FROM (SELECT *, unnest(range(0, {count})) AS {offset} FROM {src} WHERE {count} > 0))"


def dense_ids(small: DataFrame, count: str, order: str, base: int = 1, out: str = "start") -> DataFrame:
    """D5 for generated rows: the first id of each group is ``base`` plus the rows of all earlier
    groups; a generated row's id is then ``start + offset`` (no window over the big rows)."""
    return with_prefix(small, count, order, out).withColumn(out, F.col(out) + F.lit(base))


def posts_rate(joined: str, pre_end: str, peak_end: str, p: GrowthParams) -> Column:
    """D3: expected posts of a user by join period; after the peak the rate decays by the day."""
    t, after = F.col(joined), F.datediff(F.to_date(joined), F.to_date(F.lit(peak_end)))
    return (F.when(t < F.lit(pre_end).cast("timestamp_ntz"), F.lit(p.posts_rate_pre))
            .when(t < F.lit(peak_end).cast("timestamp_ntz"), F.lit(p.posts_rate_peak))
            .otherwise(F.lit(p.posts_rate_post) * F.exp(F.lit(-p.posts_decay) * after)))


def posts_rate_sql(joined: str, pre_end: str, peak_end: str, p: GrowthParams) -> str:
    return f"""CASE WHEN {joined} < TIMESTAMP '{pre_end}' THEN {p.posts_rate_pre!r}
  WHEN {joined} < TIMESTAMP '{peak_end}' THEN {p.posts_rate_peak!r}
  ELSE {p.posts_rate_post!r} * exp(-{p.posts_decay!r} * date_diff('day', TIMESTAMP '{peak_end}', {joined})) END"""


def posts_per_user(users: DataFrame, key: str, joined: str, pre_end: str, peak_end: str, p: GrowthParams) -> DataFrame:
    """D3 + C18: (key, k, post_date): the whole part of each user's rate as rows k = 0, 1, ..., all on a day drawn from the
    ``post_shift_days`` after joining (one shift per user). Users whose rate is below 1, or who have no join time, have none."""
    rate = posts_rate(joined, pre_end, peak_end, p)
    u = users.where(F.col(joined).isNotNull() & (rate >= 1))
    shift = F.floor(draw_uniform(p.seed, "ppu", key) * p.post_shift_days).cast("int")
    u = u.select(key, F.floor(rate).cast("bigint").alias("n"), F.date_add(F.to_date(joined), shift).cast("timestamp_ntz").alias("post_date"))
    return expand_counts(u, "n", p.rows_per_chunk, "k").select(key, "k", "post_date")
