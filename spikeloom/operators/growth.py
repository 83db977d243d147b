"""Growth analytics.

Shape of every report: one aggregation pass over the big table down to a small per-day or
per-group table, then windows and ratios on that small table. Windows without a partition
key only ever run on such small tables (days in the data, degree values), never on rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spikeloom.operators.joins import edge_pairs
from spikeloom.params import Timeline
from spikeloom.session import stored


def _one():
    """The whole (small) table as one window partition."""
    return Window.partitionBy(F.lit(0))


def _ts(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def period_of(ts, peak_start: str, peak_end: str) -> Column:
    t = _ts(ts)
    return (F.when(t < F.lit(peak_start).cast("timestamp_ntz"), F.lit("pre"))
            .when(t < F.lit(peak_end).cast("timestamp_ntz"), F.lit("peak"))
            .otherwise(F.lit("post")))


def daily_counts(df: DataFrame, ts: str, out: str = "n") -> DataFrame:
    """Rows per calendar day (``day`` as a midnight timestamp): the small table reports use."""
    return (df.groupBy(F.to_date(F.col(ts)).cast("timestamp_ntz").alias("day"))
            .agg(F.count(F.lit(1)).alias(out)))


def day_spine(daily: DataFrame, day: str, counts: list[str]) -> DataFrame:
    """Every calendar day from the first to the last of a daily table, with 0 where it has none."""
    ends = daily.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).where("lo IS NOT NULL")
    days = ends.select(F.explode(F.sequence(F.to_date("lo"), F.to_date("hi"))).alias("__d")).select(
        F.col("__d").cast("timestamp_ntz").alias(day))
    return days.join(daily, day, "left").fillna(0, counts)


def monthly_volume(tables: dict[str, DataFrame], ts: str = "created_at") -> DataFrame:
    """K2: rows per (table, year, month)."""
    parts = [df.groupBy(F.year(ts).cast("bigint").alias("year"), F.month(ts).cast("bigint").alias("month"))
             .agg(F.count(F.lit(1)).alias("n_rows")).withColumn("table_name", F.lit(name))
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def first_months(volume: DataFrame, k: int = 6) -> DataFrame:
    """The first k months of each table of a `monthly_volume`, in order (H1, H2)."""
    w = Window.partitionBy("table_name").orderBy("year", "month")
    return volume.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= k).drop("__r") \
        .orderBy("table_name", "year", "month")


def period_means(df: DataFrame, ts: str, peak_start: str, peak_end: str) -> DataFrame:
    """mean rows per active day in each period (one row per period)."""
    d = daily_counts(df, ts).withColumn("period", period_of("day", peak_start, peak_end))
    return d.groupBy("period").agg(F.avg("n").alias("per_day"), F.count(F.lit(1)).alias("days"))


def period_report(users: DataFrame, posts: DataFrame, follows: DataFrame, tl: Timeline,
                  ts: str = "created_at") -> DataFrame:
    """K3: metric / value rows: mean daily registrations before, during and after the peak,
    table totals and posts per user. Registrations go through one small daily table."""
    ps, pe = str(tl.viral_start), str(tl.peak_end)
    means = period_means(users, ts, ps, pe)
    # fixed values: the source's metric labels
    names = {"pre": "DAILY_REGISTRATIONS_PRE_VIRAL", "peak": "DAILY_REGISTRATIONS_VIRAL_PEAK",
             "post": "DAILY_REGISTRATIONS_POST_VIRAL"}
    spark = users.sparkSession
    labels = spark.createDataFrame(list(names.items()), "period string, metric string")
    # every period is reported, with a null mean when nobody joined in it
    m = F.broadcast(labels).join(means, "period", "left").select("metric", F.col("per_day").alias("value"))
    # one row with the three sizes, each table counted once
    parts = [df.agg(F.count(F.lit(1)).alias("v")).withColumn("t", F.lit(t)) for t, df in (("u", users), ("p", posts), ("f", follows))]
    one = reduce(DataFrame.unionByName, parts).groupBy().agg(*[F.max(F.when(F.col("t") == t, F.col("v").cast("double"))).alias(t) for t in "upf"])
    totals = one.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in (
        ("TOTAL_USERS", F.col("u")), ("TOTAL_POSTS", F.col("p")), ("TOTAL_FOLLOWS", F.col("f")),
        ("POSTS_PER_USER_RATIO", F.try_divide("p", "u")))])))
    return m.unionByName(totals).withColumn("value", F.round("value", 6))


def period_samples(df: DataFrame, ts: str, peak_start: str, peak_end: str, k: int = 5,
                   labels: dict[str, str] | None = None) -> DataFrame:
    """K4: the first k active days of each period with their counts (``date`` as yyyy-MM-dd)."""
    labels = labels or {"pre": "PRE_VIRAL_SAMPLE", "peak": "VIRAL_PEAK_SAMPLE", "post": "POST_VIRAL_SAMPLE"}
    d = daily_counts(df, ts).withColumn("p", period_of("day", peak_start, peak_end))
    d = d.withColumn("__r", F.row_number().over(Window.partitionBy("p").orderBy("day")))
    lab = F.element_at(F.create_map(*[x for kk, v in labels.items() for x in (F.lit(kk), F.lit(v))]), F.col("p"))
    return d.where(F.col("__r") <= k).select(lab.alias("period"), F.date_format("day", "yyyy-MM-dd").alias("date"),
                                             F.col("n").alias("n_rows"))


def spike_ratio(tables: dict[str, DataFrame], ts: str, peak_start: str, peak_end: str) -> DataFrame:
    """K5: rows per calendar day before, during and after the peak; peak / before. The days of a
    period run from the first to the last day that any of the tables has; a period without such
    days is null."""
    # a row per table and day, used three times below: stored, so the tables are read once
    daily = stored(reduce(DataFrame.unionByName, [daily_counts(df, ts).withColumn("table_name", F.lit(name)) for name, df in tables.items()]))
    days = daily.select("day").distinct().withColumn("n", F.lit(0))
    per = period_of("day", peak_start, peak_end)
    spans = day_spine(days, "day", ["n"]).groupBy(per.alias("period")).agg(F.count(F.lit(1)).alias("days"))
    sums = daily.groupBy("table_name", per.alias("period")).agg(F.sum("n").alias("n"))
    names = daily.select("table_name").distinct()
    rates = names.join(spans).join(sums, ["table_name", "period"], "left") \
        .withColumn("per_day", F.coalesce("n", F.lit(0)) / F.col("days"))
    r = rates.groupBy("table_name").agg(*[F.max(F.when(F.col("period") == p, F.col("per_day"))).alias(f"{p}_per_day")
                                          for p in ("pre", "peak", "post")])
    r = r.withColumn("spike_ratio", F.try_divide(F.col("peak_per_day"), F.col("pre_per_day")))
    return r.select("table_name", *[F.round(c, 6).alias(c) for c in
                                    ("pre_per_day", "peak_per_day", "post_per_day", "spike_ratio")])


def cohort_retention(users: DataFrame, key: str, joined: str, activity: DataFrame, act_key: str,
                     act_ts: str, unit: str = "month") -> DataFrame:
    """K6: cohort (join month or week) x periods since joining: active users and retention.

    The distinct (cohort, period, user) step is a hash aggregate (map-side partial), then a
    count per (cohort, period); cohort sizes come from one more small aggregate.
    """
    u = users.select(F.col(key).alias("__u"), F.col(joined).alias("__j"),
                     F.date_trunc(unit, F.col(joined)).cast("timestamp_ntz").alias("cohort"))
    # one row per user and day before the join: a hot user is folded on the map side
    a = activity.groupBy(F.col(act_key).alias("__u"), F.to_date(F.col(act_ts)).alias("__day")).agg(F.max(act_ts).alias("__t"))
    j = a.join(u, "__u").where(F.col("__t") >= F.col("__j"))
    if unit == "week":
        since = F.floor(F.datediff(F.to_date("__t"), F.to_date("cohort")) / 7)
    else:
        since = (F.year("__t") - F.year("cohort")) * 12 + F.month("__t") - F.month("cohort")
    act = (j.select("cohort", since.cast("bigint").alias("period_n"), "__u").distinct()
           .groupBy("cohort", "period_n").agg(F.count(F.lit(1)).alias("active_users")))
    sizes = u.groupBy("cohort").agg(F.count(F.lit(1)).alias("cohort_users"))
    return (act.join(sizes, "cohort")
            .withColumn("retention", F.round(F.col("active_users") / F.col("cohort_users"), 6)))


def churn_after_spike(users: DataFrame, key: str, joined: str, activity: DataFrame, act_key: str,
                      act_ts: str, peak_start: str, peak_end: str, horizon_days: int = 30) -> DataFrame:
    """K7: users who joined during the peak and show no activity from ``horizon_days`` after
    joining on (anti join); one row: spike users, churned users, churn rate."""
    spike = users.where((F.col(joined) >= F.lit(peak_start).cast("timestamp_ntz"))
                        & (F.col(joined) < F.lit(peak_end).cast("timestamp_ntz")))
    spike = spike.select(F.col(key).alias("__u"), F.col(joined).alias("__j"))
    a = activity.groupBy(F.col(act_key).alias("__au")).agg(F.max(act_ts).alias("__t"))
    late = a.join(spike, F.col("__au") == F.col("__u")).where(
        F.col("__t") >= F.timestamp_add("DAY", F.lit(horizon_days), F.col("__j"))).select("__u")
    churned = spike.join(late, "__u", "left_anti")
    n_spike = spike.agg(F.count(F.lit(1)).alias("spike_users"))
    return (n_spike.withColumn("churned_users", churned.agg(F.count(F.lit(1))).scalar())
            .withColumn("churn_rate", F.round(F.col("churned_users") / F.col("spike_users"), 6)))


def content_virality(posts: DataFrame, author: str, ts: str, peak_start: str, peak_end: str) -> DataFrame:
    """K8: per period, posts, distinct authors and posts per author, with the ratio to 'pre'."""
    p = posts.select(period_of(ts, peak_start, peak_end).alias("period"), F.col(author).alias("__a"))
    per = (p.groupBy("period", "__a").agg(F.count(F.lit(1)).alias("__n"))
           .groupBy("period").agg(F.sum("__n").alias("posts"), F.count(F.lit(1)).alias("authors")))
    per = per.withColumn("posts_per_author", F.col("posts") / F.col("authors"))
    base = F.max(F.when(F.col("period") == "pre", F.col("posts_per_author"))).over(_one())
    return per.select("period", "posts", "authors", F.round("posts_per_author", 6).alias("posts_per_author"),
                      F.round(F.col("posts_per_author") / base, 6).alias("virality"))


def network_effect(users: DataFrame, user_ts: str, follows: DataFrame, follow_ts: str) -> DataFrame:
    """K9: per day, new users and new follows, follows per new user, and day-over-day growth of
    each (lag on the small daily table, every calendar day present)."""
    du = daily_counts(users, user_ts, "new_users")
    df_ = daily_counts(follows, follow_ts, "new_follows")
    d = du.join(df_, "day", "full_outer").fillna(0, ["new_users", "new_follows"])
    d = day_spine(d, "day", ["new_users", "new_follows"])
    w = Window.partitionBy(F.lit(0)).orderBy("day")
    return d.select(
        "day", "new_users", "new_follows",
        F.round(F.try_divide(F.col("new_follows"), F.col("new_users")), 6).alias("follows_per_user"),
        F.round(F.try_divide(F.col("new_users"), F.lag("new_users").over(w)), 6).alias("user_growth"),
        F.round(F.try_divide(F.col("new_follows"), F.lag("new_follows").over(w)), 6).alias("follow_growth"))


def influence_share(edges: DataFrame, dst: str, top: float = 0.2, n_nodes=None) -> DataFrame:
    """Share of edges pointing at the top ``top`` fraction of nodes by in-degree.

    Exact without ranking nodes: in-degrees -> histogram of degree values (small) -> the
    threshold degree where the running node count passes k = ceil(top * nodes) -> sum of
    degrees above it plus the remainder at the threshold. ``n_nodes`` (int or scalar Column)
    counts nodes with no in-edge too; default is nodes with at least one.
    """
    deg = edges.groupBy(dst).agg(F.count(F.lit(1)).alias("__d"))
    # a row per degree: everything below is computed from it, the edges are read once
    hist = stored(deg.groupBy("__d").agg(F.count(F.lit(1)).alias("__nodes")))
    own_nodes, total_edges = (hist.agg(F.coalesce(F.sum(c), F.lit(0))).first()[0] for c in (F.col("__nodes"), F.col("__nodes") * F.col("__d")))
    total_edges = F.lit(int(total_edges))
    w = Window.partitionBy(F.lit(0)).orderBy(F.col("__d").desc()).rowsBetween(Window.unboundedPreceding, -1)
    hist = (hist.withColumn("__above_nodes", F.coalesce(F.sum("__nodes").over(w), F.lit(0)))
            .withColumn("__above_edges", F.coalesce(F.sum(F.col("__nodes") * F.col("__d")).over(w), F.lit(0))))
    nodes = F.lit(int(own_nodes)) if n_nodes is None else F.lit(n_nodes) if isinstance(n_nodes, int) else n_nodes
    k = F.ceil(F.lit(float(top)) * nodes)
    take = F.least(F.greatest(k - F.col("__above_nodes"), F.lit(0)), F.col("__nodes"))
    top_edges = hist.agg(F.sum(take * F.col("__d")).alias("top_edges"))
    return top_edges.select(
        nodes.cast("bigint").alias("nodes"), total_edges.alias("edges"), k.cast("bigint").alias("top_nodes"),
        F.col("top_edges").cast("bigint").alias("top_edges"),
        F.round(F.try_divide(F.col("top_edges"), total_edges), 6).alias("top_share"))


def reciprocity(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct non-self edges, how many have their reverse, and the mutual share."""
    pairs = edge_pairs(edges.where(F.col(a) != F.col(b)), a, b)
    n = pairs.agg(F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("up") & F.col("down")).alias("both"))
    return n.select((F.col("pairs") + F.col("both")).alias("edges"), (2 * F.col("both")).alias("mutual_edges"),
                    F.round(F.try_divide(2 * F.col("both"), F.col("pairs") + F.col("both")), 6).alias("mutual_share"))


def spike_days(daily: DataFrame, day: str, n: str, window: int = 7, z: float = 3.0) -> DataFrame:
    """Each calendar day's count against the mean and sample sd of the ``window`` days before it;
    ``is_spike`` when above mean + z * sd. Runs on the small daily table."""
    daily = day_spine(daily.select(day, n), day, [n])
    w = Window.partitionBy(F.lit(0)).orderBy(day).rowsBetween(-window, -1)
    mean, sd = F.avg(n).over(w), F.stddev_samp(n).over(w)
    d = daily.select(day, n, mean.alias("trailing_mean"), sd.alias("trailing_sd"))
    d = d.withColumn("is_spike", F.coalesce(
        F.col(n) > F.col("trailing_mean") + F.lit(z) * F.col("trailing_sd"), F.lit(False)))
    return d.withColumn("trailing_mean", F.round("trailing_mean", 6)).withColumn(
        "trailing_sd", F.round("trailing_sd", 6))
