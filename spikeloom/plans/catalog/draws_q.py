"""Queries for the seeded draws (C1-C5, C8-C12), B8, B9 and the share reports (K1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from spikeloom.functions import draws as D
from spikeloom.operators.checks import share_by
from spikeloom.params import POWER_LAW_80_20, ROLES, STATUSES_BY_PERIOD_E
from spikeloom.plans.catalog.common import (
    EVENTS_PEAK_END, EVENTS_PEAK_START, ORDERS_PEAK_END, ORDERS_PRE_END, SEED, count_of,
    count_sql, period_of, period_of_sql)
from spikeloom.plans.registry import register
from spikeloom.sources.tables import read_table

S = SEED


@register("draw_uniform", f"""
SELECT c_custkey AS id, {D.draw_uniform_sql(S, 'u', 'c_custkey')} AS u,
       {D.draw_uniform_sql(S, 'u', 'c_custkey', slot=1)} AS u2
FROM customer""")
def q_draw_uniform(spark, sf):
    d = D.digest(S, "u", "c_custkey")
    return read_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), D.slice_uniform(d, 0).alias("u"),
        D.slice_uniform(d, 1).alias("u2"))


@register("draw_modular", f"""
SELECT o_orderkey AS id, CAST({D.draw_modular_sql('o_orderkey', 17, 100)} AS BIGINT) AS m
FROM orders""")
def q_draw_modular(spark, sf):
    return read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), D.draw_modular("o_orderkey", 17, 100).cast("bigint").alias("m"))


@register("draw_categorical", f"""
SELECT c_custkey AS id, {D.draw_categorical_sql(D.draw_uniform_sql(S, 'role', 'c_custkey'), ROLES)} AS role
FROM customer""")
def q_draw_categorical(spark, sf):
    return read_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        D.draw_categorical(D.draw_uniform(S, "role", "c_custkey"), ROLES).alias("role"))


_PERIOD_SQL = period_of_sql("o_orderdate", ORDERS_PRE_END, ORDERS_PEAK_END)


@register("draw_categorical_by", f"""
SELECT id, period,
       {D.draw_categorical_by_sql(D.draw_uniform_sql(S, 'status', 'id'), 'period', STATUSES_BY_PERIOD_E)} AS status
FROM (SELECT o_orderkey AS id, {_PERIOD_SQL} AS period FROM orders)""")
def q_draw_categorical_by(spark, sf):
    o = read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        period_of("o_orderdate", ORDERS_PRE_END, ORDERS_PEAK_END).alias("period"))
    return o.withColumn("status", D.draw_categorical_by(D.draw_uniform(S, "status", "id"), "period",
                                                        STATUSES_BY_PERIOD_E))


@register("draw_int", f"""
SELECT o_orderkey AS id, {D.draw_int_sql(D.draw_uniform_sql(S, 'int', 'o_orderkey'), 10, 100)} AS k
FROM orders""")
def q_draw_int(spark, sf):
    return read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        D.draw_int(D.draw_uniform(S, "int", "o_orderkey"), 10, 100).alias("k"))


@register("power_law_id", f"""
SELECT o_orderkey AS id,
       {D.power_law_id_sql(D.draw_uniform_sql(S, 'pl', 'o_orderkey'), count_sql('customer'), 2.0, 0)} AS follower,
       {D.power_law_id_sql(D.draw_uniform_sql(S, 'pl', 'o_orderkey', slot=1), count_sql('customer'), POWER_LAW_80_20, 0)} AS followed
FROM orders""")
def q_power_law_id(spark, sf):
    n = count_of(spark, sf, "customer")
    d = D.digest(S, "pl", "o_orderkey")
    return read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        D.power_law_id(D.slice_uniform(d, 0), n, 2.0, 0).alias("follower"),
        D.power_law_id(D.slice_uniform(d, 1), n, POWER_LAW_80_20, 0).alias("followed"))


@register("exponential_id", f"""
SELECT o_orderkey AS id,
       {D.exponential_id_sql(D.draw_uniform_sql(S, 'ex', 'o_orderkey'), D.draw_uniform_sql(S, 'ex', 'o_orderkey', slot=1), count_sql('customer'), '0.4 * ' + count_sql('customer'), '0.2 * ' + count_sql('customer'), 0)} AS follower
FROM orders""")
def q_exponential_id(spark, sf):
    n = count_of(spark, sf, "customer")
    d = D.digest(S, "ex", "o_orderkey")
    return read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        D.exponential_id(D.slice_uniform(d, 0), D.slice_uniform(d, 1), n, n * 0.4, n * 0.2, 0).alias("follower"))


def _avoid_cands_sql(n):
    return [D.power_law_id_sql(D.draw_uniform_sql(S, f"b{i}", "o_orderkey"), n, POWER_LAW_80_20, 0)
            for i in range(5)]


@register("avoid_self", f"""
SELECT id, a, {D.avoid_self_sql('a', _avoid_cands_sql(count_sql('customer')), count_sql('customer'), 0)} AS b
FROM (SELECT o_orderkey, o_orderkey AS id,
             {D.power_law_id_sql(D.draw_uniform_sql(S, 'a', 'o_orderkey'), count_sql('customer'), POWER_LAW_80_20, 0)} AS a
      FROM orders)""")
def q_avoid_self(spark, sf):
    n = count_of(spark, sf, "customer")
    o = read_table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderkey").alias("id"),
        D.power_law_id(D.draw_uniform(S, "a", "o_orderkey"), n, POWER_LAW_80_20, 0).alias("a"))
    cands = [D.power_law_id(D.draw_uniform(S, f"b{i}", "o_orderkey"), n, POWER_LAW_80_20, 0)
             for i in range(5)]
    return o.select("id", "a", D.avoid_self("a", cands, n, 0).alias("b"))


@register("fk_uniform", f"""
SELECT o_orderkey AS id, {D.fk_uniform_sql(D.draw_uniform_sql(S, 'fk', 'o_orderkey'), count_sql('customer'), 0)} AS user_id
FROM orders""")
def q_fk_uniform(spark, sf):
    n = count_of(spark, sf, "customer")
    return read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        D.fk_uniform(D.draw_uniform(S, "fk", "o_orderkey"), n, 0).alias("user_id"))


@register("fk_cyclic", f"""
SELECT o_orderkey AS id, {D.fk_cyclic_sql('o_orderkey', 113, count_sql('customer'), 0)} AS user_id FROM orders""")
def q_fk_cyclic(spark, sf):
    n = count_of(spark, sf, "customer")
    return read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), D.fk_cyclic("o_orderkey", 113, n, 0).alias("user_id"))


_EV_PERIOD_SQL = period_of_sql("ts", EVENTS_PEAK_START, EVENTS_PEAK_END)


@register("bernoulli_sample", f"""
SELECT event_id, user_id, ts FROM events
WHERE {D.draw_uniform_sql(S, 'keep', 'event_id')} <
      CASE {_EV_PERIOD_SQL} WHEN 'pre' THEN 0.02::DOUBLE WHEN 'peak' THEN 0.20::DOUBLE
      ELSE 0.05 * exp(-0.01 * date_diff('day', TIMESTAMP '{EVENTS_PEAK_END}', ts)) END""")
def q_bernoulli_sample(spark, sf):
    from spikeloom.plans.catalog.common import period_of
    ev = read_table(spark, sf, "events")
    per = period_of("ts", EVENTS_PEAK_START, EVENTS_PEAK_END)
    days_after = F.datediff(F.to_date("ts"), F.to_date(F.lit(EVENTS_PEAK_END)))
    p = (F.when(per == "pre", F.lit(0.02)).when(per == "peak", F.lit(0.20))
         .otherwise(F.lit(0.05) * F.exp(F.lit(-0.01) * days_after)))
    return ev.where(D.bernoulli(D.draw_uniform(S, "keep", "event_id"), p)).select(
        "event_id", "user_id", "ts")


@register("period_filter", f"""
SELECT event_id, user_id, ts FROM events
WHERE ts >= TIMESTAMP '{EVENTS_PEAK_START}' AND ts < TIMESTAMP '{EVENTS_PEAK_END}'""")
def q_period_filter(spark, sf):
    lo = F.lit(EVENTS_PEAK_START).cast("timestamp_ntz")
    hi = F.lit(EVENTS_PEAK_END).cast("timestamp_ntz")
    return (read_table(spark, sf, "events").where((F.col("ts") >= lo) & (F.col("ts") < hi))
            .select("event_id", "user_id", "ts"))


@register("share_by_role", f"""
WITH g AS (SELECT {D.draw_categorical_sql(D.draw_uniform_sql(S, 'role', 'c_custkey'), ROLES)} AS role,
                  count(*) AS n_rows
           FROM customer GROUP BY 1)
SELECT role, n_rows, round(100.0 * n_rows / (SELECT sum(n_rows) FROM g), 2)::DOUBLE AS percentage
FROM g""")
def q_share_by_role(spark, sf):
    users = read_table(spark, sf, "customer").select(
        D.draw_categorical(D.draw_uniform(S, "role", "c_custkey"), ROLES).alias("role"))
    return share_by(users, "role")


@register("share_by_status", """
WITH g AS (SELECT o_orderstatus AS status, count(*) AS n_rows FROM orders GROUP BY 1)
SELECT status, n_rows, round(100.0 * n_rows / (SELECT sum(n_rows) FROM g), 2)::DOUBLE AS percentage
FROM g""")
def q_share_by_status(spark, sf):
    return share_by(read_table(spark, sf, "orders").select(F.col("o_orderstatus").alias("status")),
                    "status")


_PICKS_SQL = ", ".join((
    D.power_law_id_sql(D.draw_uniform_sql(S, "pl", "o_orderkey"), count_sql("customer"), 2.0, 0) + " AS power_law",
    D.exponential_id_sql(D.draw_uniform_sql(S, "ex", "o_orderkey"), D.draw_uniform_sql(S, "ex", "o_orderkey", slot=1),
                         count_sql("customer"), "0.4 * " + count_sql("customer"), "0.2 * " + count_sql("customer"), 0) + " AS exponential",
    D.fk_cyclic_sql("o_orderkey", 113, count_sql("customer"), 0) + " AS cyclic",
    D.fk_uniform_sql(D.draw_uniform_sql(S, "fk", "o_orderkey"), count_sql("customer"), 0) + " AS uniform"))


@register("drawn_key_orphans", f"""
WITH p AS (SELECT {_PICKS_SQL} FROM orders), u AS (UNPIVOT p ON power_law, exponential, cyclic, uniform INTO NAME draw VALUE k)
SELECT draw, count(*) AS n_rows, count(*) FILTER (k NOT IN (SELECT c_custkey FROM customer)) AS orphans,
       count(DISTINCT k) AS n_keys FROM u GROUP BY draw""")
def q_drawn_key_orphans(spark, sf):
    """J2 over every key draw: rows, references without a customer (none), distinct customers hit."""
    n = count_of(spark, sf, "customer")
    d, e = D.digest(S, "pl", "o_orderkey"), D.digest(S, "ex", "o_orderkey")
    picks = read_table(spark, sf, "orders").select(
        D.power_law_id(D.slice_uniform(d, 0), n, 2.0, 0).alias("power_law"),
        D.exponential_id(D.slice_uniform(e, 0), D.slice_uniform(e, 1), n, n * 0.4, n * 0.2, 0).alias("exponential"),
        D.fk_cyclic("o_orderkey", 113, n, 0).alias("cyclic"),
        D.fk_uniform(D.draw_uniform(S, "fk", "o_orderkey"), n, 0).alias("uniform"))
    long = picks.unpivot([], ["power_law", "exponential", "cyclic", "uniform"], "draw", "k")
    hits = long.groupBy("draw", "k").agg(F.count(F.lit(1)).alias("c"))
    known = read_table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.lit(1).alias("known"))
    return hits.join(known, "k", "left").groupBy("draw").agg(
        F.sum("c").alias("n_rows"), F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("c"))), F.lit(0)).alias("orphans"),
        F.count(F.lit(1)).alias("n_keys"))
