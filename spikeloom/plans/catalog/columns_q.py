"""Queries for time and text columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from spikeloom.functions import columns as C
from spikeloom.functions import text as X
from spikeloom.functions.draws import draw_uniform, draw_uniform_sql
from spikeloom.plans.catalog.common import SEED as S
from spikeloom.plans.registry import register
from spikeloom.session import spread
from spikeloom.sources.tables import USERS_STANDIN_SQL, read_table, users_standin


def _ts_query(name, table, key, mixture):
    day_sql = C.growth_day_sql(S, name, key, mixture)
    sec_sql = C.second_of_day_sql(S, name, key)
    sql = (f"SELECT {key} AS id, {day_sql} AS day_offset, "
           f"{C.growth_timestamp_sql(C.WINDOW_START, day_sql, sec_sql)} AS created_at FROM {table}")

    @register(name, sql)
    def q(spark, sf):
        t = read_table(spark, sf, table).select(F.col(key).alias("id"))
        t = t.withColumn("day_offset", C.growth_day(S, name, "id", mixture))
        return t.withColumn("created_at", C.growth_timestamp(
            C.WINDOW_START, "day_offset", C.second_of_day(S, name, "id")))
    return q


_ts_query("growth_timestamp_users", "customer", "c_custkey", C.USER_DAYS)
_ts_query("growth_timestamp_posts", "orders", "o_orderkey", C.POST_DAYS)
_ts_query("growth_timestamp_follows", "events", "event_id", C.FOLLOW_DAYS)
_ts_query("growth_timestamp_rates", "orders", "o_orderkey", C.mixture_from_rates(C.POST_RATES))


@register("make_username", f"""
SELECT c_custkey AS id, {X.make_username_sql(S, 'c_custkey')} AS username,
       {X.make_user_handle_sql('c_custkey')} AS handle, {X.hash_username_sql(S, 'c_custkey')} AS hash_name
FROM customer""")
def q_make_username(spark, sf):
    return read_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), X.make_username(S, "c_custkey").alias("username"),
        X.make_user_handle("c_custkey").alias("handle"), X.hash_username(S, "c_custkey").alias("hash_name"))


@register("make_title", f"""
WITH {X.TEXT_CTE_SQL}
SELECT o_orderkey AS id, {X.make_title_sql(S, 'o_orderkey')} AS title FROM orders {X.TEXT_JOIN_SQL}""")
def q_make_title(spark, sf):
    return X.add_title(spread(read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))), S, "id")


@register("make_body", f"""
WITH {X.TEXT_CTE_SQL}
SELECT o_orderkey AS id, {X.make_body_sql(S, 'o_orderkey')} AS body FROM orders {X.TEXT_JOIN_SQL}""")
def q_make_body(spark, sf):
    return X.add_body(spread(read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))), S, "id")


@register("hash_text", f"""
SELECT doc_id AS id, {X.hash_text_sql(S, 'title', 'doc_id', 20)} AS title,
       substr(sha256(text), 1, 16) AS text_digest FROM documents""")
def q_hash_text(spark, sf):
    return read_table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), X.hash_text(S, "title", "doc_id", 20).alias("title"),
        F.substring(F.sha2(F.col("text"), 256), 1, 16).alias("text_digest"))


@register("rare_flag", f"""
SELECT id, viral, {X.make_title_e_sql(S, 'id')} AS title, {X.make_body_e_sql(S, 'id', 'viral')} AS body
FROM (SELECT o_orderkey AS id, {X.viral_flag_sql(S, 'o_orderkey')} AS viral FROM orders)""")
def q_rare_flag(spark, sf):
    o = read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), X.viral_flag(S, "o_orderkey").alias("viral"))
    return o.select("id", "viral", X.make_title_e(S, "id").alias("title"),
                    X.make_body_e(S, "id", F.col("viral")).alias("body"))


@register("shifted_date", f"""
SELECT id, created_at, {C.shifted_date_sql('created_at', draw_uniform_sql(S, 'shift', 'id'), 30)} AS post_date
FROM {USERS_STANDIN_SQL}""")
def q_shifted_date(spark, sf):
    u = users_standin(spark, sf).select("id", "created_at")
    return u.withColumn("post_date", C.shifted_date("created_at", draw_uniform(S, "shift", "id"), 30))
