"""Time columns (C6, C7, C18): day offsets from a mixture of day ranges, timestamps from a fixed
window start, and date shifts. One md5 per row feeds the range pick (slot 0), the day inside the
range (slot 1) and the second of the day (last 8 hex digits)."""

from __future__ import annotations

from datetime import date
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from spikeloom.functions.draws import (
    _c, digest, digest_sql, draw_int, draw_int_sql, slice_uniform, slice_uniform_sql)

TWO32 = float(1 << 32)

# --- FIXED values: the source's day mixtures over its 180-day window --------------------------
# users (B-D): 50 % baseline (60 % on days 0-59, 40 % on days 105-179), 30 % days 60-74,
#              20 % days 75-104
# posts (A-D): 40 % baseline (half on days 0-59, half on days 105-179), 40 % elevated
#              (half on days 60-74, half on days 75-104), 20 % spread over days 0-179
# follows (A-D): 30 % baseline (half/half), 40 % elevated (half/half), 30 % spread
USER_DAYS = ((0.30, 0, 60), (0.20, 105, 180), (0.30, 60, 75), (0.20, 75, 105))
POST_DAYS = ((0.20, 0, 60), (0.20, 105, 180), (0.20, 60, 75), (0.20, 75, 105), (0.20, 0, 180))
FOLLOW_DAYS = ((0.15, 0, 60), (0.15, 105, 180), (0.20, 60, 75), (0.20, 75, 105), (0.30, 0, 180))
# the plan's daily rates: baseline days 0-59, viral 60-74, adjustment 75-104, new normal 105-179
POST_RATES = ((0, 60, 1500.0), (60, 75, 15000.0), (75, 105, 3000.0), (105, 180, 3000.0))
WINDOW_START = "2025-07-05 00:00:00"   # fixed anchor: 180 days before 2026-01-01
# ----------------------------------------------------------------------------------------------


def mixture_from_rates(rates: Sequence[tuple[int, int, float]]) -> tuple[tuple[float, int, int], ...]:
    """Day mixture whose range weights are rate x length: daily volume follows the rates."""
    total = sum((hi - lo) * r for lo, hi, r in rates)
    return tuple(((hi - lo) * r / total, lo, hi) for lo, hi, r in rates)


def _cum(ws):
    t, acc, out = float(sum(ws)), 0.0, []
    for w in ws:
        acc += w
        out.append(acc / t)
    return out


def growth_day(seed: int, tag: str, key, mixture) -> Column:
    """Pick a day range by weight with one draw, then a day inside it with another."""
    d = digest(seed, tag, key)
    u, v = slice_uniform(d, 0), slice_uniform(d, 1)
    cum = _cum([w for w, _, _ in mixture])
    expr = None
    for (w, lo, hi), c in zip(mixture, cum):
        day = draw_int(v, lo, hi)
        if expr is None:
            expr = F.when(u < F.lit(c), day)
        else:
            expr = expr.when(u < F.lit(c), day)
    return expr.otherwise(draw_int(v, mixture[-1][1], mixture[-1][2]))


def growth_day_sql(seed: int, tag: str, key: str, mixture) -> str:
    d = digest_sql(seed, tag, key)
    u, v = slice_uniform_sql(d, 0), slice_uniform_sql(d, 1)
    cum = _cum([w for w, _, _ in mixture])
    whens = " ".join(f"WHEN {u} < CAST({c!r} AS DOUBLE) THEN {draw_int_sql(v, lo, hi)}"
                     for (w, lo, hi), c in zip(mixture, cum))
    return f"(CASE {whens} ELSE {draw_int_sql(v, mixture[-1][1], mixture[-1][2])} END)"


def second_of_day(seed: int, tag: str, key) -> Column:
    d = digest(seed, tag, key)
    u = F.conv(F.substring(d, 25, 8), 16, 10).cast("bigint") / F.lit(TWO32)
    return F.floor(u * F.lit(86400)).cast("bigint")


def second_of_day_sql(seed: int, tag: str, key: str) -> str:
    d = digest_sql(seed, tag, key)
    return f"CAST(floor(CAST(('0x' || substr({d}, 25, 8)) AS BIGINT) / 4294967296.0 * 86400) AS BIGINT)"


def ts_literal(ts: str | date) -> Column:
    return F.lit(str(ts)).cast("timestamp_ntz")


def growth_timestamp(start, day, second) -> Column:
    """Window start + day days + second seconds (timestamp without time zone)."""
    start_c = ts_literal(start) if isinstance(start, (str, date)) else start
    return F.timestamp_add("DAY", _c(day), F.timestamp_add("SECOND", _c(second), start_c))


def growth_timestamp_sql(start: str | date, day: str, second: str) -> str:
    return f"(TIMESTAMP '{start}' + INTERVAL ({day}) DAY + INTERVAL ({second}) SECOND)"


def shifted_date(ts, u, span: int) -> Column:
    """The row's date plus 0..span-1 days, as a midnight timestamp."""
    return F.date_add(F.to_date(_c(ts)), draw_int(u, 0, span).cast("int")).cast("timestamp_ntz")


def shifted_date_sql(ts: str, u: str, span: int) -> str:
    return f"CAST(CAST({ts} AS DATE) + CAST({draw_int_sql(u, 0, span)} AS INTEGER) AS TIMESTAMP)"
