"""Seeded draws.

A draw is a pure function of (seed, tag, key...): the md5 of ``seed|tag|key...`` cut into
48-bit slices, each divided by 2^48. Retries, speculative tasks and repartitioning cannot change
a value, and DuckDB computes the same bits (``*_sql`` twins), which is how the oracle checks us.
Two slices come from one md5, so a column needing two numbers hashes once.

Each Column function has a DuckDB twin returning SQL text over the same column names.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO48 = float(1 << 48)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _cum(weights: Sequence[float]) -> list[float]:
    total = float(sum(weights))
    out, acc = [], 0.0
    for w in weights:
        acc += w
        out.append(acc / total)
    return out


def _sql_lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    return str(v)


# --- C1 uniform ------------------------------------------------------------------------------

def digest(seed: int, tag: str, *keys) -> Column:
    """md5 hex of ``seed|tag|k1|k2...``; keys are integer columns (cast to their decimal text)."""
    parts = [F.lit(str(seed)), F.lit(tag)] + [_c(k).cast("string") for k in keys]
    return F.md5(F.concat_ws("|", *parts))


def digest_sql(seed: int, tag: str, *keys: str) -> str:
    parts = [f"'{seed}'", f"'{tag}'"] + [f"CAST({k} AS VARCHAR)" for k in keys]
    return f"md5(concat_ws('|', {', '.join(parts)}))"


def slice_uniform(d: Column, slot: int = 0) -> Column:
    """Uniform in [0, 1) from hex digits 12*slot+1 .. 12*slot+12 of a digest (slot 0 or 1)."""
    return F.conv(F.substring(d, 12 * slot + 1, 12), 16, 10).cast("bigint") / F.lit(TWO48)


def slice_uniform_sql(d: str, slot: int = 0) -> str:
    return (f"(CAST(CAST(('0x' || substr({d}, {12 * slot + 1}, 12)) AS BIGINT) AS DOUBLE)"
            f" / 281474976710656.0)")


def draw_uniform(seed: int, tag: str, *keys, slot: int = 0) -> Column:
    return slice_uniform(digest(seed, tag, *keys), slot)


def draw_uniform_sql(seed: int, tag: str, *keys: str, slot: int = 0) -> str:
    return slice_uniform_sql(digest_sql(seed, tag, *keys), slot)


# --- C2 modular ------------------------------------------------------------------------------

def draw_modular(x, mult: int, mod) -> Column:
    """``(x * mult) mod mod``: evenly spread, no hashing (variant D's generator)."""
    return F.pmod(_c(x) * F.lit(mult), mod if isinstance(mod, Column) else F.lit(mod))


def draw_modular_sql(x: str, mult: int, mod) -> str:
    return f"((({x}) * {mult}) % {mod} + {mod}) % {mod}"


# --- C3 / C4 categorical ---------------------------------------------------------------------

def draw_categorical(u, choices: Sequence[tuple[str, float]]) -> Column:
    """One value per row from a single draw ``u`` against cumulative thresholds (fixes X1)."""
    values = [v for v, _ in choices]
    cum = _cum([w for _, w in choices])
    u = _c(u)
    expr = None
    for v, c in zip(values[:-1], cum[:-1]):
        expr = F.when(u < F.lit(c), F.lit(v)) if expr is None else expr.when(u < F.lit(c), F.lit(v))
    last = F.lit(values[-1])
    return last if expr is None else expr.otherwise(last)


def draw_categorical_sql(u: str, choices: Sequence[tuple[str, float]]) -> str:
    values = [v for v, _ in choices]
    cum = _cum([w for _, w in choices])
    if len(values) == 1:
        return _sql_lit(values[0])
    whens = " ".join(f"WHEN {u} < {_sql_lit(c)} THEN {_sql_lit(v)}"
                     for v, c in zip(values[:-1], cum[:-1]))
    return f"(CASE {whens} ELSE {_sql_lit(values[-1])} END)"


def draw_categorical_by(u, key, table: dict) -> Column:
    """Weights that change with ``key`` (a period name): one categorical per key value. A null key,
    or one that the table doesn't have, gives null."""
    key = _c(key)
    picks = [F.when(key == F.lit(k), draw_categorical(u, choices)) for k, choices in table.items()]
    return F.coalesce(*picks)


def draw_categorical_by_sql(u: str, key: str, table: dict) -> str:
    whens = " ".join(f"WHEN {key} = {_sql_lit(k)} THEN {draw_categorical_sql(u, ch)}" for k, ch in table.items())
    return f"(CASE {whens} END)"


# --- C5 integer ------------------------------------------------------------------------------

def draw_int(u, lo: int, hi) -> Column:
    """Integer in [lo, hi); ``hi`` may be a column."""
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    return (F.floor(_c(u) * (hi_c - F.lit(lo))) + F.lit(lo)).cast("bigint")


def draw_int_sql(u: str, lo: int, hi) -> str:
    return f"CAST(floor({u} * (({hi}) - {lo})) + {lo} AS BIGINT)"


# --- B8 Bernoulli ----------------------------------------------------------------------------

def bernoulli(u, p) -> Column:
    """Keep-flag with probability ``p`` (a number or a per-row column)."""
    return _c(u) < (p if isinstance(p, Column) else F.lit(float(p)))


def bernoulli_sql(u: str, p) -> str:
    return f"({u} < {p if isinstance(p, str) else _sql_lit(float(p))})"


# --- C8 / C9 skewed ids ----------------------------------------------------------------------

def power_law_id(u, n, k: float, base: int = 1) -> Column:
    """``floor(n * (1 - u^k))`` clamped to [0, n - 1], plus ``base``, for keys base .. base + n - 1;
    large k puts most mass on high ids."""
    n_c = n if isinstance(n, Column) else F.lit(n)
    raw = F.floor(n_c * (F.lit(1.0) - F.pow(_c(u), F.lit(float(k)))))
    return (F.least(F.greatest(raw, F.lit(0)), n_c - F.lit(1)) + F.lit(base)).cast("bigint")


def power_law_id_sql(u: str, n, k: float, base: int = 1) -> str:
    return (f"CAST(least(greatest(floor(({n}) * (1.0 - pow({u}, {float(k)!r}))), 0), ({n}) - 1) + {base}"
            f" AS BIGINT)")


def exponential_id(u1, u2, n, a, b, base: int = 1) -> Column:
    """A key of base .. base + n - 1: an exponential of mean ``a``, wrapped at n, less an
    exponential of mean ``b``, not below the first key. Choose a and b as fractions of n: with
    small fixed means nearly all draws fall on the first keys (X5)."""
    n_c = n if isinstance(n, Column) else F.lit(n)
    ahead = F.pmod(F.floor(-F.log(F.lit(1.0) - _c(u1)) * a), n_c)
    back = -F.log(F.lit(1.0) - _c(u2)) * b
    return (F.greatest(ahead - F.floor(back), F.lit(0)) + F.lit(base)).cast("bigint")


def exponential_id_sql(u1: str, u2: str, n, a, b, base: int = 1) -> str:
    """``a`` and ``b`` are numbers or SQL scalars."""
    ahead = f"(CAST(floor(-ln(1.0 - {u1}) * ({a})) AS BIGINT) % ({n}))"
    return f"CAST(greatest({ahead} - CAST(floor(-ln(1.0 - {u2}) * ({b})) AS BIGINT), 0) + {base} AS BIGINT)"


# --- C10 avoid self --------------------------------------------------------------------------

def avoid_self(a, candidates: Iterable[Column], n, base: int = 1) -> Column:
    """First candidate different from ``a``; if all equal ``a``, the next key of base .. base + n - 1.
    With a single key there is no other: null."""
    a = _c(a)
    n_c = n if isinstance(n, Column) else F.lit(n)
    picks = [F.when(c != a, c) for c in candidates]
    after = F.pmod(a - F.lit(base) + F.lit(1), n_c) + F.lit(base)
    return F.coalesce(*picks, F.when(n_c > 1, after)).cast("bigint")


def avoid_self_sql(a: str, candidates: Iterable[str], n, base: int = 1) -> str:
    picks = [f"CASE WHEN ({c}) <> {a} THEN ({c}) END" for c in candidates]
    return f"CAST(coalesce({', '.join(picks)}, CASE WHEN ({n}) > 1 THEN (({a}) - {base} + 1) % ({n}) + {base} END) AS BIGINT)"


# --- C11 / C12 foreign keys ------------------------------------------------------------------

def fk_uniform(u, n, base: int = 1) -> Column:
    """A uniformly drawn key in [base, base + n) when keys are dense."""
    n_c = n if isinstance(n, Column) else F.lit(n)
    return (F.floor(_c(u) * n_c) + F.lit(base)).cast("bigint")


def fk_uniform_sql(u: str, n, base: int = 1) -> str:
    return f"CAST(floor({u} * ({n})) + {base} AS BIGINT)"


def fk_cyclic(x, mult: int, n, base: int = 1) -> Column:
    """``(x * mult) mod n + base``: every key hit equally when mult and n are coprime (variant D)."""
    return (draw_modular(x, mult, n) + F.lit(base)).cast("bigint")


def fk_cyclic_sql(x: str, mult: int, n, base: int = 1) -> str:
    return f"CAST({draw_modular_sql(x, mult, n)} + {base} AS BIGINT)"
