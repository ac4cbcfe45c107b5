"""Seeded, partition-independent randomness as Column expressions.

``draw(seed, id, slot)`` replaces a process-global RNG: the value depends only
on (seed, row key, slot name), so any partitioning, retry or re-execution of a
task gives the same answer. 32 uniform bits from md5, all JVM-side.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO32 = 4294967296.0


def resolve_seed(seed=None) -> int:
    """A fixed seed as given; ``None`` draws one fresh 32-bit seed once on
    the driver (then every draw of the run derives from it, so retries and
    re-executions still agree)."""
    if seed is not None:
        return int(seed)
    import os
    return int.from_bytes(os.urandom(4), "little")


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


class Prefix:
    """A precomputed ``"seed|key|"`` column, by name (see ``draw_prefix``).
    Passing it as the key lets many draws on one row share the key-to-string
    work; the hashed string, and so every value, is unchanged. Draws on a
    prefix are built as one SQL expression each (one call to the JVM instead
    of one per node and per list literal)."""

    def __init__(self, name: str):
        self.name = name
        self.col = F.col(name)


def sql_str(v) -> str:
    """Spark SQL string literal."""
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _draw_sql(key: Prefix, slot: str) -> str:
    return f"cast(conv(substring(md5(concat(`{key.name}`, {sql_str(slot)})), 1, 8), 16, 10) as bigint)"


def draw_prefix(seed, key) -> Column:
    return F.concat(F.lit(f"{seed}|"), _c(key).cast("string"), F.lit("|"))


def draw(seed, key, slot) -> Column:
    """Uniform integer in [0, 2^32) for (seed, key, slot)."""
    if isinstance(key, Prefix) and isinstance(slot, str):
        return F.expr(_draw_sql(key, slot))
    if isinstance(key, Prefix):
        k = F.concat(key.col, _c(slot).cast("string"))
    else:
        k = F.concat_ws("|", _c(str(seed)), _c(key).cast("string"), _c(slot).cast("string"))
    return F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("bigint")


def uniform(seed, key, slot) -> Column:
    """Uniform double in [0, 1)."""
    if isinstance(key, Prefix) and isinstance(slot, str):
        return F.expr(f"({_draw_sql(key, slot)}) / {TWO32!r}")
    return draw(seed, key, slot) / F.lit(TWO32)


def pick_index(seed, key, slot, n) -> Column:
    """0-based uniform index into a list of size ``n`` (int or Column)."""
    if isinstance(key, Prefix) and isinstance(slot, str) and isinstance(n, int):
        return F.expr(f"pmod({_draw_sql(key, slot)}, cast({n} as bigint))")
    return F.pmod(draw(seed, key, slot), _c(n).cast("bigint"))


def choice(seed, key, slot, values: list) -> Column:
    """Uniform choice from a fixed list (inlined as a literal array)."""
    if isinstance(key, Prefix) and isinstance(slot, str) and all(isinstance(v, str) for v in values):
        arr = "array(" + ", ".join(sql_str(v) for v in values) + ")"
        return F.expr(f"element_at({arr}, cast(pmod({_draw_sql(key, slot)}, cast({len(values)} as bigint)) + 1 as int))")
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (pick_index(seed, key, slot, len(values)) + 1).cast("int"))


def choice_from(arr: Column, seed, key, slot) -> Column:
    """Uniform choice from an array column (NULL when empty)."""
    n = F.size(arr)
    return F.when(n > 0, F.element_at(arr, (F.pmod(draw(seed, key, slot), n.cast("bigint")) + 1).cast("int")))


def bernoulli(seed, key, slot, p: float) -> Column:
    return uniform(seed, key, slot) < F.lit(float(p))


def weighted_choice_col(u: Column, items: list[tuple[str, float]]) -> Column:
    """Cumulative-weight pick: first item with u <= cumulative weight,
    last item when rounding leaves u above the total."""
    expr = None
    c = 0.0
    for name, w in items:
        c += w
        cond = u <= F.lit(c)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(items[-1][0]))
