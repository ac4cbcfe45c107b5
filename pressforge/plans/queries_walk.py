"""Registered queries: the scene space walked in a keyed order."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import walk as W
from . import sqlgen as Q
from .queries_scene import _BT, _ET, _MATCH, _RT
from .registry import register
from .views import SEED, table

SPACE = W.SceneSpace()


def walk_sql(rows: str, space: W.SceneSpace = SPACE, seed=SEED) -> str:
    """``rows`` has id and n (from 0): the rounds written out, each on the one before."""
    a, b = space.sides
    s = f"SELECT id, n // {a * b} AS lap, (n % {a * b}) % {a} AS l, (n % {a * b}) // {a} AS r FROM ({rows})"
    for i in range(W.ROUNDS):
        side, other, n = ("l", "r", a) if i % 2 == 0 else ("r", "l", b)
        key = f"concat_ws(':', cast(lap AS VARCHAR), cast({other} AS VARCHAR))"
        s = f"SELECT id, lap, {other}, ({side} + {Q.draw(seed, key, f'walk{i}')}) % {n} AS {side} FROM ({s})"
    return (f"SELECT id, lap, l + r * {a} AS scene, ({Q.lst(space.roles)})[l % {len(space.roles)} + 1] AS role, "
            f"({Q.lst(space.events)})[r % {len(space.events)} + 1] AS event, ({Q.lst(space.backdrops)})[r // {len(space.events)} + 1] AS back_raw, "
            f"r // {len(space.events)} >= {len(space.normal)} AS mismatch, ({Q.lst(space.shots)})[l // {len(space.roles)} + 1] AS shot FROM ({s})")


_ORDERS = "SELECT o_orderkey AS id, row_number() OVER (ORDER BY o_orderkey) - 1 AS n FROM orders"
_CAPTION = f"CASE WHEN mismatch THEN {Q.caption_backdrop('back_raw')} ELSE back_raw END"
_VALID = f"SELECT *, mismatch OR {_MATCH} AS valid FROM (SELECT *, {_RT} AS rt, {_ET} AS et, {_BT} AS bt FROM ({walk_sql(_ORDERS)}))"


@register("scene_walk", f"SELECT id, cast(lap AS BIGINT) AS lap, cast(scene AS BIGINT) AS scene, role, event, shot, mismatch, {_CAPTION} AS back_caption, valid FROM ({_VALID})")
def q_scene_walk(spark, sf_dir):
    """a scene for every order, in arrival order: all roles, events, backdrops and shots
    in a keyed cyclic order, each combination once a lap; which of them make sense (D4)."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("accept_order"))
    d = W.walk(o, SEED)
    return d.select("id", "lap", "scene", "role", "event", "shot", "mismatch", "back_caption", "valid")


@register("scene_walk_share",
          f"SELECT role, cast(count(*) AS BIGINT) AS n, cast(count(DISTINCT scene) AS BIGINT) AS scenes, cast(sum(CASE WHEN valid THEN 1 ELSE 0 END) AS BIGINT) AS valid FROM ({_VALID}) GROUP BY role")
def q_scene_walk_share(spark, sf_dir):
    """How evenly the walk goes through the roles: orders, distinct scenes, valid scenes."""
    d = q_scene_walk(spark, sf_dir)
    return d.groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("scene").alias("scenes"), F.sum(F.col("valid").cast("long")).alias("valid"))
