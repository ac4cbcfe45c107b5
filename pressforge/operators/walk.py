"""The scene space walked in a keyed order (F1, E7), without building it.

The space is the product role x event x backdrop x shot. Row number i of the walk is sent
through a keyed permutation of the space and decoded into its four parts, so

* scenes are distinct by construction within a lap: no cross join, no distinct step, no
  state, and any row can be computed alone, in any task;
* the walk is cyclic: after the last scene the next lap starts, under another key.

The permutation is a Feistel network over the product Z_A x Z_B instead of two halves of
the same number of bits: each round adds a keyed hash of one side to the other, modulo
that side's size. Every round can be undone, so it is a bijection for any sizes, and no
value has to be drawn again for lying outside of the space.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import text as T
from ..functions.sampling import draw
from ..plans.ranking import DENSE_BITS, ordered_rank
from ..session import cut_lineage
from .tags import semantic_match

ROUNDS = 4


@dataclass(frozen=True)
class SceneSpace:
    """The vocabularies of a scene space; backdrops are the normal ones, then the absurd ones."""

    roles: list[str] = field(default_factory=lambda: V.ROLES)
    events: list[str] = field(default_factory=lambda: V.EVENTS)
    normal: list[str] = field(default_factory=lambda: V.BACKDROPS)
    absurd: list[str] = field(default_factory=lambda: V.ABSURD_BACKDROPS)
    shots: list[str] = field(default_factory=lambda: [s for s, _ in V.SHOT_TYPES])

    def __post_init__(self):
        if not (self.roles and self.events and self.backdrops and self.shots):
            raise ValueError("a scene space needs a role, an event, a backdrop and a shot")

    @property
    def backdrops(self) -> list[str]:
        return [*self.normal, *self.absurd]

    @property
    def sides(self) -> tuple[int, int]:
        """Sizes of the two sides of the permutation: role x shot, event x backdrop."""
        return len(self.roles) * len(self.shots), len(self.events) * len(self.backdrops)

    @property
    def size(self) -> int:
        a, b = self.sides
        return a * b


def permuted(df: DataFrame, number: str, sides: tuple[int, int], seed, rounds: int = ROUNDS) -> DataFrame:
    """Adds lap, left and right: the place in the space of row ``number`` (from 0) of the walk."""
    a, b = sides
    d = df.withColumn("lap", F.expr(f"{number} div {a * b}")).withColumn("_at", F.expr(f"pmod({number}, {a * b})"))
    d = d.withColumns({"left": F.pmod(F.col("_at"), F.lit(a)), "right": F.expr(f"_at div {a}")}).drop("_at")

    def hashed(side: str, i: int) -> Column:
        return draw(seed, F.concat_ws(":", F.col("lap").cast("string"), F.col(side).cast("string")), f"walk{i}")

    for i in range(rounds):
        side, other, n = ("left", "right", a) if i % 2 == 0 else ("right", "left", b)
        d = d.withColumn(side, F.pmod(F.col(side) + hashed(other, i), F.lit(n)))
    return d


def part(values: list[str], at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (at + 1).cast("int"))


def _tag_lists(values: list[str], table: dict[str, list[str]]) -> Column:
    """The tags of every value of a vocabulary list (D1, D2), worked out once, here."""
    def tags(value: str) -> list[str]:
        low = value.lower()
        return sorted(t for t, kws in table.items() if any(k in low for k in kws)) or [V.DEFAULT_TAG]

    return F.array(*[F.array(*[F.lit(t) for t in tags(v)]) for v in values])


def decoded(df: DataFrame, space: SceneSpace, vocab=V) -> DataFrame:
    """Adds scene (its number in the space), role, event, back_raw, mismatch, shot, back_caption, and
    whether the scene makes sense (D4: valid; absurd ones do by construction).

    What a scene's parts have in common is looked up by their numbers in the lists, not searched
    for in texts, so a filter on ``valid`` stays a small expression wherever the optimizer puts it."""
    a, _ = space.sides
    n_events, n_roles = len(space.events), len(space.roles)
    role, event = F.pmod(F.col("left"), F.lit(n_roles)), F.pmod(F.col("right"), F.lit(n_events))
    back = F.expr(f"right div {n_events}")

    def at(lists: Column, i: Column) -> Column:
        return F.element_at(lists, (i + 1).cast("int"))

    match = semantic_match(at(_tag_lists(space.roles, vocab.ROLE_RULES), role), at(_tag_lists(space.events, vocab.EVENT_TAGS), event),
                           at(_tag_lists(space.backdrops, vocab.BACKDROP_TAGS), back))
    d = df.withColumns({
        "scene": F.col("left") + F.col("right") * a,
        "role": part(space.roles, role), "event": part(space.events, event), "back_raw": part(space.backdrops, back),
        "shot": part(space.shots, F.expr(f"left div {n_roles}")),
        "mismatch": back >= len(space.normal), "valid": (back >= len(space.normal)) | match}).drop("left", "right")
    d = T.add_caption_backdrop(d, "back_raw", "_bc")
    return d.withColumn("back_caption", F.when(F.col("mismatch"), F.col("_bc")).otherwise(F.col("back_raw"))).drop("_bc")


def walk(jobs: DataFrame, seed, space: SceneSpace | None = None, order_col: str = "accept_order", vocab=V) -> DataFrame:
    """A scene for every job, in arrival order: the columns of ``jobs`` and those of ``decoded``."""
    space = space or SceneSpace()
    d = ordered_rank(jobs, order_col, None, out="_n", bits=DENSE_BITS).withColumn("_n", F.col("_n") - 1)
    return decoded(permuted(d, "_n", space.sides, seed), space, vocab).drop("_n")


def walk_pool(spark: SparkSession, n: int, seed, space: SceneSpace | None = None, start: int = 0, vocab=V) -> DataFrame:
    """The first n valid scenes of the walk from position ``start`` on, with their position: the pool
    of E8 for any n up to what one lap holds (a larger one is an error), distinct by construction.
    A lap is one pass over a range; it has as many rows as the vocabularies have combinations."""
    space = space or SceneSpace()
    lap = spark.range(start, start + space.size).withColumnRenamed("id", "position")
    valid = cut_lineage(decoded(permuted(lap, "position", space.sides, seed), space, vocab).filter("valid").drop("valid"))
    found = valid.count()
    if found < n:
        raise ValueError(f"{found} valid scenes in a lap for a pool of {n}")
    ranked = ordered_rank(valid, "position", None, out="_rank", bits=DENSE_BITS)
    return ranked.filter(F.col("_rank") <= n).select("position", "scene", "role", "event", "back_raw", "mismatch", "shot", "back_caption")


def unwalk(left: int, right: int, lap: int, sides: tuple[int, int], seed, rounds: int = ROUNDS) -> int:
    """The row number that the walk sends to (left, right) of a lap: the rounds undone, last first."""
    import hashlib

    def hashed(side, i):
        return int(hashlib.md5(f"{seed}|{lap}:{side}|walk{i}".encode()).hexdigest()[:8], 16)

    a, b = sides
    for i in reversed(range(rounds)):
        if i % 2 == 0:
            left = (left - hashed(right, i)) % a
        else:
            right = (right - hashed(left, i)) % b
    return lap * a * b + left + right * a
