"""Scene planning (E4-E9, C16, C17, D4): candidate scenes -> semantic filter ->
prompt -> first-wins distinct -> first n in candidate order."""

from __future__ import annotations

from itertools import zip_longest

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import text as T
from ..functions.sampling import Prefix, choice, draw, draw_prefix, uniform
from ..session import cut_lineage
from ..plans.ranking import DENSE_BITS, ordered_rank
from .dedup import first_wins
from .tags import add_text_tags, semantic_match

SCENE_KEY = ["prompt", "back_caption", "shot", "role", "event"]


def props(id_col, absurd: Column, seed, vocab=V) -> Column:
    """C17: optional prop phrases by Bernoulli gates; default phrase when none."""
    items = []
    for i, (odd, usual) in enumerate(zip_longest(vocab.PROPS_ABSURD, vocab.PROPS_NORMAL)):
        u = uniform(seed, id_col, f"prop{i}")
        pick = [F.when(u < p[1], F.lit(p[0])) if p else F.lit(None).cast("string") for p in (odd, usual)]
        items.append(F.when(absurd, pick[0]).otherwise(pick[1]))
    joined = F.array_join(F.concat(*[F.when(i.isNotNull(), F.array(i)).otherwise(F.array().cast("array<string>")) for i in items]), "; ")
    return F.coalesce(F.nullif(joined, F.lit("")), F.lit(vocab.PROPS_DEFAULT))


def with_prompt(df: DataFrame, seed, vocab=V) -> DataFrame:
    """Image prompt assembled from scene parts (needs id, role, event,
    back_raw, mismatch, shot)."""
    d = T.add_loc_phrase(df, "back_raw", "_bp").withColumn("_dk", draw_prefix(seed, F.col("id")))
    key = Prefix("_dk")
    back_prompt = F.when(F.col("mismatch"), F.col("_bp")).otherwise(F.col("back_raw"))
    no_text = vocab.NO_TEXT_PREFIX + ", ".join(vocab.TEXT_BLACKLIST)
    style = F.when(F.col("mismatch"), F.lit(vocab.STYLE_ABSURD)).otherwise(F.lit(vocab.STYLE_NORMAL))
    prompt = F.concat_ws("; ",
                         F.concat_ws(" ", F.col("role"), F.col("event"), back_prompt),
                         F.col("shot"),
                         F.lit(vocab.PROMPT_MIDDLE + vocab.FACE_HINT),
                         choice(seed, key, "light", vocab.LIGHTING),
                         props(key, F.col("mismatch"), seed, vocab),
                         F.lit(no_text), style)
    return d.withColumn("prompt", prompt).drop("_bp", "_dk")


def with_validity(df: DataFrame, vocab=V) -> DataFrame:
    """D4 on normal scenes; absurd scenes are valid by construction."""
    d = add_text_tags(df, "role", "role_tags", vocab.ROLE_RULES)
    d = add_text_tags(d, "event", "event_tags", vocab.EVENT_TAGS)
    d = add_text_tags(d, "back_raw", "back_tags", vocab.BACKDROP_TAGS)
    return d.withColumn("valid", F.col("mismatch") | semantic_match(F.col("role_tags"), F.col("event_tags"), F.col("back_tags")))


def scene_pool(candidates: DataFrame, n: int, seed, partial: bool = False, vocab=V) -> DataFrame:
    """The first ``n`` valid, distinct scenes in candidate (id) order.

    Candidates are rows the caller derives from its tables (one per job);
    the distinct step is a partial aggregation and the cut is an exact
    block-split rank, so no step gathers the pool in one task. A pool that the
    candidates can't fill is an error, unless the caller takes a ``partial`` one."""
    pool = cut_lineage(distinct_valid(candidates, seed, n, vocab))
    found = pool.count()
    if found < n and not partial:
        raise ValueError(f"{found} valid distinct scenes for a pool of {n}")
    return pool


def distinct_valid(candidates: DataFrame, seed, n: int | None = None, vocab=V) -> DataFrame:
    """E9 (+ the E8 cut when ``n`` is given). Validity depends only on the
    scene key, so the filter runs after the first-wins aggregation: a filter
    on the derived flag before it would be pushed below the projection and
    repeat the whole tagging work inside the filter."""
    v = with_validity(candidates, vocab)
    p = with_prompt(v, seed, vocab).withColumn("accept_order", F.col("id"))
    d = first_wins(p.select("accept_order", "id", *SCENE_KEY, "mismatch", "valid"), SCENE_KEY)
    d = d.filter(F.col("valid")).drop("valid")
    if n is None:
        return d.drop("accept_order")
    d = cut_lineage(d)  # ranking reads its input twice
    r = ordered_rank(d, "accept_order", None, out="pool_pos", bits=DENSE_BITS)
    return r.filter(F.col("pool_pos") <= n).drop("accept_order")


def shuffled(values: list[str], seed, slot: str = "shuffle") -> Column:
    """E6 for a fixed vocabulary list: order by a draw on the value."""
    arr = F.array(*[F.struct(draw(seed, F.lit(v), slot).alias("d"), F.lit(v).alias("v")) for v in values])
    return F.transform(F.sort_array(arr), lambda s: s["v"])
