"""Caption generation (C8-C13): one narrow projection per job row.

Inputs are job rows carrying ``id`` plus scene columns; every random choice is
``draw(seed, id, slot)`` so the output does not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions import text as T
from ..functions.sampling import Prefix, bernoulli, choice, choice_from, draw_prefix, pick_index
from ..session import compiled_methods
from .tags import add_text_tags, objects_for, tag_choice, tag_union

SPAN_MODES = ("exact", "reference")


def headline_core(id_col: Column, role: Column, event: Column, back_caption: Column, tags: Column,
                  dateline: Column, seed, em_dash: bool = False) -> Column:
    """Literal newswire headline (before any affect edit)."""
    pats = V.pattern_list(em_dash)
    subj = T.role_to_subject(role)
    e = T.clean_event(event)
    w = F.when(bernoulli(seed, id_col, "when_u", V.WHEN_RATE), choice(seed, id_col, "when", V.WHEN_FRAG)).otherwise(F.lit(""))
    v = T.conjugate_third_person(choice(seed, id_col, "verb", V.ACTIONS_BASE), False)
    tag = tag_choice(tags, seed, id_col, "tag")
    objs = objects_for(tag)
    o = choice_from(objs, seed, id_col, "obj")
    k = pick_index(seed, id_col, "pattern", len(pats))
    core = T.render_pattern(k, {"S": subj, "V": v, "O": o, "B": back_caption, "E": e, "D": dateline, "W": w}, pats)
    return T.headline_tidy(core)


def affect(id_col: Column, seed, vocab=V) -> Column:
    """C10 helper: one member of a drawn affect pair."""
    pair = pick_index(seed, id_col, "aff_pair", len(vocab.AFFECT_PAIRS))
    side = pick_index(seed, id_col, "aff_side", 2)
    pos = F.element_at(F.array(*[F.lit(p) for p, _ in vocab.AFFECT_PAIRS]), (pair + 1).cast("int"))
    neg = F.element_at(F.array(*[F.lit(n) for _, n in vocab.AFFECT_PAIRS]), (pair + 1).cast("int"))
    return F.when(side == 0, pos).otherwise(neg)


def ta_caption(text: Column, aff: Column) -> Column:
    """Replace one terminal . ! ? with ', <affect>.'."""
    return F.concat(T.strip_terminal_punct(text), F.lit(", "), aff, F.lit("."))


def ta_span(text: Column, aff: Column, mode: str = "exact") -> Column:
    """C11: token span of the affect words; ``reference`` reproduces the
    one-token-early span of the original builder."""
    return span_of_counts(T.token_count(text), T.token_count(aff), mode)


def span_of_counts(n: Column, k: Column, mode: str = "exact") -> Column:
    """C11 from the token counts of the caption and of the affect words."""
    if mode == "exact":
        return T.index_range(n - k, n)
    if mode == "reference":
        return T.index_range(n - k - 1, n - 1)
    raise ValueError(f"span mode must be one of {SPAN_MODES}")


def ts_caption(id_col: Column, seed) -> Column:
    """Irrelevant headline for text swaps (Column form)."""
    s = choice(seed, id_col, "irr_subject", V.IRREL_SUBJECTS)
    a = choice(seed, id_col, "irr_action", V.IRREL_ACTIONS_BASE)
    return T.headline_tidy(ts_raw(s, a, id_col, seed))


def ts_raw(s: Column, a: Column, id_col: Column, seed, vocab=V) -> Column:
    """C12 before tidy: subject + conjugated first verb word + rest + place + tail."""
    parts = F.split(a, " ", 2)
    verb_base = F.element_at(parts, 1)
    rest = F.when(F.size(parts) > 1, F.concat(F.lit(" "), F.element_at(parts, 2))).otherwise(F.lit(""))
    verb = T.conjugate_third_person(verb_base, T.is_plural_subject(s))
    p = choice(seed, id_col, "irr_place", vocab.IRREL_PLACES)
    tail = choice(seed, id_col, "irr_tail", vocab.IRREL_TAILS)
    return F.concat(s, F.lit(" "), verb, rest, F.lit(" "), p, tail)


def ts_span(text: Column) -> Column:
    """Every token index."""
    return T.index_range(F.lit(0), T.token_count(text))


def with_captions(jobs: DataFrame, seed, span_mode: str | tuple[str, ...] = "exact", em_dash: bool = False, vocab=V) -> DataFrame:
    """Caption path for job rows with columns
    ``id, bucket, role, event, back_caption, dateline``.

    Adds ``tags, text, fake_text_pos, fake_cls``; bucket ``lit`` gives a
    literal headline, ``inv`` a text-attribute edit, ``irr`` a text swap.
    ``vocab`` holds the word lists (see ``vocab.with_lists``). Several span modes
    give a column ``fake_text_pos_<mode>`` each instead of ``fake_text_pos``.
    Slots and intermediate texts are separate columns so the optimizer never
    copies a large sub-expression into several places (keeps every stage in
    whole-stage codegen).
    """
    idc = Prefix("_dk")
    pats = vocab.PATTERNS_EM_DASH if em_dash else vocab.PATTERNS
    b = F.col("bucket")
    df = compiled_methods(jobs).withColumn("_dk", draw_prefix(seed, F.col("id")))
    df = add_text_tags(df, "role", "_rt", vocab.ROLE_RULES)
    df = add_text_tags(df, "event", "_et", vocab.EVENT_TAGS)
    df = df.withColumn("tags", tag_union(F.col("_rt"), F.col("_et"))).drop("_rt", "_et")
    df = T.add_role_to_subject(df, "role", "_S")
    df = (df.withColumn("_E", T.clean_event(F.col("event")))
          .withColumn("_W", F.when(bernoulli(seed, idc, "when_u", vocab.WHEN_RATE),
                                   choice(seed, idc, "when", vocab.WHEN_FRAG)).otherwise(F.lit("")))
          .withColumn("_vb", choice(seed, idc, "verb", vocab.ACTIONS_BASE))
          .withColumn("_V", T.conjugate_third_person(F.col("_vb"), False))
          .withColumn("_tag", tag_choice(F.col("tags"), seed, idc, "tag"))
          .withColumn("_objs", objects_for(F.col("_tag"), vocab.OBJECTS_BY_TAG))
          .withColumn("_O", choice_from(F.col("_objs"), seed, idc, "obj"))
          .withColumn("_k", pick_index(seed, idc, "pattern", len(pats))))
    slots = {n: F.col(f"_{n}") for n in "SEWVO"}
    slots.update({"B": F.col("back_caption"), "D": F.col("dateline")})
    df = df.withColumn("_raw", F.when(b != "irr", T.render_pattern(F.col("_k"), slots, pats)))
    df = T.add_headline_tidy(df, "_raw", "_core")
    df = df.withColumn("_aff", affect(idc, seed, vocab))
    df = df.withColumn("_ta", ta_caption(F.col("_core"), F.col("_aff")))
    df = (df.withColumn("_is", choice(seed, idc, "irr_subject", vocab.IRREL_SUBJECTS))
          .withColumn("_ia", choice(seed, idc, "irr_action", vocab.IRREL_ACTIONS_BASE)))
    df = df.withColumn("_tsraw", F.when(b == "irr", ts_raw(F.col("_is"), F.col("_ia"), idc, seed, vocab)))
    df = T.add_headline_tidy(df, "_tsraw", "_ts")
    df = df.withColumn("text", F.when(b == "lit", F.col("_core")).when(b == "inv", F.col("_ta")).otherwise(F.col("_ts")))
    df = df.withColumn("_nt", F.when(b == "lit", F.lit(None)).otherwise(T.token_count(F.col("text"))))
    df = df.withColumn("_na", F.when(b == "inv", T.token_count(F.col("_aff"))))

    def spans(mode):
        return (F.when(b == "lit", T.empty_int_array()).when(b == "inv", span_of_counts(F.col("_nt"), F.col("_na"), mode))
                .otherwise(T.index_range(F.lit(0), F.col("_nt"))))

    modes = [span_mode] if isinstance(span_mode, str) else list(span_mode)
    df = df.withColumns({"fake_text_pos" if len(modes) == 1 else f"fake_text_pos_{m}": spans(m) for m in modes})
    cls = F.create_map(*[x for k, v in vocab.BUCKET_CLASS.items() for x in (F.lit(k), F.lit(v))])
    df = df.withColumn("fake_cls", F.element_at(cls, b))
    return df.drop("_S", "_E", "_W", "_V", "_O", "_k", "_raw", "_core", "_aff", "_ta", "_ts", "_is", "_ia", "_tsraw", "_dk",
                   "_vb", "_tag", "_objs", "_nt", "_na")
