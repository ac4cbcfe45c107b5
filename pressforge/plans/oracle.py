"""SQL (DuckDB dialect) twins of the views and caption path, for the oracle."""

from __future__ import annotations

from .. import vocab as V
from . import sqlgen as Q
from .views import JOB_ABSURD_RATE, SEED


def v_job_sql(seed=SEED, absurd_rate: float = JOB_ABSURD_RATE) -> str:
    idc = "o_orderkey"
    absurd = f"({Q.uniform(seed, idc, 'absurd')} < {absurd_rate!r})"
    back_raw = (f"CASE WHEN {absurd} THEN {Q.choice(seed, idc, 'absurd_bg', V.ABSURD_BACKDROPS)} "
                f"ELSE {Q.choice(seed, idc, 'normal_bg', V.BACKDROPS)} END")
    inner = (f"SELECT o_orderkey AS id, o_orderkey AS accept_order, n_name AS dateline, "
             f"{Q.choice(seed, idc, 'bucket', V.BUCKETS)} AS bucket, "
             f"{Q.choice(seed, idc, 'role', V.ROLES)} AS role, "
             f"{Q.choice(seed, idc, 'event', V.EVENTS)} AS event, "
             f"{absurd} AS mismatch, {back_raw} AS back_raw, "
             f"{Q.weighted_choice(Q.uniform(seed, idc, 'shot'), V.SHOT_TYPES)} AS shot "
             f"FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey")
    return (f"SELECT *, CASE WHEN mismatch THEN {Q.caption_backdrop('back_raw')} ELSE back_raw END AS back_caption "
            f"FROM ({inner})")


def text_tags_sql(x: str, table: dict) -> str:
    hits = ", ".join(f"CASE WHEN {Q.contains_any(f'lower({x})', kws)} THEN {Q.q(tag)} END" for tag, kws in table.items())
    return (f"list_sort(list_transform([list_filter([{hits}], lambda _h: _h IS NOT NULL)], "
            f"lambda _hs: CASE WHEN len(_hs) > 0 THEN _hs ELSE [{Q.q(V.DEFAULT_TAG)}] END)[1])")


def tag_union_sql(a: str, b: str) -> str:
    return f"list_sort(list_distinct(list_concat({a}, {b})))"


def objects_for_sql(tag: str) -> str:
    whens = " ".join(f"WHEN {Q.q(k)} THEN {Q.lst(v)}" for k, v in V.OBJECTS_BY_TAG.items())
    return f"(CASE {tag} {whens} ELSE {Q.lst(V.OBJECTS_BY_TAG[V.DEFAULT_TAG])} END)"


def affect_sql(seed, idc: str) -> str:
    pair = Q.pick_index(seed, idc, "aff_pair", len(V.AFFECT_PAIRS))
    side = Q.pick_index(seed, idc, "aff_side", 2)
    pos = Q.lst([p for p, _ in V.AFFECT_PAIRS])
    neg = Q.lst([n for _, n in V.AFFECT_PAIRS])
    return f"(CASE WHEN {side} = 0 THEN ({pos})[{pair} + 1] ELSE ({neg})[{pair} + 1] END)"


def ta_span_sql(text: str, aff: str, mode: str = "exact") -> str:
    n, k = Q.token_count(text), Q.token_count(aff)
    if mode == "exact":
        return Q.index_range(f"{n} - {k}", n)
    return Q.index_range(f"{n} - {k} - 1", f"{n} - 1")


def ts_caption_sql(seed, idc: str) -> str:
    s = Q.choice(seed, idc, "irr_subject", V.IRREL_SUBJECTS)
    a = Q.choice(seed, idc, "irr_action", V.IRREL_ACTIONS_BASE)
    p = Q.choice(seed, idc, "irr_place", V.IRREL_PLACES)
    tail = Q.choice(seed, idc, "irr_tail", V.IRREL_TAILS)
    conj = Q.conjugate_third_person("split_part(_a, ' ', 1)", Q.is_plural_subject("_s"))
    rest = "(CASE WHEN contains(_a, ' ') THEN ' ' || substr(_a, strpos(_a, ' ') + 1) ELSE '' END)"
    body = f"_s || ' ' || {conj} || {rest} || ' ' || {p} || {tail}"
    return (f"(list_transform([{s}], lambda _s: list_transform([{a}], lambda _a: "
            f"{Q.headline_tidy(body)})[1])[1])")


def captions_sql(src: str, seed=SEED, span_mode: str = "exact") -> str:
    """Twin of ``operators.captions.with_captions`` over a relation ``src``."""
    idc = "id"
    tags = tag_union_sql(text_tags_sql("role", V.ROLE_RULES), text_tags_sql("event", V.EVENT_TAGS))
    w = f"(CASE WHEN {Q.uniform(seed, idc, 'when_u')} < {V.WHEN_RATE!r} THEN {Q.choice(seed, idc, 'when', V.WHEN_FRAG)} ELSE '' END)"
    v = Q.conjugate_third_person(f"({Q.choice(seed, idc, 'verb', V.ACTIONS_BASE)})", "false")
    s1 = (f"SELECT *, {tags} AS tags, {Q.role_to_subject('role')} AS _S, {Q.clean_event('event')} AS _E, "
          f"{w} AS _W, {v} AS _V, {Q.pick_index(seed, idc, 'pattern', len(V.PATTERNS))} AS _k, "
          f"{affect_sql(seed, idc)} AS _aff FROM ({src})")
    s2 = (f"SELECT *, coalesce({Q.choice_from('list_sort(tags)', seed, idc, 'tag')}, {Q.q(V.DEFAULT_TAG)}) AS _tag "
          f"FROM ({s1})")
    s3 = f"SELECT *, {Q.choice_from(objects_for_sql('_tag'), seed, idc, 'obj')} AS _O FROM ({s2})"
    render = Q.render_pattern("_k", {"S": "_S", "V": "_V", "O": "_O", "B": "back_caption", "E": "_E",
                                     "D": "dateline", "W": "_W"})
    s4 = (f"SELECT *, CASE WHEN bucket <> 'irr' THEN {Q.headline_tidy(render)} END AS _core, "
          f"CASE WHEN bucket = 'irr' THEN {ts_caption_sql(seed, idc)} END AS _ts FROM ({s3})")
    s5 = f"SELECT *, {Q.strip_terminal_punct('_core')} || ', ' || _aff || '.' AS _ta FROM ({s4})"
    cls = " ".join(f"WHEN {Q.q(k)} THEN {Q.q(v)}" for k, v in V.BUCKET_CLASS.items())
    return (f"SELECT * EXCLUDE (_S, _E, _W, _V, _k, _aff, _tag, _O, _core, _ts, _ta), "
            f"CASE bucket WHEN 'lit' THEN _core WHEN 'inv' THEN _ta ELSE _ts END AS text, "
            f"CASE bucket WHEN 'lit' THEN [] WHEN 'inv' THEN {ta_span_sql('_ta', '_aff', span_mode)} "
            f"ELSE {Q.index_range('0', Q.token_count('_ts'))} END AS fake_text_pos, "
            f"CASE bucket {cls} END AS fake_cls FROM ({s5})")


def image_path_sql(bucket: str, idc: str, seed=SEED) -> str:
    dirs = " ".join(f"WHEN {Q.q(k)} THEN {Q.q(v)}" for k, v in V.BUCKET_DIR.items())
    name = f"md5(concat_ws('|', {Q.q(seed)}, cast({idc} as varchar), 'img'))"
    return f"((CASE {bucket} {dirs} END) || '/' || {name} || '.jpg')"
