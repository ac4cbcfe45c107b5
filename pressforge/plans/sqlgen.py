"""DuckDB-dialect SQL twins of the Column functions, for the oracle.

Each helper takes SQL expression text and returns SQL expression text that
computes the same value as the Spark Column function of the same name.
DuckDB's regex engine has no look-around, so whole-word checks are done by
wrapping every word in marker characters first.
"""

from __future__ import annotations

from .. import vocab as V
from ..functions.text import SPACE_CODEPOINTS

WS = "[" + "".join("\\x{%X}" % c for c in SPACE_CODEPOINTS) + "]"
WORD = "[\\p{L}\\p{N}_]"
NONWORD = "[^\\p{L}\\p{N}_]"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + str(s).replace("'", "''") + "'"


def lst(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def draw(seed, key: str, slot: str, slot_is_sql: bool = False) -> str:
    s = f"cast({slot} as varchar)" if slot_is_sql else q(slot)
    k = f"concat_ws('|', {q(seed)}, cast({key} as varchar), {s})"
    return f"cast(('0x' || substr(md5({k}), 1, 8)) as bigint)"


def uniform(seed, key, slot) -> str:
    return f"({draw(seed, key, slot)} / 4294967296.0)"


def pick_index(seed, key, slot, n) -> str:
    return f"({draw(seed, key, slot)} % {n})"


def choice(seed, key, slot, values) -> str:
    return f"({lst(values)})[{pick_index(seed, key, slot, len(values))} + 1]"


def choice_from(arr: str, seed, key, slot) -> str:
    return f"(CASE WHEN len({arr}) > 0 THEN ({arr})[({draw(seed, key, slot)} % len({arr})) + 1] END)"


def weighted_choice(u: str, items) -> str:
    parts, c = [], 0.0
    for name, w in items:
        c += w
        parts.append(f"WHEN {u} <= {repr(c)} THEN {q(name)}")
    return f"(CASE {' '.join(parts)} ELSE {q(items[-1][0])} END)"


def strip(s: str) -> str:
    return f"regexp_replace({s}, '\\A{WS}+|{WS}+\\z', '', 'g')"


def collapse_ws(s: str) -> str:
    return f"regexp_replace(regexp_replace({s}, '{WS}+', ' ', 'g'), '\\A | \\z', '', 'g')"


def tidy_punct(s: str) -> str:
    return f"replace(replace(replace({s}, ' ,', ','), ' .', '.'), ' :', ':')"


def tidy_prep(s: str, preps=None) -> str:
    p = "(?:" + "|".join(preps or V.TIDY_PREPS) + ")"
    marked = f"regexp_replace({s}, '({WORD}+)', chr(2) || '\\1' || chr(3), 'g')"
    pat = f"(?i)\\x{{2}}({p})\\x{{3}}{WS}+(?:\\x{{2}}the\\x{{3}}{WS}+)?\\x{{2}}{p}\\x{{3}}"
    rep = f"regexp_replace({marked}, '{pat}', chr(2) || '\\1' || chr(3), 'g')"
    return f"replace(replace({rep}, chr(2), ''), chr(3), '')"


def tidy_capital(s: str) -> str:
    return f"(upper(substr({s}, 1, 1)) || substr({s}, 2))"


def tidy_terminal(s: str) -> str:
    return f"regexp_replace({s}, '([^.!?])\\z', '\\1.')"


def headline_tidy(s: str, preps=None) -> str:
    x = f"({tidy_prep(tidy_punct(collapse_ws(s)), preps)})"
    return f"(list_transform([{x}], lambda _t: {tidy_terminal(tidy_capital('_t'))})[1])"


def tokens(s: str) -> str:
    return f"list_filter(regexp_split_to_array({s}, '{WS}+'), lambda _w: _w <> '')"


def token_count(s: str) -> str:
    return f"len({tokens(s)})"


def is_plural_subject(s: str) -> str:
    x = strip(s)
    return (f"({x} IN ({', '.join(q(p) for p in V.PLURALS)}) OR "
            f"(ends_with({x}, 's') AND lower({x}) NOT IN ({', '.join(q(p) for p in V.NOT_PLURAL_LOWER)})))")


def conjugate_third_person(b: str, plural: str) -> str:
    es = " OR ".join(f"ends_with({b}, {q(s)})" for s in ("s", "x", "z", "ch", "sh", "o"))
    return (f"(CASE WHEN {plural} THEN {b} WHEN {es} THEN {b} || 'es' "
            f"WHEN regexp_matches({b}, '[^aeiouAEIOU]y\\z') THEN regexp_replace({b}, 'y\\z', '') || 'ies' "
            f"ELSE {b} || 's' END)")


def _cap_word(w: str) -> str:
    return f"(upper(substr({w}, 1, 1)) || lower(substr({w}, 2)))"


def role_to_subject(role: str) -> str:
    r = f"regexp_replace(lower({strip(role)}), '\\A(a|an){WS}+', '')"
    words = f"list_filter(regexp_split_to_array(_r, '{WS}+'), lambda _w: _w <> '')"
    body = (f"CASE WHEN NOT contains(_r, ' ') THEN {_cap_word('_r')} "
            f"ELSE array_to_string(list_transform({words}, lambda _x: {_cap_word('_x')}), ' ') END")
    return f"(list_transform([{r}], lambda _r: {body})[1])"


def clean_event(e: str, rewrites=None) -> str:
    x = strip(e)
    for a, b in (rewrites if rewrites is not None else V.EVENT_REWRITES):
        x = f"replace({x}, {q(a)}, {q(b)})"
    return x


def starts_with_any(x: str, prefixes) -> str:
    return "(" + " OR ".join(f"starts_with({x}, {q(p)})" for p in prefixes) + ")"


def contains_any(x: str, kws) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(k)})" for k in kws) + ")"



def loc_phrase(place: str) -> str:
    body = (f"CASE WHEN {starts_with_any('lower(_p)', V.PROMPT_PREP_STARTS)} THEN _p "
            f"WHEN {contains_any('lower(_p)', V.IN_KEYWORDS)} THEN 'in ' || _p "
            f"WHEN {contains_any('lower(_p)', V.ON_KEYWORDS)} THEN 'on ' || _p "
            f"ELSE 'at ' || _p END")
    return f"(list_transform([{strip(place)}], lambda _p: {body})[1])"


def caption_backdrop(raw: str) -> str:
    part = "\\A(?:[a-z]+ing|" + "|".join(V.PARTICIPLES) + f")({NONWORD}|\\z)"
    inner = loc_phrase("_b")
    body = (f"CASE WHEN {starts_with_any('lower(_b)', V.CAPTION_CONNECTORS)} THEN _b "
            f"WHEN regexp_matches(lower(_b), '{part}') THEN 'while ' || _b "
            f"ELSE {inner} END")
    return f"(list_transform([{strip(raw)}], lambda _b: {body})[1])"


def render_pattern(k: str, slots: dict[str, str], patterns=None) -> str:
    from ..functions.text import parse_template
    pats = patterns or V.PATTERNS
    whens = []
    for i, t in enumerate(pats):
        parts = [slots[n] if is_slot else q(n) for is_slot, n in parse_template(t)]
        whens.append(f"WHEN {k} = {i} THEN " + " || ".join(f"({p})" for p in parts))
    return strip(f"(CASE {' '.join(whens)} END)")


def strip_terminal_punct(s: str) -> str:
    return f"regexp_replace({s}, '[.!?]{WS}*\\z', '')"


def index_range(start: str, end: str) -> str:
    return f"(CASE WHEN ({end}) > ({start}) THEN range(({start}), ({end})) ELSE [] END)"


def ints_to_str(arr: str) -> str:
    return f"array_to_string(list_transform({arr}, lambda _i: cast(_i as varchar)), ',')"
