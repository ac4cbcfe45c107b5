"""Headline grammar as native Column expressions (no UDFs).

Whitespace and word characters follow Python ``str`` semantics exactly:
the whitespace class is built from ``str.isspace`` and word characters are
letters, numbers and ``_`` (Unicode-aware), so results do not depend on the
regex dialect's defaults.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab as V

# Every code point Python's str.isspace() accepts (rule-built, not typed in).
SPACE_CODEPOINTS = [c for c in range(0x3001) if chr(c).isspace()]
# The same set for Java's regex engine: Character.isWhitespace plus the
# no-break / next-line spaces Python also counts. One library predicate plus
# four code points is far cheaper per character than a 25-way union
# (tests/test_text.py checks the two sets are equal).
JAVA_EXTRA_SPACES = [c for c in SPACE_CODEPOINTS if not chr(c).isspace() or c in (0x85, 0xA0, 0x2007, 0x202F)]
WS = "[\\p{javaWhitespace}" + "".join("\\x{%X}" % c for c in JAVA_EXTRA_SPACES) + "]"
WORD = "[\\p{L}\\p{N}_]"


def empty_int_array() -> Column:
    return F.array().cast("array<int>")


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def prep_alternation(words=None) -> str:
    return "(?:" + "|".join(words or V.TIDY_PREPS) + ")"


SPACE_CHARS = "".join(chr(c) for c in SPACE_CODEPOINTS)


def strip(s) -> Column:
    """Python ``str.strip()``: trim any of the whitespace characters from both
    ends (a character-set trim, no regex)."""
    return F.btrim(_c(s), F.lit(SPACE_CHARS))


def collapse_ws(s) -> Column:
    """Runs of whitespace -> one space, then strip."""
    return F.regexp_replace(F.regexp_replace(_c(s), f"{WS}+", " "), "\\A | \\z", "")


def tidy_punct(s) -> Column:
    """Drop the space before ',' then '.' then ':'."""
    x = _c(s)
    for a, b in ((" ,", ","), (" .", "."), (" :", ":")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def tidy_prep(s, preps=None) -> Column:
    """Two adjacent prepositions (optional 'the' between) -> the first.
    Case-insensitive, one left-to-right pass, whole words only. A lookahead
    on the possible first letters rejects most positions before the word
    boundary test runs."""
    words = preps or V.TIDY_PREPS
    p = prep_alternation(words)
    first = "".join(sorted({w[0] for w in words}))
    pat = f"(?i)(?=[{first}])(?<!{WORD})({p}){WS}+(?:the{WS}+)?{p}(?!{WORD})"
    return F.regexp_replace(_c(s), pat, "$1")


def tidy_capital(s) -> Column:
    """C3d: upper-case the first character."""
    x = _c(s)
    return F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, 2, 2147483647))


def tidy_terminal(s) -> Column:
    """C3e: append '.' unless it ends with . ! ? ; empty stays empty."""
    return F.regexp_replace(_c(s), "([^.!?])\\z", "$1.")


def headline_tidy(s, preps=None) -> Column:
    """The full tidy pass."""
    return tidy_terminal(tidy_capital(tidy_prep(tidy_punct(collapse_ws(s)), preps)))


def tokens(s) -> Column:
    """C14: Python ``str.split()`` tokens (strip, then split on whitespace
    runs; empty text gives no tokens). No lambda, so it stays in codegen."""
    x = strip(s)
    return F.when(x == F.lit(""), F.array().cast("array<string>")).otherwise(F.split(x, f"{WS}+"))


def token_count(s) -> Column:
    x = strip(s)
    return F.when(x == F.lit(""), F.lit(0)).otherwise(F.size(F.split(x, f"{WS}+")))


def tokens(s) -> Column:
    """C14: the tokens themselves."""
    x = strip(s)
    return F.when(x == F.lit(""), F.array().cast("array<string>")).otherwise(F.split(x, f"{WS}+"))


def is_plural_subject(s) -> Column:
    """C1."""
    x = strip(s)
    return x.isin(*V.PLURALS) | (x.endswith("s") & ~F.lower(x).isin(*V.NOT_PLURAL_LOWER))


def conjugate_third_person(base, plural) -> Column:
    """Third-person singular of a base verb unless the subject is plural."""
    b = _c(base)
    pl = plural if isinstance(plural, Column) else F.lit(bool(plural))
    es = None
    for suf in ("s", "x", "z", "ch", "sh", "o"):
        es = b.endswith(suf) if es is None else (es | b.endswith(suf))
    return (F.when(pl, b)
            .when(es, F.concat(b, F.lit("es")))
            .when(b.rlike("[^aeiouAEIOU]y\\z"),
                  F.concat(F.regexp_replace(b, "y\\z", ""), F.lit("ies")))
            .otherwise(F.concat(b, F.lit("s"))))


def _cap_word(w: Column) -> Column:
    return F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 2147483647)))


def role_to_subject(role) -> Column:
    """C4: 'a PTA member' -> 'Pta Member'."""
    r = F.regexp_replace(F.lower(strip(role)), f"\\A(a|an){WS}+", "")
    words = F.filter(F.split(r, f"{WS}+"), lambda t: t != F.lit(""))
    return F.when(~r.contains(" "), _cap_word(r)).otherwise(F.array_join(F.transform(words, _cap_word), " "))


def clean_event(event, rewrites=None) -> Column:
    """Literal phrase rewrites after strip."""
    x = strip(event)
    for a, b in (rewrites if rewrites is not None else V.EVENT_REWRITES):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def any_prefix_regex(prefixes) -> str:
    """One anchored alternation of literal prefixes (\\Q..\\E quoted)."""
    return "\\A(?:" + "|".join(f"\\Q{p}\\E" for p in prefixes) + ")"


def any_substring_regex(keywords) -> str:
    return "(?:" + "|".join(f"\\Q{k}\\E" for k in keywords) + ")"


def starts_with_any(x: Column, prefixes) -> Column:
    return x.rlike(any_prefix_regex(prefixes))


def contains_any(x: Column, keywords) -> Column:
    return x.rlike(any_substring_regex(keywords))


def _loc_prefix(pl: Column, in_kw=None, on_kw=None, starts=None) -> Column:
    return (F.when(starts_with_any(pl, starts or V.PROMPT_PREP_STARTS), F.lit(""))
            .when(contains_any(pl, in_kw or V.IN_KEYWORDS), F.lit("in "))
            .when(contains_any(pl, on_kw or V.ON_KEYWORDS), F.lit("on "))
            .otherwise(F.lit("at ")))


def loc_phrase(place, in_kw=None, on_kw=None, starts=None) -> Column:
    """Place -> prepositional phrase (Column form; see ``add_loc_phrase``)."""
    p = strip(place)
    return F.concat(_loc_prefix(F.lower(p), in_kw, on_kw, starts), p)


def participle_regex(words=None) -> str:
    return "\\A(?:[a-z]+ing|" + "|".join(words or V.PARTICIPLES) + f")(?!{WORD})"


def _backdrop_prefix(pl: Column) -> Column:
    return (F.when(starts_with_any(pl, V.CAPTION_CONNECTORS), F.lit(""))
            .when(pl.rlike(participle_regex()), F.lit("while "))
            .otherwise(_loc_prefix(pl)))


def caption_backdrop(raw) -> Column:
    """Backdrop phrase for captions (Column form; see ``add_caption_backdrop``)."""
    p = strip(raw)
    return F.concat(_backdrop_prefix(F.lower(p)), p)


# DataFrame-level forms: the stripped / lower-cased value is computed once as
# its own column, so the keyword regexes read an attribute instead of
# re-running the strip for every test.

def add_loc_phrase(df, src: str, out: str):
    d = df.withColumn("_p", strip(F.col(src))).withColumn("_pl", F.lower(F.col("_p")))
    return d.withColumn(out, F.concat(_loc_prefix(F.col("_pl")), F.col("_p"))).drop("_p", "_pl")


def add_caption_backdrop(df, src: str, out: str):
    d = df.withColumn("_p", strip(F.col(src))).withColumn("_pl", F.lower(F.col("_p")))
    return d.withColumn(out, F.concat(_backdrop_prefix(F.col("_pl")), F.col("_p"))).drop("_p", "_pl")


def add_headline_tidy(df, src: str, out: str, preps=None):
    d = df.withColumn(out, tidy_prep(tidy_punct(collapse_ws(F.col(src))), preps))
    return d.withColumn(out, tidy_terminal(tidy_capital(F.col(out))))


def add_role_to_subject(df, src: str, out: str):
    d = df.withColumn("_r", F.regexp_replace(F.lower(strip(F.col(src))), f"\\A(a|an){WS}+", ""))
    r = F.col("_r")
    words = F.filter(F.split(r, f"{WS}+"), lambda t: t != F.lit(""))
    return d.withColumn(out, F.when(~r.contains(" "), _cap_word(r))
                        .otherwise(F.array_join(F.transform(words, _cap_word), " "))).drop("_r")


def parse_template(t: str) -> list[tuple[bool, str]]:
    """'{D}: {S}' -> [(True,'D'), (False,': '), (True,'S')]."""
    out, i = [], 0
    while i < len(t):
        if t[i] == "{":
            j = t.index("}", i)
            out.append((True, t[i + 1:j]))
            i = j + 1
        else:
            j = t.find("{", i)
            j = len(t) if j < 0 else j
            out.append((False, t[i:j]))
            i = j
    return out


def render_pattern(k: Column, slots: dict[str, Column], patterns=None) -> Column:
    """Fill template number ``k`` (0-based) with slot columns, then strip."""
    pats = patterns or V.PATTERNS
    expr = None
    for i, t in enumerate(pats):
        parts = [slots[name] if is_slot else F.lit(name) for is_slot, name in parse_template(t)]
        filled = F.concat(*parts)
        expr = F.when(k == i, filled) if expr is None else expr.when(k == i, filled)
    return strip(expr)


def strip_terminal_punct(s) -> Column:
    return F.regexp_replace(_c(s), f"[.!?]{WS}*\\z", "")


def index_range(start: Column, end: Column) -> Column:
    """Python ``list(range(start, end))`` as array<int>."""
    return F.when(end > start, F.sequence(start.cast("int"), (end - 1).cast("int"))).otherwise(empty_int_array())


def ints_to_str(arr) -> Column:
    """array<int> -> '1,2,3' (for order-free comparison with SQL)."""
    return F.array_join(F.transform(_c(arr), lambda x: x.cast("string")), ",")
