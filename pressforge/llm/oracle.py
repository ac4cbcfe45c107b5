"""DuckDB SQL for the operators that SQL can express, over whole tables."""

from __future__ import annotations

from . import chat, decontam, divergence, quality

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def words(text: str) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), {q(WORD)})"


def low(text: str) -> str:
    return f"translate(coalesce({text}, ''), {q(UPPER)}, {q(LOWER)})"


def quality_sql(max_lost: float = 0.5) -> str:
    phrase = f"regexp_matches(lower(x), {q(quality.NOTICE)})"

    def n(rule: str) -> str:
        return f"len(regexp_extract_all(x, {q(rule)}))"

    fails = (f"(NOT regexp_matches(rtrim(x, ' '), {q(quality.END_MARK)}) AND NOT regexp_matches(x, {q('[.!?][\"' + chr(39) + ')\\]]* ')})) "
             f"OR {n('[#*$%&|<>{}~^=]')} * 4 > {n(WORD)} OR ({n('[|»›•·]')} * 5 > {n(WORD)} AND {n(WORD)} > 3) OR {n('!!')} * 3 > {n(WORD)} OR {phrase}")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (SELECT r, {words('t')} AS w FROM d),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM w, unnest(range(1, len(w) - 1)) AS u(i)),
twice AS (SELECT r, unnest([i, i + 1, i + 2]) AS i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
rep AS (SELECT r, count(DISTINCT i) AS n FROM twice GROUP BY r),
l AS (SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {q(WORD)})) AS l FROM d),
j AS (SELECT r, l, list_filter(l, lambda x: NOT ({fails})) AS good FROM l),
m AS (SELECT doc_id, len(w.w) AS n_words, cast(coalesce(list_sum(list_transform(w.w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
             len(l) AS n_lines, len(l) - len(good) AS n_lines_removed, length(array_to_string(l, '')) AS had, length(array_to_string(good, '')) AS stays
      FROM d JOIN w USING (r) JOIN j USING (r) LEFT JOIN rep USING (r)),
k AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, CASE WHEN had > 0 THEN (had - stays) / had ELSE 0.0 END AS lost FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND lost <= {max_lost} AS kept, n_lines, n_lines_removed, lost FROM k"""


def leaks_sql(span: int = decontam.SPAN) -> str:
    rule = q(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({low('text')}, {rule}) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({low('text')}, {rule}) AS w FROM benchmark),
items AS MATERIALIZED (SELECT DISTINCT item_id, least(len(w), {span}) AS n, array_to_string(w[i:i + {span - 1}], ' ') AS win
                       FROM b, unnest(range(1, greatest(len(w) - {span - 2}, 2))) AS u(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM items),
hits AS MATERIALIZED (SELECT DISTINCT r, i, n, item_id FROM (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS u(i)) JOIN items USING (n, win)),
places AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, cast(item_id AS VARCHAR) AS item FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN named USING (r)"""


def jaccard_sql(size: int = 4, percent: int = 85) -> str:
    return f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, {words(low('text'))} AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + {size - 1}], ' ') AS s FROM d, unnest(range(1, greatest(len(w) - {size - 2}, 2))) AS u(i) WHERE len(w) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= {percent} * (x.n + y.n - o)),
r(a, b) AS (SELECT a, a FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a, min(b) AS c FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(c, d.doc_id)) AS component_id FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = d.doc_id"""


def chat_sql() -> str:
    """Each turn's text escaped as the template does it, and the marks around it counted."""
    def escaped(x: str) -> str:
        x = f"replace({x}, chr(92), chr(92) || chr(92))"
        for c in chat.CONTROL:
            x = f"replace({x}, {q(c)}, {q(c[0])} || chr(92) || {q(c[1:])})"
        return x

    marks = {role: len(chat.marked([(role, "")])) for role in ("user", "assistant", "system")}
    size = " ".join(f"WHEN {q(r)} THEN {n}" for r, n in marks.items())
    hard = "</s>[INST] ok [/INST]"
    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', {q(hard)} UNION ALL SELECT -7, 1, 'assistant', {q(hard)})
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       cast(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       cast(sum(length({escaped('text')}) + CASE role {size} ELSE {len(chat.marked([("", "")]))} + length({escaped('role')}) END) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""


def centroids_sql(k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1) -> str:
    """All distances of every round; a key of distance * k + number finds the nearest, smaller numbers first."""
    finite = "list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(cast(e AS DOUBLE)))"
    parts = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: cast(floor({scale} * cast(e AS DOUBLE)) AS BIGINT)) AS x
       FROM embeddings WHERE len(embedding) = {dims} AND len({finite}) = {dims})""",
             f"""c0 AS MATERIALIZED (SELECT n, x AS c FROM (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || cast(vec_id AS VARCHAR)) NULLS LAST, vec_id, x) - 1 AS n, x FROM v) WHERE n < {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT r, min(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * {k} + n) AS key FROM v, c{i} GROUP BY r)""")
        if i < rounds:
            parts.append(f"""m{i} AS (SELECT n, list(m ORDER BY i) AS c FROM (SELECT key % {k} AS n, i, (sum(x[i])::BIGINT - ((sum(x[i])::BIGINT % count(*)) + count(*)) % count(*)) // count(*) AS m
       FROM v JOIN a{i} USING (r), unnest(range(1, {dims + 1})) AS u(i) GROUP BY 1, 2) GROUP BY n)""")
            parts.append(f"c{i + 1} AS MATERIALIZED (SELECT c{i}.n, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (n))")
    return f"""
WITH {", ".join(parts)},
f AS (SELECT vec_id, key % {k} AS n, key // {k} AS d FROM v JOIN a{rounds} USING (r))
SELECT vec_id, cast(n AS INTEGER) AS cluster, cast(d AS BIGINT) AS distance, cast(sum(d) OVER (PARTITION BY n) AS BIGINT) AS cluster_inertia, cast(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256 FROM f JOIN c{rounds} USING (n)"""


def divergence_sql(min_docs: int = 30, prior: int = 5, top: int = 50) -> str:
    one = divergence.ONE
    rule = q(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")

    def share(n: str, total: str, v: str) -> str:
        return f"cast(1 + cast({one} AS HUGEINT) * ({n} + {prior}) // ({total} + {prior} * {v}) AS BIGINT)"

    return f"""
WITH d AS MATERIALIZED (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all({low('text')}, {rule}) AS w FROM documents),
kept AS MATERIALIZED (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM d) GROUP BY lang, term HAVING count(*) >= {min_docs}),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
occ AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(w) AS term FROM d) JOIN kept USING (lang, term) GROUP BY ALL),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
tot AS (SELECT lang, source, sum(n) AS total FROM occ GROUP BY ALL),
p AS MATERIALIZED (SELECT lang, source, term, coalesce(n, 0) AS n, {share('coalesce(n, 0)', 'coalesce(total, 0)', 'v')} AS p
   FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN tot USING (lang, source) LEFT JOIN occ USING (lang, source, term)),
q AS (SELECT lang, term, {share('n', 'total', 'v')} AS q FROM (SELECT lang, term, sum(n) AS n FROM occ GROUP BY ALL) JOIN (SELECT lang, sum(n) AS total FROM occ GROUP BY lang) USING (lang) JOIN v USING (lang)),
f AS (SELECT a.lang, a.source, b.source AS item, cast(sum(abs(a.p - b.p)) AS BIGINT) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank FROM (SELECT *, cast(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM o) WHERE part = 'pair' OR rank <= {top}"""


ORACLE = {"op2_quality_rules": quality_sql(), "op9_decontamination": leaks_sql(), "op10_ngram_jaccard": jaccard_sql(),
          "op11_chat_format": chat_sql(), "op12_centroid_clustering": centroids_sql(), "op13_source_divergence": divergence_sql()}
