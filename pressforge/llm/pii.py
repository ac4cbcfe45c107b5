"""Personal data: fixed formats, and bootstrapped contextual extraction, with native columns.

Formats give the base spans (e-mail, IP address, card and phone number). They are
also the seeds of a bootstrap. Every token with a digit or an @ is an instance;
the words around it are its patterns ("two words before", "one word before and
one after", each with the token's shape). Instances and patterns form a bipartite
graph, over which scores go back and forth for a few rounds: a pattern is worth
the mean score of its distinct instances, lowered when they are few, and needs
``support`` of them that are seeds or, after the first round, well scored; an
instance is worth 1 if a seed, else the noisy-or of its good patterns. Tokens in
patterns of at least ``threshold`` are reported as kind ``id``.

Edge cases: a null text counts as empty: no spans, and the hash of "". Repeated
rows give one result each and their tokens count as instances once. Spans of
different kinds may overlap; ``redact`` merges those that do. Columns other than
doc_id and text are not looked at; ``redact`` passes them on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressforge.session import cut_lineage

from .common import let, row_key

KINDS = ["email", "ip", "card", "phone", "id"]
LOCAL = "[A-Za-z0-9._%+-]"
# Written so that a search never goes back over what it has read: a match can start only where a
# run of its characters starts or the last match ended, and runs are possessive.
EMAIL = rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
# digit groups with a space between them are one token, up to a group that a comma or the like ends;
# an IP address is a token of its own
GROUP = r"[+(]*+[0-9][0-9()./-]*+"
GROUPED = rf"(?<![^\x20\x09-\x0D]){GROUP}(?:\x20(?![0-9]++\.[0-9]++\.[0-9]++\.[0-9]){GROUP}(?![^\x20\x09-\x0D,;:!?'\"]))++[^\x20\x09-\x0D]*+"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


BLOCK = 256


def running(lens: Column, body) -> Column:
    """Hands ``body`` a function i -> sum of lens[0..i], from sums of whole blocks and a rest, so
    that the work stays in proportion to the array."""
    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0), lambda x, y: x + y)

    blocks = F.sequence(F.lit(0), F.floor((F.size(lens) - 1) / BLOCK).cast("int"))
    sums = F.transform(blocks, lambda b: total(F.slice(lens, b * BLOCK + 1, F.lit(BLOCK))))
    before = let(sums, lambda s: F.transform(s, lambda _, b: total(F.slice(s, F.lit(1), b))))
    return let(before, lambda o: body(lambda i: F.get(o, F.floor(i / BLOCK).cast("int")) + total(
        F.slice(lens, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK + 1))))


def matches(text: Column, regex: str) -> Column:
    """start, end, m, before, after of each match, left to right; null where there is none. before and
    after: some of the text around, reaching into the neighbouring matches."""
    def placed(parts: Column) -> Column:
        def one(found: Column, m: Column, i: Column, end: Column) -> Column:
            before = F.concat(F.when(i > 0, F.concat(F.substring(F.get(parts, i - 1), F.lit(-40), F.lit(40)), F.get(found, i - 1))).otherwise(F.lit("")), F.get(parts, i))
            after = F.concat(F.substring(F.get(parts, i + 1), F.lit(1), F.lit(24)), F.coalesce(F.get(found, i + 1), F.lit("")))
            return F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("m"), F.substring(before, F.lit(-40), F.lit(40)).alias("before"),
                            F.substring(after, F.lit(1), F.lit(24)).alias("after"))

        def walk(found: Column) -> Column:
            lens = F.transform(found, lambda m, i: F.length(F.get(parts, i)) + F.length(m))
            return let(lens, lambda n: running(n, lambda end: F.transform(found, lambda m, i: one(found, m, i, end(i)))))

        return let(F.regexp_extract_all(text, F.lit(regex), F.lit(0)), walk)

    return F.when(text.rlike(regex), let(F.split(text, regex), placed))


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(d: Column) -> Column:
    def term(i: Column) -> Column:  # i: place from the right
        v = F.substring(d, F.length(d) - i, F.lit(1)).cast("int")
        twice = F.when(v > 4, 2 * v - 9).otherwise(2 * v)
        return F.when(i % 2 == 1, twice).otherwise(v)

    total = F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), lambda a, i: a + term(i))
    return total % 10 == 0


def base_spans(text: Column) -> Column:
    """Array of (start, kind number, end) of the fixed formats, sorted."""
    rules = [
        (EMAIL, text.contains("@"), lambda m: F.lit(True)),
        (IP, text.contains("."), lambda m: m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")),
        (CARD, text.rlike("[0-9](?:[\\x20-]?[0-9]){13}"), lambda m: let(digits(m), lambda d: F.length(d).between(14, 19) & luhn(d))),
        (PHONE, text.contains("+"), lambda m: F.length(digits(m)).between(10, 15)),
    ]
    def of_kind(found: Column, k: int, good) -> Column:
        return F.transform(F.filter(found, lambda s: good(s["m"])), lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end")))

    none = F.expr("cast(array() as array<struct<start: int, kind: int, end: int>>)")
    kinds = []
    for k, (regex, gate, good) in enumerate(rules):
        kinds.append(F.coalesce(of_kind(F.when(gate, matches(text, regex)), k, good), none))
    return F.sort_array(F.concat(*kinds))


def instances(text: Column, base: Column) -> Column:
    """Array of (start, end, token, seed, patterns) of the tokens with a digit or @."""
    def word(s: Column) -> Column:  # case and numbers are not part of a pattern
        return F.regexp_replace(F.lower(s), "[0-9]+", "0")

    def one(s: Column) -> Column:
        head = F.length(F.regexp_extract(s["m"], r"^[^\p{L}0-9+]*", 0))
        core = F.regexp_replace(F.regexp_replace(s["m"], r"^[^\p{L}0-9+]+", ""), r"[^\p{L}0-9]+$", "")
        start = s["start"] + head
        end = start + F.length(core)
        # a few characters around are enough for two words; a cut word still is a pattern
        before = F.split(F.rtrim(s["before"]), r"[\x20\x09-\x0D]+")
        after = F.split(F.ltrim(s["after"]), r"[\x20\x09-\x0D]+")
        shape = F.when(core.contains("@"), "@").otherwise(F.regexp_replace(F.regexp_replace(core, r"\p{L}+", "a"), "[0-9]+", "9"))
        n = F.size(before)
        last, prior = word(F.get(before, n - 1)), word(F.coalesce(F.get(before, n - 2), F.lit("")))
        patterns = F.array(F.concat_ws(" ", F.lit("2"), prior, last, shape), F.concat_ws(" ", F.lit("1"), last, shape, word(F.get(after, F.lit(0)))))
        # groups are context to each other
        patterns = F.when(core.contains(" "), F.concat(patterns, F.array(F.concat_ws(" ", F.lit("3"), shape)))).otherwise(patterns)
        seed = F.exists(base, lambda b: (b["start"] < end) & (b["end"] > start))
        return F.struct(start.alias("start"), end.alias("end"), core.alias("token"), seed.alias("seed"), patterns.alias("patterns"))

    found = F.transform(matches(text, f"{GROUPED}|{TOKEN}"), one)
    return F.filter(found, lambda x: x["token"].rlike("[0-9@]"))


def good_patterns(inst: DataFrame, rounds: int = 3, support: int = 5, threshold: float = 0.8) -> DataFrame:
    """inst: token, seed, patterns. Patterns and their scores, those of at least ``threshold``."""
    edges = cut_lineage(inst.select(F.xxhash64("token").alias("i"), "seed", F.explode("patterns").alias("p"))
                        .groupBy("p", "i").agg(F.max(F.col("seed").cast("int")).alias("seed")))
    scored = edges.withColumn("v", F.col("seed").cast("double"))
    for r in range(rounds):
        mass, n = F.sum("v"), F.count("*")
        patterns = (scored.groupBy("p").agg((mass / (n + 1)).alias("w"), F.sum((F.col("v") >= threshold).cast("int")).alias("sure"))
                    .filter((F.col("sure") >= support) & (F.col("w") >= threshold)).select("p", "w"))
        if r + 1 < rounds:
            worth = (edges.join(patterns, "p").groupBy("i").agg((1 - F.exp(F.sum(F.log(1 - F.least(F.col("w"), F.lit(0.999)))))).alias("x")))
            scored = (edges.join(worth, "i", "left").select("p", "i", "seed", F.greatest(F.col("seed").cast("double"), F.coalesce("x", F.lit(0.0))).alias("v")))
    return patterns


def spans(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """doc_id, k1, k2, base and all: sorted arrays of (start, kind number, end)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    read = (row_key(docs.select("doc_id", "text")).select("doc_id", "k1", "k2", let(base_spans(text), lambda b: F.struct(
        b.alias("base"), instances(text, b).alias("inst"))).alias("s")))
    read = cut_lineage(read.select("doc_id", "k1", "k2", "s.*"))
    each = read.select("k1", "k2", F.explode("inst").alias("x")).select("k1", "k2", "x.*")
    good = good_patterns(each, threshold=threshold)
    more = (each.filter(~F.col("seed")).select("k1", "k2", "start", "end", F.explode("patterns").alias("p")).join(good, "p", "left_semi")
            .groupBy("k1", "k2").agg(F.collect_set(F.struct("start", F.lit(KINDS.index("id")).alias("kind"), "end")).alias("more")))
    return (read.select("doc_id", "k1", "k2", "base").join(more, ["k1", "k2"], "left")
            .select("doc_id", "k1", "k2", "base", F.when(F.col("more").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "more"))).alias("all")))


def written(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, base_sha256, spans."""
    def count(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    counts = [count(k) for k in range(4)]
    return spans(docs).select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("all")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span replaced by its kind in brackets; a column n_chars follows the text."""
    text, columns = F.col("row.text"), docs.columns
    found = spans(docs).filter(F.size("all") > 0).select("k1", "k2", "all").distinct()
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        piece = F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(names, s["kind"]))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, F.concat(acc["out"], F.array(piece))).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))
    clean = F.aggregate("all", start, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text))))
    rows = row_key(docs.select(F.struct(*columns).alias("row"), "doc_id", "text")).select("row", "k1", "k2").join(found, ["k1", "k2"], "left")
    rows = rows.withColumn("new", F.when(F.col("all").isNull(), text).otherwise(clean))
    new = {"text": F.col("new"), "n_chars": F.length("new").cast("long")}
    return rows.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in columns])
