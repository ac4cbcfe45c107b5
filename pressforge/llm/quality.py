"""Line-first cleaning with native columns.

Every line is judged on its own: punctuation (it ends in a closing mark or holds
a whole sentence, and is not littered with symbols or doubled exclamation marks), navigation (a row of
menu entries) and boilerplate (licence, cookie and subscription notices). Lines
that fail are removed, and a document that loses more than ``max_lost`` of its
characters to that is rejected.

Edge cases: a null text counts as empty: no words, base_failed, not kept, and a
clean text of "". Repeated rows give one result each. Columns other than doc_id
and text are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, let

POS_BITS = 24  # words of a text that have a position of their own: 16 million
#: Notices, as whole words in a lower-cased line; a single word that prose uses too is none.
BOILERPLATE = ["licensed under", "all rights reserved", "copyright", "cookie policy", "cookie settings", "use cookies", "uses cookies", "accept cookies",
               "accept all cookies", "privacy policy", "terms of use", "terms of service", "enable javascript", "javascript is", "lorem ipsum",
               "subscribe to our", "subscribe now", "sign up for", "sign up now", "log in to", "log in or", "please log in", "click here", "read more",
               "todos los derechos reservados", "política de privacidad", "términos de uso", "utiliza cookies", "haga clic aquí", "leer más", "iniciar sesión",
               "alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen", "verwendet cookies", "klicken sie hier", "mehr lesen", "jetzt anmelden",
               "tous droits réservés", "politique de confidentialité", "conditions d'utilisation", "utilise des cookies", "cliquez ici", "lire la suite", "se connecter"]
NOTICE = rf"(?:^|[^\p{{L}}\p{{N}}])(?:{'|'.join(BOILERPLATE)})(?:$|[^\p{{L}}\p{{N}}])"
END_MARK = r"[.!?…:;。！？][\"')\]’”»]*$"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"{WS}+"), lambda w: w != "")


def repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more."""
    low = (1 << POS_BITS) - 1

    def covered(w: Column, g: Column) -> Column:
        # hash bits above, position below: equal windows become neighbours
        packed = F.sort_array(F.transform(g, lambda x, i: x.bitwiseAND(~low).bitwiseOR(i.cast("long"))))

        def at(s: Column) -> Column:
            def same(x: Column, y: Column) -> Column:
                return (F.shiftright(x, POS_BITS) == F.shiftright(y, POS_BITS)) & (
                    F.get(g, x.bitwiseAND(low).cast("int")) == F.get(g, y.bitwiseAND(low).cast("int")))

            twice = F.transform(s, lambda x, i: F.when(same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1)), x.bitwiseAND(low)))
            starts = F.filter(twice, lambda p: p.isNotNull())
            return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda p: F.array(p, p + 1, p + 2)))))

        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(let(packed, at))

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(let(windows(words), lambda g: covered(words, g)))


def line_fails(line: Column, notices: Column) -> Column:
    """Does a line with a word fail? ``notices``: its document has a boilerplate phrase somewhere."""
    n = F.size(words_of(line))
    symbols = F.regexp_count(line, F.lit(r"[#*$%&|<>{}~^=]"))
    # a line that holds whole sentences may break off; one without any must end with a mark
    no_end = ~F.rtrim(line).rlike(END_MARK) & ~line.rlike(r"[.!?][\"')\]]* ")
    navigation = (F.regexp_count(line, F.lit(r"[|»›•·]")) * 5 > n) & (n > 3)
    shouting = F.regexp_count(line, F.lit("!!")) * 3 > n
    phrase = F.lower(line).rlike(NOTICE)
    return no_end | (symbols * 4 > n) | navigation | shouting | (notices & phrase)


def clean(docs: DataFrame, max_lost: float = 0.5) -> DataFrame:
    """doc_id, the base counts, kept, n_lines, n_lines_removed, lost (share of characters) and clean_text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # lower-cased once: few texts hold any of the phrases, and only their lines are searched for whole words
    notices = let(F.lower(text), lambda t: reduce(lambda x, y: x | y, [t.contains(p) for p in BOILERPLATE]))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    judged = let(F.struct(lines.alias("all"), notices.alias("notices")), lambda s: F.struct(
        s["all"].alias("all"), F.filter(s["all"], lambda x: ~line_fails(x, s["notices"])).alias("good")))

    def measures(j: Column) -> Column:
        had, left = F.length(F.array_join(j["all"], "")), F.length(F.array_join(j["good"], ""))
        return F.struct(
            F.size(j["all"]).cast("long").alias("n_lines"),
            (F.size(j["all"]) - F.size(j["good"])).cast("long").alias("n_lines_removed"),
            (F.size(j["all"]) - F.size(F.array_distinct(j["all"]))).cast("long").alias("n_dup_lines"),
            F.when(had > 0, (had - left) / had).otherwise(F.lit(0.0)).alias("lost"),
            F.array_join(j["good"], "\n").alias("clean_text"))

    counted = let(words_of(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeat_words(w).cast("long").alias("n_repeat_words")))
    failed = (F.col("w.n_words") < 50) | (100 * F.col("w.n_repeat_words") > 50 * F.col("w.n_words"))
    return (docs.select("doc_id", F.length(F.regexp_replace(text, f"{WS}+", "")).cast("long").alias("word_chars"),
                        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
                        counted.alias("w"), let(judged, measures).alias("l"))
            .select("doc_id", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", failed.alias("base_failed"),
                    (~failed & (F.col("l.lost") <= max_lost)).alias("kept"), "l.n_lines", "l.n_lines_removed", "l.lost", "l.clean_text"))
