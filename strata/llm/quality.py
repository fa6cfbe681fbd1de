"""Quality rules: line-first cleaning.

Every line of a text is judged by three families of rules:

* punctuation: a line of three words or more carries no sentence end, or its
  words are decorated with symbols or doubled exclamation marks;
* navigation: words separated by menu separators;
* boilerplate: a stock phrase of web pages, or a licence notice.

Failing lines are removed. A document that loses more than ``max_lost`` of its
characters (line ends not counted), or that fails the whole-text base rules,
is rejected. Lines without a word are dropped silently and count as nothing.

Everything is a per-row expression: one scan, no shuffle, nothing that grows
with a group; a text of any length is judged whole. The stock phrases are those
of four languages (English, French, German, Spanish), sentence ends those of the
Latin, Greek, Cyrillic, Chinese, Japanese, Devanagari and Arabic scripts; in
other languages only a stock phrase of these four fails a line. Defined results: a null text is an empty text (no words, so the
base rules reject it); repeated rows and ties are judged row by row; an empty
table gives an empty result; extra columns are kept, and an added column that
would clash with one gets a numeric suffix.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WORD, free_name, let, quoted, words

SYMBOLS = r"[#*$%&|<>]"
#: FIXED VALUES: stock phrases of page furniture, in lower case: English, French,
#: German, Spanish.
BOILERPLATE = (
    "accept cookies",
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "licensed under",
    "lorem ipsum",
    "privacy policy",
    "released under the",
    "sign in to",
    "subscribe to",
    "terms of use",
    "accepter les cookies",
    "tous droits réservés",
    "cliquez ici",
    "politique de confidentialité",
    "mentions légales",
    "conditions d'utilisation",
    "inscrivez-vous à",
    "cookies akzeptieren",
    "alle rechte vorbehalten",
    "hier klicken",
    "datenschutzerklärung",
    "nutzungsbedingungen",
    "newsletter abonnieren",
    "javascript aktivieren",
    "aceptar cookies",
    "todos los derechos reservados",
    "haga clic aquí",
    "política de privacidad",
    "términos de uso",
    "suscríbete a",
    "iniciar sesión",
)
#: FIXED VALUES: a sentence end, perhaps followed by closing marks; ends of
#: scripts that put no space behind them (Chinese, Japanese, Hindi, Arabic, Urdu).
SENTENCE_END = r"[.!?:;\x{2026}][\"')\]\x{201D}\x{00BB}]*(\z|[\x20\x09-\x0D])|[\x{3002}\x{FF0E}\x{FF01}\x{FF1F}\x{0964}\x{0965}\x{061F}\x{06D4}]"
#: FIXED VALUES: a word that is a menu separator.
SEPARATOR = r"(^|[\x20\x09-\x0D])([|/>\x{00BB}\x{00B7}\x{2022}]|::)(\z|[\x20\x09-\x0D])"
#: FIXED VALUES: a word that ends in symbols or in a row of exclamation marks.
DECORATED = r"([#*$%&|<>]|!!)(\z|[\x20\x09-\x0D])"
MAX_MARKED = 0.3
MAX_LOST = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_fails(line: Column) -> Column:
    """True if one of the line rules fails."""
    n = F.regexp_count(line, F.lit(WORD))
    low = F.translate(line, UPPER, LOWER)
    no_end = ~line.rlike(SENTENCE_END) & (n >= 3)
    decorated = F.regexp_count(line, F.lit(DECORATED)) > MAX_MARKED * n
    menu = (F.regexp_count(line, F.lit(SEPARATOR)) >= 2) & (F.regexp_count(line, F.lit(SEPARATOR)) > 0.15 * n)
    # Plain searches cost far less than a pattern of many alternatives.
    stock = let(low, lambda t: reduce(or_, [t.contains(x) for x in BOILERPLATE]))
    return no_end | decorated | menu | stock


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))


def repeated_words(ws: Column, width: int = 5) -> Column:
    """Words that lie in a ``width``-word window found twice or more."""

    def covered(starts: Column) -> Column:
        # A start covers up to the next one, at most a window's width.
        return F.aggregate(
            F.transform(starts, lambda p, i: F.least(F.lit(width), F.coalesce(F.get(starts, i + 1) - p, F.lit(width)))),
            F.lit(0).cast("long"),
            lambda a, x: a + x,
        )

    def repeats(windows: Column) -> Column:
        def starts(s: Column) -> Column:
            same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
            marked = F.transform(s, lambda x, i: F.when(same(F.get(s, i - 1), x) | same(F.get(s, i + 1), x), x["i"]))
            return F.sort_array(F.filter(marked, lambda p: p.isNotNull()))

        by_hash = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(
            let(let(by_hash, starts), covered)
        )

    windows = F.transform(
        F.sequence(F.lit(0), F.size(ws) - width), lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(width)])
    )
    return F.when(F.size(ws) < width, F.lit(0).cast("long")).otherwise(let(windows, repeats))


def measure(text: Column) -> Column:
    """One struct of everything the verdict needs."""

    def of(t: Column) -> Column:
        def with_words(ws: Column) -> Column:
            return F.struct(
                F.size(ws).cast("long").alias("n_words"),
                F.aggregate(ws, F.lit(0).cast("long"), lambda a, w: a + F.char_length(w)).alias("word_chars"),
                repeated_words(ws).alias("n_repeat_words"),
            )

        def with_lines(ls: Column) -> Column:
            good = F.filter(ls, lambda x: ~line_fails(x))
            return let(
                good,
                lambda g: F.struct(
                    (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
                    F.size(ls).cast("long").alias("n_lines"),
                    (F.size(ls) - F.size(g)).cast("long").alias("n_failed_lines"),
                    F.char_length(F.array_join(ls, "")).cast("long").alias("line_chars"),
                    F.char_length(F.array_join(g, "")).cast("long").alias("kept_chars"),
                    F.array_join(g, "\n").alias("cleaned"),
                ),
            )

        return F.struct(
            let(words(t), with_words).alias("w"),
            let(lines_with_words(t), with_lines).alias("l"),
            (F.char_length(t) - F.char_length(F.regexp_replace(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        )

    return let(F.coalesce(text, F.lit("")), of)


COLUMNS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_failed_lines",
    "chars_lost", "base_failed", "kept", "cleaned",
)


def clean_lines(docs: DataFrame, text: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """``docs`` with the measures, ``cleaned`` (the text without its failing
    lines) and the verdict ``kept``."""
    m = free_name(docs, "measured")
    name = {c: free_name(docs, c) for c in COLUMNS}
    out = docs.withColumn(m, measure(quoted(text)))
    w, ln = F.col(f"`{m}`.w"), F.col(f"`{m}`.l")
    base = (w["n_words"] < 10) | (100 * w["n_repeat_words"] > 20 * w["n_words"])
    lost = ln["line_chars"] - ln["kept_chars"]
    made = {
        "n_words": w["n_words"],
        "word_chars": w["word_chars"],
        "n_symbols": F.col(f"`{m}`.n_symbols"),
        "n_dup_lines": ln["n_dup_lines"],
        "n_repeat_words": w["n_repeat_words"],
        "n_lines": ln["n_lines"],
        "n_failed_lines": ln["n_failed_lines"],
        "chars_lost": lost,
        "base_failed": base,
        "kept": ~base & (lost <= max_lost * ln["line_chars"]),
        "cleaned": ln["cleaned"],
    }
    return out.select(*[quoted(c) for c in docs.columns], *[made[c].alias(name[c]) for c in COLUMNS])
