"""Line-first quality rules: judge each line, remove the failing ones, then judge the document.

Everything is a column expression over one text, so the rules run inside the scan: no shuffle,
no Python.  A document costs O(words log words) for its own arrays only.

Defined results
    null or empty text       no word, every count 0, ``base_failed`` (too few words)
    very long text           whole text; arrays of one entry per word, in the row's own task
    ties, repeated rows      each row is judged by itself
    empty table              empty result
    extra columns            ``judge`` returns only the id and its own columns
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from snapflow.llm.common import DOC_ID, let, narrow, without, words_of

SYMBOLS = "#*$%&|<>"

# fixed values: phrases of page furniture in the corpus's four languages (compared in lower case)
BOILERPLATE = (
    "all rights reserved", "privacy policy", "terms of service", "terms of use", "cookie policy",
    "we use cookies", "accept cookies", "javascript is disabled", "enable javascript", "sign in",
    "log in", "subscribe to our newsletter", "click here", "read more", "share this",
    "licensed under", "copyright (c)", "lorem ipsum",
    "alle rechte vorbehalten", "wir verwenden cookies", "cookies akzeptieren", "hier klicken", "mehr lesen",
    "newsletter abonnieren", "allgemeine nutzungsbedingungen",
    "tous droits réservés", "politique de confidentialité", "conditions d'utilisation", "nous utilisons des cookies",
    "accepter les cookies", "cliquez ici", "lire la suite",
    "todos los derechos reservados", "política de privacidad", "condiciones de uso", "utilizamos cookies",
    "aceptar cookies", "haga clic aquí", "leer más", "iniciar sesión",
)
_IN_WORD = r"[\p{L}\p{M}\p{N}]"
#: A phrase as whole words: no letter or digit goes on at an end that is a letter.
WHOLE_PHRASE = "|".join(rf"(?<!{_IN_WORD})\Q{p}\E" + (rf"(?!{_IN_WORD})" if p[-1].isalnum() else "") for p in BOILERPLATE)
# fixed values: marks that close a sentence or a quotation
TERMINAL = ".!?…。！？\"'”’»)"


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules.

    min_words, max_repeat_pct, window   document base rules: fewest words, share of words inside
                                        repeated word windows, words of a window
    min_open_words                      a line without a closing mark stands if it has this many words
                                        and a sentence end inside
    max_symbol_pct                      navigation: 100 * symbols / words of a line
    max_shout_pct                       boilerplate: 100 * words with ``!!`` / words of a line
    min_kept_pct                        word characters that must survive, of those of the document
    max_phrase_pct                      boilerplate: phrases count as whole words only; any of them fails a
                                        line of less than min_words, a longer one 100 * words of phrases / words
    """

    min_words: int = 20
    max_repeat_pct: int = 30
    window: int = 8
    min_open_words: int = 10
    max_symbol_pct: int = 30
    max_shout_pct: int = 30
    min_kept_pct: int = 50
    max_phrase_pct: int = 30


def count_of(text: Column, chars: str) -> Column:
    """Characters of ``text`` that are in ``chars`` (ASCII)."""
    return F.octet_length(text) - F.octet_length(without(text, chars))


def word_chars(words: Column) -> Column:
    return F.char_length(F.array_join(words, "")).cast("long")


def repeated_words(words: Column, window: int) -> Column:
    """Words inside a ``window``-word window that is found twice or more in the array.

    Windows are compared by a 64-bit hash of the row's own words.  Texts whose windows all differ
    (nearly all) stop after one hash set; others sort (hash, position) and walk the positions.
    """
    def windows(h: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(h) - window),
            lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(window)]))

    def covered(starts: Column) -> Column:
        zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).alias("last"))
        return F.aggregate(
            starts, zero,
            lambda a, p: F.struct((a["n"] + F.least(F.lit(window), p - a["last"])).cast("long").alias("n"),
                                  p.alias("last")),
            lambda a: a["n"])

    def repeats(win: Column) -> Column:
        pairs = F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = let(pairs, lambda s: F.transform(
            F.filter(s, lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])),
            lambda x: x["i"]))
        return covered(F.sort_array(starts))

    zero = F.lit(0).cast("long")
    found = let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(
        windows(h), lambda win: F.when(F.size(F.array_distinct(win)) == F.size(win), zero)
        .otherwise(repeats(win))))
    return F.when(F.size(words) < window, zero).otherwise(found)


def split_lines(text: Column) -> Column:
    """Lines of a text with their words."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"),
                       lambda ln: F.struct(ln.alias("line"), words_of(ln).alias("words")))


def duplicate_lines(lines: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(F.transform(F.filter(lines, lambda x: F.size(x["words"]) > 0), lambda x: x["line"]),
               lambda a: (F.size(a) - F.size(F.array_distinct(a))).cast("long"))


def line_passes(line: Column, words: Column, rules: LineRules) -> Column:
    """The three rules on one line; 100 * a > p * b keeps them in whole numbers.

    punctuation   its last word ends in a closing mark, or it is long and another word ends a sentence
    navigation    few symbols a word (menus, tables and symbol noise have many)
    boilerplate   no phrase of page furniture, or few for the line's length, and few words that shout ``!!``
    """
    n = F.size(words)

    def closes(word: Column) -> Column:
        return F.contains(F.lit(TERMINAL), F.right(word, F.lit(1)))

    punctuated = closes(F.element_at(words, -1)) | (
        (n >= rules.min_open_words) & F.exists(words, lambda w: F.contains(F.lit(".!?…"), F.right(w, F.lit(1)))))
    navigation = 100 * count_of(line, SYMBOLS) > rules.max_symbol_pct * n
    shouted = F.contains(line, F.lit("!!")) & (
        100 * F.size(F.filter(words, lambda w: F.contains(w, F.lit("!!")))) > rules.max_shout_pct * n)

    def furniture(low: Column) -> Column:
        found = F.lit(False)
        for phrase in BOILERPLATE:
            found = found | F.contains(low, F.lit(phrase))
        phrase_words = F.aggregate(F.regexp_extract_all(low, F.lit(f"({WHOLE_PHRASE})"), F.lit(1)), F.lit(0),
                                   lambda a, hit: a + F.size(F.split(hit, " ")))
        return found & let(phrase_words, lambda k: (k > 0) & ((n < rules.min_words) | (100 * k > rules.max_phrase_pct * n)))

    return (n > 0) & punctuated & ~navigation & ~shouted & ~let(F.lower(line), furniture)


def clean_lines(lines: Column, rules: LineRules) -> Column:
    """The lines that pass, in order, with their words; blank lines go too."""
    return F.filter(lines, lambda x: line_passes(x["line"], x["words"], rules))


def judgement(text: Column, rules: LineRules = LineRules()) -> Column:
    """All counts and verdicts of a text as one struct."""
    t = F.coalesce(text, F.lit(""))

    def build(lines: Column) -> Column:
        words = F.flatten(F.transform(lines, lambda x: x["words"]))
        return let(let(words, lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            word_chars(w).alias("word_chars"),
            count_of(t, SYMBOLS).cast("long").alias("n_symbols"),
            duplicate_lines(lines).alias("n_dup_lines"),
            repeated_words(w, rules.window).alias("n_repeat_words"),
            F.aggregate(clean_lines(lines, rules), F.lit(0).cast("long"),
                        lambda a, x: a + word_chars(x["words"])).alias("kept_chars"))), verdict)

    def verdict(m: Column) -> Column:
        failed = (m["n_words"] < rules.min_words) | (
            100 * m["n_repeat_words"] > rules.max_repeat_pct * m["n_words"])
        enough = 100 * m["kept_chars"] >= rules.min_kept_pct * m["word_chars"]
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        return F.struct(*[m[n].alias(n) for n in names], failed.alias("base_failed"),
                        (~failed & enough).alias("kept"), m["kept_chars"].alias("kept_chars"))

    return let(split_lines(t), build)


def judge(docs: DataFrame, rules: LineRules = LineRules(), id_col: str = DOC_ID,
          text_col: str = "text") -> DataFrame:
    """One row per document: counts, ``base_failed``, ``kept`` and the characters that survive."""
    d = narrow(docs, id_col, text_col)
    return d.select(DOC_ID, judgement(F.col("text"), rules).alias("j")).select(DOC_ID, "j.*")


def keep_clean(docs: DataFrame, rules: LineRules = LineRules(), text_col: str = "text") -> DataFrame:
    """The documents that the rules keep, without their failing lines; other columns as they came."""
    return docs.withColumn("__kept", kept_text(docs[text_col], rules)).filter("__kept is not null").select(
        *[(F.col("__kept") if c == text_col else docs[c]).alias(c) for c in docs.columns])


def kept_text(text: Column, rules: LineRules = LineRules()) -> Column:
    """The text without its failing lines, blank lines stay; null: the document is rejected.  Every
    line is split and judged once."""
    def verdict(lines: Column) -> Column:
        def decide(w: Column) -> Column:
            n = F.size(w)

            def cut(left: Column) -> Column:
                kept_chars = F.aggregate(left, F.lit(0).cast("long"), lambda a, x: a + word_chars(x["words"]))
                enough = 100 * kept_chars >= rules.min_kept_pct * word_chars(w)
                return F.when(enough, F.array_join(F.transform(left, lambda x: x["line"]), "\n"))

            failed = (n < rules.min_words) | (100 * repeated_words(w, rules.window) > rules.max_repeat_pct * n)
            return F.when(~failed, let(F.filter(lines, lambda x: (F.size(x["words"]) == 0) | line_passes(x["line"], x["words"], rules)), cut))
        return let(F.flatten(F.transform(lines, lambda x: x["words"])), decide)

    return let(split_lines(text), verdict)
