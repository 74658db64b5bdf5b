"""URL filter: rules first; other urls by the words of host and path.

Concatenated host names are split into words by a unigram Viterbi search (most probable split under
the word counts of all pages); a multinomial naive Bayes model scores host words and path words.
The urls that a rule judges are its training set; a prior list of words that advertise weighs as much
as it takes to outweigh what speaks for most ordinary urls of a held-out part.

Word counts, token counts and weights are tables that grow with the pages and are joined, never
collected.  Substrings of distinct host labels meet the word counts in a join; the search then runs
on the matches of one label at a time.

Defined results
    null url, no ``://``   host and path are empty; no rule fits; the class prior decides
    very long url          whole url; words of any length count, see ``split_labels``
    ties                   of equally long rules the first wins; equal class scores allow
    repeated rows          each judged; equal urls are scored once
    no url with a rule     the prior list alone decides
    empty table            empty result
    extra columns          only the named columns are read
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from snapflow.llm.common import materialize

# rule: (verdict, host, path)
Rule = tuple[str, str, str]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words that count as seen in blocked urls before any url is read.
ADVERTISING = ("adult", "ads", "bet", "bets", "casino", "cheap", "pills", "porn", "poker", "spam", "track", "xxx")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule (host and path) that fits, as ``struct<rule, verdict>``; none: null."""
    found = None
    for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found if found is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def words_in(text: Column) -> Column:
    """Lower-case letter runs of a text."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")


def word_counts(pages: DataFrame) -> DataFrame:
    """``word, n`` over the visible text and the url paths of all pages."""
    text = F.concat_ws(" ", F.regexp_replace(F.coalesce("html", F.lit("")), r"<[^>]*>", " "), path_of(F.col("url")))
    return (pages.select(F.explode(words_in(text)).alias("word")).groupBy("word").agg(F.count("*").alias("n")))


def best_split(label: str, edges: list, total: float) -> list[str]:
    """Most probable split of ``label``.  An edge (start, length, count) is a known word; a letter
    outside every word stands alone at less than a count of one."""
    n = len(label)
    by_end: list[list] = [[] for _ in range(n + 1)]
    for e in edges:
        by_end[e["i"] + e["len"]].append(e)
    alone = math.log(0.1 / max(total, 1.0))
    best, came = [0.0] + [-math.inf] * n, [0] * (n + 1)
    for end in range(1, n + 1):
        best[end], came[end] = best[end - 1] + alone, end - 1
        for e in by_end[end]:
            p = best[e["i"]] + math.log(e["n"] / total)
            if p > best[end] or (p == best[end] and e["i"] < came[end]):
                best[end], came[end] = p, e["i"]
    out, end = [], n
    while end:
        out.append(label[came[end]:end])
        end = came[end]
    return out[::-1]


def split_labels(labels: DataFrame, counts: DataFrame, short_word: int = 20) -> DataFrame:
    """``label, words`` of distinct host labels (letters only).  Spans of up to ``short_word`` letters
    meet the counts at every length, longer ones only at lengths that counted words have."""
    total = float(counts.agg(F.sum("n")).first()[0] or 0)
    longest = labels.agg(F.max(F.char_length("label"))).first()[0] or 0
    size = F.char_length("word")
    # at most as many lengths as the longest label has letters
    lengths = [r[0] for r in counts.filter((size > short_word) & (size <= longest)).select(size).distinct().orderBy(size).collect()]
    lengths = [*range(1, min(short_word, longest) + 1), *lengths]
    spans = (labels.select("label", F.explode(F.sequence(F.lit(0), F.char_length("label") - 1)).alias("i"))
             .select("label", "i", F.explode(F.filter(F.lit(lengths or [1]), lambda x: x <= F.char_length("label") - F.col("i"))).alias("len"))
             .withColumn("word", F.substring("label", F.col("i") + 1, F.col("len"))))
    edges = (spans.join(counts, "word").groupBy("label")
             .agg(F.sort_array(F.collect_list(F.struct("i", "len", "n"))).alias("edges")))

    @F.pandas_udf("array<string>")
    def viterbi(label: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([best_split(a, [] if b is None else list(b), total) for a, b in zip(label, found)], dtype=object)

    return labels.join(edges, "label", "left").select("label", viterbi("label", "edges").alias("words"))


def url_tokens(urls: DataFrame, counts: DataFrame) -> DataFrame:
    """``url, token``: words of host labels (``h:``) and path words (``p:``; digits count as ``#``)."""
    pieces = urls.select("url", F.explode(words_in(F.col("host"))).alias("label"))
    words = split_labels(pieces.select("label").distinct(), counts)
    host = pieces.join(words, "label").select("url", F.explode("words").alias("w")).select("url", F.concat(F.lit("h:"), "w").alias("token"))
    runs = F.filter(F.split(F.regexp_replace(F.lower("path"), r"\d+", "/#/"), r"[^\p{L}#]+"), lambda w: w != "")
    path = urls.select("url", F.explode(runs).alias("w")).select("url", F.concat(F.lit("p:"), "w").alias("token"))
    return host.unionByName(path)


def held_out(url: Column) -> Column:
    """Fold of a url that is kept from learning to set the prior list's strength: one in five."""
    return F.crc32(url.cast("binary")) % 5 == 0


def token_weights(tokens: DataFrame, judged: DataFrame, alpha: float = 1.0) -> tuple[DataFrame, float]:
    """``token, weight``: log odds of block over allow, and the log odds of the classes.
    ``judged``: ``url, n, block`` with ``n`` rows a url."""
    allow, block = F.sum(F.when(F.col("block"), 0).otherwise(F.col("n"))), F.sum(F.when(F.col("block"), F.col("n")).otherwise(0))
    both = tokens.join(judged, "url").groupBy("token").agg(allow.alias("a"), block.alias("b"))
    a, b, v = both.agg(F.sum("a"), F.sum("b"), F.count("*")).first()
    na, nb = judged.agg(allow, block).first()
    smooth = alpha * ((v or 0) + 1)
    weight = F.log((F.col("b") + alpha) / (float(b or 0) + smooth)) - F.log((F.col("a") + alpha) / (float(a or 0) + smooth))
    return both.select("token", weight.alias("weight")), math.log(((nb or 0) + alpha) / ((na or 0) + alpha))


def evidence(tokens: DataFrame, urls: DataFrame, weights: DataFrame) -> DataFrame:
    """``url, evidence``: sum of the weights of a url's tokens; a token that was never seen says nothing."""
    return (tokens.join(urls.select("url"), "url").join(weights, "token")
            .groupBy("url").agg(F.round(F.sum("weight"), 9).alias("evidence")))


def seed_weight(tokens: DataFrame, judged: DataFrame, share: float = 0.9) -> float:
    """Strength of a word of the prior list: it outweighs what speaks for all but ``1 - share`` of the
    allowed urls that were held out from learning, at any number of urls.  None held out: log 100."""
    weights, odds = token_weights(tokens, judged.filter(~held_out(F.col("url"))))
    ordinary = judged.filter(held_out(F.col("url")) & ~F.col("block"))
    score = F.round(F.lit(odds) + F.coalesce("evidence", F.lit(0.0)), 2)          # hundredths: a bounded histogram
    found = (ordinary.join(evidence(tokens, ordinary, weights), "url", "left").groupBy(score.alias("s")).agg(F.sum("n").alias("n"))
             .agg(F.percentile(-F.col("s"), share, F.col("n"))).first()[0])
    return math.log(100.0) if found is None else max(0.0, found) + 0.01


def learnt(tokens: DataFrame, judged: DataFrame, seeds: tuple[str, ...] = ADVERTISING) -> tuple[DataFrame, float]:
    """``token, weight`` with the prior list, which no learnt weight weakens, and the log odds of the classes."""
    weights, odds = token_weights(tokens, judged)
    strength = seed_weight(tokens, judged)
    prior = tokens.sparkSession.createDataFrame([(f"h:{w}", strength) for w in seeds], "token string, weight double")
    return weights.unionByName(prior).groupBy("token").agg(F.max("weight").alias("weight")), odds


def held_out_recall(tokens: DataFrame, judged: DataFrame) -> tuple[float, float]:
    """(share of blocked, share of allowed) held-out urls that the learnt weights judge as their rule does."""
    weights, odds = token_weights(tokens, judged.filter(~held_out(F.col("url"))))
    rest = judged.filter(held_out(F.col("url")))
    right = (F.lit(odds) + F.coalesce("evidence", F.lit(0.0)) > 0) == F.col("block")
    rows = dict(rest.join(evidence(tokens, rest, weights), "url", "left").groupBy("block")
                .agg(F.sum(F.when(right, F.col("n")).otherwise(0)) / F.sum("n")).collect())
    return rows.get(True, 1.0), rows.get(False, 1.0)


def prepared(pages: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(distinct urls with host, path and rule; their tokens; the urls that rules judge)."""
    p = pages.select(pages["url"].alias("url"), pages["html"].alias("html"))
    urls = p.groupBy("url").agg(F.count("*").alias("n")).select("url", "n", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = urls.withColumn("r", matching_rule(F.col("host"), F.col("path"), rules)).filter("url is not null")
    counts = materialize(word_counts(p), "word-counts")         # one row a word; asked three times
    tokens = materialize(url_tokens(urls.select("url", "host", "path"), counts), "url-tokens")
    return urls, tokens, urls.filter("r is not null").select("url", "n", (F.col("r.verdict") == "block").alias("block"))


def judge_urls(pages: DataFrame, rules: list[Rule], seeds: tuple[str, ...] = ADVERTISING) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every row; ``score`` (log odds of block) is
    null where a rule decides."""
    p = pages.select(pages["page_id"].alias("page_id"), pages["url"].alias("url"))
    urls, tokens, judged = prepared(pages, rules)
    weights, odds = learnt(tokens, judged, seeds)
    scores = evidence(tokens, urls.filter("r is null"), weights)
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    out = p.join(scores, "url", "left").select("page_id", host.alias("host"), path.alias("path"),
                                              matching_rule(host, path, rules).alias("r"), "evidence")
    score = F.when(F.col("r").isNull(), F.lit(odds) + F.coalesce("evidence", F.lit(0.0)))
    return out.select("page_id", "host", "path", F.col("r.rule").alias("rule"),
                      F.coalesce(F.col("r.verdict"), F.when(score > 0, "block").otherwise("allow")).alias("verdict"),
                      score.alias("score"))
