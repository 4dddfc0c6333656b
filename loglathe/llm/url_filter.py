"""URL filters: rules on hosts and paths, and a naive Bayes judgement for the rest.

Hosts often run words together. Every run of letters in a host is cut into words by a
unigram Viterbi search: the cut with the most probable words, by counts over the text of
all pages. A multinomial naive Bayes model over the words of host and path then tells
blocked from allowed; it learns from all pages, where those with a seed word count as
blocked. Word lookups are joins, so no lexicon has to fit a task.

Cases: a null URL, one without ``://`` and any other without words in host and path has no tokens and no
score, and is allowed unless a rule fits; null pages text counts as empty; repeated rows are judged
alike; hosts of any length are cut in time proportional to their length. With no pages
that carry a seed word everything without a rule is allowed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglathe.llm.common import stored
from loglathe.operators.skew import attach_by_key, fits_broadcast

# (action, host, beginning of the path), as the query's contract lists them.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
# Words that mark unwanted sites (fixed values); each counts as SEED_COUNT in the lexicon.
SEEDS = ("ads", "adult", "bet", "bets", "bingo", "casino", "cheap", "crack", "escort", "farm",
         "gamble", "jackpot", "loan", "loans", "lottery", "nude", "phish", "pills", "poker", "porn",
         "replica", "sex", "slots", "spam", "torrent", "track", "tracker", "viagra", "warez",
         "win", "xxx")
SEED_COUNT = 1000
# Longest word the search considers.
WORD_CHARS = 20

_AFTER = r"://"


def parsed(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL, both empty without ``://``."""
    rest = F.when(F.coalesce(F.instr(url, _AFTER), F.lit(0)) > 0,
                  F.substring(url, F.instr(url, _AFTER) + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = F.substring(rest, F.length(host) + 1, F.length(rest))
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lowered, F.regexp_extract(after, r"^[^?#]*", 0)


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct of length, rule and action; else null."""
    fitting = [
        F.when(((host == name) | host.endswith("." + name)) & path.startswith(prefix), F.struct(
            F.lit(len(name + prefix)).alias("length"), F.lit(name + prefix).alias("rule"),
            F.lit(action).alias("action")))
        for action, name, prefix in rules]
    return fitting[0] if len(fitting) == 1 else F.greatest(*fitting)


def lexicon(pages: DataFrame) -> DataFrame:
    """``word, n``: how often each word of letters occurs in the pages' text, seeds included."""
    text = F.lower(F.regexp_replace(F.coalesce("html", F.lit("")), r"<[^>]*+>", " "))
    words = pages.select(F.explode(F.regexp_extract_all(text, F.lit(r"\p{L}++"), 0)).alias("word"))
    counted = words.filter(F.length("word") <= WORD_CHARS).groupBy("word").agg(F.count("*").alias("n"))
    seeds = pages.sparkSession.createDataFrame([(w, SEED_COUNT) for w in SEEDS], "word string, n bigint")
    return counted.unionByName(seeds).groupBy("word").agg(F.sum("n").alias("n"))


def _best_cut(run: str, found: list[tuple[int, str, int]], total: int) -> list[str]:
    """Viterbi over the cuts of a run; letters that no word covers stand alone or together."""
    unknown = -math.log(total + 1.0)
    by_end: dict[int, list[tuple[int, float]]] = {}
    for start, word, n in found:
        by_end.setdefault(start + len(word), []).append((start, math.log(n / (total + 1.0))))
    best = [(0.0, 0, False)] + [(-math.inf, 0, False)] * len(run)
    for end in range(1, len(run) + 1):
        # An unknown letter costs more than any word of one count.
        options = [(best[end - 1][0] + unknown - 1.0, end - 1, False)]
        options += [(best[s][0] + p, s, True) for s, p in by_end.get(end, ())]
        best[end] = max(options)
    words, end, loose = [], len(run), ""
    while end:
        _, start, known = best[end]
        if known:
            if loose:
                words.append(loose)
                loose = ""
            words.append(run[start:end])
        else:
            loose = run[start:end] + loose
        end = start
    if loose:
        words.append(loose)
    return words[::-1]


def segmented(runs: DataFrame, words: DataFrame) -> DataFrame:
    """``run, words``: each distinct run of letters cut into words."""
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    length = F.length("run")
    starts = runs.select("run", F.explode(F.sequence(F.lit(1), length)).alias("start"))
    spans = starts.select("run", "start", F.explode(F.sequence(
        F.lit(1), F.least(F.lit(WORD_CHARS), length - F.col("start") + 1))).alias("size"))
    spans = spans.select("run", (F.col("start") - 1).alias("start"),
                         F.expr("substring(run, start, size)").alias("word"))
    # A run has at most WORD_CHARS spans a letter.
    found = spans.join(words, "word").groupBy("run").agg(
        F.collect_list(F.struct("start", "word", "n")).alias("found"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            cuts = [_best_cut(r, [tuple(f.values()) for f in found or ()], total)
                    for r, found in zip(rows["run"], rows["found"])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cuts, pa.list_(pa.string()))], names=["run", "words"])

    return runs.join(found, "run", "left").mapInArrow(cut, "run string, words array<string>")


def _letters(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}++"), 0)


def shapes(urls: DataFrame, words: DataFrame) -> DataFrame:
    """``host, path_words, n, tokens``: distinct hosts and path words of all pages."""
    keys = stored(urls.groupBy("host", "path_words").agg(F.count("*").alias("n")), "urls")
    hosts = keys.select("host").distinct().select("host", F.posexplode(_letters(F.col("host"))).alias("at", "run"))
    cuts = segmented(hosts.select("run").distinct(), words)
    # A host has at most as many runs as letters.
    cut_hosts = hosts.join(cuts, "run").groupBy("host").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "words"))), lambda r: r["words"]).alias("runs")
    ).select("host", F.flatten("runs").alias("host_words"))
    return keys.join(cut_hosts, "host", "left").withColumn("tokens", F.concat(
        F.transform(F.coalesce("host_words", F.array().cast("array<string>")),
                    lambda w: F.concat(F.lit("h:"), w)),
        # A path without words has no tokens.
        F.transform(F.filter(F.split(F.col("path_words"), " "), lambda w: w != ""),
                    lambda w: F.concat(F.lit("p:"), w))))


def bayes(shaped: DataFrame) -> DataFrame:
    """``token, odds``: log of how much likelier a token is on blocked pages; null: the prior."""
    marked = shaped.withColumn("blocked", F.coalesce(F.arrays_overlap(
        "tokens", F.array(*[F.lit("h:" + w) for w in SEEDS])), F.lit(False)))
    count = lambda b: F.coalesce(F.sum(F.when(F.col("blocked") == b, F.col("n"))), F.lit(0))
    pages = marked.agg(count(True).alias("yes"), count(False).alias("no")).first()
    tokens = stored(marked.select("n", "blocked", F.explode("tokens").alias("token")).groupBy(
        "token").agg(count(True).alias("yes"), count(False).alias("no")), "tokens")
    sums = tokens.agg(F.count("*").alias("v"), F.sum("yes").alias("yes"), F.sum("no").alias("no")).first()
    v = sums["v"] or 1
    odds = (F.log((F.col("yes") + 1) / F.lit((sums["yes"] or 0) + v))
            - F.log((F.col("no") + 1) / F.lit((sums["no"] or 0) + v)))
    prior = math.log((pages["yes"] + 1) / (pages["no"] + 1)) if pages["yes"] else -math.inf
    return tokens.select("token", odds.alias("odds")).unionByName(
        tokens.sparkSession.createDataFrame([(None, prior)], "token string, odds double"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every page."""
    host, path = parsed(F.col("url"))
    urls = stored(pages.select("page_id", host.alias("host"), path.alias("path")).withColumn(
        "path_words", F.array_join(_letters(F.col("path")), " ")), "parsed")
    shaped = stored(shapes(urls, stored(lexicon(pages), "lexicon")), "shapes")
    odds = stored(bayes(shaped), "odds")
    prior = odds.filter("token IS NULL").first()["odds"]
    model = odds.filter("token IS NOT NULL")
    tokens = shaped.select("host", "path_words", F.explode("tokens").alias("token"))
    scores = attach_by_key(tokens, model, "token", fits_broadcast(model)).groupBy(
        "host", "path_words").agg(F.sum("odds").alias("score")).withColumn("score", F.col("score") + prior)
    # Host and path words name few rows against all pages; beyond a measured size the join
    # is a shuffle that splits heavy names.
    key = F.to_json(F.struct("host", "path_words"))
    keyed = stored(scores.select(key.alias("shape"), "score"), "scores")
    judged = attach_by_key(urls.withColumn("shape", key), keyed, "shape", fits_broadcast(keyed))
    return judged.withColumn("found", rule_for(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.action", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"),
        "score")
