"""Operator 6, URL filters: host and path rules, then naive Bayes over the words that host and path names are made of.

A rule is a verdict and a prefix such as `example.org/en/`: it fits that host and its subdomains where the path starts with
the rule's path; the longest rule wins. Urls without a rule get the method's verdict:

* Names are split at everything but letters, and each run of letters into words by a unigram Viterbi search: the split with
  the largest product of word probabilities, taken from the words of all pages. A run of letters that the dictionary lacks
  costs as a word seen less than once, ten times less for each letter, so known words win where they fit.
* A multinomial naive Bayes model scores the words (host and path words apart), with add-one smoothing. Its labels are the
  rules' own verdicts, the only judgement that the table comes with: it is trained on all pages that a rule fits, and so
  carries over to other hosts what blocked and allowed urls are made of. held_out() tells how well it foresees them.

Both tables of counts stay on Spark and are whole. All words of two letters or more enter the dictionary; a run of letters is
joined by its substrings, of the lengths that the dictionary has, to the words that it holds, so a task's search needs no dictionary but each run's own. Odds are
joined to the pages' words and added up by page. The joins' left sides repeat common runs and words: plain sort-merge joins
with one row a key on the right, which AQE may split. Only sums and class counts reach the driver.

Nulls: a null url, or one without `://`, has an empty host and path, fits no rule and is judged by the prior alone. Repeated
rows are judged and counted each. Without training rows of a class the prior is even, and a tie means allow. An empty table
gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.llm import textvec as tv
from sessionlens.llm.common import ascii_lower, own_columns, written

#: (verdict, rule) in any order.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Rows that leave a task at a time.
ROWS = 50_000
_LETTERS = np.zeros(256, bool)
_LETTERS[97:123] = True


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_rest(url), "^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _first_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...], value: int) -> Column:
    """The verdict (value 0) or text (1) of the longest rule that fits; rules are a parameter, not a table."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is asked last and wins
        own, _, rest = rule[1].partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        found = F.when(fits, F.lit(rule[value])).otherwise(found)
    return found


def _word_counts() -> Callable:
    """Texts -> word, n: the words of letters only, added up a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in tv.slices(batch.column("text"), 4 << 20):
                w = tv.words(data, offsets, _LETTERS)
                size = w.end - w.start
                ok = np.flatnonzero(size >= 2)
                _, at, n = np.unique(w.hash[ok], return_index=True, return_counts=True)
                low = tv._LOWER[data].tobytes()
                words = [low[a:b].decode() for a, b in zip(w.start[ok][at].tolist(), w.end[ok][at].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n)], ["word", "n"])

    return run


def dictionary(texts: DataFrame) -> DataFrame:
    """word, n of all words of the table's column text."""
    return texts.mapInArrow(_word_counts(), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def segment(run: str, log_p: dict[str, float]) -> list[str]:
    """The likeliest split of a run of letters into words; log_p[""] is the base cost of an unknown word."""
    unknown, letter = log_p[""], math.log(10)
    lengths = sorted({len(w) for w in log_p if w}, reverse=True)
    best, cut = [0.0], [0]
    lost, since = -math.inf, 0  # the best split that ends in an unknown word, and where that word starts
    for j in range(1, len(run) + 1):
        lost, since = max((lost - letter, since), (best[j - 1] + unknown - letter, j - 1), key=lambda x: x[0])
        top, at = lost, since
        for n in lengths:
            p = log_p.get(run[j - n : j]) if n <= j else None
            if p is not None and best[j - n] + p > top:
                top, at = best[j - n] + p, j - n
        best.append(top)
        cut.append(at)
    out, j = [], len(run)
    while j:
        out.append(run[cut[j] : j])
        j = cut[j]
    return out[::-1]


def _parts() -> Callable:
    """Adds parts: host runs as h:<run>, path runs as p:<run>; numbers as # and their digits' count."""
    runs = re.compile(r"[a-z]+|[0-9]+")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for host, path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True):
                found = [("h:", x) for x in runs.findall(host)] + [("p:", x) for x in runs.findall(path.lower())]
                out.append([kind + (f"#{len(x)}" if x[0] <= "9" else x) for kind, x in found])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.string()))], [*batch.schema.names, "parts"])

    return run


def _substrings(lengths: list[int]) -> Callable:
    """rid, run -> rid, word: its substrings of the given lengths, repeats included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid: list[int] = []
        words: list[str] = []
        out = lambda: pa.RecordBatch.from_arrays([pa.array(rid, pa.int64()), pa.array(words, pa.string())], ["rid", "word"])
        for batch in batches:
            for own, name in zip(batch.column("rid").to_pylist(), batch.column("run").to_pylist(), strict=True):
                for i in range(len(name) - 1):
                    ends = [i + n for n in lengths if i + n <= len(name)]
                    rid += [own] * len(ends)
                    words += [name[i:j] for j in ends]
                    if len(words) >= ROWS:
                        yield out()
                        rid, words = [], []
        yield out()

    return run


def _segmented(total: int) -> Callable:
    """run, own (its words in the dictionary and their counts) -> run, words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unknown = math.log(0.1 / max(total, 1))
        for batch in batches:
            names = batch.column("run").to_pylist()
            words = [segment(x, {w["word"]: math.log(w["n"] / total) for w in own or ()} | {"": unknown}) for x, own in zip(names, batch.column("own").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("run"), pa.array(words, pa.list_(pa.string()))], ["run", "words"])

    return run


def segmented(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """run, words of distinct runs of letters, by all words of counts (word, n)."""
    by_length = counts.groupBy(F.length("word").alias("length")).agg(F.sum("n").alias("n")).collect()  # a row a length of words
    total, lengths = sum(r.n for r in by_length), sorted(r.length for r in by_length)
    runs = written(runs.withColumn("rid", F.monotonically_increasing_id()), "runs")
    found = runs.select("rid", "run").mapInArrow(_substrings(lengths), "rid long, word string").join(counts, "word")
    own = runs.join(found.groupBy("rid").agg(F.collect_set(F.struct("word", "n")).alias("own")), "rid", "left").select("run", "own")
    return own.mapInArrow(_segmented(total), "run string, words array<string>")


def with_words(names: DataFrame, counts: DataFrame) -> DataFrame:
    """names (a unique nid, and parts) with words in place of parts: every run split, in order, each word after its h: or p:."""
    part = F.col("part")
    each = names.select("nid", F.posexplode("parts").alias("at", "part")).select("nid", "at", F.substring(part, 1, 2).alias("kind"), F.substring(part, 3, 1 << 30).alias("run"))
    split = segmented(each.select("run").where("run NOT LIKE '#%'").distinct(), counts)
    words = F.transform(F.coalesce("words", F.array("run")), lambda w: F.concat("kind", w))
    own = each.join(split, "run", "left").select("nid", F.struct("at", words.alias("words")).alias("part")).groupBy("nid").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    own = own.select("nid", F.flatten("parts.words").alias("words"))
    return names.drop("parts").join(own, "nid", "left").withColumn("words", F.coalesce("words", F.array().cast("array<string>")))


def naive_bayes(labelled: DataFrame) -> tuple[DataFrame, float]:
    """Log odds (block against allow) of all words (word, odds), and of the classes, from columns words and label."""
    rows = labelled.select("label", F.explode("words").alias("word")).groupBy("word").agg(F.count_if(F.col("label") == "block").alias("b"), F.count_if(F.col("label") == "allow").alias("a"))
    rows = written(rows, "word-labels")
    totals = rows.agg(F.sum("b"), F.sum("a"), F.count(F.lit(1))).first()
    n_b, n_a, kinds = (x or 0 for x in totals)
    docs = dict(labelled.groupBy("label").count().collect())
    odds = rows.select("word", (F.log((F.col("b") + 1) / F.lit(n_b + kinds + 1)) - F.log((F.col("a") + 1) / F.lit(n_a + kinds + 1))).alias("odds"))
    prior = math.log(docs["block"] / docs["allow"]) if docs.get("block") and docs.get("allow") else 0.0
    return odds, prior


def judged(names: DataFrame, odds: DataFrame, prior: float) -> DataFrame:
    """names (a unique nid, and words) with block_score in place of words; odds are added in the words' order."""
    each = names.select("nid", F.posexplode("words").alias("at", "word")).join(odds, "word")
    own = each.groupBy("nid").agg(F.array_sort(F.collect_list(F.struct("at", "odds"))).alias("odds"))
    own = own.select("nid", F.aggregate("odds.odds", F.lit(0.0), lambda x, y: x + y).alias("score"))
    return names.drop("words").join(own, "nid", "left").withColumn("block_score", F.lit(prior) + F.coalesce("score", F.lit(0.0)))


def named(pages: DataFrame, rules: tuple[tuple[str, str], ...]) -> DataFrame:
    """page_id, host, path, rule, ruled (the rule's verdict), nid and words of every page, written."""
    pages = own_columns(pages, "page_id", "url", "html")
    counts = written(dictionary(pages.select(F.col("html").alias("text"))), "words")
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    host, path = F.col("host"), F.col("path")
    urls = urls.withColumn("rule", _first_rule(host, path, rules, 1)).withColumn("ruled", _first_rule(host, path, rules, 0))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in urls.schema)
    parts = urls.mapInArrow(_parts(), f"{kinds}, parts array<string>").withColumn("nid", F.monotonically_increasing_id())
    return written(with_words(written(parts, "parts"), counts), "names")


def _verdict() -> Column:
    return F.when(F.col("block_score") > 0, F.lit("block")).otherwise(F.lit("allow"))


def filter_urls(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and block_score (the method's log odds) of every page."""
    names = named(pages, rules)
    odds, prior = naive_bayes(names.withColumn("label", F.col("ruled")).where("label IS NOT NULL"))
    scored = judged(names, odds, prior)
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", _verdict()).alias("verdict"), "block_score")


def held_out(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, folds: int = 5) -> DataFrame:
    """label (the rule's verdict), n, right: urls of one fold, by a hash of host and path, judged by a model of the others."""
    names = named(pages, rules).withColumn("label", F.col("ruled")).where("label IS NOT NULL")
    out = F.pmod(F.xxhash64("host", "path"), F.lit(folds)) == 0
    odds, prior = naive_bayes(names.where(~out))
    scored = judged(names.where(out), odds, prior)
    return scored.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == _verdict()).alias("right"))
