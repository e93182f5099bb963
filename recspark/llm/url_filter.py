"""URL filter: rules first, then naive Bayes over words segmented from hosts and paths.

Concatenated names in hosts are split by a unigram model with a Viterbi search; the word
counts come from all page texts. Only counts of substrings of host labels are joined to the
distinct labels, so the vocabulary is never broadcast and each label is split once. Tokens
of host and path, hashed to a fixed number of buckets, feed a multinomial naive Bayes model.
It learns from the pages that rules decide and from hosts with a blocked word, and judges
the others. What reaches the driver are two counts per bucket.

Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; path: then up to
`?`, `#` or the end. A rule fits its host and subdomains where the path begins with the
rule's; the longest rule wins, of equally long ones the alphabetically first.

Defined cases: a null url or one without `://` has an empty host and path and no tokens, so
it gets the verdict of the class shares alone; null or empty html adds no words; without any
training page every page is allowed; equal scores allow; repeated rows are judged alike;
other columns of pages are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..operators.skew import attach
from ..storage import materialize

LONGEST_WORD = 20
BUCKETS = 1 << 18
BLOCKED_WORDS = ("ad", "ads", "advert", "banner", "casino", "popup", "porn", "spam", "track", "tracker", "tracking")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(rules: Sequence[str]) -> Column:
    """The longest rule (host and path, like `example.net/en/`) that fits `host` and `path`."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r), r), reverse=True):
        host, slash, path = rule.partition("/")
        own = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        found = F.when(own & F.col("path").startswith(slash + path), F.lit(rule)).otherwise(found)
    return found


def word_counts(texts: DataFrame, html: str) -> DataFrame:
    """(word, n) of all page texts without their tags, letters only."""
    text = F.lower(F.regexp_replace(html, "<[^>]*>", " "))
    words = texts.select(F.explode(F.split(text, r"[^\p{L}]+")).alias("word"))
    return words.where(F.length("word").between(1, LONGEST_WORD)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def segment(name: str, counts: dict[str, int], total: int) -> list[str]:
    """The likeliest split of `name` by a unigram model; words never seen get a probability
    that falls tenfold with each letter. Ties go to the longer last word."""
    best = [0.0] + [-math.inf] * len(name)
    back = [0] * (len(name) + 1)
    total = max(total, 1)
    for end in range(1, len(name) + 1):
        for begin in range(max(0, end - LONGEST_WORD), end):
            word = name[begin:end]
            seen = counts.get(word)
            here = math.log(seen / total) if seen else math.log(10 / total) - len(word) * math.log(10)
            if best[begin] + here > best[end]:
                best[end], back[end] = best[begin] + here, begin
    words, end = [], len(name)
    while end:
        words.append(name[back[end] : end])
        end = back[end]
    return words[::-1]


def host_words(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, words) of distinct hosts: their labels, cut at other signs and segmented."""
    parts = F.filter(F.split("host", r"[^\p{L}]+"), lambda p: F.length(p) > 0)
    places = hosts.select("host", F.posexplode(parts).alias("place", "part"))
    names = places.select("part").distinct()
    begins = F.sequence(F.lit(1), F.length("part"))
    pieces = F.flatten(
        F.transform(begins, lambda b: F.transform(F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("part") - b + 1)), lambda n: F.substr(F.col("part"), b, n)))
    )
    wanted = names.select("part", F.explode(F.array_distinct(pieces)).alias("word"))
    # one scan of the counts gives the total and the words that some host needs
    total = counts.agg(F.sum("n")).first()[0] or 0
    known = wanted.join(counts, "word", "left").groupBy("part").agg(
        F.collect_list(F.when(F.col("n").isNotNull(), F.struct("word", "n"))).alias("known")
    )

    @arrow_udf("array<string>")
    def split(part: pa.Array, known: pa.Array) -> pa.Array:
        rows = zip(part.to_pylist(), known.to_pylist())
        return pa.array([segment(p, {w["word"]: w["n"] for w in k}, total) for p, k in rows], pa.list_(pa.string()))

    words = known.select("part", split("part", "known").alias("words"))
    joined = places.join(words, "part").groupBy("host").agg(F.array_sort(F.collect_list(F.struct("place", "words"))).alias("w"))
    return joined.select("host", F.flatten(F.transform("w", lambda w: w["words"])).alias("words"))


def _path_words(path: str) -> Column:
    """Path tokens: lower-cased words; a number becomes a sign with its length."""
    parts = F.filter(F.split(F.lower(F.col(path)), r"[^\p{L}\p{N}]+"), lambda p: F.length(p) > 0)
    return F.transform(parts, lambda p: F.when(p.rlike(r"^\p{N}+$"), F.concat(F.lit("#"), F.length(p).cast("string"))).otherwise(p))


def _buckets(words: Column, kind: str) -> Column:
    return F.transform(words, lambda w: F.pmod(F.xxhash64(F.lit(kind), w), F.lit(BUCKETS)).cast("int"))


def log_odds(training: DataFrame) -> tuple[np.ndarray, float]:
    """Of block against allow: per bucket, and of the class shares (add-one smoothing).

    `training`: tokens (array of buckets) and block (boolean).
    """
    classes = {r["block"]: r["n"] for r in training.groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not classes:
        return np.zeros(BUCKETS), -1.0
    exploded = training.select("block", F.explode("tokens").alias("token"))
    rows = exploded.groupBy("token").agg(F.count_if("block").alias("b"), F.count_if(~F.col("block")).alias("a")).toArrow()
    counts = np.ones((2, BUCKETS))
    for i, column in enumerate(("a", "b")):
        counts[i][rows["token"].to_numpy()] += rows[column].to_numpy()
    odds = np.log(counts / counts.sum(1, keepdims=True))
    return odds[1] - odds[0], math.log((classes.get(True, 0) + 1) / (classes.get(False, 0) + 1))


def judge(pages: DataFrame, block: Sequence[str], allow: Sequence[str], blocked_words: Sequence[str] = BLOCKED_WORDS) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every page; score: log odds of block."""
    host, path = host_and_path("url")
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = urls.withColumn("rule", matching_rule([*block, *allow]))
    counts = materialize(word_counts(pages.select("html"), "html"), "page-words")
    hosts = urls.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    words = host_words(hosts.where("host <> ''"), counts)
    hosts = hosts.join(words, "host", "left").withColumn("words", F.coalesce("words", F.array().cast("array<string>")))
    hosts = materialize(hosts, "host-words")
    known = attach(urls, hosts, ["host"])
    tokens = F.concat(_buckets(F.col("words"), "host"), _buckets(_path_words("path"), "path"))
    known = known.withColumn("tokens", tokens)
    by_word = F.arrays_overlap("words", F.array(*[F.lit(w) for w in blocked_words]).cast("array<string>"))
    taught = F.when(F.col("rule").isNotNull(), F.col("rule").isin(*block)).when(by_word, True)
    odds, share = log_odds(known.select("tokens", taught.alias("block")).where("block is not null"))
    shared = pages.sparkSession.sparkContext.broadcast(odds)

    @arrow_udf("double")
    def score(tokens: pa.Array) -> pa.Array:
        running = np.concatenate(([0.0], np.cumsum(shared.value[tokens.flatten().to_numpy()])))
        ends = np.cumsum(tokens.value_lengths().to_numpy())
        return pa.array(running[ends] - running[np.concatenate(([0], ends[:-1]))] + share)

    scored = known.withColumn("score", F.round(score("tokens"), 9))
    own = F.when(F.col("score") > 0, "block").otherwise("allow")
    verdict = F.when(F.col("rule").isNull(), own).when(F.col("rule").isin(*block), "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
