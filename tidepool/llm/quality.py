"""Quality rules judged per host: DataFrame functions only.

1. Every document is scored by text rules (``score``).
2. Rule failures are summed per host and the hosts' failure rates are shrunk by an empirical beta
   prior, fitted to all hosts by moments, so that a host with few documents is not condemned on
   little evidence (``host_rates``).
3. The hosts' verdicts are joined back to the documents (``judge``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import materialize, text_of, words_of

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50          # fewer words fail
MAX_REPEAT_PCT = 50     # more words in repeated 3-word windows fail
MAX_SYMBOL_PCT = 10     # more symbols for 100 word characters fail
MAX_DUP_LINE_PCT = 50   # more repeated lines of 100 lines with words fail
MAX_MEAN_WORD = 20      # longer words on average fail
HOST_REJECT = 0.5       # hosts whose shrunk failure rate is above are rejected
MAX_PRIOR = 10_000.0    # most documents that the prior counts for


def _repeat_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more in the array.

    Windows are sorted by hash inside the row, equal neighbours mark repeats, and the marked
    positions' union of [p, p + 3) is measured: n log n for a document of n words, no shuffle.
    """
    windows = F.transform(
        F.sequence(F.lit(1), F.size(words) - 2),
        lambda i: F.struct(F.xxhash64(F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)).alias("h"),
                           i.alias("p")))
    return F.when(F.size(words) >= 3, F.sort_array(windows))


def score(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, soft_failed.

    Null and empty texts have no words: all counts 0, base_failed. ``docs`` must not have columns
    of these names; all others are kept.
    """
    body = text_of(text)
    lines = F.filter(F.split(body, "\n"), lambda x: F.length(F.translate(x, " " + WHITE_LINE, "")) > 0)
    out = docs.withColumn("_words", words_of(body)).withColumn("_lines", lines)
    out = out.withColumn("_w3", _repeat_words(F.col("_words")))
    s = F.col("_w3")
    hit = F.filter(s, lambda x, j: x["h"].eqNullSafe(F.get(s, j - 1)["h"]) | x["h"].eqNullSafe(F.get(s, j + 1)["h"]))
    out = out.withColumn("_at", F.coalesce(F.sort_array(F.transform(hit, lambda x: x["p"])),
                                           F.array().cast("array<int>")))
    at = F.col("_at")
    out = out.withColumn("_cover", F.transform(
        at, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - p, F.lit(3)))))
    bare = F.translate(body, " " + "\t\n\x0b\x0c\r", "")
    out = out.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(bare).cast("long"),
        "n_symbols": (F.length(bare) - F.length(F.translate(bare, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_n_lines": F.size("_lines").cast("long"),
        "n_repeat_words": F.aggregate("_cover", F.lit(0).cast("long"), lambda a, x: a + x),
    })
    out = out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                         | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")))
    out = out.withColumn("soft_failed", (100 * F.col("n_symbols") > MAX_SYMBOL_PCT * F.col("word_chars"))
                         | (100 * F.col("n_dup_lines") > MAX_DUP_LINE_PCT * F.col("_n_lines"))
                         | (F.col("word_chars") > MAX_MEAN_WORD * F.col("n_words")))
    return out.drop("_words", "_lines", "_w3", "_at", "_cover", "_n_lines")


WHITE_LINE = "\t\x0b\x0c\r"


def host_rates(scored: DataFrame, host: str) -> DataFrame:
    """One row per host (null is a host): _host, n_docs, n_failed, host_rate, host_failed.

    host_rate is the posterior mean (n_failed + s m) / (n_docs + s) under a beta prior of mean m
    (the corpus rate) and size s = m (1 - m) / v - 1, v the variance of host rates around m
    weighted by documents; s is held to 1 .. MAX_PRIOR.
    """
    failed = (F.col("base_failed") | F.col("soft_failed")).cast("long")
    hosts = scored.groupBy(F.col(host).alias("_host")).agg(F.count("*").alias("n_docs"), F.sum(failed).alias("n_failed"))
    hosts = materialize(hosts, "hosts")
    # sum n (r - m)^2 = sum f^2 / n - n m^2: three sums over the hosts make the prior.
    n, f, q = hosts.agg(F.sum("n_docs"), F.sum("n_failed"),
                        F.sum(F.col("n_failed") * F.col("n_failed") / F.col("n_docs"))).first()
    mean = f / n if n else 0.0
    var = q / n - mean * mean if n else 0.0
    size = max(1.0, min(MAX_PRIOR, mean * (1 - mean) / var - 1)) if var > 1e-12 else MAX_PRIOR
    rate = (F.col("n_failed") + F.lit(size * mean)) / (F.col("n_docs") + F.lit(size))
    return hosts.select("_host", "n_docs", "n_failed", rate.alias("host_rate"), (rate > HOST_REJECT).alias("host_failed"))


def judge(scored: DataFrame, hosts: DataFrame, host: str) -> DataFrame:
    """``scored`` plus host_failed and kept: false for documents that fail a rule themselves
    and for all documents of rejected hosts."""
    verdict = hosts.select("_host", "host_failed")
    out = scored.join(verdict, F.col(host).eqNullSafe(F.col("_host")), "left").drop("_host")
    out = out.withColumn("host_failed", F.coalesce("host_failed", F.lit(False)))
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("soft_failed") & ~F.col("host_failed"))
