"""URL filter: rules by host and path, and gradient-boosted trees on lexical features for the rest.

Everything runs in the JVM: features are built-in functions, the trees are Spark's own
``GBTClassifier``.  Rules label the URLs they fit; about ``TRAIN_ROWS`` labelled URLs, half
of them of either verdict as far as there are so many (chosen by a hash, weighted back to
their numbers), train the trees, which judge the URLs no rule fits.  Suffix statistics
(share of blocked URLs by the host's last label, smoothed, and how common the label is) are
counted over all labelled URLs in two halves: a training URL has those of the other half, so
that its own label is not among its features, and a judged one those of both.  Labelled hosts
end as the rules' do, so there are at most as many suffixes as rules and the statistics may
be broadcast.

Defined cases: a NULL URL, or one without ``://``, has an empty host and path and is judged
by the trees; an unseen suffix has the overall share; with labels of one class only (or
none) the trees are left out and the verdict is that class (or ``allow``); a chance of just
one half allows; URLs of any length are read whole; rows that repeat are judged alike, each
on its own; an empty table gives an empty result; further columns, whatever their names,
are not read.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialise

TRAIN_ROWS = 10_000
TREES = 12
DEPTH = 4
SMOOTHING = 20.0
SPLIT = 1 << 30

# Fixed by the contract: (host, path, verdict)
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

FEATURES = ["f_length", "f_host", "f_path", "f_depth", "f_digits", "f_letters", "f_entropy", "f_params", "f_equals",
            "f_labels", "f_hyphens", "f_escapes", "f_fragment", "f_secure", "f_longest", "f_suffix_share", "f_suffix_count"]


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path, both empty for a URL without ``://``."""
    whole = F.coalesce(url, F.lit(""))
    at = F.instr(whole, "://")
    rest = F.when(at > 0, F.substring(whole, at + F.lit(3), F.length(whole))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + F.lit(1), F.length(rest)), r"^([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def match_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (as host and path in one) and its verdict; NULL where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def count_of(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are among ``chars``."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def entropy(text: Column) -> Column:
    """Bits per character over a-z, 0-9 and all others together; one linear pass a symbol."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    low = F.lower(text)
    counts = [count_of(low, c) for c in string.ascii_lowercase + string.digits]
    other = F.length(low) - reduce(lambda a, b: a + b, counts)

    def term(c):
        share = c.cast("double") / n
        return F.when(share > 0, -share * F.log2(share)).otherwise(F.lit(0.0))
    return reduce(lambda a, b: a + b, map(term, [*counts, other]))


def lexical(df: DataFrame, url: str = "url") -> DataFrame:
    """``df`` with host, path and the features that need the URL alone."""
    host, path = parts(F.col(url))
    u = F.coalesce(F.col(url), F.lit(""))
    n = F.greatest(F.length(u), F.lit(1)).cast("double")
    query = F.substring_index(F.regexp_extract(u, r"\?(.*)$", 1), "#", 1)
    out = df.withColumn("host", host).withColumn("path", path)
    own = {
        "f_length": F.length(u), "f_host": F.length("host"), "f_path": F.length("path"),
        "f_depth": count_of(F.col("path"), "/"), "f_digits": count_of(u, string.digits) / n,
        "f_letters": count_of(u, string.ascii_letters) / n, "f_entropy": entropy(u),
        "f_params": F.when(F.length(query) > 0, count_of(query, "&") + 1).otherwise(0), "f_equals": count_of(query, "="),
        "f_labels": count_of(F.col("host"), "."), "f_hyphens": count_of(u, "-_"), "f_escapes": count_of(u, "%"),
        "f_fragment": F.instr(u, "#") > 0, "f_secure": F.lower(F.substring(u, 1, 6)) == "https:",
        "f_longest": F.coalesce(F.array_max(F.transform(F.split("path", "/"), F.length)), F.lit(0)),
    }
    return out.withColumns({k: v.cast("double") for k, v in own.items()}).withColumn("suffix", F.substring_index("host", ".", -1))


def suffix_counts(labelled: DataFrame) -> DataFrame:
    """Blocked and labelled URLs by suffix, in either half of the table."""
    def of(half, what):
        return F.sum(F.when(F.col("half") == half, what).otherwise(0.0))
    return labelled.groupBy("suffix").agg(of(0, F.col("y")).alias("b0"), of(0, F.lit(1.0)).alias("n0"),
                                          of(1, F.col("y")).alias("b1"), of(1, F.lit(1.0)).alias("n1"))


def with_suffixes(df: DataFrame, counts: DataFrame, totals: tuple[float, float], prior: float, learning: bool = False) -> DataFrame:
    """``df`` with the suffix features; URLs to learn from see the half they are not in.  ``totals``: labelled URLs by half."""
    def pick(name):
        parts_ = [F.coalesce(F.col(f"{name}{i}"), F.lit(0.0)) if name else F.lit(totals[i]) for i in (0, 1)]
        return F.when(F.col("half") == 0, parts_[1]).otherwise(parts_[0]) if learning else parts_[0] + parts_[1]
    blocked, seen, total = pick("b"), pick("n"), pick("")
    return (df.join(F.broadcast(counts), "suffix", "left")
            .withColumn("f_suffix_share", (blocked + SMOOTHING * prior) / (seen + SMOOTHING))
            .withColumn("f_suffix_count", F.log1p(1e6 * seen / F.greatest(total, F.lit(1.0))))
            .drop("b0", "n0", "b1", "n1"))


def filter_urls(pages: DataFrame, key: str = "page_id", url: str = "url", rules=RULES, rows: int = TRAIN_ROWS) -> DataFrame:
    """A verdict for every row: key, host, path, rule, verdict, and the trees' probability to block."""
    df = lexical(pages.select(F.col(key), F.col(url)), url)
    rule, by_rule = match_rules(F.col("host"), F.col("path"), rules)
    df = df.withColumn("rule", rule).withColumn("by_rule", by_rule)
    draw = F.pmod(F.xxhash64(F.col(key), F.col(url)), F.lit(SPLIT))
    labelled = (df.filter(F.col("by_rule").isNotNull()).withColumn("draw", draw).withColumn("half", F.col("draw") % 2)
                .withColumn("y", (F.col("by_rule") == "block").cast("double")))
    counts = materialise(suffix_counts(labelled), "suffixes")
    sums = counts.agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("b0", "n0", "b1", "n1")]).first()
    totals, blocked = (sums["n0"], sums["n1"]), sums["b0"] + sums["b1"]
    of_class = {1.0: blocked, 0.0: sum(totals) - blocked}
    prior = blocked / max(1.0, sum(totals))
    if min(of_class.values()) > 0:
        share = {y: min(SPLIT, int(rows / 2 * SPLIT / n)) for y, n in of_class.items()}
        drawn = F.when(F.col("y") == 1.0, F.lit(share[1.0])).otherwise(F.lit(share[0.0]))
        sample = labelled.filter(F.col("draw") < drawn).withColumn("weight", F.lit(float(SPLIT)) / drawn)
        learn = with_suffixes(sample, counts, totals, prior, learning=True)
        assembler = VectorAssembler(inputCols=FEATURES, outputCol="f_vector")
        learn = materialise(learn.select(*FEATURES, "y", "weight"), "urls")
        trees = GBTClassifier(featuresCol="f_vector", labelCol="y", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=1)
        model = trees.fit(assembler.transform(learn).select("f_vector", "y", "weight"))
        judged = model.transform(assembler.transform(with_suffixes(df, counts, totals, prior)))
        judged = judged.withColumn("block_chance", F.element_at(vector_to_array(F.col("probability")), 2))
    else:
        judged = df.withColumn("block_chance", F.lit(1.0 if prior > 0.5 else 0.0))
    by_trees = F.when(F.col("block_chance") > 0.5, "block").otherwise("allow")
    return judged.select(key, "host", "path", "rule", F.coalesce("by_rule", by_trees).alias("verdict"), "block_chance")
