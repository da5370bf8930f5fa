"""URL filters: given rules first, then rules that FP-growth mines from labelled URLs.

A URL becomes a set of tokens (scheme, host and its parents, path segments
with numbers as one token, extension, query keys, fragment). FP-growth finds
the frequent combinations of tokens with the label `block`; combinations of
enough support and confidence become rules, unless a smaller one is as sure.
Tokens that always occur together count as one, so that they do not multiply
the combinations. An inverted index from token to rules matches them: a rule
applies when all its tokens are found. URLs with equal tokens are matched once.
"""

from __future__ import annotations

import string

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partnerlens.llm.common import others, values, written

BLOCK = "=block"


def host(url: str) -> Column:
    """What stands after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty for null or no `://`."""
    found = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path(url: str) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def given_rule(host_col: str, path_col: str, rules: list[tuple[str, str, str]]) -> Column:
    """The longest of rules (host, path, verdict) that fits: struct of length, rule and verdict; null if none does.

    A rule fits its host and all subdomains, where the path starts with its
    own. The list is part of the plan; it is looked up by the host's last
    labels, as many as the longest rule has.
    """
    if not rules:
        return F.lit(None).cast("struct<length: int, rule: string, verdict: string, start: string>")
    by_host: dict[str, list[Column]] = {}
    for h, p, verdict in rules:
        one = F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"), F.lit(p).alias("start"))
        by_host.setdefault(h, []).append(one)
    index = F.create_map(*(x for h, found in by_host.items() for x in (F.lit(h), F.array(*found))))
    most = max(h.count(".") + 1 for h in by_host)
    labels = F.split(host_col, r"\.", -1)
    parents = F.transform(F.sequence(F.lit(1), F.least(F.lit(most), F.size(labels))), lambda k: F.array_join(F.slice(labels, -k, k), "."))
    fits = F.flatten(F.transform(parents, lambda p: F.coalesce(F.try_element_at(index, p), F.expr("cast(array() as array<struct<length: int, rule: string, verdict: string, start: string>>)"))))
    return F.array_max(F.filter(fits, lambda r: F.col(path_col).startswith(r["start"])))


def tokens(url: str, host_col: str, path_col: str) -> Column:
    """The distinct tokens of a URL, sorted; a null URL has none."""
    labels = F.split(host_col, r"\.", -1)
    segments = F.filter(F.split(path_col, "/", -1), lambda s: s != "")
    shape = lambda s: F.regexp_replace(s, "[0-9]+", "0")
    keys = F.transform(F.regexp_extract_all(F.col(url), F.lit("[?&]([^=&#]*)"), F.lit(1)), lambda k: F.concat(F.lit("key:"), k))
    parts = [
        F.array(F.concat(F.lit("scheme:"), F.substring_index(url, "://", 1))),
        F.array(F.concat(F.lit("host:"), F.col(host_col))),
        F.transform(labels, lambda x: F.concat(F.lit("label:"), x)),
        F.transform(F.filter(F.split(host_col, "[.-]", -1), lambda x: x != ""), lambda x: F.concat(F.lit("word:"), x)),
        F.transform(segments, lambda s: F.concat(F.lit("path:"), shape(s))),
        F.array(F.concat(F.lit("ending:"), F.regexp_extract(path_col, r"(\.[A-Za-z0-9]+|/)$", 1))),
        keys,
        F.array(F.when(F.col(url).contains("#"), "fragment").otherwise("no fragment")),
    ]
    return F.when(F.col(host_col) == "", F.expr("cast(array() as array<string>)")).otherwise(F.array_sort(F.array_distinct(F.concat(*parts))))


def telling_tokens(rows: DataFrame, least: float) -> DataFrame:
    """token: those in ``least`` rows or more, but not in all; of tokens that are in the same rows (by count and 64-bit hashes) the first."""
    n = rows.count()
    each = rows.select(F.explode("tokens").alias("token"), F.xxhash64("tokens").cast("decimal(38,0)").alias("h"))
    found = each.groupBy("token").agg(F.count("*").alias("n"), F.sum("h").alias("h")).filter((F.col("n") >= least) & (F.col("n") < n))
    return found.groupBy("n", "h").agg(F.min("token").alias("token")).select("token")


def mine(labelled: DataFrame, min_support: float = 0.01, min_rows: int = 20, min_confidence: float = 0.6, min_gain: float = 0.0) -> DataFrame:
    """Rules from rows of tokens (array of distinct strings) and block (boolean): rule id, tokens, confidence, support.

    A combination needs min_support of the rows and min_rows of them;
    min_confidence of its rows must be blocked, and so many that it takes away
    min_gain of what the share of blocked rows in all lacks to 1; and no part of
    it may be as sure. Of tokens that are in the same rows the first stands for
    all; tokens of all rows tell nothing. Rows with a null are left out; too few
    rows give no rules.
    """
    spark = labelled.sparkSession
    schema = "rule long, tokens array<string>, confidence double, support double"
    rows = labelled.filter(F.col("tokens").isNotNull() & F.col("block").isNotNull())
    n, blocked = rows.agg(F.count("*"), F.count_if("block")).first()
    support = max(min_support, min_rows / n) if n else 2.0
    if support > 1:
        return spark.createDataFrame([], schema)
    min_confidence = max(min_confidence, blocked / n + min_gain * (1 - blocked / n))
    # As each is in so many rows, they are at most the tokens of a URL divided by the support.
    telling = spark.sparkContext.broadcast({r["token"] for r in telling_tokens(rows, support * n).collect()})

    def lean(batches):
        for batch in batches:
            kept = [[t for t in row if t in telling.value] + [BLOCK] * b for row, b in zip(values(batch, "tokens"), values(batch, "block"))]
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.list_(pa.string()))], names=["items"])

    items, _ = written(rows.select("tokens", "block").mapInArrow(lean, "items array<string>"), "url-items")
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(items)
    sure = model.associationRules.filter(F.col("consequent") == F.array(F.lit(BLOCK)))
    sure = sure.select(F.array_sort("antecedent").alias("tokens"), "confidence", "support")
    sure, _ = written(sure, "url-rules")
    # A part of a rule has the part's own rarest token: only those are compared, not all rules that share a token.
    often = sure.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count("*").alias("often"))
    parts = sure.select(F.col("tokens").alias("small"), F.col("confidence").alias("small_confidence"), F.explode("tokens").alias("t")).join(often, "t")
    parts = parts.groupBy("small", "small_confidence").agg(F.min_by("t", F.struct("often", "t")).alias("t"))
    larger = sure.select(F.explode("tokens").alias("t"), "tokens", "confidence").join(parts, "t")
    larger = larger.filter((F.size("small") < F.size("tokens")) & (F.col("small_confidence") >= F.col("confidence"))
                           & (F.size(F.array_except("small", "tokens")) == 0)).select("tokens").distinct()
    kept = sure.join(larger, "tokens", "left_anti")
    return kept.select(F.xxhash64("tokens").alias("rule"), "tokens", "confidence", "support")


def matched(urls: DataFrame, rules: DataFrame, tokens_col: str) -> DataFrame:
    """The distinct token sets of urls to which a mined rule applies (column tokens_col)."""
    index = rules.select("rule", F.size("tokens").alias("size"), F.explode("tokens").alias("token"))
    sets = urls.select(tokens_col).distinct().select(tokens_col, F.explode(tokens_col).alias("token"))
    found = sets.join(index, "token").groupBy(tokens_col, "rule").agg(F.count("*").alias("n"), F.first("size").alias("size"))
    return found.filter(F.col("n") == F.col("size")).select(tokens_col).distinct()


def judge(urls: DataFrame, rules: list[tuple[str, str, str]], mined: DataFrame, url_col: str = "url") -> DataFrame:
    """urls with host, path, rule and verdict (`allow` or `block`).

    The longest given rule that fits decides; elsewhere a URL is blocked if a
    mined rule applies and allowed if not. A null URL or one without `://` has
    an empty host and path, no rule, and is allowed. Every row stays, also
    repeated ones; input columns with these names are replaced.
    """
    kept = others(urls, "host", "path", "rule", "verdict")
    out = urls.select(F.struct(*kept).alias("row"), F.col(url_col).cast("string").alias("u"))
    out = out.withColumns({"h": host("u"), "p": path("u")})
    out = out.withColumns({"given": given_rule("h", "p", rules), "tokens": tokens("u", "h", "p")})
    hits = matched(out.filter(F.col("given").isNull()), mined, "tokens").withColumn("hit", F.lit(True))
    out = out.join(hits, "tokens", "left")
    verdict = F.coalesce(F.col("given")["verdict"], F.when(F.col("hit"), "block").otherwise("allow"))
    return out.select("row.*", F.col("h").alias("host"), F.col("p").alias("path"), F.col("given")["rule"].alias("rule"), verdict.alias("verdict"))


def url_tokens(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """urls with their tokens (column tokens, replaced if it is there), as mine takes them."""
    kept = others(urls, "tokens")
    out = urls.select(F.struct(*kept).alias("row"), F.col(url_col).cast("string").alias("u")).withColumns({"h": host("u"), "p": path("u")})
    return out.select("row.*", tokens("u", "h", "p").alias("tokens"))


def labelled_urls(urls: DataFrame, rules: list[tuple[str, str, str]], bad_words: set[str], label_col: str, url_col: str = "url") -> DataFrame:
    """tokens and block (boolean, null if unknown) of urls, as mine takes them.

    A URL is a bad example if its host has one of these words (between dots and
    hyphens); else the given rule that fits says what it is; else label_col.
    """
    out = urls.select(F.col(url_col).cast("string").alias("u"), F.col(label_col).alias("known")).withColumns({"h": host("u"), "p": path("u")})
    bad = F.arrays_overlap(F.split("h", "[.-]", -1), F.array(*map(F.lit, sorted(bad_words)))) if bad_words else F.lit(False)
    ruled = given_rule("h", "p", rules)["verdict"] == "block"
    return out.select(tokens("u", "h", "p").alias("tokens"), F.when(bad, True).otherwise(F.coalesce(ruled, "known")).alias("block"))
