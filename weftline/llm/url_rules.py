"""URL filter from association rules.

URLs are cut into tokens (scheme, host suffixes, path segments, query keys; digits folded). Tokens that are in exactly the
same labelled rows, as those of one URL template are, count as one item. FP-growth mines item
combinations on all labelled rows, with the label ``bad`` as one more item; its counts give support and confidence of each
combination, and only rules above both thresholds remain; a rule that contains a shorter rule goes. A rule is a list of sets of
tokens, and a URL fits it that has a token of each set. Matching is an inverted index: every rule is filed under the tokens of its
rarest item, URLs look up their tokens, and only the rules found that way are compared in full.

Cases: a null URL, or one without ``://``, has an empty host and path and no tokens; no rule fits it. A label that is null
is left out. Without labelled rows, or without rules above the thresholds, every URL is allowed. Repeated URLs are judged
once and the verdict is joined back to every row. URLs are read whole, whatever their length. Other columns pass through;
columns of the input named host, path, rule, verdict or confidence are replaced by those of the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from weftline.session import materialise


BAD = "label:bad"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fixed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest (verdict, host, path) that fits a host, its subdomains and a path prefix."""
    by_length = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    case = F.when(F.lit(False), F.struct(F.lit("").alias("rule"), F.lit("").alias("verdict")))
    for verdict, rule_host, rule_path in by_length:
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        case = case.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict")))
    return case


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL; null for a URL without host."""
    u = F.coalesce(url, F.lit(""))
    fold = lambda c: F.regexp_replace(F.lower(c), "[0-9]+", "0")
    scheme = F.array(F.concat(F.lit("scheme:"), F.lower(F.regexp_extract(u, r"(?s)^(.*?)://", 1))))
    labels = F.split(fold(host_of(u)), r"\.")
    hosts = F.transform(labels, lambda x: F.concat(F.lit("host:"), x))
    segments = F.transform(
        F.filter(F.split(fold(path_of(u)), "/"), lambda x: x != ""), lambda x: F.concat(F.lit("path:"), x)
    )
    query = F.regexp_extract(u, r"(?s)^[^?#]*\?([^#]*)", 1)
    keys = F.transform(
        F.filter(F.split(fold(query), "&"), lambda x: x != ""),
        lambda x: F.concat(F.lit("query:"), F.substring_index(x, "=", 1)),
    )
    return F.when(host_of(u) != "", F.array_distinct(F.concat(scheme, hosts, segments, keys)))


def _items(rows: DataFrame, at_least: Column) -> DataFrame:
    """(token, item, n_tokens) of all tokens in ``at_least`` rows or more; tokens with equal sets of rows share an item.

    Equal sets have equal row numbers and equal combined hashes of their distinct token lists. What has equal hashes is then checked
    list by list, and tokens that fail become items of their own. Tokens are at most the tokens of a row over the support share.
    """
    lists = materialise(rows.groupBy("tokens").agg(F.count("*").alias("n")), "url-token-lists")
    held = lists.select(F.explode("tokens").alias("token"), "n", *[F.xxhash64("tokens", F.lit(i)).alias(f"h{i}") for i in (0, 1)])
    marks = held.groupBy("token").agg(F.sum("n").alias("n"), F.bit_xor("h0").alias("h0"), F.bit_xor("h1").alias("h1"))
    marks = materialise(marks.where(F.col("n") >= at_least), "url-token-marks")
    sets = marks.groupBy("n", "h0", "h1").agg(F.min("token").alias("item"), F.count("*").alias("n_tokens"))
    items = materialise(marks.join(sets, ["n", "h0", "h1"]).select("token", "item", "n_tokens"), "url-token-items")
    met = held.join(items.where(F.col("n_tokens") > 1), "token").groupBy("item", "h0", "h1", "n_tokens").agg(F.count("*").alias("n_met"))
    unequal = met.where(F.col("n_met") != F.col("n_tokens")).select("item").distinct().withColumn("unequal", F.lit(True))
    own = F.when(F.col("unequal"), F.col("token")).otherwise(F.col("item"))
    return materialise(items.join(unequal, "item", "left").select("token", own.alias("item")), "url-items")


def mine_rules(labelled: DataFrame, min_support: float = 0.002, min_confidence: float = 0.6) -> DataFrame:
    """Rules (rule, anchors, confidence, support) from rows of (url, bad); ``anchors`` is the rarest set of the rule.

    Support is the share of all labelled rows that have the tokens and
    are bad; confidence is the share of bad rows among those that have the tokens.
    """
    rows = labelled.select(tokens_of(F.col("url")).alias("tokens"), F.col("bad").cast("boolean").alias("bad")).where(
        F.col("tokens").isNotNull() & F.col("bad").isNotNull()
    )
    rows = materialise(rows, "url-labelled")
    whole = rows.agg(F.count("*")).scalar()
    # A little less, so that rounding does not lose a rule at the threshold itself.
    share = min_support * (1 - 1e-9)
    items = _items(rows, whole * F.lit(share))
    merged = (
        rows.select("tokens").distinct().select("tokens", F.explode("tokens").alias("token"))
        .join(items, "token")
        .groupBy("tokens")
        .agg(F.collect_set("item").alias("items"))
    )
    # Rows without a frequent token still count as rows.
    found = rows.join(merged, "tokens", "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    baskets = found.select(F.when(F.col("bad"), F.array_append("items", F.lit(BAD))).otherwise(F.col("items")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=share).fit(baskets)
    mined = materialise(model.freqItemsets, "url-itemsets")
    bad = mined.where(F.array_contains("items", BAD)).select(
        F.array_sort(F.array_remove("items", BAD)).alias("rule"), F.col("freq").alias("n_bad")
    )
    counts = mined.select(F.array_sort("items").alias("rule"), F.col("freq").alias("n"))
    counted = (
        bad.join(counts, "rule")
        .where((F.col("n_bad") >= whole * F.lit(min_support)) & (F.col("n_bad") >= min_confidence * F.col("n")))
        .select("rule", (F.col("n_bad") / F.col("n")).alias("confidence"), (F.col("n_bad") / whole).alias("support"))
    )
    shortest = _shortest(materialise(counted, "url-counted"))
    # Each item of a rule is an item set of its own; its tokens come from one URL, so they are few.
    frequency = counts.where(F.size("rule") == 1).select(F.element_at("rule", 1).alias("item"), "n")
    sets = items.groupBy("item").agg(F.array_sort(F.collect_set("token")).alias("set")).join(frequency, "item")
    spelled = (
        shortest.select("rule", "confidence", "support", F.explode("rule").alias("item"))
        .join(sets, "item")
        .groupBy("rule", "confidence", "support")
        .agg(F.array_sort(F.collect_list("set")).alias("sets"), F.min_by("set", F.struct("n", "item")).alias("anchors"))
    )
    # Written, so that Spark knows the size of the rule index and broadcasts it if it is small.
    return materialise(spelled.select(F.col("sets").alias("rule"), "anchors", "confidence", "support"), "url-rules")


def spelled_out(rules: DataFrame) -> DataFrame:
    """Rules (rule, confidence, support) with one token of each set, in every combination; for reading, not for matching."""
    none = F.array(F.array().cast("array<string>"))
    add = lambda so_far, tokens: F.flatten(
        F.transform(so_far, lambda head: F.transform(tokens, lambda t: F.array_append(head, t)))
    )
    each = F.explode(F.aggregate("rule", none, add)).alias("rule")
    return rules.select(each, "confidence", "support").withColumn("rule", F.array_sort("rule"))


def _fitting(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Inverted index: each URL meets the rules filed under one of its tokens, and keeps those with a token of it in each set."""
    filed = rules.withColumn("anchor", F.explode("anchors"))
    met = urls.withColumn("anchor", F.explode("tokens")).join(filed, "anchor")
    return met.where(F.forall("rule", lambda tokens: F.arrays_overlap(tokens, F.col("tokens"))))


def _shortest(rules: DataFrame) -> DataFrame:
    """Rules that contain no shorter rule: a shorter one blocks the same URLs already."""
    inner = rules.select(F.col("rule").alias("within"), F.element_at("rule", 1).alias("anchor"))
    longer = (
        rules.select("rule", F.explode("rule").alias("anchor"))
        .join(inner, "anchor")
        .where((F.size("within") < F.size("rule")) & (F.size(F.array_except("within", "rule")) == 0))
        .select("rule")
        .distinct()
    )
    return rules.join(longer, "rule", "left_anti")


def judge(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct URLs that a mined rule blocks, with the highest confidence among its rules."""
    distinct = urls.select("url").distinct().select("url", tokens_of(F.col("url")).alias("tokens"))
    return _fitting(distinct, rules).groupBy("url").agg(F.max("confidence").alias("confidence"))


def filter_urls(pages: DataFrame, labelled: DataFrame, fixed: Sequence[tuple[str, str, str]], **thresholds) -> DataFrame:
    """``pages`` with host, path, rule and verdict: the longest fixed rule decides, else the mined rules."""
    blocked = judge(pages, mine_rules(labelled, **thresholds))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    named = pages.drop("host", "path", "rule", "verdict", "confidence").join(blocked, "url", "left")
    named = named.withColumns({"host": host, "path": path}).withColumn("__fixed", fixed_rule(F.col("host"), F.col("path"), fixed))
    mined = F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return named.withColumns(
        {"rule": F.col("__fixed.rule"), "verdict": F.coalesce(F.col("__fixed.verdict"), mined)}
    ).drop("__fixed")
