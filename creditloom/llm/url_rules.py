"""URL filters by association rules.

A list of rules (host, path) judges the URLs that it fits. Those verdicts are labels: a
frequent-pattern tree over all judged URLs mines token combinations that go with a blocked
page. Tokens that merely restate a rule take no part, tokens that always come together are one
item, and a combination must go with blocked pages of several hosts. The combinations with
enough support and confidence, without what a shorter one already says, judge the URLs that no
rule fits. A combination is looked up by its rarest item in an inverted index and then checked
in full.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import ascii_lower, meet, text_of
from creditloom.sources.staging import stage

#: The rules of the contract.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.8
MIN_HOSTS = 3
"""A combination holds on blocked pages of so many hosts at least, to say more than a host's name."""
COMMON = 0.95
BLOCK = "verdict=block"
INDEX = "need array<string>, index string, confidence double, support double"
ITEMS = "token string, item string, n long"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(text_of(url), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(text_of(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge_by_rules(rows: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Add ``rule`` and ``ruled``: the longest rule that fits, or null.

    A rule fits its host and all its subdomains if the path starts with the rule's path. The
    first of equally long rules wins. The list is a parameter, short enough for one
    expression.
    """
    name = verdict = F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = (
            (F.col("host") == host) | F.endswith(F.col("host"), F.lit(f".{host}"))
        ) & F.startswith(F.col("path"), F.lit(path))
        name = F.when(fits, F.lit(host + path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rows.withColumn("rule", name).withColumn("ruled", verdict)


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: the host's last one and two labels, its other labels, path words,
    and query keys.

    Digits count as one token, so that no page is known by its number.
    """
    labels = F.split(host, "\\.")
    own = F.transform(
        F.slice(labels, 1, F.greatest(F.lit(0), F.size(labels) - 2)),
        lambda x: F.concat(F.lit("label:"), x),
    )
    ends = F.array(*[F.concat(F.lit("end:"), F.substring_index(host, ".", -n)) for n in (1, 2)])
    words = F.transform(
        F.regexp_extract_all(ascii_lower(path), F.lit(r"[^/._-]+"), 0),
        lambda w: F.concat(F.lit("path:"), F.regexp_replace(w, "[0-9]+", "0")),
    )
    query = F.regexp_extract(ascii_lower(text_of(url)), r"(?s)\?([^#]*)", 1)
    keys = F.transform(
        F.regexp_extract_all(query, F.lit(r"(?:^|&)([^=&]+)"), 1),
        lambda k: F.concat(F.lit("key:"), k),
    )
    return F.array_sort(F.array_distinct(F.concat(ends, own, words, keys)))


def restated(rules: Sequence[tuple[str, str, str]]) -> list[str]:
    """The tokens that the hosts and paths of the rules have themselves."""
    found = set()
    for _, host, path in rules:
        labels = host.split(".")
        found |= {"end:" + ".".join(labels[-n:]) for n in (1, 2)}
        found |= {f"label:{x}" for x in labels[:-2]}
        found |= {f"path:{re.sub('[0-9]+', '0', w)}" for w in re.findall("[^/._-]+", path.lower())}
    return sorted(found)


def fold(
    judged: DataFrame, rules: Sequence[tuple[str, str, str]], min_support: float, total: int
) -> DataFrame:
    """The ``item`` that stands for each frequent ``token``, staged, with its number ``n`` of URLs.

    Tokens that the same judged URLs have are one item, named after the first of them. Two
    sums of hashes tell the sets of URLs apart. At most 1 / ``min_support`` times the mean number
    of tokens of a URL are frequent.
    """
    known = restated(rules)
    each = judged.select(F.xxhash64("row").alias("a"), F.xxhash64("row", F.lit(1)).alias("b"), "tokens")
    each = each.select("a", "b", F.explode("tokens").alias("token"))
    sums = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in "ab"]
    counts = each.filter(~F.col("token").isin(known)).groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), *sums
    )
    often = (F.col("n") >= min_support * total) & (F.col("n") < COMMON * total)
    counts = stage(counts.filter(often), "url-tokens")
    items = counts.groupBy("n", "a", "b").agg(
        F.min("token").alias("item"), F.collect_list("token").alias("tokens")
    )
    return stage(items.select(F.explode("tokens").alias("token"), "item", "n"), "url-items")


def items_of(rows: DataFrame, key: str, items: DataFrame) -> DataFrame:
    """``key`` and the sorted ``items`` of rows with ``tokens``; rows without any are left out."""
    each = rows.select(key, F.explode("tokens").alias("token"))
    met = each.join(F.broadcast(items.select("token", "item")), "token")
    return met.groupBy(key).agg(F.array_sort(F.collect_set("item")).alias("items"))


def mine(
    judged: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_hosts: int = MIN_HOSTS,
) -> tuple[DataFrame, DataFrame]:
    """Combinations of items that go with a blocked URL, and the items; staged tables.

    ``judged`` has ``row`` (names it), ``host``, ``tokens`` and ``ruled`` (block or allow).
    Columns of the first: ``need`` (sorted items), ``index`` (the rarest of them),
    ``confidence`` and ``support``; of the second: ``token``, ``item`` and ``n``. A combination
    is left out if a part of it is already one. Tokens that nearly every URL has say nothing
    and take no part.
    """
    spark = judged.sparkSession
    total = judged.count()
    if total == 0:
        return spark.createDataFrame([], INDEX), spark.createDataFrame([], ITEMS)
    items = fold(judged, rules, min_support, total)
    label = F.when(F.col("ruled") == "block", F.array(F.lit(BLOCK))).otherwise(
        F.array().cast("array<string>")
    )
    held = stage(
        judged.select("row", "host", label.alias("label"))
        .join(items_of(judged, "row", items), "row", "left")
        .select("host", "label", F.coalesce("items", F.array().cast("array<string>")).alias("items")),
        "url-baskets",
    )
    model = FPGrowth(itemsCol="all", minSupport=min_support, minConfidence=min_confidence).fit(
        held.select(F.concat("items", "label").alias("all"))
    )
    found = stage(
        model.associationRules.filter(
            (F.size("consequent") == 1) & (F.col("consequent")[0] == BLOCK)
        ).select(F.array_sort("antecedent").alias("need"), "confidence", "support"),
        "url-rules",
    )
    counts = F.broadcast(items.select(F.col("item").alias("index"), "n").distinct())
    rare = (
        found.select("need", F.explode("need").alias("index"))
        .join(counts, "index")
        .groupBy("need")
        .agg(F.min(F.struct("n", "index")).alias("rare"))
    )
    found = found.join(rare, "need").select(
        "need", F.col("rare.index").alias("index"), "confidence", "support"
    )
    found = stage(found, "url-indexed")
    blocked = held.filter(F.size("label") > 0).select("host", "items").distinct()
    hosts = matches(blocked.select(F.col("host").alias("key"), "items"), found)
    wide = hosts.groupBy("need").agg(F.count_distinct("key").alias("hosts"))
    found = stage(
        found.join(wide.filter(F.col("hosts") >= min_hosts), "need").drop("hosts"), "url-wide"
    )
    # Rules that hold all items of a shorter one.
    inside = matches(found.select(F.col("need").alias("key"), F.col("need").alias("items")), found)
    implied = inside.filter(F.size("need") < F.size("key")).select(F.col("key").alias("need"))
    return stage(found.join(implied.distinct(), "need", "left_anti"), "url-index"), items


def matches(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """``key`` of item sets (``key``, ``items``) with each combination ``need`` that they hold.

    The inverted index has one entry per item with all rules indexed under it, so a set
    meets each entry once.
    """
    entries = rules.groupBy("index").agg(F.collect_list("need").alias("needs"))
    hits = sets.select("key", "items", F.explode("items").alias("index")).join(entries, "index")
    held = F.filter("needs", lambda need: F.size(F.array_except(need, F.col("items"))) == 0)
    return hits.select("key", F.explode(held).alias("need"))


def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_hosts: int = MIN_HOSTS,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every page.

    The verdict is the rule's, or for URLs without one that of the mined combinations:
    block if any holds, else allow. One row per input row; null URLs have empty parts and
    are allowed. Other columns are ignored. URLs of equal tokens are matched once, and long
    ones cost what their frequent tokens do that do not always come together.
    """
    url = F.col("url").cast("string")
    split = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        url.alias("url"),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
    )
    judged = judge_by_rules(split, rules).withColumn(
        "tokens", tokens(F.col("url"), F.col("host"), F.col("path"))
    )
    judged = judged.withColumns(
        {"key": F.array_join("tokens", " "), "row": F.monotonically_increasing_id()}
    )
    judged = stage(judged.drop("url"), "urls")
    mined, items = mine(
        judged.filter(F.col("ruled").isNotNull()), rules, min_support, min_confidence, min_hosts
    )
    judged_rows = judged.select("page_id", "host", "path", "rule", "ruled", "key")
    ruled = judged_rows.filter(F.col("ruled").isNotNull()).withColumn("blocked", F.lit(False))
    open_rows = judged_rows.filter(F.col("ruled").isNull())
    sets = (
        judged.filter(F.col("ruled").isNull())
        .groupBy("key")
        .agg(F.first("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    )
    sets = stage(sets, "url-sets")
    facts = stage(
        matches(items_of(sets, "key", items), mined)
        .select("key")
        .distinct()
        .join(sets.select("key", "rows"), "key")
        .withColumn("blocked", F.lit(True)),
        "url-blocked",
    )
    met = meet(open_rows, facts, ["key"], "rows", judged.count()).drop("rows")
    verdict = F.coalesce("ruled", F.when(F.col("blocked"), "block").otherwise("allow"))
    return ruled.unionByName(met).select(
        "page_id", "host", "path", "rule", verdict.alias("verdict")
    )
