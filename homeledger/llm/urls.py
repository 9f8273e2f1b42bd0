"""URL filter: listed rules first, mined association rules for the rest.

Listed rules name a host and a path; one fits its host and all subdomains if the URL's path
starts with the rule's, and the longest fitting one decides. Rows that a rule decides are the
labelled rows. Over their URL tokens and labels FP-growth finds the frequent combinations;
a combination that goes with one label in at least ``confidence`` of its rows becomes an
association rule, unless a part of it already says so with no less confidence. A URL that no
listed rule fits gets the verdict of the most confident association rule contained in its
tokens, found through an inverted index from each rule's rarest token; without one, ``default``.

Each URL has at most one token per slot (``SLOTS``), so it has under 2^(slots + 1) token
combinations, and a support share s leaves under 2^(slots + 1) / s frequent ones whatever
the number of rows: the table of rules is bounded and may be broadcast.

Column expressions and Spark ML's FPGrowth only. Null URLs and URLs without ``://`` have an
empty host and path and no tokens. Repeated rows and keys are judged row by row. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from homeledger.llm.common import lower_ascii
from homeledger.session import cut_lineage

SUPPORT = 0.005
CONFIDENCE = 0.9
SLOTS = ("scheme", "tld", "site", "sub", "dir", "next", "depth", "ext", "keys", "mark")
Rule = tuple[str, str, str]  # verdict, host, path


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest listed rule that fits, or nulls."""
    name = verdict = F.lit(None).cast("string")
    for what, at, begin in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(begin)
        name, verdict = F.when(fits, at + begin).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def url_tokens(url: Column) -> Column:
    """One token per slot that the URL fills, each with its slot's name."""
    host, path = url_host(url), url_path(url)
    labels, steps = F.split(host, r"\."), F.filter(F.split(path, "/"), lambda s: s != "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    keys = F.array_sort(F.array_distinct(F.transform(F.split(query, "&"), lambda kv: F.substring_index(kv, "=", 1))))
    last = F.get(steps, F.size(steps) - 1)
    values = {
        "scheme": lower_ascii(F.regexp_extract(url, r"^([^:]*)://", 1)),
        "tld": F.get(labels, F.size(labels) - 1),
        "site": F.array_join(F.slice(labels, -2, 2), "."),
        "sub": F.array_join(F.slice(labels, 1, F.greatest(F.size(labels) - 2, F.lit(0))), "."),
        "dir": F.get(steps, F.lit(0)),
        "next": F.substring(F.get(steps, F.lit(1)), 1, 1),
        "depth": F.size(steps).cast("string"),
        "ext": F.regexp_extract(last, r"\.([A-Za-z0-9]+)$", 1),
        "keys": F.array_join(keys, "&"),
        "mark": F.when(F.instr(url, "#") > 0, F.lit("#")),
    }
    values["site"] = F.when(F.size(labels) >= 2, values["site"])
    values["sub"] = F.when(F.size(labels) >= 3, values["sub"])
    filled = F.array(*[F.when(values[s] != "", F.concat(F.lit(s + "="), values[s])) for s in SLOTS])
    return F.when(host != "", F.filter(filled, lambda t: t.isNotNull())).otherwise(F.array().cast("array<string>"))


def mine_rules(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(items, label, hits, confidence) from rows (tokens, label); ``items`` are sorted.

    At most 2^(slots + 1) / support rows.
    """
    mark = F.concat(F.lit("label="), F.col("label"))
    baskets = labelled.select(F.array_append(F.col("tokens"), mark).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    frequent = cut_lineage(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"), "itemsets")
    is_label = lambda t: t.startswith("label=")
    plain = frequent.where(~F.exists("items", is_label)).select("items", F.col("freq").alias("all_hits"))
    with_label = frequent.where(F.exists("items", is_label) & (F.size("items") > 1)).select(
        F.filter("items", lambda t: ~is_label(t)).alias("items"),
        F.expr("substring(filter(items, t -> startswith(t, 'label='))[0], 7)").alias("label"), F.col("freq").alias("hits"))
    rules = cut_lineage(
        with_label.join(plain, "items")
        .select("items", "label", "hits", (F.col("hits").cast("double") / F.col("all_hits")).alias("confidence"))
        .where(F.col("confidence") >= confidence), "rules")
    part = F.explode(F.transform("items", lambda t: F.array_remove("items", t))).alias("part")
    implied = (
        rules.where(F.size("items") > 1).select("items", "label", "confidence", part)
        .join(rules.select(F.col("items").alias("part"), "label", F.col("confidence").alias("less")), ["part", "label"])
        .where(F.col("less") >= F.col("confidence")).select("items", "label").distinct())
    return rules.join(implied, ["items", "label"], "left_anti")


def index_rules(rules: DataFrame, labelled: DataFrame) -> DataFrame:
    """``rules`` under their rarest token ``anchor``; ``token_rows`` counts come from all rows."""
    tokens = labelled.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    parts = rules.select("items", "label", "hits", "confidence", F.explode("items").alias("token"))
    return parts.join(tokens, "token").groupBy("items", "label", "hits", "confidence").agg(
        F.min_by("token", F.struct("n", "token")).alias("anchor"))


def judge(pages: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url", support: float = SUPPORT,
          confidence: float = CONFIDENCE, default: str = "allow") -> DataFrame:
    """Per row: key, host, path, rule, verdict, and for mined verdicts their confidence."""
    host, path = url_host(F.col(url)), url_path(F.col(url))
    read = pages.select(
        F.col(key).alias("k"), F.monotonically_increasing_id().alias("row"), host.alias("host"), path.alias("path"),
        url_tokens(F.col(url)).alias("tokens"))
    name, verdict = listed_rule(F.col("host"), F.col("path"), rules)
    read = cut_lineage(read.withColumns({"rule": name, "label": verdict}), "urls")
    labelled = read.where(F.col("rule").isNotNull())
    index = cut_lineage(index_rules(mine_rules(labelled, support, confidence), labelled), "index")
    best = F.max(F.struct("confidence", "hits", "size", "label")).alias("best")
    found = (
        read.where(F.col("rule").isNull()).select("row", "tokens", F.explode("tokens").alias("anchor"))
        .join(F.broadcast(index.withColumn("size", F.size("items"))), "anchor")
        .where(F.size(F.array_except("items", "tokens")) == 0)
        .groupBy("row").agg(best))
    decided = read.where(F.col("rule").isNotNull()).select(
        F.col("k").alias(key), "host", "path", "rule", F.col("label").alias("verdict"), F.lit(None).cast("double").alias("confidence"))
    rest = read.where(F.col("rule").isNull()).join(found, "row", "left").select(
        F.col("k").alias(key), "host", "path", "rule", F.coalesce("best.label", F.lit(default)).alias("verdict"), "best.confidence")
    return decided.unionByName(rest)
