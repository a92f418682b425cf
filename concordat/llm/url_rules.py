"""URL filter: stated host and path rules first, then association rules that FP-growth mines from what they label.

Everything is a DataFrame operation. The items of a URL are its host labels, path segments and query keys; a number
counts as one item whatever its digits. Transactions of labelled URLs carry their verdict as one more item. Rules whose
consequent is a verdict are kept at the given support and confidence, if the lower bound of their confidence exceeds
the share of the verdict where they do not apply, and indexed by their rarest item.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VERDICT = "verdict="

#: (action, host, path); a rule fits its host and all subdomains where the path starts with the rule's.
Rule = tuple[str, str, str]


def url_host(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z in lower case; empty without ://."""
    host = F.regexp_extract(F.substring(url, F.instr(url, "://") + 3, F.length(url)), r"^[^/?#]*", 0)
    return F.when(F.instr(url, "://") > 0, F.translate(host, UPPER, LOWER)).otherwise(F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ? # or the end; empty without ://."""
    path = F.regexp_extract(F.substring(url, F.instr(url, "://") + 3, F.length(url)), r"^[^/?#]*([^?#]*)", 1)
    return F.when(F.instr(url, "://") > 0, path).otherwise(F.lit(""))


def _first_fit(rules: Sequence[Rule], host: Column, path: Column, give) -> Column:
    """What give says of the longest rule that fits, else null; of equally long ones the first stated."""
    found = [
        F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.lit(give((action, h, p))))
        for action, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))
    ]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def url_items(url: Column, host: Column, path: Column) -> Column:
    """Distinct items of a URL, sorted."""
    labels = F.transform(F.filter(F.split(host, r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("host:"), x))
    segments = F.transform(
        F.filter(F.split(path, "[/._-]"), lambda x: x != ""),
        lambda x: F.concat(F.lit("path:"), F.regexp_replace(x, "[0-9]+", "0")))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    keys = F.transform(
        F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("query:"), F.regexp_extract(x, "^[^=]*", 0)))
    return F.array_sort(F.array_distinct(F.concat(labels, segments, keys)))


def stated_items(rules: Sequence[Rule]) -> list[str]:
    """The host labels and path segments that the stated rules name, as items."""
    hosts = [f"host:{x}" for _, h, _ in rules for x in h.split(".") if x]
    return sorted({*hosts, *(f"path:{re.sub('[0-9]+', '0', x)}" for _, _, p in rules for x in re.split("[/._-]", p) if x)})


def lower_bound(share: Column, n: Column, z: float) -> Column:
    """Wilson's lower bound of a share seen in n cases: a share of 1 is worth little in three cases and much in 200."""
    spread = z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))
    return (share + z * z / (2 * n) - spread) / (1 + z * z / n)


def mine_rules(
    labelled: DataFrame, min_support: float, min_confidence: float, stated: Sequence[str] = (), z: float = 1.96
) -> DataFrame:
    """(items, said, bound, confidence, support) of the rules that FP-growth finds in labelled(items, verdict).

    bound is the lower bound of the confidence (z: standard errors); it has to exceed the verdict's share among the
    other labelled rows, those without all of the rule's items. A rule that has no others says nothing.
    Items in stated are left out: they agree with the labels of the stated rules by construction, alone or beside any other.
    """
    rest = F.array_except("items", F.array(*map(F.lit, stated)).cast("array<string>"))
    labelled = labelled.select(rest.alias("items"), "verdict").where(F.size("items") > 0)
    baskets = labelled.select(F.array_append("items", F.concat(F.lit(VERDICT), "verdict")).alias("items"))
    rules = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets).associationRules
    total = baskets.count()
    # Counts of rows, whole numbers again: with the rule's items, with its verdict too, with its verdict at all.
    hits = F.round(F.col("support") * total)
    seen, all_said = F.round(hits / F.col("confidence")), F.round(F.col("confidence") / F.col("lift") * total)
    others = F.try_divide(all_said - hits, total - seen)
    said, bound = F.col("consequent")[0], lower_bound(F.col("confidence"), seen, z)
    return rules.where((bound > others) & said.startswith(VERDICT) & ~F.exists("antecedent", lambda x: x.startswith(VERDICT))).select(
        F.col("antecedent").alias("items"), F.substring(said, len(VERDICT) + 1, 99).alias("said"), bound.alias("bound"), "confidence", "support")


def filter_urls(
    pages: DataFrame, rules: Sequence[Rule], min_support: float = 0.002, min_confidence: float = 0.9, default: str = "allow",
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """One row per page: page_id, host, path, rule (host and path of the stated rule, else null), verdict, and items.

    The hosts and paths of the stated rules are not mined. Without a stated rule the mined rule with the highest lower
    bound of its confidence decides; ties go to the higher support, then to more items, then to block. Without any the default holds, as for a null URL or one without ://. Rows are neither merged
    nor dropped; a null id stays null; an empty table gives no rows; with no labelled page nothing is mined.
    """
    url = F.col(url_col)
    parts = pages.select(F.col(id_col).alias("page_id"), url.alias("url"), url_host(url).alias("host"), url_path(url).alias("path"))
    judged = parts.select(
        "page_id", "host", "path", _first_fit(rules, F.col("host"), F.col("path"), lambda r: r[1] + r[2]).alias("rule"),
        _first_fit(rules, F.col("host"), F.col("path"), lambda r: r[0]).alias("stated"),
        url_items(F.col("url"), F.col("host"), F.col("path")).alias("items"))
    # Equal URLs shapes are judged once: what follows grows with the distinct item sets.
    labelled = judged.where(F.col("stated").isNotNull() & (F.size("items") > 0)).select("items", F.col("stated").alias("verdict"))
    if labelled.isEmpty():
        return judged.select("page_id", "host", "path", "rule", F.coalesce("stated", F.lit(default)).alias("verdict"), "items")
    mined = mine_rules(labelled, min_support, min_confidence, stated_items(rules))
    sets = judged.where(F.col("stated").isNull() & (F.size("items") > 0)).groupBy("items").agg(F.count("*").alias("n"))
    uses = sets.select(F.explode("items").alias("item"), "n").groupBy("item").agg(F.sum("n").alias("uses"))
    # Each rule is listed under its rarest item, so a common item brings up few rules.
    listed = mined.select("*", F.explode("items").alias("item")).join(uses, "item").groupBy("items", "said", "bound", "support").agg(
        F.min(F.struct("uses", "item")).alias("key"), F.count("*").alias("known"))
    index = listed.where(F.col("known") == F.size("items")).select(
        F.col("key.item").alias("item"), F.col("items").alias("needs"), "said", "bound", "support")
    hits = sets.select("items", F.explode("items").alias("item")).join(index, "item").where(F.size(F.array_except("needs", "items")) == 0)
    best = hits.groupBy("items").agg(F.max(F.struct("bound", "support", F.size("needs").alias("width"), "said")).alias("best"))
    verdicts = best.select(F.col("items").alias("set_items"), F.col("best.said").alias("mined"))
    return judged.join(verdicts, F.col("stated").isNull() & (F.col("items") == F.col("set_items")), "left").select(
        "page_id", "host", "path", "rule", F.coalesce("stated", "mined", F.lit(default)).alias("verdict"), "items")
