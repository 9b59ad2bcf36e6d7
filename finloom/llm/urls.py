"""URL filtering: longest fitting host rules, and association rules mined from their verdicts.

DataFrame functions and Spark ML's FP-growth only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.operators.lookup import lookup_join
from finloom.session import materialize

ALLOW, BLOCK = "allow", "block"
#: Items of the two labels; no token of a url holds a blank.
LABELS = {ALLOW: "is allow", BLOCK: "is block"}

#: Mined rules that are sent to every task; more are joined by shuffle.
MOST_SENT = 20_000

_AZ, _az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str]


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _AZ, _az)


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule, written as host and path in one, that fits; null when none does.

    A rule fits its host and the host's subdomains when the path starts with the rule's path. The list
    is a parameter of the program, not data."""
    texts = sorted((text for _, text in rules), key=lambda t: (-len(t), t))
    cases = []
    for text in texts:
        name, _, rest = text.partition("/")
        cases.append(F.when(((host == name) | host.endswith("." + name)) & path.startswith("/" + rest), F.lit(text)))
    return F.coalesce(*cases) if cases else F.lit(None).cast("string")


def tokens_of(url: Column) -> Column:
    """Distinct items of a url: parts of its host by their place from the right, directories and
    words of its path by depth, names of its query parameters, and whether it has a fragment.
    Digits read as 0, so that numbers of a length are one item."""
    host, path = host_of(url), path_of(url)
    plain = lambda c: F.regexp_replace(F.lower(c), "[0-9]", "0")
    parts = F.reverse(F.split(host, r"\."))
    by_place = F.transform(parts, lambda x, k: F.concat(F.lit("h"), k.cast("string"), F.lit(":"), plain(x)))
    steps = F.filter(F.split(path, "/"), lambda x: x != "")
    by_depth = F.transform(steps, lambda x, k: F.concat(F.lit("d"), k.cast("string"), F.lit(":"), plain(x)))
    words = F.transform(F.regexp_extract_all(path, F.lit(r"([A-Za-z]+)"), 1), lambda x: F.concat(F.lit("w:"), F.lower(x)))
    asked = F.coalesce(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), F.lit(""))
    names = F.transform(F.regexp_extract_all(asked, F.lit(r"(?:^|&)([^=&]+)"), 1), lambda x: F.concat(F.lit("q:"), plain(x)))
    mark = F.when(F.contains(url, F.lit("#")), F.array(F.lit("#"))).otherwise(F.array().cast("array<string>"))
    items = F.array_distinct(F.concat(by_place, by_depth, words, names, mark))
    return F.transform(items, lambda x: F.regexp_replace(x, r"\s", "_"))


def mine_rules(labelled: DataFrame, least_support: float, least_confidence: float) -> DataFrame:
    """antecedent (items), verdict, confidence, support and number, from rows (url, verdict).

    Urls with the same items and verdict count once, so a url that fills the table weighs no more
    than another. Items found in exactly the same urls are mined as one, which keeps the number
    of frequent sets small on sites whose urls share a long beginning. Of the frequent sets those
    that predict a verdict with least_confidence stay, unless a part of the set predicts it as
    surely. The mined sets follow the support, not the number of urls."""
    once = labelled.select(tokens_of(F.col("url")).alias("items"), "verdict").distinct().withColumn("number", F.xxhash64("items", "verdict"))
    once = materialize(once, "transactions")
    places = once.select("number", F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("n"), F.sum(F.col("number").cast("decimal(38,0)")).alias("where"))
    alike = places.groupBy("n", "where").agg(F.min("item").alias("item"))
    named = once.select("number", "verdict", F.explode("items").alias("item")).join(alike.select("item"), "item", "left_semi")
    label = F.when(F.col("verdict") == BLOCK, LABELS[BLOCK]).otherwise(LABELS[ALLOW])
    baskets = named.groupBy("number", "verdict").agg(F.collect_set("item").alias("items")).select(F.concat("items", F.array(label)).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=least_support, minConfidence=least_confidence).fit(materialize(baskets, "baskets"))
    back = reduce(lambda c, kv: F.when(F.col("consequent")[0] == kv[1], F.lit(kv[0])).otherwise(c), LABELS.items(), F.lit(None).cast("string"))
    rules = model.associationRules.withColumn("verdict", back).where("verdict IS NOT NULL").where(~F.arrays_overlap("antecedent", F.array(*map(F.lit, LABELS.values()))))
    rules = materialize(rules.select(F.array_sort("antecedent").alias("antecedent"), "verdict", "confidence", "support"), "mined")
    # one item fewer predicts it as surely: the larger set adds nothing
    fewer = rules.withColumn("gone", F.explode("antecedent")).withColumn("part", F.array_remove("antecedent", F.col("gone")))
    smaller = rules.select(F.col("antecedent").alias("part"), F.col("verdict").alias("v"), F.col("confidence").alias("c"))
    useless = fewer.join(smaller, "part").where("v = verdict AND c >= confidence").select("antecedent", "verdict").distinct()
    kept = rules.join(useless, ["antecedent", "verdict"], "left_anti")
    rare = places.select(F.col("item").alias("posting"), F.col("n").alias("found_in"))
    posted = kept.withColumn("posting", F.explode("antecedent")).join(rare, "posting").groupBy("antecedent", "verdict", "confidence", "support")
    return materialize(posted.agg(F.min_by("posting", F.struct("found_in", "posting")).alias("posting")), "rules")


def judge(
    pages: DataFrame, rules: Sequence[Rule], labelled: DataFrame | None = None, otherwise: str = ALLOW,
    least_support: float = 0.01, least_confidence: float = 0.8, id_column: str = "page_id", url_column: str = "url",
) -> DataFrame:
    """The id, host, path, rule, verdict, and mined: the items of the association rule used.

    A fitting rule of `rules` (verdict, text) decides. Other urls are judged by rules mined with
    FP-growth from labelled urls (url, verdict: allow or block); by default the labels are the
    verdicts of `rules` on this table. Each mined rule is posted in an inverted index under its
    rarest item; a url looks up its items and keeps the rules whose items it all has. The most
    confident rule decides, then the one with more support, then block, then the first by items.
    Urls that no rule matches get `otherwise`.

    A null url, and one without ://, has an empty host and path and no items of a host. Repeated
    rows and null ids are judged like any other; other columns are ignored; an empty table gives
    no rows. Each different url is matched once, so a url that fills the table costs one lookup.
    """
    host, path = host_of(F.col(url_column)), path_of(F.col(url_column))
    ruled = fitting_rule(host, path, rules)
    rows = pages.select(F.col(id_column), F.col(url_column).cast("string").alias("url"), host.alias("host"), path.alias("path"), ruled.alias("rule"))
    verdict_of = reduce(lambda c, r: F.when(F.col("rule") == r[1], F.lit(r[0])).otherwise(c), rules, F.lit(None).cast("string"))
    urls = materialize(rows.select("url", "rule").where("url IS NOT NULL").distinct(), "urls")
    if labelled is None:
        labelled = urls.where("rule IS NOT NULL").select("url", verdict_of.alias("verdict"))
    mined = mine_rules(labelled.select("url", "verdict").where("url IS NOT NULL"), least_support, least_confidence)
    index = F.broadcast(mined) if mined.count() <= MOST_SENT else mined
    open_urls = urls.where("rule IS NULL").select("url", tokens_of(F.col("url")).alias("items"))
    looked_up = open_urls.withColumn("posting", F.explode("items")).join(index, "posting").where(F.size(F.array_except("antecedent", "items")) == 0)
    order = F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), (F.col("verdict") != BLOCK).alias("b"), F.col("antecedent").alias("a"), F.col("verdict").alias("v"))
    best = looked_up.groupBy("url").agg(F.min(order).alias("best")).select("url", F.col("best.v").alias("found"), F.col("best.a").alias("mined"))
    judged = lookup_join(rows, best, ["url"], "left")  # spreads a url that fills the table
    return judged.select(F.col(id_column), "host", "path", "rule", F.coalesce(verdict_of, "found", F.lit(otherwise)).alias("verdict"), "mined")
