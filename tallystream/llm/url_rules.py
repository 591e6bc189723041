"""URL filter: given rules first, mined association rules for the rest.

Rules on host and path decide the urls they fit. Their verdicts label those urls, and
Spark's FP-growth mines combinations of url tokens that go with a verdict. The rules
that pass support and confidence judge all other urls; an inverted index from token to
rule finds the candidates, and a rule matches when all its tokens are found. The most
confident matching rule wins, then support, then length, then its text; urls that no
rule matches are allowed.

Every host label, path part and query name is a token of its kind, wherever it stands,
beside scheme, file ending and fragment; the leading places give a second token with the
place. Tokens that stand in exactly the same labelled urls make the same rules, so they
are one item: FP-growth sees the first of them, and a url that has any of them has the
item. That changes no verdict and keeps long urls from multiplying the item sets.

Defined results: null urls and urls without ``://`` have an empty host and path; host
and path are cut as they stand, however long; repeated rows are judged alike; without
labelled urls everything is allowed.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream.llm.common import stored

# Verdict, host, start of the path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    raw = F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), r"\A[^/?#]*", 0)
    return F.translate(raw, UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), r"\A[^/?#]*([^?#]*)", 1)


def _best_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Verdict and text of the longest rule that fits, null without one."""
    chain = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        chain = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule"))).otherwise(chain)
    return chain


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url, each marked with its kind, and with its place where that is a leading one."""
    labels = F.filter(F.reverse(F.split(host, r"\.")), lambda x: x != "")
    digits = lambda x: F.when(x.rlike(r"\A[0-9]+\z"), F.lit("#")).otherwise(x)
    ending = r"\.([A-Za-z0-9]{1,8})\z"
    parts = F.transform(F.filter(F.split(F.regexp_replace(path, ending, ""), "/"), lambda x: x != ""), digits)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    names = F.filter(F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1)), lambda x: x != "")

    def put(mark: str, value: Column) -> Column:
        return F.when(value.isNotNull() & (value != ""), F.concat(F.lit(mark + "="), value))

    def each(mark: str, values: Column) -> Column:
        return F.transform(values, lambda x: F.concat(F.lit(mark + "="), x))

    places = [
        put("scheme", F.lower(F.substring_index(url, "://", 1))),
        put("tld", F.get(labels, F.lit(0))),
        put("domain", F.get(labels, F.lit(1))),
        put("sub", F.get(labels, F.lit(2))),
        put("third", F.get(labels, F.lit(3))),
        put("dir", F.get(parts, F.lit(0))),
        put("leaf", F.get(parts, F.lit(1))),
        put("end", F.regexp_extract(path, ending, 1)),
        put("ask", F.get(names, F.lit(0))),
        put("also", F.get(names, F.lit(1))),
        F.when(F.instr(url, "#") > 0, F.lit("fragment")),
    ]
    kinds = F.concat(each("label", labels), each("part", parts), each("name", names))
    return F.array_distinct(F.concat(F.array_compact(F.array(*places)), kinds))


VERDICTS = ("allow", "block")


def mine(labelled: DataFrame, min_support: float = 0.002, min_confidence: float = 0.8) -> DataFrame:
    """``verdict, tokens, confidence, support`` of mined rules.

    ``labelled`` has ``tokens`` and ``verdict``. A rule is dropped when a shorter one
    with part of its tokens and the same verdict is at least as confident.
    """
    items = labelled.select(F.concat("tokens", F.array(F.concat(F.lit("verdict="), "verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    rules = model.associationRules.where(F.col("consequent")[0].startswith("verdict="))
    rules = rules.select(
        F.substring_index(F.col("consequent")[0], "=", -1).alias("verdict"),
        F.array_sort("antecedent").alias("tokens"),
        "confidence",
        "support",
    )
    return rules.where(~F.exists("tokens", lambda t: t.startswith("verdict=")))


def token_items(labelled: DataFrame, min_support: float) -> DataFrame:
    """``t, item``: for every frequent token the first one that stands in the same labelled rows."""
    sets = labelled.groupBy(F.array_sort("tokens").alias("tokens"), "verdict").agg(F.count("*").alias("n"))
    marks = (F.xxhash64(F.lit(k), "tokens", "verdict").alias(f"h{k}") for k in (1, 2))
    each = sets.select("n", *marks, F.explode("tokens").alias("t"))
    where = each.groupBy("t").agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"), F.sum("n").alias("c"))
    where = where.where(F.col("c") >= labelled.count() * min_support)
    first = where.groupBy("x1", "x2", "c").agg(F.min("t").alias("item"))
    return where.join(first, ["x1", "x2", "c"]).select("t", "item")


def _items(sets: DataFrame, items: DataFrame) -> DataFrame:
    """``set, items`` of distinct token sets; sets without a frequent token are missing."""
    return sets.select("set", F.explode("set").alias("t")).join(items, "t").groupBy("set").agg(F.collect_set("item").alias("items"))


def _pruned(rules: DataFrame) -> DataFrame:
    short = rules.select(F.col("verdict").alias("v2"), F.col("tokens").alias("t2"), F.col("confidence").alias("c2"), F.explode("tokens").alias("t"))
    long_ = rules.select("*", F.explode("tokens").alias("t"))
    beaten = long_.join(short, "t").where((F.col("verdict") == F.col("v2")) & (F.size("t2") < F.size("tokens")) & (F.col("c2") >= F.col("confidence")))
    beaten = beaten.where(F.size(F.array_intersect("tokens", "t2")) == F.size("t2")).select("tokens", "verdict").distinct()
    return rules.join(beaten, ["tokens", "verdict"], "left_anti")


def judge(pages: DataFrame, min_support: float = 0.002, min_confidence: float = 0.8) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page."""
    spark = pages.sparkSession
    cut = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"))
    cut = cut.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = cut.withColumn("given", _best_rule(F.col("host"), F.col("path")))
    tokens = url_tokens(F.col("url"), F.col("host"), F.col("path"))
    labelled = ruled.where("given IS NOT NULL").select(F.array_sort(tokens).alias("tokens"), F.col("given.verdict").alias("verdict"))
    if labelled.limit(1).count():
        labelled = stored(spark, labelled, "url-labelled")
        items = stored(spark, token_items(labelled, min_support), "url-items")
        sets = labelled.withColumnRenamed("tokens", "set")
        has = sets.join(_items(sets.select("set").distinct(), items), "set", "left")
        has = has.select(F.coalesce("items", F.array().cast("array<string>")).alias("tokens"), "verdict")
        mined = stored(spark, mine(stored(spark, has, "url-transactions"), min_support, min_confidence), "url-rules")
        mined = stored(spark, _pruned(mined), "url-rules-pruned")
    else:
        items = spark.createDataFrame([], "t string, item string")
        mined = spark.createDataFrame([], "verdict string, tokens array<string>, confidence double, support double")

    # Equal token sets are judged once: a busy host does not meet the index row by row.
    open_ = ruled.where("given IS NULL").select(F.array_sort(tokens).alias("set")).distinct()
    rules = mined.withColumn("rule_id", F.concat_ws(" ", "tokens")).withColumn("n", F.size("tokens"))
    index = rules.select(F.explode("tokens").alias("t"), "rule_id", "n", "verdict", "confidence", "support")
    met = _items(open_, items).select("set", F.explode("items").alias("t")).join(index, "t")
    matched = met.groupBy("set", "rule_id", "verdict").agg(
        F.count("*").alias("found"), F.first("n").alias("n"), F.first("confidence").alias("confidence"), F.first("support").alias("support")
    ).where("found = n")
    best = F.max(F.struct("confidence", "support", "n", "rule_id", "verdict")).alias("best")
    judged = matched.groupBy("set").agg(best).select("set", F.col("best.verdict").alias("mined"))

    plain = ruled.withColumn("set", F.when(F.col("given").isNull(), F.array_sort(tokens)))
    out = plain.join(judged, "set", "left")
    return out.select("page_id", "host", "path", F.col("given.rule").alias("rule"), F.coalesce("given.verdict", "mined", F.lit("allow")).alias("verdict"))
