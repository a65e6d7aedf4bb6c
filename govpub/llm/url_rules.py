r"""URL filtering by association rules, with DataFrame and SQL functions only.

A URL becomes a set of tokens (host, site, subdomain, path words, ending, query keys, fragment). Labelled pages are the
transactions; Spark's FP-growth finds the token combinations that are frequent with the item `bad`; rules from a
combination to `bad` stay if they have the support, the confidence and the lift asked for and no more general rule
remains. Before mining

* tokens on too few bad pages go, as no combination with them has the support;
* a token that alone is a rule goes into the rule list and out of the transactions: every combination with it is less general;
* tokens of exactly the same labelled pages become one class, mined as one item: any of them says the same, and without
  this each of them would double the number of combinations (a host, its site and the keys its pages share).

A rule is a set of classes and holds for a page that has a token of each. Rules are matched by an inverted index: each is
filed under its rarest class in the corpus, a page looks up its classes and then tests whether all of the rule are present. The
same index finds the more general rules.

Listed prefixes (host and path) come first: a page that one fits takes the verdict of the longest.

Defined results: a null URL or one without `://` has an empty host and path and no tokens, no rule fits it and it is
allowed; pages without a label teach nothing; repeated labels of a document count once, a document is bad if any of
them says so; without labelled pages there are no rules; repeated pages are judged one by one; extra columns are not
read.

Scale: pages are scanned once, only tokens travel. FP-growth distributes its conditional trees by item. A host
with a third of all pages is one token like others: it costs its pages one row per rule filed under it, and rules are few, as each
needs `min_pages` bad pages. What still multiplies combinations are many tokens that each say little about `bad`, lie on
different pages and occur together often; nothing is cut off then.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from govpub.llm.base import staged

#: Listed prefixes and their verdicts.
LISTED = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
          ("net/fr/", "block")]
#: Least number of labelled pages that are bad and hold the combination; least confidence and lift.
MIN_PAGES, MIN_CONFIDENCE, MIN_LIFT = 10, 0.5, 1.2
BAD = "bad"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str | Column) -> tuple[Column, Column, Column]:
    """Host, path and what follows the path."""
    url = F.col(url) if isinstance(url, str) else url
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substr(rest, F.length(host) + 1)
    path = F.regexp_extract(tail, r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path, F.substr(tail, F.length(path) + 1)


def tokens(host: Column, path: Column, tail: Column) -> Column:
    """Distinct tokens of a URL."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    words = F.filter(F.split(path, "/"), lambda s: (s != "") & ~s.rlike(r"^[0-9]+([.].*)?$"))
    keys = F.filter(F.transform(F.split(F.regexp_extract(tail, r"^\?([^#]*)", 1), "&"),
                                lambda kv: F.substring_index(kv, "=", 1)), lambda k: k != "")
    name = lambda mark, c: F.concat(F.lit(mark), c)
    ending = F.regexp_extract(path, r"[.]([A-Za-z0-9]+)$", 1)
    found = F.concat(
        F.array(name("host=", host)),
        F.when(n > 2, F.array(name("site=", F.array_join(F.slice(labels, -2, 2), ".")),
                              name("sub=", F.element_at(labels, 1)))).otherwise(F.array().cast("array<string>")),
        F.transform(words, lambda s: name("path=", s)),
        F.when(ending != "", F.array(name("ending=", ending))).otherwise(F.array().cast("array<string>")),
        F.when(path.endswith("/"), F.array(F.lit("slash"))).otherwise(F.array().cast("array<string>")),
        F.transform(keys, lambda k: name("key=", k)),
        F.when(F.contains(tail, F.lit("#")), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(found)))


def listed_rule(host: Column, path: Column, listed: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest listed prefix that fits, and its verdict. The list is a short parameter."""
    rule = verdict = F.lit(None).cast("string")
    for prefix, says in sorted(listed, key=lambda x: (len(x[0]), x[0])):
        of, slash, rest = prefix.partition("/")
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, prefix).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def parsed(pages: DataFrame, listed: list[tuple[str, str]] = LISTED) -> DataFrame:
    """row, page_id, host, path, rule, listed verdict and tokens."""
    host, path, tail = host_and_path("url")
    rule, verdict = listed_rule(F.col("host"), F.col("path"), listed)
    return pages.select("page_id", host.alias("host"), path.alias("path"), tail.alias("tail")).select(
        F.monotonically_increasing_id().alias("row"), "page_id", "host", "path", rule.alias("rule"),
        verdict.alias("listed"), tokens(F.col("host"), F.col("path"), F.col("tail")).alias("tokens"))


def bad_documents(labels: DataFrame) -> DataFrame:
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    return labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(bad.cast("int")).alias("bad"))


def transactions(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """row, tokens, bad of the labelled pages. The number in a path names the document whose label the page has."""
    number = F.expr("try_cast(regexp_extract(path, '^/[a-z]+/([0-9]+)', 1) as bigint)")
    return pages.where(F.size("tokens") > 0).select("row", number.alias("doc_id"), "tokens").join(
        bad_documents(labels), "doc_id").select("row", "tokens", "bad")


def token_classes(taught: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """token, class, n, b: tokens on enough bad pages, with the class of those on the same pages (its first token),
    and its numbers of pages and of bad pages. Page sets are compared by count and two 64 bit sums."""
    h = F.xxhash64("row").cast("decimal(38,0)")
    g = F.xxhash64(F.lit("g"), F.col("row"))
    seen = taught.select("row", "bad", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bad").alias("b"), F.sum(h).alias("h"), F.bit_xor(g).alias("g")).where(
        F.col("b") >= min_pages)
    named = seen.groupBy("n", "b", "h", "g").agg(F.min("token").alias("class"))
    return seen.join(named, ["n", "b", "h", "g"]).select("token", "class", "n", "b")


def filed(rules: DataFrame, frequency: DataFrame) -> DataFrame:
    """combination, class: every rule under its rarest class. `frequency` has class and n."""
    each = rules.select("combination", F.explode("combination").alias("class")).join(frequency, "class")
    return each.groupBy("combination").agg(F.min(F.struct("n", "class")).alias("m")).select(
        "combination", F.col("m.class").alias("class"))


def mined_rules(taught: DataFrame, classes: DataFrame, min_pages: int = MIN_PAGES,
                min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT) -> DataFrame:
    """combination (sorted classes), confidence, support: the most general rules to `bad`."""
    total = taught.agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad")).first()
    schema = "combination array<string>, confidence double, support double"
    if not total["bad"]:
        return taught.sparkSession.createDataFrame([], schema)
    n, share = total["n"], total["bad"] / total["n"]
    whole = classes.where("token = class").withColumn("confidence", F.col("b") / F.col("n"))
    good = (F.col("confidence") >= min_confidence) & (F.col("confidence") / share >= min_lift)
    single = whole.where(good).select(F.array("class").alias("combination"), "confidence",
                                      (F.col("b") / n).alias("support"))
    open_ = whole.where(~good).select("class", F.lit(True).alias("open"))
    used = classes.select("token", "class").join(open_, "class")
    spread = taught.select("row", F.explode("tokens").alias("token")).join(used, "token")
    sets = spread.groupBy("row").agg(F.collect_set("class").alias("items"))  # tokens of one URL
    items = staged(taught.join(sets, "row", "left").select(F.concat(
        F.coalesce("items", F.array().cast("array<string>")),
        F.when(F.col("bad") == 1, F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))).alias("items")), "items")
    # the support is a number of pages; half a page less keeps the share from rounding above it
    model = FPGrowth(itemsCol="items", minSupport=(min_pages - 0.5) / n, minConfidence=min_confidence).fit(items)
    joint = model.associationRules.where(
        (F.size("consequent") == 1) & (F.col("consequent")[0] == BAD) & (F.col("lift") >= min_lift)).select(
            F.array_sort("antecedent").alias("combination"), "confidence", "support")
    rules = staged(joint, "rules")
    index = filed(rules, rules.select(F.explode("combination").alias("class")).groupBy("class").agg(
        F.count(F.lit(1)).alias("n"))).withColumnRenamed("combination", "general")
    wider = rules.select("combination", F.explode("combination").alias("class")).join(index, "class").where(
        (F.size("general") < F.size("combination")) & (F.size(F.array_except("general", "combination")) == 0))
    return rules.join(wider.select("combination").distinct(), "combination", "left_anti").unionByName(single)


def fired(pages: DataFrame, rules: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows of the pages that hold a token of every class of a rule."""
    asked = classes.join(rules.select(F.explode("combination").alias("class")).distinct(), "class", "left_semi")
    has = pages.select("row", F.explode("tokens").alias("token")).join(asked.select("token", "class"), "token").groupBy(
        "row").agg(F.collect_set("class").alias("has"))  # classes of one URL
    looked = staged(has, "looked").select("row", "has", F.explode("has").alias("class"))
    frequency = looked.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    return looked.join(filed(rules, frequency), "class").where(
        F.size(F.array_except("combination", "has")) == 0).select("row").distinct()


def judged(pages: DataFrame, labels: DataFrame, listed: list[tuple[str, str]] = LISTED, min_pages: int = MIN_PAGES,
           **limits) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    rows = staged(parsed(pages, listed), "urls")
    taught = staged(transactions(rows, labels), "transactions")
    classes = staged(token_classes(taught, min_pages), "classes")
    rules = staged(mined_rules(taught, classes, min_pages, **limits), "rules")
    hit = fired(rows, rules, classes).withColumn("hit", F.lit(True))
    return rows.join(hit, "row", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("listed", F.when(F.col("hit"), "block").otherwise("allow")).alias("verdict"))
