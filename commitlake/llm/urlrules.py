"""URL filters: given host and path rules, and for the other urls association rules mined from labelled pages.

Given rules. A rule is a host and a path; it fits its host and all subdomains if the url's path starts with the rule's,
and the longest fitting rule decides.

Mined rules. A url is a set of tokens: scheme, host labels, path segments, query parameters, fragment (digits as ``#``).
A page is labelled through the label row with its id: ``block`` for quality 0 or toxic 1, else ``allow``. With
``every_page``, as in the query, each labelled page is a transaction, alike or not: a url seen on a thousand blocked pages
weighs a thousand; without it each different labelled token set weighs one. Spark's parallel FP-growth mines the
combinations of tokens that end in a label. Rules need ``MIN_PAGES`` transactions and
``MIN_SHARE`` of them as support, ``MIN_CONFIDENCE``, and a confidence above the label's own share; a rule is dropped
if one with fewer of its tokens is as sure. Of the rules that match a url the surest decides (then the one with more
support, then block before allow), and a url without any is allowed.

Two steps keep hot hosts from costing more than their share. Equal labelled token sets are counted together until the
mining, where each stands as often as it weighs, in pieces dealt over all tasks; and tokens that occur in exactly the
same transactions are one item, so that thousands of urls alike do not yield all subsets of their tokens. Rules match by
an inverted index: each is filed under its rarest token only, urls are looked up once per distinct token set, and the rest
of a rule's tokens is compared on the spot. The share bounds how many rules there can be, whatever the input; the index is
an ordinary join side, which Spark broadcasts only below its own limit.

Defined cases: a NULL url or one without ``://`` has empty host and path and no tokens, no rule fits it and it is
allowed; a label row whose quality and toxic are both NULL, or without a page, labels nothing; several label rows of a
page, and several rows of a page, all count; repeated rows and NULL ids stay rows of their own; no labels, no mined rules;
an empty table has no rows; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlake.llm.common import materialise, prepare

MIN_PAGES = 5
MIN_SHARE = 0.002          # of the transactions
MIN_CONFIDENCE = 0.6
PIECE = 1000               # equal transactions that stay in one task

# Fixed values of the contract: verdict and rule (host and path).
GIVEN = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
         ("block", "net/fr/"))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LABELS = {True: "=block", False: "=allow"}     # no url token starts with "="
RULES = "tokens array<string>, verdict string, confidence double, support double"


def lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    return lower(F.regexp_extract(_rest(url), "^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def given_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, NULL for none; of equally long ones the longer host decides."""
    rule = verdict = F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (len(r[1]), r[1].find("/"))):
        own, _, start = text.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit("/" + start))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def url_tokens(url: Column) -> Column:
    """Sorted distinct tokens of a url."""
    rest = _rest(url)

    def parts(mark: str, text: Column, by: str) -> Column:
        kept = F.filter(F.split(lower(text), by, -1), lambda x: x != "")
        return F.transform(kept, lambda x: F.concat(F.lit(mark), F.regexp_replace(x, "[0-9]+", "#")))

    scheme = F.when(rest != "", F.substring_index(url, "://", 1)).otherwise(F.lit(""))
    return F.array_sort(F.array_distinct(F.concat(
        parts("s:", scheme, "://"), parts("h:", F.regexp_extract(rest, "^[^/?#]*", 0), r"\."), parts("p:", path_of(url), "/"),
        parts("q:", F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1), "&"),
        parts("f:", F.regexp_extract(rest, "^[^#]*#(.*)", 1), "#"))))


def labelled_sets(pages: DataFrame, labels: DataFrame, id_col: str, url_col: str, every_page: bool) -> DataFrame:
    """Distinct (tokens, bad) of the labelled urls that have tokens, with their ``weight`` and ``tx``, a 64-bit key. The
    weight is 1, or with ``every_page`` the number of pages, each as often as it has such label rows."""
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    known = labels.where("quality IS NOT NULL OR toxic IS NOT NULL").select(F.col("doc_id").alias("l_id"), bad.alias("bad"))
    known = known.groupBy("l_id", "bad").agg(F.count(F.lit(1)).alias("times"))
    urls = pages.select(F.col(id_col).alias("p_id"), url_tokens(F.col(url_col)).alias("tokens")).where(F.size("tokens") > 0)
    weight = F.sum("times") if every_page else F.max(F.lit(1).cast("long"))
    sets = urls.join(known, F.col("p_id") == F.col("l_id")).groupBy("tokens", "bad").agg(weight.alias("weight"))
    return sets.withColumn("tx", F.xxhash64("tokens", "bad"))


def mine_rules(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url",
               every_page: bool = False) -> DataFrame:
    """(tokens, verdict, confidence, support) of the pruned association rules."""
    spark = prepare(pages.sparkSession)
    sets = materialise(labelled_sets(pages, labels, id_col, url_col, every_page), "url-sets")
    n, n_bad = (x or 0 for x in sets.agg(F.sum("weight"), F.sum(F.when(F.col("bad"), F.col("weight")))).first())
    least = max(MIN_PAGES, -int(-n * MIN_SHARE // 1))
    if n < least:
        return spark.createDataFrame([], RULES)
    each = sets.select("tx", "weight", F.explode("tokens").alias("token"))
    together = (F.sum("weight").alias("n"), F.bit_xor("tx").alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "tx")).alias("y"))
    frequent = each.groupBy("token").agg(*together).where(F.col("n") >= least)
    # an item is all tokens that occur in the same transactions, named by the first of them
    items = materialise(frequent.groupBy("n", "x", "y").agg(F.array_sort(F.collect_list("token")).alias("members")), "url-items")
    items = items.withColumn("item", F.col("members")[0])
    label = F.when(F.col("bad"), LABELS[True]).otherwise(LABELS[False])
    held = each.join(items.select(F.col("item").alias("token")), "token").groupBy("tx").agg(F.collect_set("token").alias("items"))
    transactions = sets.join(held, "tx").select(F.concat(F.array_sort("items"), F.array(label)).alias("items"), "weight")
    transactions = transactions.groupBy("items").agg(F.sum("weight").alias("weight"))
    pieces = transactions.select("items", "weight", F.explode(F.expr(f"sequence(0L, weight - 1, {PIECE}L)")).alias("first"))
    pieces = pieces.select("items", F.least(F.col("weight") - F.col("first"), F.lit(PIECE)).cast("int").alias("times"))
    pieces = materialise(pieces.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))), "url-transactions")
    model = FPGrowth(itemsCol="items", minSupport=least / n, minConfidence=MIN_CONFIDENCE).fit(
        pieces.select(F.explode(F.array_repeat("items", F.col("times"))).alias("items")))
    share = F.when(F.col("consequent")[0] == LABELS[True], F.lit(n_bad / n)).otherwise(F.lit(1 - n_bad / n))
    found = model.associationRules.where(F.col("consequent")[0].isin(*LABELS.values())).where(F.col("confidence") > share)
    found = materialise(found.select(
        F.array_sort("antecedent").alias("items"), F.ltrim(F.col("consequent")[0], F.lit("=")).alias("verdict"),
        "confidence", "support"), "url-rules")
    found = found.withColumn("rule", F.xxhash64("items", "verdict"))
    fewer = found.select(F.col("items").alias("some"), F.col("verdict").alias("v"), F.col("confidence").alias("c"),
                         F.col("items")[0].alias("token"))
    # a rule with fewer tokens starts with one of the rule's own: no pair without a common token is looked at
    beaten = found.withColumn("token", F.explode("items")).join(fewer, "token").where(
        (F.col("v") == F.col("verdict")) & (F.size("some") < F.size("items")) & (F.col("c") >= F.col("confidence"))
        & (F.size(F.array_except("some", "items")) == 0)).select("rule").distinct()
    kept = found.join(beaten, "rule", "left_anti")
    whole = kept.select("*", F.explode("items").alias("item")).join(items.select("item", "members"), "item")
    return materialise(whole.groupBy("rule").agg(
        F.array_sort(F.flatten(F.collect_list("members"))).alias("tokens"), F.any_value("verdict").alias("verdict"),
        F.any_value("confidence").alias("confidence"), F.any_value("support").alias("support")).drop("rule"), "url-kept")


def match_rules(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, mined) for the token sets that a rule matches: the verdict of the surest rule."""
    counts = sets.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rule = rules.select("*", F.xxhash64("tokens").alias("rule"))
    filed = rule.select("rule", F.explode("tokens").alias("token")).distinct().join(counts, "token").groupBy("rule").agg(
        F.min_by("token", F.struct("n", "token")).alias("token"))
    index = rule.withColumnRenamed("tokens", "needed").join(filed, "rule")
    sure = F.max(F.struct("confidence", "support", "verdict")).alias("best")
    found = sets.select("tokens", F.explode("tokens").alias("token")).join(index, "token").where(
        F.size(F.array_except("needed", "tokens")) == 0)
    return found.groupBy("tokens").agg(sure).select("tokens", F.col("best.verdict").alias("mined"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules: tuple[tuple[str, str], ...] = GIVEN, id_col: str = "page_id",
               url_col: str = "url", every_page: bool = False) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule (NULL if none fits) and verdict."""
    mined = mine_rules(pages, labels, id_col, url_col, every_page)
    url = F.col(url_col)
    rule, said = given_rule(F.col("host"), F.col("path"), rules)
    rows = pages.select(F.col(id_col).alias("k"), host_of(url).alias("host"), path_of(url).alias("path"),
                        url_tokens(url).alias("tokens"))
    rows = materialise(rows.select("k", "host", "path", rule.alias("rule"), said.alias("said"), F.when(
        said.isNull(), F.col("tokens")).alias("tokens")), "url-rows")
    sets = rows.where(F.size("tokens") > 0).select("tokens").distinct()
    # stored, so that both sides of the join are plain exchanges and Spark can split a hot token set
    found = rows.join(materialise(match_rules(sets, mined), "url-matched"), "tokens", "left")
    return found.select(F.col("k").alias(id_col), "host", "path", "rule",
                        F.coalesce("said", "mined", F.lit("allow")).alias("verdict"))
