"""URL filters by association rules (operator 4, DataFrame functions only).

Every url becomes a set of tokens (scheme, host and its parent domains, path
segments with digits folded, query names, fragment). FP-growth over
the labelled bad rows mines token combinations with enough support; how many labelled rows
hold a combination gives its confidence, and only confident ones are kept. Tokens that stand in the very same
labelled rows are one item of the mining, so a deep path that occurs as a whole is one
item and not all sets of its segments; a rule asks for any token of each item, which is what the rules
over all these sets would ask for. Rules match by an inverted index: each rule is listed
under the tokens of its rarest item, distinct token sets look up their tokens there, and a
rule holds if all its items have a token in the set. Listed (host, path) rules come
first and the longest one wins.

Bounds: items are tokens of at least the minimum support among bad rows, so at most
tokens / support; their combinations depend on how many items with different rows meet in that
many bad rows, not on the number of urls or the depth of a path. Token sets leave
out ids, so they are far fewer than urls, and copies of a set are judged once.

Defined results: a null url or one without ``://`` has an empty host and path;
rows without label, or whose label has neither quality nor toxic, teach nothing; if nothing is labelled or no rule is strong
enough the method allows; repeated rows are each judged; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.tables import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed values of the contract: (verdict, host and path).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def with_host_path(pages: DataFrame, url_col: str) -> DataFrame:
    """Adds host and path."""
    at = F.instr(url_col, "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return pages.withColumn("host", host).withColumn("path", path)


def listed_rule(rules: Sequence[tuple[str, str]] = RULES) -> tuple[F.Column, F.Column]:
    """(rule, verdict) of the longest listed rule that fits; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked last, outermost
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def tokens(url_col: str) -> F.Column:
    """The url's distinct tokens in order; needs host and path."""
    labels = F.split("host", "\\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels), F.lit(1))),
        lambda i: F.concat(F.lit("domain="), F.array_join(F.slice(labels, i, F.size(labels)), ".")),
    )
    segments = F.filter(F.split("path", "/"), lambda x: x != "")
    segments = F.transform(segments, lambda x: F.concat(F.lit("path="), F.regexp_replace(x, "[0-9]+", "0")))
    url = F.coalesce(F.col(url_col), F.lit(""))
    names = F.split(F.regexp_extract(url, "\\?([^#]*)", 1), "&")
    names = F.transform(F.filter(names, lambda x: x != ""), lambda x: F.concat(F.lit("query="), F.substring_index(x, "=", 1)))
    extra = F.array(
        F.concat(F.lit("scheme="), F.lower(F.regexp_extract(url, "^([^:/?#]*)://", 1))),
        F.when(F.instr(url, "#") > 0, F.lit("fragment")).otherwise(F.lit("no fragment")),
    )
    return F.array_sort(F.array_distinct(F.concat(domains, segments, names, extra)))


RULE = "antecedent array<string>, items array<array<string>>, keys array<string>, support long, confidence double"


def mine_rules(labelled: DataFrame, scratch: Scratch, *, min_support: float, min_confidence: float) -> DataFrame:
    """RULE rows: rules that lead to the bad class.

    ``labelled`` has row (unique), tokens and bad. An antecedent names items, each by its first token;
    ``items`` are their tokens, ``keys`` those of the rarest one.
    """
    least = math.ceil(min_support * labelled.count())
    places = labelled.select("row", "bad", F.explode(F.array_distinct("tokens")).alias("token"))
    # 128 bits of the set of rows that hold a token.
    rows = [F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("row")).alias("x"), F.bit_xor(F.xxhash64(F.lit("row"), "row")).alias("y")]
    frequent = places.groupBy("token").agg(F.count_if("bad").alias("n_bad"), *rows).where(F.col("n_bad") >= least)
    items = frequent.groupBy("n", "x", "y").agg(F.min("token").alias("item"), F.array_sort(F.collect_set("token")).alias("tokens"))
    items = scratch.write(items.select("item", "tokens", "n"), "items")
    held = places.join(items.select("item"), F.col("token") == F.col("item")).groupBy("row", "bad").agg(F.collect_set("item").alias("items"))
    held = scratch.write(held, "held")
    bad = held.where("bad").select("items")
    n_bad = bad.count()
    if n_bad < max(least, 1):
        return labelled.sparkSession.createDataFrame([], RULE)
    model = FPGrowth(itemsCol="items", minSupport=max(0.0, (least - 0.5) / n_bad), minConfidence=min_confidence).fit(bad)
    sets = model.freqItemsets.select(F.array_sort("items").alias("antecedent"), F.col("freq").alias("support"))
    listed = sets.select("antecedent", "support", F.explode("antecedent").alias("item")).join(items, "item")
    listed = listed.groupBy("antecedent", "support").agg(
        F.min_by("item", F.struct("n", "item")).alias("rarest"), F.min_by("tokens", F.struct("n", "item")).alias("keys"), F.collect_list("tokens").alias("items")
    )
    listed = scratch.write(listed, "sets")
    seen = held.select("items", F.explode("items").alias("rarest")).join(listed.select("antecedent", "rarest"), "rarest")
    seen = seen.where(F.size(F.array_except("antecedent", "items")) == 0).groupBy("antecedent").agg(F.count(F.lit(1)).alias("rows"))
    rules = listed.join(seen, "antecedent").withColumn("confidence", F.col("support") / F.col("rows"))
    return rules.where(F.col("confidence") >= min_confidence).select("antecedent", "items", "keys", "support", "confidence")


def judge(
    pages: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    label_id_col: str = "doc_id",
    rules: Sequence[tuple[str, str]] = RULES,
    min_support: float = 0.005,
    min_confidence: float = 0.5,
) -> DataFrame:
    """(id, host, path, rule, verdict, confidence) of every row of ``pages``.

    ``labels`` marks ids as bad (quality 0 or toxic 1) or good. confidence is
    that of the strongest mined rule that matches, null where none does.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    rule, verdict = listed_rule(rules)
    rows = with_host_path(pages.select(id_col, url_col), url_col).withColumn("tokens", tokens(url_col))
    rows = scratch.write(rows.select(F.col(id_col).alias("page_id"), "host", "path", "tokens"), "tokens")

    bad = (F.col("quality") == 0) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    marks = labels.where(F.col("quality").isNotNull() | F.col("toxic").isNotNull()).select(
        F.col(label_id_col).alias("page_id"), F.coalesce(bad, F.lit(False)).alias("bad")
    )
    taught = scratch.write(rows.join(marks, "page_id").select(F.monotonically_increasing_id().alias("row"), "tokens", "bad"), "taught")
    sets = rows.select("tokens").distinct()
    index = scratch.write(mine_rules(taught, scratch, min_support=min_support, min_confidence=min_confidence), "index")
    looked = sets.select("tokens", F.explode("tokens").alias("key")).join(index.select("items", "confidence", F.explode("keys").alias("key")), "key")
    holds = F.forall("items", lambda item: F.arrays_overlap(item, F.col("tokens")))
    strong = looked.where(holds).groupBy("tokens").agg(F.max("confidence").alias("confidence"))
    strong = scratch.write(strong, "matches")
    found = rows.join(strong, "tokens", "left")
    mined = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return found.select(
        F.col("page_id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(verdict, mined).alias("verdict"), "confidence"
    )
