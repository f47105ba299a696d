"""Keyword-group classification of products.

Rule 1 (name): every group with a keyword contained in the product name;
one group -> that group, several -> a sorted "mixed(...)" label.
Rule 2 (reviews, when rule 1 finds nothing): keyword occurrences summed over
the product's reviews per group; the unique maximum wins, ties give the
sorted mixed label, all zero gives "unclassified".

Counting is a per-review expression summed by a map-side-combined
aggregation on (product, group); the winner is picked from <= #groups rows
per product, so no group of reviews is ever collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P


def _quote(s: str) -> str:
    return "\\Q" + s + "\\E"


def mixed_label(groups: Column, prefix: str, suffix: str) -> Column:
    return F.concat(F.lit(prefix), F.array_join(F.array_sort(groups), ","), F.lit(suffix))


def name_rule(name, groups: Mapping[str, Sequence[str]] = P.GROUP_KEYWORDS,
              prefix: str = P.MIXED_PREFIX, suffix: str = P.MIXED_SUFFIX) -> Column:
    """group label from keywords contained in the name, or NULL."""
    n = F.coalesce(F.col(name) if isinstance(name, str) else name, F.lit(""))
    hits = [F.when(_any_contains(n, kws), F.lit(g)) for g, kws in groups.items()]
    found = F.array_sort(F.filter(F.array(*hits), lambda x: x.isNotNull()))
    return (F.when(F.size(found) == 0, F.lit(None).cast("string"))
             .when(F.size(found) == 1, found[0])
             .otherwise(mixed_label(found, prefix, suffix)))


def _any_contains(text: Column, kws: Sequence[str]) -> Column:
    cond = None
    for k in kws:
        if not k:
            continue
        c = text.contains(k)
        cond = c if cond is None else (cond | c)
    return cond if cond is not None else F.lit(False)


def _is(word: str):
    return lambda x: x == F.lit(word)           # one argument: a second one would be the place


def keyword_hits(text: str | None = "full_text", groups: Mapping[str, Sequence[str]] = P.GROUP_KEYWORDS,
                 tokens: str | None = None, content: str | None = None) -> dict[str, Column]:
    """Keyword occurrences of one review for every group.

    With ``tokens`` a review that has some is counted by equal tokens; any other (and
    every review without ``tokens``) by non-overlapping substrings of ``text``, or of
    ``content`` where the text is null or empty.  Overlapping keywords count twice."""
    t = F.col(text) if text else F.lit("")
    if content is not None:
        t = F.when(F.coalesce(t, F.lit("")) == "", F.col(content)).otherwise(t)
    t = F.coalesce(t, F.lit(""))
    out = {}
    for g, kws in groups.items():
        hits = sum((F.regexp_count(t, F.lit(_quote(k))) for k in kws), F.lit(0))
        if tokens is not None:
            equal = sum((F.size(F.filter(F.col(tokens), _is(k))) for k in kws), F.lit(0))
            hits = F.when(F.coalesce(F.size(tokens), F.lit(0)) > 0, equal).otherwise(hits)
        out[g] = hits.cast("bigint")
    return out


def review_keyword_counts(reviews: DataFrame, key: str, text: str | None = "full_text",
                          groups: Mapping[str, Sequence[str]] = P.GROUP_KEYWORDS,
                          tokens: str | None = None, content: str | None = None) -> DataFrame:
    """(key, group, cnt) — ``keyword_hits`` summed over the reviews of a key."""
    hits = keyword_hits(text, groups, tokens, content)
    wide = reviews.groupBy(key).agg(*[F.sum(c).alias(f"_g{i}") for i, c in enumerate(hits.values())])
    pairs = F.array(*[F.struct(F.lit(g).alias("group"), F.col(f"_g{i}").alias("cnt")) for i, g in enumerate(hits)])
    return wide.select(key, F.explode(pairs).alias("e")).select(key, "e.group", "e.cnt")


def pick_from_counts(counts: DataFrame, key: str, prefix: str = P.MIXED_PREFIX,
                     suffix: str = P.MIXED_SUFFIX, unclassified: str = P.UNCLASSIFIED) -> DataFrame:
    """winner per key from (key, group, cnt)."""
    w = Window.partitionBy(key)
    top = counts.withColumn("_max", F.max("cnt").over(w)).where(F.col("cnt") == F.col("_max"))
    agg = top.groupBy(key).agg(F.max("_max").alias("_max"),
                               F.array_sort(F.collect_list("group")).alias("_g"))   # <= #groups entries
    label = (F.when(F.col("_max") <= 0, F.lit(unclassified))
              .when(F.size("_g") == 1, F.col("_g")[0])
              .otherwise(mixed_label(F.col("_g"), prefix, suffix)))
    return agg.select(key, label.alias("review_rule"))


def classify_products(products: DataFrame, reviews: DataFrame, key: str = "product_id",
                      name: str = "product_name", text: str = "full_text",
                      groups: Mapping[str, Sequence[str]] = P.GROUP_KEYWORDS, tokens: str | None = None,
                      prefix: str = P.MIXED_PREFIX, suffix: str = P.MIXED_SUFFIX,
                      unclassified: str = P.UNCLASSIFIED, content: str | None = None) -> DataFrame:
    """name rule first, review-count rule second (``skin_type`` column).

    Reviews are read once and summed to one row per key, a number for each group; the
    winner is an expression over that row, and the name rule is evaluated once per
    product."""
    hits = keyword_hits(text, groups, tokens, content)
    names = [f"_g{i}" for i in range(len(hits))]
    sums = reviews.groupBy(key).agg(*[F.sum(c).alias(n) for n, c in zip(names, hits.values())])
    top = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    winners = F.filter(F.array(*[F.when(F.col(n) == top, F.lit(g)) for n, g in zip(names, hits)]),
                       lambda x: x.isNotNull())
    by_reviews = (F.when(F.coalesce(top, F.lit(0)) <= 0, F.lit(unclassified))
                   .when(F.size(winners) == 1, winners[0]).otherwise(mixed_label(winners, prefix, suffix)))
    out = products.join(sums, key, "left")
    return out.withColumn("skin_type", F.coalesce(name_rule(name, groups, prefix, suffix), by_reviews)).drop(*names)
