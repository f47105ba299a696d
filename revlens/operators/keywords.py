"""Sentiment-specific keywords and word frequencies.

Scoring, for each group and word *w* over eligible reviews (label in {0,1},
non-empty tokens)::

    pos_n / neg_n   reviews of each class containing w
    support         pos_n + neg_n            (kept if >= min_doc_freq)
    pos / neg       mean over those reviews of tf(r, w) = count(w in r)/|r|
    pos_rate        pos_n / total_pos        (0 if total_pos = 0), neg likewise
    balanced_ratio  (pos_rate - neg_rate) / (pos_rate + neg_rate)  (0 if both 0)
    score           |pos - neg| * log1p(support) * balanced_ratio

where total_pos / total_neg count every labelled review of the group, also
those without tokens.  The positive list is the top-n by score, the negative
list the bottom-n (score ascending); ties are broken by word.

Plan shape (scale notes):
* One explode per review emits, per token occurrence, ``1/|r|`` (so the sum
  over a review is tf) and, per *distinct* token, a document indicator.  No
  per-(review, word) shuffle is needed: the aggregation on (keys, word) is
  combined map-side before the exchange, so a hot product or a hot word sends
  one partial row per task, not its raw rows.
* The three levels (product, category, global) are additive, so the
  aggregate is computed once at the finest level and rolled up (one Expand
  over the *pre-aggregated* table).
* Top-n per group is a ``row_number`` filter, planned as WindowGroupLimit
  (a partial top-n runs before the shuffle).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..sources.documents import _stage

DEFAULT_LEVELS = (("global", P.MIN_DOC_FREQ_GLOBAL),
                  ("category", P.MIN_DOC_FREQ_CATEGORY),
                  ("product", P.MIN_DOC_FREQ_PRODUCT))

def _level_of(gid: Column, n_keys: int, names: Sequence[str]) -> Column:
    """Map a rollup grouping id to a level name (prefix length k -> 2^(L-k)-1)."""
    expr = None
    for k, name in enumerate(names):
        cond = gid == ((1 << (n_keys - k)) - 1)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def eligible(reviews: DataFrame, label: str = "label", tokens: str = "tokens") -> DataFrame:
    """Reviews that take part in keyword scoring: label 0/1 and at least one token."""
    return reviews.where(F.col(label).isin(0, 1) & (F.size(tokens) > 0))


# ----------------------------------------------------------------- A2
def term_frequency(reviews: DataFrame, id_col: str = "review_id", tokens: str = "tokens",
                   keep: Sequence[str] = (), words: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row per (review, distinct word): ``freq`` and ``tf = freq / |tokens|``.

    All tokens of a review sit in one row, so the partial aggregate resolves
    each review inside its task; the exchange carries distinct words only.
    ``words`` picks among the rows of a word each (column ``word``) before they are counted."""
    ex = reviews.select(*keep, id_col, F.size(tokens).alias("_n"), F.explode(tokens).alias("word"))
    if words is not None:
        ex = words(ex)
    return (ex.groupBy(*keep, id_col, "word")
              .agg(F.count(F.lit(1)).alias("freq"), F.first("_n").alias("_n"))
              .select(*keep, id_col, "word", "freq", (F.col("freq") / F.col("_n")).alias("tf")))


# ----------------------------------------------------------------- contributions
def token_contributions(reviews: DataFrame, keys: Sequence[str], label: str = "label",
                        tokens: str = "tokens", unlabelled: bool = False) -> DataFrame:
    """(keys, label, word, w, d): w sums to tf per review, d marks presence.
    With ``unlabelled`` the other reviews mark presence too (w = 0)."""
    # Only the cheap label predicate filters rows: reviews without tokens emit
    # nothing from the explode, and a size(tokens) filter would be pushed below
    # projections/exchanges and re-run the tokeniser on its own.
    known = F.col(label).isin(0, 1)
    elig = reviews if unlabelled else reviews.where(known)
    n = F.size(tokens)
    st = "array<struct<word:string,w:double,d:int>>"
    # arrays_zip/array_repeat are code-generated (no lambda per element)
    occ = F.arrays_zip(F.col(tokens), F.array_repeat(F.try_divide(F.lit(1.0), n), n),
                       F.array_repeat(F.lit(0), n)).cast(st)
    dt = F.array_distinct(tokens)
    dist = F.arrays_zip(dt, F.array_repeat(F.lit(0.0), F.size(dt)), F.array_repeat(F.lit(1), F.size(dt))).cast(st)
    both = F.concat(occ, dist)
    marks = F.when(known, both).otherwise(dist) if unlabelled else both
    return (elig.select(*keys, F.col(label).alias("label"), F.explode(marks).alias("e"))
                .select(*keys, "label", "e.word", "e.w", "e.d"))


def weight_contributions(reviews: DataFrame, keys: Sequence[str], weights: str = "weights",
                         label: str = "label") -> DataFrame:
    """(keys, label, word, w, d) from a per-review MAP<word, weight> column."""
    r = reviews.where(F.col(label).isin(0, 1) & F.col(weights).isNotNull())
    return (r.select(*keys, F.col(label).alias("label"), F.explode(weights).alias("word", "w"))
             .select(*keys, "label", "word", F.col("w").cast("double").alias("w"), F.lit(1).alias("d")))


def long_weight_contributions(weights: DataFrame, reviews: DataFrame, keys: Sequence[str],
                              id_col: str = "review_id", label: str = "label") -> DataFrame:
    """(keys, label, word, w, d) from a long (review, word, weight) table —
    the same contributions as a per-review weight map, without building one."""
    r = reviews.where(F.col(label).isin(0, 1)).select(id_col, *keys, F.col(label).alias("label"))
    # a hash of the narrow side: the long table is not sorted
    return (weights.join(r.hint("shuffle_hash"), id_col)
                   .select(*keys, "label", "word", F.col("weight").cast("double").alias("w"), F.lit(1).alias("d")))


# ----------------------------------------------------------------- A1
def class_totals(reviews: DataFrame, hierarchy: Sequence[str], level_names: Sequence[str],
                 label: str = "label", tokens: str | None = "tokens",
                 only_with_tokens: str | None = None) -> DataFrame:
    """Per level: review_count, pos_count, neg_count, token_review_count.
    ``only_with_tokens`` names a token column whose empty rows are not counted
    (a conditional count, not a row filter)."""
    keep = (F.coalesce(F.size(only_with_tokens), F.lit(0)) > 0) if only_with_tokens else F.lit(True)
    aggs = [F.count_if(keep).alias("review_count"),
            F.count_if(keep & (F.col(label) == 1)).alias("pos_count"),
            F.count_if(keep & (F.col(label) == 0)).alias("neg_count")]
    if tokens is not None:
        aggs.append(F.count_if(F.coalesce(F.size(tokens), F.lit(0)) > 0).alias("token_review_count"))
    out = reviews.rollup(*hierarchy).agg(*aggs, F.grouping_id().alias("_gid"))
    return (out.withColumn("level", _level_of(F.col("_gid"), len(hierarchy), level_names))
               .where(F.col("level").isNotNull()).drop("_gid"))


COUNTS = ["review_count", "pos_count", "neg_count", "token_review_count"]


def class_sums(reviews: DataFrame, hierarchy: Sequence[str], label: str = "label",
               tokens: str = "tokens") -> DataFrame:
    """``COUNTS`` at the finest level only: the mergeable form of ``class_totals``."""
    return reviews.groupBy(*hierarchy).agg(
        F.count(F.lit(1)).alias("review_count"), F.count_if(F.col(label) == 1).alias("pos_count"),
        F.count_if(F.col(label) == 0).alias("neg_count"),
        F.count_if(F.coalesce(F.size(tokens), F.lit(0)) > 0).alias("token_review_count"))


def totals_of_sums(sums: DataFrame, hierarchy: Sequence[str], level_names: Sequence[str]) -> DataFrame:
    """``class_totals`` from the (merged or not merged) rows of ``class_sums``."""
    out = sums.rollup(*hierarchy).agg(*[F.sum(c).alias(c) for c in COUNTS], F.grouping_id().alias("_gid"))
    return (out.withColumn("level", _level_of(F.col("_gid"), len(hierarchy), level_names))
               .where(F.col("level").isNotNull()).select("level", *hierarchy, *COUNTS))


def sentiment_counts(reviews: DataFrame, hierarchy: Sequence[str] = ("category", "product_id"),
                     levels: Sequence[str] = ("global", "category", "product"),
                     label: str = "label", tokens: str = "tokens") -> DataFrame:
    out = class_totals(reviews, hierarchy, levels, label, tokens)
    return out.select("level", *hierarchy, "review_count", "pos_count", "neg_count", "token_review_count")


# ----------------------------------------------------------------- A3/A4/W4
def _times_idf(rolled: DataFrame, hierarchy: Sequence[str], top: str, n_docs: Column, keep: Column,
               salts: int) -> DataFrame:
    """The rows of ``rolled`` that ``keep`` holds for, class sums times ln(N / df).

    A word's document frequency is in its row of the ``top`` level.  That row goes
    to each of ``salts`` parts of the word, so a word that very many products use
    is spread over several tasks."""
    is_top = F.col("level") == top
    part = F.when(is_top, F.sequence(F.lit(0), F.lit(salts - 1))) \
        .otherwise(F.array(F.pmod(F.hash("word", *hierarchy), F.lit(salts))))
    df = F.max(F.when(is_top, F.col("any_n"))).over(Window.partitionBy("word", "_part"))
    return (rolled.where(keep | is_top).withColumn("_part", F.explode(part))
            .withColumn("_idf", F.log(n_docs / df))
            .where(keep & (~is_top | (F.col("_part") == 0)))
            .withColumn("pos_sum", F.col("pos_sum") * F.col("_idf"))
            .withColumn("neg_sum", F.col("neg_sum") * F.col("_idf")).drop("_part", "_idf"))


def word_sums(contrib: DataFrame, hierarchy: Sequence[str]) -> DataFrame:
    """Partial sums per (hierarchy..., word): class sums of weights, class and total document
    counts.  Combined map-side, one exchange on (keys, word).  Sums of several inputs
    add up (``merge_sums``), so they can be kept as a table and never recomputed."""
    label = F.col("label")
    return (contrib.groupBy(*hierarchy, "word")
                   .agg(F.sum(F.when(label == 1, F.col("w"))).alias("pos_sum"),
                        F.sum(F.when(label == 0, F.col("w"))).alias("neg_sum"),
                        F.sum(F.when(label == 1, F.col("d"))).alias("pos_n"),
                        F.sum(F.when(label == 0, F.col("d"))).alias("neg_n"),
                        F.sum("d").alias("any_n")))


def merge_sums(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partial sums of several inputs added per key; every other column is a sum."""
    rest = [c for c in sums.columns if c not in keys]
    return sums.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in rest])


def score_keywords(contrib: DataFrame, totals: DataFrame, hierarchy: Sequence[str],
                   levels: Sequence[tuple[str, int]] = DEFAULT_LEVELS, top_n: int = P.KEYWORD_TOP_N,
                   rank_digits: int = 9, ranking: str = "one_pass",
                   n_docs: Column | None = None, split: int = 64, salts: int = 8) -> DataFrame:
    """Keyword lists from contributions (hierarchy..., label, word, w, d); see ``score_sums``."""
    return score_sums(word_sums(contrib, list(hierarchy)), totals, hierarchy, levels, top_n, rank_digits, ranking,
                      n_docs, split, salts)


def score_sums(fine: DataFrame, totals: DataFrame, hierarchy: Sequence[str],
                   levels: Sequence[tuple[str, int]] = DEFAULT_LEVELS, top_n: int = P.KEYWORD_TOP_N,
                   rank_digits: int = 9, ranking: str = "one_pass",
                   n_docs: Column | None = None, split: int = 64, salts: int = 8) -> DataFrame:
    """Keyword lists for every requested level, long format.

    ``fine``: output of ``word_sums``; ``totals``: output of ``class_totals``.  ``levels`` lists (name, min_doc_freq) for prefixes of
    ``hierarchy`` of length 0, 1, ...; a ``None`` threshold skips that level.
    Ranking uses the score rounded to ``rank_digits`` so that float summation
    order cannot reorder ties.  With ``n_docs`` (number of reviews) the weight
    sums are multiplied by the word's ln(n_docs / document frequency), where
    ``any_n`` counts all reviews with the word; ``split`` is the number of hash
    buckets of the first ranking stage."""
    hierarchy = list(hierarchy)
    names = [n for n, _ in levels]
    # roll the small table up to the coarser levels (word always kept)
    rolled = (fine.rollup("word", *hierarchy)
                  .agg(F.sum("pos_sum").alias("pos_sum"), F.sum("neg_sum").alias("neg_sum"),
                       F.sum("pos_n").alias("pos_n"), F.sum("neg_n").alias("neg_n"),
                       F.sum("any_n").alias("any_n"), F.grouping_id().alias("_gid"))
                  .where(F.col("_gid") < (1 << len(hierarchy)))
                  .withColumn("level", _level_of(F.col("_gid"), len(hierarchy), names))
                  .where(F.col("level").isNotNull()))
    pos_n = F.coalesce(F.col("pos_n"), F.lit(0)).cast("bigint")
    neg_n = F.coalesce(F.col("neg_n"), F.lit(0)).cast("bigint")
    rolled = rolled.select("level", *hierarchy, "word", "pos_sum", "neg_sum",
                           pos_n.alias("pos_n"), neg_n.alias("neg_n"),
                           (pos_n + neg_n).alias("support"), "any_n")
    thr = None
    for name, mdf in levels:
        if mdf is None:          # level only named, not produced
            continue
        c = (F.col("level") == name) & (F.col("support") >= mdf)
        thr = c if thr is None else (thr | c)
    rolled = rolled.where(thr) if n_docs is None else _times_idf(
        rolled, hierarchy, names[0], n_docs, thr & (F.col("support") > 0), salts)

    t = totals.select(F.col("level").alias("_t_level"), *[F.col(h).alias("_t_" + h) for h in hierarchy],
                      F.col("pos_count").alias("total_pos"), F.col("neg_count").alias("total_neg"))
    cond = [F.col("level") == F.col("_t_level"), *[F.col(h).eqNullSafe(F.col("_t_" + h)) for h in hierarchy]]
    j = rolled.join(t, cond, "inner").drop("_t_level", *["_t_" + h for h in hierarchy])

    pos_rate = F.when(F.col("total_pos") > 0, F.col("pos_n") / F.col("total_pos")).otherwise(F.lit(0.0))
    neg_rate = F.when(F.col("total_neg") > 0, F.col("neg_n") / F.col("total_neg")).otherwise(F.lit(0.0))
    j = j.withColumn("_pr", pos_rate).withColumn("_nr", neg_rate)
    balanced = F.when((F.col("_pr") + F.col("_nr")) == 0, F.lit(0.0)) \
        .otherwise((F.col("_pr") - F.col("_nr")) / (F.col("_pr") + F.col("_nr")))
    pos = F.when(F.col("pos_n") > 0, F.col("pos_sum") / F.col("pos_n")).otherwise(F.lit(0.0))
    neg = F.when(F.col("neg_n") > 0, F.col("neg_sum") / F.col("neg_n")).otherwise(F.lit(0.0))
    scored = (j.select("level", *hierarchy, "word", pos.alias("pos"), neg.alias("neg"), "pos_n", "neg_n",
                       "support", balanced.alias("balanced_ratio"))
               .withColumn("diff", F.col("pos") - F.col("neg"))
               .withColumn("score", F.abs(F.col("diff")) * F.log1p(F.col("support").cast("double"))
                           * F.col("balanced_ratio"))
               .withColumn("_rs", F.round("score", rank_digits)))

    part = ["level", *hierarchy]
    cols = ["level", *hierarchy, "polarity", "rank", "word", "diff", "pos", "neg", "pos_n", "neg_n",
            "support", "balanced_ratio", "score"]
    if ranking == "group_limit":
        # Alternative: two row_number filters, each planned as WindowGroupLimit
        # (partial top-n per task before the shuffle).  Measured slower here:
        # the two branches re-run the upstream plan.
        wp = Window.partitionBy(*part).orderBy(F.col("_rs").desc(), F.col("word").asc())
        wn = Window.partitionBy(*part).orderBy(F.col("_rs").asc(), F.col("word").desc())
        pos_l = (scored.withColumn("rank", F.row_number().over(wp)).where(F.col("rank") <= top_n)
                       .withColumn("polarity", F.lit("positive")).select(*cols))
        neg_l = (scored.withColumn("rank", F.row_number().over(wn)).where(F.col("rank") <= top_n)
                       .withColumn("polarity", F.lit("negative")).select(*cols))
        return pos_l.unionByName(neg_l)
    # Two-stage exact top/bottom-n without any group in one task:
    #  1) per (group, hash(word) mod split): keep words in that bucket's top-n or
    #     bottom-n — every word of the group's top-n is in its own bucket's top-n;
    #  2) rank the <= 2*n*split candidates per group.
    # Both ranks share each exchange; each word then emits a row per list it
    # made (a word may be in both lists).
    def ranks(df, keys):
        w_pos = Window.partitionBy(*keys).orderBy(F.col("_rs").desc(), F.col("word").asc())
        w_neg = Window.partitionBy(*keys).orderBy(F.col("_rs").asc(), F.col("word").desc())
        return (df.withColumn("_rp", F.row_number().over(w_pos)).withColumn("_rn", F.row_number().over(w_neg))
                  .where((F.col("_rp") <= top_n) | (F.col("_rn") <= top_n)))
    if split > 1:
        scored = ranks(scored.withColumn("_salt", F.pmod(F.hash("word"), F.lit(split))), [*part, "_salt"]) \
            .drop("_rp", "_rn", "_salt")
    ranked = ranks(scored, part)
    lists = F.filter(F.array(
        F.when(F.col("_rp") <= top_n, F.struct(F.lit("positive").alias("polarity"), F.col("_rp").alias("rank"))),
        F.when(F.col("_rn") <= top_n, F.struct(F.lit("negative").alias("polarity"), F.col("_rn").alias("rank")))),
        lambda x: x.isNotNull())
    return ranked.select("*", F.explode(lists).alias("_l")).select("*", "_l.polarity", "_l.rank").select(*cols)


def sentiment_keywords(reviews: DataFrame, hierarchy: Sequence[str] = ("category", "product_id"),
                       levels: Sequence[tuple[str, int]] = DEFAULT_LEVELS, top_n: int = P.KEYWORD_TOP_N,
                       label: str = "label", tokens: str = "tokens") -> DataFrame:
    """A3-A5: keyword lists from token frequencies at every level in one plan."""
    hierarchy = list(hierarchy)
    contrib = token_contributions(reviews, hierarchy, label, tokens)
    totals = class_totals(reviews, hierarchy, [n for n, _ in levels], label, tokens=None)
    return score_keywords(contrib, totals, hierarchy, levels, top_n)


def sentiment_keywords_weighted(reviews: DataFrame, hierarchy: Sequence[str] = ("category", "product_id"),
                                levels: Sequence[tuple[str, int]] = (("global", 20), ("category", 20),
                                                                     ("product", 20)),
                                top_n: int = P.WEIGHTED_TOP_N, weights: str = "weights",
                                label: str = "label", tokens: str = "tokens") -> DataFrame:
    """Externally supplied per-review word weights (e.g. tf-idf map).

    Only reviews with tokens are considered at all; class totals count the
    labelled reviews that carry weights."""
    hierarchy = list(hierarchy)
    r = reviews.where(F.size(tokens) > 0)
    contrib = weight_contributions(r, hierarchy, weights, label)
    totals = class_totals(r.where(F.col(weights).isNotNull()), hierarchy, [n for n, _ in levels],
                          label, tokens=None)
    return score_keywords(contrib, totals, hierarchy, levels, top_n)


def sentiment_keywords_tfidf(reviews: DataFrame, hierarchy: Sequence[str] = ("category",),
                             levels: Sequence[tuple[str, int]] = (("global", 20), ("category", 20)),
                             top_n: int = P.WEIGHTED_TOP_N, label: str = "label",
                             tokens: str = "tokens") -> DataFrame:
    """A6 with tf-idf weights, factorised: idf depends on the word only, so the
    class sums are idf(w) * (sums of tf) — no per-(review, word) weight table.
    One explode gives class sums and document frequencies, the number of
    reviews is a row of the totals."""
    hierarchy = list(hierarchy)
    contrib = token_contributions(reviews, hierarchy, label, tokens, unlabelled=True)
    totals = class_totals(reviews, hierarchy, [n for n, _ in levels], label, tokens=None,
                          only_with_tokens=tokens)
    n_docs = totals.where(F.col("level") == levels[0][0]).agg(F.max("review_count").cast("double")).scalar()
    return score_keywords(contrib, totals, hierarchy, levels, top_n, n_docs=n_docs)


def _met_lists(reviews: DataFrame, id_col: str, tokens: str, tasks: int, mark: str = "\x01") -> DataFrame:
    """(id, tokens) partitioned by id.  A list travels as one text with ``mark`` between its words, which takes
    half as much as an array; a list with a null or with ``mark`` in a word travels as it is."""
    odd = (F.size(tokens) <= 0) | F.exists(tokens, lambda t: t.isNull() | t.contains(mark))
    moved = reviews.select(id_col, F.when(~odd, F.array_join(tokens, mark)).alias("_text"),
                           F.when(odd, F.col(tokens)).alias("_list")).repartition(tasks, id_col)
    return moved.select(id_col, F.coalesce(F.split("_text", mark, -1), F.col("_list")).alias(tokens))


def tfidf_weights(reviews: DataFrame, id_col: str = "review_id", tokens: str = "tokens",
                  frequent: float = 2.5e-7) -> DataFrame:
    """Long (review, word, weight) with weight = tf * ln(N / df).

    The token lists of a review meet, and its words are counted where they are; the long table itself
    is not shuffled.  The document frequencies (a row a word) are staged.  Words with a share of
    ``frequent`` or more of all (review, word) pairs, 1 / ``frequent`` of them at most, are sent to all
    tasks; the pairs of the other words go to their word and back to their review.  The result is
    partitioned by review."""
    spark = reviews.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lists = _met_lists(reviews, id_col, tokens, tasks)
    dfreq = _stage(term_frequency(lists, id_col, tokens).groupBy("word").agg(F.count(F.lit(1)).alias("_df")),
                   "document-frequencies")
    n_docs = reviews.agg(F.count_if(F.size(tokens) > 0).cast("double")).scalar()
    least = dfreq.agg(F.sum("_df") * frequent).first()[0] or 0
    common, rest = F.broadcast(dfreq.where(F.col("_df") >= least)), dfreq.where(F.col("_df") < least)
    weight = (F.col("tf") * F.log(n_docs / F.col("_df"))).alias("weight")
    known = term_frequency(lists, id_col, tokens, words=lambda w: w.join(common.select("word"), "word", "left_semi"))
    rare = term_frequency(lists, id_col, tokens, words=lambda w: w.join(common.select("word"), "word", "left_anti"))
    return (known.join(common, "word").select(id_col, "word", weight)
            .unionByName(rare.join(rest.hint("shuffle_hash"), "word").select(id_col, "word", weight)
                         .repartition(tasks, id_col)))


# ----------------------------------------------------------------- A7 / J8
def keyword_groups(tokens, groups: Mapping[str, Sequence[str]] = P.GROUP_KEYWORDS) -> Column:
    """Array of group names whose keyword set overlaps the token array."""
    hits = [F.when(F.arrays_overlap(F.col(tokens) if isinstance(tokens, str) else tokens,
                                    F.array(*[F.lit(k) for k in kws])), F.lit(g))
            for g, kws in groups.items()]
    return F.filter(F.array(*hits), lambda x: x.isNotNull())


def ranked_counts(counts: DataFrame, part: Sequence[str], top_n: int, key: str = "word",
                  cnt: str = "cnt") -> DataFrame:
    """Top-n per partition by count desc, key asc (WindowGroupLimit)."""
    order = [F.col(cnt).desc(), F.col(key).asc()]
    if not part:
        # global top-k: distributed TakeOrderedAndProject, then number the k rows
        top = counts.orderBy(*order).limit(top_n)
        return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    w = Window.partitionBy(*part).orderBy(*order)
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n)


def group_word_frequency(reviews: DataFrame, groups: Mapping[str, Sequence[str]] = P.GROUP_KEYWORDS,
                         top_n: int = P.GROUP_WORD_TOP_N, tokens: str = "tokens") -> DataFrame:
    """Word counts over all reviews matching each keyword group; top-n per group."""
    return ranked_counts(group_word_sums(reviews, groups, tokens), ["group"], top_n).select("group", "rank", "word", "cnt")


def group_word_sums(reviews: DataFrame, groups: Mapping[str, Sequence[str]] = P.GROUP_KEYWORDS,
                    tokens: str = "tokens") -> DataFrame:
    """(group, word, cnt): word counts over the reviews matching each keyword group; they add up
    over inputs (``merge_sums``)."""
    r = reviews.select(F.explode(keyword_groups(tokens, groups)).alias("group"), tokens)
    return r.select("group", F.explode(tokens).alias("word")).groupBy("group", "word") \
        .agg(F.count(F.lit(1)).alias("cnt"))


def top_words_by_label(reviews: DataFrame, top_n: int = P.LABEL_WORD_TOP_N, label: str = "label",
                       tokens: str = "tokens") -> DataFrame:
    """Token totals per label (word-cloud input), top-n per label."""
    counts = (reviews.where(F.col(label).isin(0, 1))
                     .select(F.col(label).alias("label"), F.explode(tokens).alias("word"))
                     .groupBy("label", "word").agg(F.count(F.lit(1)).alias("cnt")))
    return ranked_counts(counts, ["label"], top_n).select("label", "rank", "word", "cnt")


def top_tokens(df: DataFrame, tokens: str = "product_tokens", top_n: int = P.NAME_TOKEN_TOP_N) -> DataFrame:
    """Corpus token frequency, top-n (a top-k report)."""
    counts = df.select(F.explode(tokens).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    return ranked_counts(counts, [], top_n).select("rank", "word", "cnt")
