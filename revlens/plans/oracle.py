"""DuckDB SQL oracles, one per catalogue query (same column names and types).

Written independently of the Spark plans (per-review tf, GROUPING SETS,
quantile_cont, ...) over the same driver tables, so agreement is evidence.
"""

from __future__ import annotations

from .. import params as P

STOP = ", ".join(f"'{w}'" for w in P.ENGLISH_STOPWORDS)


def tok(col: str) -> str:
    return (f"list_filter(regexp_split_to_array(lower({col}), '[^a-z0-9]+'), "
            f"lambda t: t <> '' AND NOT list_contains([{STOP}], t))")


RT = f"""rt AS (
  SELECT d.doc_id AS review_id, d.source AS product_id, d.lang AS category, l.quality AS label,
         {tok('d.text')} AS tokens
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""

RV = """rv AS (
  SELECT *, l_partkey AS product_id, CAST(ceil(l_quantity / 10) AS INTEGER) AS score,
         CAST(l_shipdate AS DATE) AS date, CAST(round(l_discount * 100) AS INTEGER) AS helpful_count,
         l_returnflag = 'R' AS has_image
  FROM lineitem)"""

# product metadata in long form: distribution entries (k, v) and the product rows
PM = RV + """,
dl AS (
  SELECT CAST(product_id AS VARCHAR) AS product_id, CAST(score AS VARCHAR) AS k, count(*) AS v
  FROM rv GROUP BY ALL
  UNION ALL
  SELECT CAST(product_id AS VARCHAR), '0', count(*) FROM rv WHERE l_returnflag = 'R' GROUP BY ALL),
pm AS (SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS category,
              CAST(p_size AS VARCHAR) AS total_reviews FROM part),
pv AS (SELECT pm.product_id,
              any_value(pm.category) AS category,
              any_value(TRY_CAST(trim(pm.total_reviews) AS BIGINT)) AS total,
              count(dl.k) AS n_keys,
              sum(CASE WHEN dl.k IN ('1','2','3','4','5') THEN dl.v ELSE 0 END) AS valid_sum,
              count(CASE WHEN dl.k NOT IN ('1','2','3','4','5') THEN 1 END) AS n_invalid
       FROM pm LEFT JOIN dl ON dl.product_id = pm.product_id GROUP BY pm.product_id),
prc AS (SELECT product_id,
               CAST(sum(coalesce(total, CASE WHEN n_keys > 0 THEN valid_sum END, 0)) AS BIGINT) AS review_cnt
        FROM pv GROUP BY product_id)"""


def keywords_sql(level_sets: list[tuple[str, str, int]], top_n: int, extra_cols: list[str]) -> str:
    """level_sets: (level name, grouping-set key list, min_doc_freq)."""
    gsets_w = ", ".join(f"({k + ', ' if k else ''}word)" for _, k, _ in level_sets)
    gsets_t = ", ".join(f"({k})" for _, k, _ in level_sets)
    keycols = ", ".join(extra_cols)
    kc = (keycols + ", ") if keycols else ""

    def level_case():
        parts = []
        for name, k, _ in level_sets:
            present = set(x.strip() for x in k.split(",") if x.strip())
            conds = [f"GROUPING({c}) = {0 if c in present else 1}" for c in extra_cols]
            parts.append(f"WHEN {' AND '.join(conds) if conds else 'TRUE'} THEN '{name}'")
        return "CASE " + " ".join(parts) + " END"

    thr = " ".join(f"WHEN '{n}' THEN {m}" for n, _, m in level_sets)
    join_keys = " ".join(f"AND w.{c} IS NOT DISTINCT FROM t.{c}" for c in extra_cols)
    sel_keys = "".join(f"{c}, " for c in extra_cols)
    return f"""WITH {RT},
elig AS (SELECT * FROM rt WHERE label IN (0, 1) AND len(tokens) > 0),
occ AS (SELECT review_id, category, product_id, label, len(tokens) AS n, unnest(tokens) AS word FROM elig),
tf AS (SELECT review_id, category, product_id, label, word, count(*) / any_value(n) AS tf
       FROM occ GROUP BY review_id, category, product_id, label, word),
wl AS (SELECT {level_case()} AS level, {kc}word,
              sum(CASE WHEN label = 1 THEN tf END) AS pos_sum, sum(CASE WHEN label = 0 THEN tf END) AS neg_sum,
              count(CASE WHEN label = 1 THEN 1 END) AS pos_n, count(CASE WHEN label = 0 THEN 1 END) AS neg_n
       FROM tf GROUP BY GROUPING SETS ({gsets_w})),
tot AS (SELECT {level_case()} AS level, {kc}
               count(CASE WHEN label = 1 THEN 1 END) AS total_pos, count(CASE WHEN label = 0 THEN 1 END) AS total_neg
        FROM rt GROUP BY GROUPING SETS ({gsets_t})),
sc AS (SELECT w.*, w.pos_n + w.neg_n AS support,
              CASE WHEN w.pos_n > 0 THEN w.pos_sum / w.pos_n ELSE 0.0 END AS pos,
              CASE WHEN w.neg_n > 0 THEN w.neg_sum / w.neg_n ELSE 0.0 END AS neg,
              CASE WHEN t.total_pos > 0 THEN w.pos_n / t.total_pos ELSE 0.0 END AS pr,
              CASE WHEN t.total_neg > 0 THEN w.neg_n / t.total_neg ELSE 0.0 END AS nr
       FROM wl w JOIN tot t ON w.level = t.level {join_keys}
       WHERE w.pos_n + w.neg_n >= CASE w.level {thr} END),
sc2 AS (SELECT *, pos - neg AS diff,
               CASE WHEN pr + nr = 0 THEN 0.0 ELSE (pr - nr) / (pr + nr) END AS balanced_ratio FROM sc),
sc3 AS (SELECT *, abs(diff) * ln(1 + support) * balanced_ratio AS score FROM sc2),
rk AS (SELECT *,
         row_number() OVER (PARTITION BY level{''.join(', ' + c for c in extra_cols)} ORDER BY round(score, 9) DESC, word ASC) AS rp,
         row_number() OVER (PARTITION BY level{''.join(', ' + c for c in extra_cols)} ORDER BY round(score, 9) ASC, word DESC) AS rn
       FROM sc3)
SELECT level, {sel_keys}'positive' AS polarity, rp AS rank, word, round(diff, 6) AS diff, round(pos, 6) AS pos,
       round(neg, 6) AS neg, CAST(pos_n AS BIGINT) AS pos_n, CAST(neg_n AS BIGINT) AS neg_n,
       CAST(support AS BIGINT) AS support, round(balanced_ratio, 6) AS balanced_ratio, round(score, 6) AS score
FROM rk WHERE rp <= {top_n}
UNION ALL
SELECT level, {sel_keys}'negative' AS polarity, rn AS rank, word, round(diff, 6), round(pos, 6), round(neg, 6),
       CAST(pos_n AS BIGINT), CAST(neg_n AS BIGINT), CAST(support AS BIGINT), round(balanced_ratio, 6), round(score, 6)
FROM rk WHERE rn <= {top_n}"""


SQL: dict[str, str] = {}

SQL["sentiment_keywords_overall"] = keywords_sql([("global", "", 20)], 30, [])
SQL["sentiment_keywords_category"] = keywords_sql([("category", "category", 20)], 30, ["category"])
SQL["sentiment_keywords_product"] = keywords_sql([("product", "category, product_id", 5)], 30,
                                                 ["category", "product_id"])
SQL["sentiment_keywords_all_levels"] = keywords_sql(
    [("global", "", 20), ("category", "category", 20), ("product", "category, product_id", 5)], 30,
    ["category", "product_id"])

SQL["sentiment_keywords_weighted"] = f"""WITH {RT},
tk AS (SELECT * FROM rt WHERE len(tokens) > 0),
occ AS (SELECT review_id, len(tokens) AS n, unnest(tokens) AS word FROM tk),
tf AS (SELECT review_id, word, count(*) / any_value(n) AS tf FROM occ GROUP BY review_id, word),
df AS (SELECT word, count(*) AS dfreq FROM tf GROUP BY word),
nd AS (SELECT count(*) AS n_docs FROM tk),
wt AS (SELECT tf.review_id, tf.word, tf.tf * ln(nd.n_docs / df.dfreq) AS w
       FROM tf JOIN df USING (word) CROSS JOIN nd),
j AS (SELECT tk.category, tk.label, wt.word, wt.w FROM wt JOIN tk USING (review_id) WHERE tk.label IN (0, 1)),
wl AS (SELECT CASE WHEN GROUPING(category) = 1 THEN 'global' ELSE 'category' END AS level, category, word,
              sum(CASE WHEN label = 1 THEN w END) AS pos_sum, sum(CASE WHEN label = 0 THEN w END) AS neg_sum,
              count(CASE WHEN label = 1 THEN 1 END) AS pos_n, count(CASE WHEN label = 0 THEN 1 END) AS neg_n
       FROM j GROUP BY GROUPING SETS ((category, word), (word))),
tot AS (SELECT CASE WHEN GROUPING(category) = 1 THEN 'global' ELSE 'category' END AS level, category,
               count(CASE WHEN label = 1 THEN 1 END) AS total_pos, count(CASE WHEN label = 0 THEN 1 END) AS total_neg
        FROM tk GROUP BY GROUPING SETS ((category), ())),
sc AS (SELECT w.*, w.pos_n + w.neg_n AS support,
              CASE WHEN w.pos_n > 0 THEN w.pos_sum / w.pos_n ELSE 0.0 END AS pos,
              CASE WHEN w.neg_n > 0 THEN w.neg_sum / w.neg_n ELSE 0.0 END AS neg,
              CASE WHEN t.total_pos > 0 THEN w.pos_n / t.total_pos ELSE 0.0 END AS pr,
              CASE WHEN t.total_neg > 0 THEN w.neg_n / t.total_neg ELSE 0.0 END AS nr
       FROM wl w JOIN tot t ON w.level = t.level AND w.category IS NOT DISTINCT FROM t.category
       WHERE w.pos_n + w.neg_n >= 20),
sc2 AS (SELECT *, pos - neg AS diff,
               CASE WHEN pr + nr = 0 THEN 0.0 ELSE (pr - nr) / (pr + nr) END AS balanced_ratio FROM sc),
sc3 AS (SELECT *, abs(diff) * ln(1 + support) * balanced_ratio AS score FROM sc2),
rk AS (SELECT *,
         row_number() OVER (PARTITION BY level, category ORDER BY round(score, 9) DESC, word ASC) AS rp,
         row_number() OVER (PARTITION BY level, category ORDER BY round(score, 9) ASC, word DESC) AS rn
       FROM sc3)
SELECT level, category, 'positive' AS polarity, rp AS rank, word, round(diff, 6) AS diff, round(pos, 6) AS pos,
       round(neg, 6) AS neg, CAST(pos_n AS BIGINT) AS pos_n, CAST(neg_n AS BIGINT) AS neg_n,
       CAST(support AS BIGINT) AS support, round(balanced_ratio, 6) AS balanced_ratio, round(score, 6) AS score
FROM rk WHERE rp <= 50
UNION ALL
SELECT level, category, 'negative', rn, word, round(diff, 6), round(pos, 6), round(neg, 6),
       CAST(pos_n AS BIGINT), CAST(neg_n AS BIGINT), CAST(support AS BIGINT), round(balanced_ratio, 6), round(score, 6)
FROM rk WHERE rn <= 50"""

SQL["sentiment_counts"] = f"""WITH {RT}
SELECT CASE WHEN GROUPING(category) = 1 THEN 'global' WHEN GROUPING(product_id) = 1 THEN 'category'
            ELSE 'product' END AS level, category, product_id,
       count(*) AS review_count, count(CASE WHEN label = 1 THEN 1 END) AS pos_count,
       count(CASE WHEN label = 0 THEN 1 END) AS neg_count,
       count(CASE WHEN len(tokens) > 0 THEN 1 END) AS token_review_count
FROM rt GROUP BY ROLLUP (category, product_id)"""

SQL["term_frequency"] = f"""WITH {RT},
occ AS (SELECT review_id, len(tokens) AS n, unnest(tokens) AS word FROM rt),
tf AS (SELECT review_id, word, count(*) AS freq, count(*) / any_value(n) AS tf FROM occ GROUP BY review_id, word),
rk AS (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY tf DESC, word) AS rank FROM tf)
SELECT review_id, rank, word, freq, round(tf, 6) AS tf FROM rk"""

_groups = {"g_de": ["der", "die", "und"], "g_es": ["que", "es"], "g_fr": ["la", "le", "des"],
           "g_x": ["ci", "tion"]}
_gvals = ", ".join(f"('{g}', [{', '.join(repr(k) for k in ks)}])" for g, ks in _groups.items())
SQL["group_word_frequency"] = f"""WITH {RT},
g(grp, kws) AS (VALUES {_gvals}),
m AS (SELECT g.grp, rt.review_id, rt.tokens FROM rt JOIN g ON list_has_any(rt.tokens, g.kws)
      WHERE len(rt.tokens) > 0),
c AS (SELECT grp, word, count(*) AS cnt FROM (SELECT grp, unnest(tokens) AS word FROM m) GROUP BY grp, word),
rk AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY cnt DESC, word) AS rank FROM c)
SELECT grp AS "group", rank, word, cnt FROM rk WHERE rank <= 20"""

SQL["top_words_by_label"] = f"""WITH {RT},
c AS (SELECT label, word, count(*) AS cnt FROM (SELECT label, unnest(tokens) AS word FROM rt WHERE label IN (0, 1))
      GROUP BY label, word),
rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY cnt DESC, word) AS rank FROM c)
SELECT CAST(label AS BIGINT) AS label, rank, word, cnt FROM rk WHERE rank <= 100"""

SQL["sentiment_label"] = f"""WITH {RV}
SELECT CAST(score AS BIGINT) AS score,
       CAST(CASE WHEN score >= 4 THEN 1 WHEN score <= 2 THEN 0 END AS BIGINT) AS label, count(*) AS cnt
FROM rv GROUP BY ALL"""

SQL["category_product_counts"] = f"""WITH {PM}
SELECT category, count(DISTINCT product_id) AS product_cnt FROM pm GROUP BY category"""

SQL["product_review_counts"] = f"""WITH {PM} SELECT product_id, review_cnt FROM prc"""

SQL["review_count_summary"] = f"""WITH {PM}
SELECT count(review_cnt) AS count, round(avg(review_cnt), 6) AS mean, round(stddev_samp(review_cnt), 6) AS std,
       round(CAST(min(review_cnt) AS DOUBLE), 6) AS min,
       round(quantile_cont(review_cnt, 0.5), 6) AS p50, round(quantile_cont(review_cnt, 0.75), 6) AS p75,
       round(quantile_cont(review_cnt, 0.9), 6) AS p90, round(quantile_cont(review_cnt, 0.95), 6) AS p95,
       round(quantile_cont(review_cnt, 0.99), 6) AS p99, round(CAST(max(review_cnt) AS DOUBLE), 6) AS max
FROM prc"""

_bins = list(P.REVIEW_COUNT_BINS)
_bin_rows = ", ".join(
    f"({i}, {lo}, {('NULL' if i + 1 == len(_bins) else _bins[i + 1])})" for i, lo in enumerate(_bins))
SQL["review_count_bins"] = f"""WITH {PM},
b(bin_order, lo, hi) AS (VALUES {_bin_rows})
SELECT CASE WHEN b.hi IS NULL THEN CAST(b.lo AS VARCHAR) || '+'
            ELSE CAST(b.lo AS VARCHAR) || '~' || CAST(b.hi - 1 AS VARCHAR) END AS bin,
       CAST(b.bin_order AS BIGINT) AS bin_order,
       count(prc.product_id) AS product_cnt
FROM b LEFT JOIN prc ON prc.review_cnt >= b.lo AND (b.hi IS NULL OR prc.review_cnt < b.hi)
GROUP BY b.bin_order, b.lo, b.hi"""

SQL["score_distribution"] = f"""WITH {PM}
SELECT CAST(k AS BIGINT) AS score, CAST(sum(v) AS BIGINT) AS cnt FROM dl
WHERE k IN ('1','2','3','4','5') GROUP BY k"""

SQL["category_score_distribution"] = f"""WITH {PM}
SELECT pm.category, CAST(dl.k AS BIGINT) AS score, CAST(sum(dl.v) AS BIGINT) AS cnt
FROM dl JOIN pm USING (product_id) WHERE dl.k IN ('1','2','3','4','5') GROUP BY pm.category, dl.k"""

SQL["category_score_summary"] = f"""WITH {PM},
c AS (SELECT pm.category, CAST(dl.k AS BIGINT) AS score, sum(dl.v) AS cnt
      FROM dl JOIN pm USING (product_id) WHERE dl.k IN ('1','2','3','4','5') GROUP BY pm.category, dl.k)
SELECT category, CAST(sum(cnt) AS BIGINT) AS total_cnt, CAST(sum(score * cnt) AS BIGINT) AS score_sum,
       round(sum(score * cnt) / sum(cnt), 6) AS mean_score
FROM c GROUP BY category"""

SQL["data_quality_counters"] = f"""WITH {PM}
SELECT CAST(0 AS BIGINT) AS missing_product_id,
       CAST(sum(n_invalid) AS BIGINT) AS invalid_score,
       count(CASE WHEN n_keys = 0 THEN 1 END) AS missing_rating_distribution,
       count(CASE WHEN n_keys > 0 AND total IS NOT NULL AND total <> valid_sum THEN 1 END) AS review_cnt_mismatch,
       count(*) AS total_products_seen,
       CAST(sum(coalesce(total, CASE WHEN n_keys > 0 THEN valid_sum END, 0)) AS BIGINT) AS total_reviews_collected
FROM pv"""

SQL["avg_rating_weighted"] = f"""WITH {PM},
r AS (SELECT pm.product_id,
             CAST(coalesce(sum(CASE WHEN k = '5' THEN v END), 0) AS BIGINT) AS rating_5,
             CAST(coalesce(sum(CASE WHEN k = '4' THEN v END), 0) AS BIGINT) AS rating_4,
             CAST(coalesce(sum(CASE WHEN k = '3' THEN v END), 0) AS BIGINT) AS rating_3,
             CAST(coalesce(sum(CASE WHEN k = '2' THEN v END), 0) AS BIGINT) AS rating_2,
             CAST(coalesce(sum(CASE WHEN k = '1' THEN v END), 0) AS BIGINT) AS rating_1
      FROM pm LEFT JOIN dl USING (product_id) GROUP BY pm.product_id),
a AS (SELECT *, rating_5 + rating_4 + rating_3 + rating_2 + rating_1 AS total,
             (5 * rating_5 + 4 * rating_4 + 3 * rating_3 + 2 * rating_2 + rating_1)
               / nullif(rating_5 + rating_4 + rating_3 + rating_2 + rating_1, 0) AS avg_rating FROM r),
rk AS (SELECT *, row_number() OVER (ORDER BY avg_rating DESC, product_id) AS rank FROM a WHERE avg_rating IS NOT NULL)
SELECT product_id, rating_5, rating_4, rating_3, rating_2, rating_1, CAST(total AS BIGINT) AS total,
       round(avg_rating, 6) AS avg_rating, rank FROM rk WHERE rank <= 10"""

# ------------------------------------------------------------------ review-level EDA
SQL["product_scores"] = f"""WITH {RV},
m AS (SELECT product_id, avg(score) AS mean_score, avg(coalesce(helpful_count, 0)) AS mean_helpful,
             count(score) AS review_cnt FROM rv GROUP BY product_id)
SELECT m.product_id, p.p_name AS product_name, round(mean_score, 6) AS mean_score,
       round(mean_helpful, 6) AS mean_helpful, review_cnt
FROM m LEFT JOIN part p ON p.p_partkey = m.product_id"""

SQL["top_products_by_reviews"] = f"""WITH {RV},
c AS (SELECT product_id, count(*) AS review_cnt FROM rv GROUP BY product_id),
t AS (SELECT *, row_number() OVER (ORDER BY review_cnt DESC, product_id) AS rank FROM c)
SELECT t.rank, t.product_id, coalesce(p.p_name, CAST(t.product_id AS VARCHAR)) AS name, t.review_cnt
FROM t LEFT JOIN part p ON p.p_partkey = t.product_id WHERE t.rank <= 6"""

SQL["top_products_monthly"] = f"""WITH {RV},
c AS (SELECT product_id, count(*) AS review_cnt FROM rv GROUP BY product_id),
t AS (SELECT product_id FROM c ORDER BY review_cnt DESC, product_id LIMIT 5)
SELECT product_id, strftime(date, '%Y-%m') AS month, count(*) AS review_cnt, round(avg(score), 6) AS mean_score,
       count(CASE WHEN score = 1 THEN 1 END) AS s1, count(CASE WHEN score = 2 THEN 1 END) AS s2,
       count(CASE WHEN score = 3 THEN 1 END) AS s3, count(CASE WHEN score = 4 THEN 1 END) AS s4,
       count(CASE WHEN score = 5 THEN 1 END) AS s5
FROM rv WHERE product_id IN (SELECT product_id FROM t) GROUP BY ALL"""

SQL["score_share"] = f"""WITH {RV},
c AS (SELECT score, count(*) AS cnt FROM rv GROUP BY score)
SELECT CAST(score AS BIGINT) AS score, cnt, round(cnt / sum(cnt) OVER (), 6) AS share FROM c"""

SQL["helpful_by_score"] = f"""WITH {RV},
h AS (SELECT score, coalesce(helpful_count, 0) AS helpful FROM rv)
SELECT CAST(score AS BIGINT) AS score, count(helpful) AS count, round(avg(helpful), 6) AS mean,
       round(stddev_samp(helpful), 6) AS std, round(CAST(min(helpful) AS DOUBLE), 6) AS min,
       round(quantile_cont(helpful, 0.25), 6) AS p25, round(quantile_cont(helpful, 0.5), 6) AS p50,
       round(quantile_cont(helpful, 0.75), 6) AS p75, round(CAST(max(helpful) AS DOUBLE), 6) AS max
FROM h GROUP BY score"""

SQL["score_correlations"] = f"""WITH {RV},
h AS (SELECT product_id, score, coalesce(helpful_count, 0) AS helpful, CAST(has_image AS INTEGER) AS img FROM rv),
pm AS (SELECT product_id, avg(score) AS ms, avg(helpful) AS mh FROM h GROUP BY product_id)
SELECT round(corr(score, helpful), 6) AS r_score_helpful, round(corr(score, img), 6) AS r_score_image,
       round((SELECT corr(ms, mh) FROM pm), 6) AS r_product_means
FROM h"""

SQL["rating_heatmap_top"] = f"""WITH {RV},
pv AS (SELECT product_id,
              count(CASE WHEN score = 1 THEN 1 END) AS s1, count(CASE WHEN score = 2 THEN 1 END) AS s2,
              count(CASE WHEN score = 3 THEN 1 END) AS s3, count(CASE WHEN score = 4 THEN 1 END) AS s4,
              count(CASE WHEN score = 5 THEN 1 END) AS s5, count(*) AS total
       FROM rv GROUP BY product_id),
t AS (SELECT *, row_number() OVER (ORDER BY total DESC, product_id) AS rank FROM pv)
SELECT t.product_id, s1, s2, s3, s4, s5, total, rank, substr(p.p_name, 1, 30) AS short_name
FROM t LEFT JOIN part p ON p.p_partkey = t.product_id WHERE rank <= 10"""

_SPINE = """sp AS (SELECT product_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month
       FROM (SELECT product_id, min(month) AS lo, max(month) AS hi FROM per GROUP BY product_id))"""

SQL["monthly_mean_score"] = f"""WITH {RV},
per AS (SELECT product_id, CAST(date_trunc('month', date) AS DATE) AS month, avg(score) AS v
        FROM rv WHERE date IS NOT NULL AND score IS NOT NULL GROUP BY ALL),
{_SPINE}
SELECT sp.product_id, last_day(sp.month) AS month_end, round(per.v, 6) AS mean
FROM sp LEFT JOIN per ON per.product_id = sp.product_id AND per.month = sp.month"""

SQL["monthly_review_count"] = f"""WITH {RV},
per AS (SELECT product_id, CAST(date_trunc('month', date) AS DATE) AS month, count(*) AS v
        FROM rv WHERE date IS NOT NULL GROUP BY ALL),
{_SPINE}
SELECT sp.product_id, last_day(sp.month) AS month_end, coalesce(per.v, 0) AS count
FROM sp LEFT JOIN per ON per.product_id = sp.product_id AND per.month = sp.month"""

SQL["dataset_totals"] = f"""WITH {RV},
a AS (SELECT count(DISTINCT product_id) AS products, count(*) AS reviews,
             count(CASE WHEN l_returnflag <> 'N' THEN 1 END) AS text_reviews,
             count(CASE WHEN score = 1 THEN 1 END) AS rating_1, count(CASE WHEN score = 2 THEN 1 END) AS rating_2,
             count(CASE WHEN score = 3 THEN 1 END) AS rating_3, count(CASE WHEN score = 4 THEN 1 END) AS rating_4,
             count(CASE WHEN score = 5 THEN 1 END) AS rating_5 FROM rv)
SELECT metric, CAST(value AS BIGINT) AS value FROM a
UNPIVOT (value FOR metric IN (products, reviews, text_reviews, rating_1, rating_2, rating_3, rating_4, rating_5))"""

SQL["product_text_counts"] = f"""WITH {RV}
SELECT product_id, count(*) AS total_count, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS text_count,
       count(CASE WHEN l_returnflag = 'R' OR l_linestatus = 'O' THEN 1 END) AS with_text_count
FROM rv GROUP BY product_id"""

SQL["review_length_stats"] = """WITH l AS (SELECT lang, length(text) AS char_length FROM documents WHERE length(text) > 0)
SELECT lang, count(char_length) AS count, round(avg(char_length), 6) AS mean, round(stddev_samp(char_length), 6) AS std,
       round(CAST(min(char_length) AS DOUBLE), 6) AS min, round(quantile_cont(char_length, 0.25), 6) AS p25,
       round(quantile_cont(char_length, 0.5), 6) AS p50, round(quantile_cont(char_length, 0.75), 6) AS p75,
       round(CAST(max(char_length) AS DOUBLE), 6) AS max
FROM l GROUP BY lang"""

SQL["length_histogram"] = """WITH l AS (SELECT CAST(length(text) AS DOUBLE) AS v FROM documents WHERE text IS NOT NULL),
mm AS (SELECT min(v) AS lo, max(v) AS hi FROM l),
b AS (SELECT v, CASE WHEN mm.hi = mm.lo THEN 1
                     ELSE least(CAST(floor((v - mm.lo) * 50 / (mm.hi - mm.lo)) AS BIGINT) + 1, 50) END AS bucket
      FROM l, mm)
SELECT bucket, count(*) AS cnt, round(min(v), 6) AS bin_min, round(max(v), 6) AS bin_max FROM b GROUP BY bucket"""

SQL["reviews_with_products"] = f"""WITH {RV},
p AS (SELECT p_partkey, p_brand FROM part)
SELECT p.p_brand AS brand, count(*) AS cnt, round(avg(rv.score), 6) AS mean_score
FROM rv LEFT JOIN p ON p.p_partkey = rv.product_id GROUP BY p.p_brand"""

SQL["union_reviews"] = f"""WITH {RV},
u AS (SELECT 'parquet' AS source, helpful_count, has_image, CAST(NULL AS INTEGER) AS label FROM rv WHERE l_returnflag = 'R'
      UNION ALL
      SELECT 'json', 0, false, CAST(NULL AS INTEGER) FROM rv WHERE l_returnflag <> 'R')
SELECT source, count(*) AS cnt, CAST(sum(helpful_count) AS BIGINT) AS helpful_sum,
       count(CASE WHEN has_image THEN 1 END) AS image_cnt, count(label) AS labelled
FROM u GROUP BY source"""

# ------------------------------------------------------------------ clean / sampling / incremental / scans
_LI_ORD = ("l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
           "l_returnflag, l_linestatus, l_shipdate")
_LI_TOTAL = "l_orderkey, " + _LI_ORD

SQL["unnest_products"] = f"""SELECT l.l_orderkey,
       CAST(row_number() OVER (PARTITION BY l.l_orderkey ORDER BY {_LI_ORD}) - 1 AS BIGINT) AS product_pos,
       l.l_partkey AS product_id, concat_ws('_', o.o_orderstatus, 'with', CAST(l.l_partkey AS VARCHAR)) AS product_key
FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey"""

SQL["flatten_reviews"] = f"""SELECT l.l_orderkey,
       CAST(row_number() OVER (PARTITION BY l.l_orderkey ORDER BY {_LI_ORD}) - 1 AS BIGINT) AS review_pos,
       l.l_partkey, o.o_orderpriority, CAST(ceil(l.l_quantity / 10) AS BIGINT) AS score
FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey"""

SQL["nullify_defaults"] = """SELECT count(*) AS rows, count(CASE WHEN l_discount = 0 THEN 1 END) AS null_discount,
       count(CASE WHEN l_returnflag = 'N' THEN 1 END) AS null_flag,
       count(CASE WHEN l_returnflag <> 'R' THEN 1 END) AS null_image
FROM lineitem"""

SQL["split_by_text"] = f"""WITH {RV}
SELECT l_returnflag <> 'N' AS has_text, CAST(score AS BIGINT) AS score, count(*) AS cnt FROM rv GROUP BY ALL"""

SQL["min_reviews_filter"] = """SELECT p_partkey AS product_id, p_name AS product_name FROM part
WHERE p_partkey IN (SELECT l_partkey FROM lineitem GROUP BY l_partkey HAVING count(*) >= 30)"""

SQL["min_declared_filter"] = """SELECT p_partkey AS product_id, CAST(p_size AS VARCHAR) AS total_reviews
FROM part WHERE p_size >= 30"""

SQL["dedupe_reviews"] = f"""WITH {RV},
k AS (SELECT *, row_number() OVER (PARTITION BY product_id, date, l_suppkey ORDER BY {_LI_TOTAL}) AS rn FROM rv)
SELECT product_id, date, l_suppkey, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity
FROM k WHERE rn = 1"""

SQL["dedupe_products"] = """SELECT p_name AS product_name, min(p_partkey) AS product_id FROM part GROUP BY p_name"""

SQL["stratified_quota"] = f"""WITH {RV},
k AS (SELECT *, row_number() OVER (PARTITION BY product_id, score ORDER BY {_LI_TOTAL}) AS seq,
             count(*) OVER (PARTITION BY product_id, score) AS n FROM rv)
SELECT product_id, CAST(score AS BIGINT) AS score, seq, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber
FROM k WHERE seq <= greatest(3, CAST(floor(0.25 * n) AS BIGINT))"""

SQL["cumulative_cap"] = """WITH c AS (SELECT l_partkey AS product_id, count(*) AS review_cnt FROM lineitem GROUP BY l_partkey),
i AS (SELECT p.p_type AS category, c.product_id, c.review_cnt FROM c JOIN part p ON p.p_partkey = c.product_id),
r AS (SELECT *, coalesce(sum(review_cnt) OVER (PARTITION BY category ORDER BY product_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS running_before FROM i)
SELECT category, product_id, review_cnt, CAST(running_before AS BIGINT) AS running_before FROM r
WHERE running_before < 2000"""

SQL["incremental_new_only"] = """SELECT page_id, url FROM pages
WHERE url NOT IN (SELECT url FROM pages WHERE starts_with(url, 'https:'))"""

SQL["incremental_backfill"] = """WITH p AS (SELECT page_id, url, length(html) AS html_len FROM pages),
prev AS (SELECT * FROM p WHERE url IN (SELECT url FROM pages WHERE starts_with(url, 'https:'))),
fresh AS (SELECT * FROM p WHERE contains(url, '.com') OR NOT starts_with(url, 'https:'))
SELECT page_id, url, html_len, 'backfill' AS origin FROM prev WHERE url NOT IN (SELECT url FROM fresh)
UNION ALL
SELECT page_id, url, html_len, 'new' FROM fresh"""

SQL["scan_parquet_count"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in
    ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
     "embeddings", "pages", "benchmark", "labels", "conversations"])

SQL["scan_filter_in"] = """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_quantity
FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#13')"""

SQL["scan_json_props"] = """SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS cnt FROM events GROUP BY 1"""

# ------------------------------------------------------------------ text / parsing / pages / classify / vectors
def _collapse(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '\s+', ' ', 'g'), '^ | $', '', 'g')"


SQL["normalize_text"] = r"""WITH n AS (
  SELECT doc_id, CASE WHEN text IS NULL OR text = '' THEN text
         ELSE trim(regexp_replace(regexp_replace(text, '[^a-zA-Z0-9 \t\n\r.,!?~]', '', 'g'), '\s+', ' ', 'g')) END AS t
  FROM documents)
SELECT doc_id, length(t) AS n_chars, md5(t) AS md5 FROM n"""

SQL["text_normalisers"] = r"""WITH s AS (
  SELECT doc_id, text, nfc_normalize(replace(replace(text, 'é', 'e' || chr(769)), 'ü', 'u' || chr(776))) AS n,
         replace(text, 'o', 'ㅋㅋㅋ') AS j FROM documents),
x AS (SELECT doc_id,
  CASE WHEN n IS NULL OR n = '' THEN n
       ELSE trim(regexp_replace(regexp_replace(n, '[^a-zA-Z0-9 \t\n\r.,!?~éü]', '', 'g'), '\s+', ' ', 'g')) END AS nfc,
  CASE WHEN text IS NULL OR text = '' THEN text
       ELSE trim(regexp_replace(regexp_replace(text, '[^가-힣a-zA-Z0-9\s.,!?~❤️]', '', 'g'), '\s+', ' ', 'g')) END AS plain,
  trim(regexp_replace(regexp_replace(text, '[^a-z\s]', ' ', 'g'), '\s+', ' ', 'g')) AS tokens,
  CASE WHEN j IS NULL OR j = '' THEN j
       ELSE trim(regexp_replace(regexp_replace(regexp_replace(j, '[^a-z ㄱ-ㅎ]', '', 'g'), 'ㅋ+', 'ㅋㅋ', 'g'),
                                '\s+', ' ', 'g')) END AS jamo FROM s)
SELECT doc_id, length(nfc) AS nfc_chars, md5(nfc) AS nfc_md5, md5(plain) AS plain_md5, md5(tokens) AS tokens_md5,
       md5(jamo) AS jamo_md5 FROM x"""

SQL["tokenize_stopwords"] =f"""SELECT doc_id, len({tok('text')}) AS token_count,
       len(list_distinct({tok('text')})) AS distinct_count FROM documents"""

SQL["strip_html"] = """SELECT page_id, length(regexp_replace(html, '<[^>]+>', '', 'g')) AS text_len FROM pages"""

_RAW_PRICE = r"""CASE p_type
  WHEN 'STANDARD' THEN CAST(CAST(floor(p_retailprice / 1000) AS BIGINT) AS VARCHAR) || ',' ||
                       lpad(CAST(CAST(floor(p_retailprice) AS BIGINT) % 1000 AS VARCHAR), 3, '0')
  WHEN 'PROMO' THEN '-' || CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR)
  WHEN 'SMALL' THEN CAST(p_retailprice AS VARCHAR)
  WHEN 'LARGE' THEN ' ' || CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) || ' '
  WHEN 'ECONOMY' THEN ''
  ELSE CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) END"""

SQL["lenient_int"] = rf"""WITH s AS (SELECT p_partkey AS product_id, {_RAW_PRICE} AS raw FROM part)
SELECT product_id, raw,
       CASE WHEN regexp_matches(replace(raw, ',', ''), '^[0-9]+$') THEN CAST(replace(raw, ',', '') AS BIGINT) ELSE 0 END
         AS lenient,
       CASE WHEN regexp_matches(trim(raw), '^[+-]?[0-9]+$') THEN CAST(trim(raw) AS BIGINT) END AS safe
FROM s"""

SQL["parse_dates"] = r"""WITH x AS (
  SELECT o_orderkey,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'yesterday' ELSE strftime(o_orderdate, '%Y.%-m.%-d.') END AS raw,
         strftime(o_orderdate, '%Y.%-m.%-d %-H:%-M:%-S') AS ts_raw
  FROM orders)
SELECT o_orderkey, raw,
       CAST(try_strptime(regexp_replace(trim(raw), '^\.+|\.+$', '', 'g'), '%Y.%m.%d') AS DATE) AS parsed,
       try_strptime(trim(ts_raw), '%Y.%m.%d %H:%M:%S') AS parsed_ts
FROM x"""

SQL["parse_token_string"] = """WITH s AS (SELECT p_partkey AS product_id,
  regexp_extract_all('[''' || replace(p_name, ' ', ''', ''') || ''']', '''([^'']+)''', 1) AS toks FROM part)
SELECT product_id, CAST(unnest(generate_series(0, len(toks) - 1)) AS BIGINT) AS pos, unnest(toks) AS token FROM s"""

SQL["normalize_brand"] = """WITH b AS (SELECT lower(trim('  ' || p_brand || ' ')) AS x FROM part)
SELECT CASE x WHEN 'brand#1' THEN 'acme' WHEN 'brand#11' THEN 'acme' WHEN 'brand#2' THEN 'zenith' ELSE x END
       AS brand_std, count(*) AS cnt FROM b GROUP BY 1"""

SQL["normalize_category"] = """WITH c AS (SELECT lower(trim(string_split('A > B > ' || p_type, '>')[-1])) AS leaf FROM part)
SELECT CASE leaf WHEN 'standard' THEN 'std' WHEN 'promo' THEN 'sale' WHEN 'economy' THEN 'sale' ELSE leaf END
       AS category_normal, count(*) AS cnt FROM c GROUP BY 1"""

SQL["category_fallback"] = """WITH c AS (SELECT CASE WHEN p_size > 45 THEN '  ' ELSE 'A > ' || p_type END AS path FROM part),
l AS (SELECT trim(string_split(trim(path), '>')[-1]) AS leaf FROM c)
SELECT coalesce(nullif(leaf, ''), 'UNKNOWN_CATEGORY') AS category, count(*) AS cnt FROM l GROUP BY 1"""


def _brand_pat(b: str) -> str:
    return (rf"'\Q' || {b} || '\E|' || array_to_string(list_transform(string_split({b}, ''), "
            rf"lambda c: '\Q' || c || '\E'), '\s*')")


SQL["remove_brand"] = rf"""WITH s AS (SELECT p_partkey AS product_id, string_split(p_name, ' ')[1] AS brand, p_name FROM part),
n AS (SELECT product_id, brand, array_to_string(string_split(brand, ''), ' ') || ' ' || p_name AS name FROM s)
SELECT product_id, {_collapse("regexp_replace(lower(name), " + _brand_pat("brand") + ", ' ', 'g')")} AS cleaned
FROM n"""


def _rules_sql(x: str, rules) -> str:
    for pat, rep in rules:
        pat_sql = pat.replace("'", "''")
        x = f"regexp_replace({x}, '{pat_sql}', '{rep}', 'g')"
    return x


def _clean_name_sql(name: str, brand: str, noise, synonyms) -> str:
    x1 = rf"lower(regexp_replace({name}, '^\s+|\s+$', '', 'g'))"
    x2 = _rules_sql(x1, [(p, " ") for p in noise])
    x3 = f"CASE WHEN {brand} IS NULL OR {brand} = '' THEN {x2} ELSE " + \
        _collapse(f"regexp_replace(lower({x2}), {_brand_pat(brand)}, ' ', 'g')") + " END"
    x4 = _collapse(_rules_sql(f"lower({x3})", synonyms))
    return _collapse(x4)


_DECOR = "'[x] ' || p_name || ' 50ml 3pcs, #1'"
SQL["clean_product_name"] = f"""WITH s AS (SELECT p_partkey AS product_id, {_DECOR} AS name,
  lower(regexp_replace(p_brand, '^\\s+|\\s+$', '', 'g')) AS brand FROM part)
SELECT product_id, {_clean_name_sql("name", "brand", P.ASCII_NOISE_RULES, P.ASCII_SYNONYM_RULES)} AS clean FROM s"""

_drop = ", ".join(f"'{t}'" for t in P.ASCII_DROP_TOKENS)
_tmap = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in P.ASCII_TOKEN_MAP.items())
_STD = f"""s AS (SELECT p_partkey AS product_id,
  lower(trim(' ' || p_brand)) AS b0, 'Home > ' || p_type AS category_path, {_DECOR} AS name FROM part),
s2 AS (SELECT product_id,
  CASE b0 WHEN 'brand#1' THEN 'acme' WHEN 'brand#11' THEN 'acme' WHEN 'brand#2' THEN 'zenith' ELSE b0 END AS brand,
  lower(trim(string_split(category_path, '>')[-1])) AS leaf, name FROM s),
s3 AS (SELECT product_id, brand,
  CASE leaf WHEN 'standard' THEN 'std' WHEN 'promo' THEN 'sale' WHEN 'economy' THEN 'sale' ELSE leaf END AS category_normal,
  {_clean_name_sql("name", "brand", P.ASCII_NOISE_RULES, P.ASCII_SYNONYM_RULES)} AS product_name_clean FROM s2),
s4 AS (SELECT *, list_transform(list_filter(list_filter(regexp_split_to_array(product_name_clean, '\\s+'),
                   lambda t: t <> ''), lambda t: t NOT IN ({_drop})),
                   lambda t: CASE t {_tmap} ELSE t END) AS toks FROM s3)"""

SQL["standardize_products"] = f"""WITH {_STD}
SELECT product_id, brand, category_normal, product_name_clean, CAST(len(toks) AS BIGINT) AS n_tokens,
       array_to_string(toks, ' ') AS tokens FROM s4"""

SQL["top_name_tokens"] = f"""WITH {_STD},
c AS (SELECT word, count(*) AS cnt FROM (SELECT unnest(toks) AS word FROM s4) GROUP BY word),
r AS (SELECT *, row_number() OVER (ORDER BY cnt DESC, word) AS rank FROM c)
SELECT rank, word, cnt FROM r WHERE rank <= 30"""


def _classify_sql(groups: dict) -> str:
    names = list(groups)
    name_hits = ", ".join(
        "CASE WHEN " + " OR ".join(f"contains(coalesce(p_name, ''), '{k}')" for k in kws) + f" THEN '{g}' END"
        for g, kws in groups.items())
    cnt_rows = " UNION ALL ".join(
        f"SELECT doc_id AS product_id, '{g}' AS grp, "
        + " + ".join(f"(length(coalesce(text, '')) - length(replace(coalesce(text, ''), '{k}', ''))) // {len(k)}"
                     for k in kws) + " AS cnt FROM documents"
        for g, kws in groups.items())
    return f"""WITH nm AS (SELECT p_partkey AS product_id,
     list_sort(list_filter([{name_hits}], lambda x: x IS NOT NULL)) AS found FROM part),
nr AS (SELECT product_id, CASE WHEN len(found) = 0 THEN NULL WHEN len(found) = 1 THEN found[1]
       ELSE 'mixed(' || array_to_string(found, ',') || ')' END AS name_rule FROM nm),
c AS (SELECT product_id, grp, sum(cnt) AS cnt FROM ({cnt_rows}) GROUP BY product_id, grp),
m AS (SELECT product_id, max(cnt) AS mx FROM c GROUP BY product_id),
w AS (SELECT c.product_id, any_value(m.mx) AS mx, list_sort(list(c.grp)) AS gs FROM c JOIN m USING (product_id)
      WHERE c.cnt = m.mx GROUP BY c.product_id),
rr AS (SELECT product_id, CASE WHEN mx <= 0 THEN 'unclassified' WHEN len(gs) = 1 THEN gs[1]
       ELSE 'mixed(' || array_to_string(gs, ',') || ')' END AS review_rule FROM w)
SELECT nr.product_id, coalesce(nr.name_rule, rr.review_rule, 'unclassified') AS skin_type
FROM nr LEFT JOIN rr USING (product_id)"""


SQL["classify_by_keywords"] = _classify_sql(P.ASCII_GROUP_KEYWORDS)


def _clean_page(x: str) -> str:
    y = f"translate({x}, chr(160) || chr(8232) || chr(8233), '   ')"
    y = rf"regexp_replace({y}, '[^\P{{C}}\n\r\t]|[^\P{{Z}} ]', '', 'g')"
    y = rf"regexp_replace({y}, '^[ \n\r\t]+|[ \n\r\t]+$', '', 'g')"
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN {x} ELSE {y} END"


_crumbs = (r"array_to_string(list_filter(list_transform(regexp_extract_all("
           r"regexp_extract(html, '(?s)<nav[^>]*>(.*?)</nav>', 1), '(?s)<a[^>]*>(.*?)</a>', 1), "
           r"lambda x: " + _clean_page(r"regexp_replace(x, '<[^>]+>', '', 'g')") + r"), lambda x: x <> ''), ' > ')")

SQL["pages_extract"] = rf"""WITH e AS (
  SELECT page_id,
         {_clean_page(r"regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)")} AS title,
         {_clean_page(r"""regexp_extract(html, '<html[^>]*\slang="([^"]*)"', 1)""")} AS lang,
         {_clean_page(r"regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)")} AS h1,
         {_crumbs} AS breadcrumb
  FROM pages)
SELECT * FROM e WHERE page_id IS NOT NULL AND coalesce(title, '') <> ''"""

SQL["pages_blocks"] = r"""WITH b AS (SELECT page_id, regexp_extract_all(html, '(?s)<p>(.*?)</p>', 1) AS bl FROM pages),
x AS (SELECT page_id, unnest(generate_series(0, len(bl) - 1)) AS ord, unnest(bl) AS block FROM b)
SELECT page_id, CAST(ord AS BIGINT) AS ord, CAST((length(block) - length(replace(block, '<b>', ''))) // 3 AS BIGINT) AS n_marker,
       length(regexp_replace(block, '<[^>]+>', '', 'g')) AS text_len
FROM x"""

def _page_text(expr: str) -> str:
    x = rf"regexp_replace({expr}, '<[^>]+>', '', 'g')"
    for entity, char in (("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "chr(34)"), ("&#39;", "chr(39)"),
                         ("&nbsp;", "chr(160)"), ("&amp;", "'&'")):
        x = f"replace({x}, '{entity}', {char})"
    return _clean_page(x)


_li = _page_text(r"regexp_extract(regexp_extract(html, '(?s)<nav[^>]*>(.*?)</nav>', 1), '(?s)<li[^>]*>(.*?)</li>', 1)")
_track = r"regexp_extract(html, 'track\(([0-9]+)\)', 1)"
SQL["product_pages"] = rf"""WITH e AS (
  SELECT page_id, coalesce(nullif({_page_text("regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)")}, ''), 'Unknown') AS product_name,
         coalesce(nullif({_li}, ''), {_track}) AS price_text, TRY_CAST({_track} AS BIGINT) AS n,
         {_page_text("""regexp_extract(html, '(?s)<div class="ad">(.*?)</div>', 1)""")} AS brand,
         {_page_text(r"""regexp_extract(html, '<html[^>]*\slang="([^"]*)"', 1)""")} AS badge,
         regexp_extract(html, '(?s)<nav[^>]*>.*?href="([^"]*)"', 1) AS href
  FROM pages)
SELECT page_id, product_name, coalesce(TRY_CAST(replace(regexp_extract(price_text, '([0-9][0-9,]*)', 1), ',', '') AS BIGINT), 0) AS price,
       coalesce(n, 0) AS total_reviews, brand, badge,
       CASE WHEN contains(href, '/The') THEN 'the' WHEN contains(href, '/E') THEN 'e' ELSE 'plain' END AS delivery_type,
       CASE WHEN badge = 'de' THEN 'official' WHEN product_name = 'Unknown' THEN 'unknown'
            WHEN coalesce(n, 0) = 0 THEN 'metadata' ELSE 'collect' END AS ingest_status
FROM e"""


def _beside(label: str) -> str:
    rules = [f"nullif(regexp_extract(url, '{label}{sign}([0-9,]+)', 1), '')" for sign in ("/", "=")]
    return f"coalesce(TRY_CAST(replace(coalesce({', '.join(rules)}), ',', '') AS BIGINT), 0)"


SQL["rating_map"] = f"""SELECT page_id, {_beside('fr')} AS rating_5, {_beside('en')} AS rating_4, {_beside('de')} AS rating_3,
  {_beside('es')} AS rating_2, {_beside('page')} AS rating_1 FROM pages"""

SQL["review_blocks"] = rf"""WITH b AS (SELECT page_id, regexp_extract_all(html, '(?s)<p>(.*?)</p>', 1) AS bl FROM pages),
x AS (SELECT page_id, unnest(generate_series(1, len(bl))) AS id, unnest(bl) AS block FROM b),
t AS (SELECT *, {_page_text("regexp_extract(block, '(?s)<b>(.*?)<br>', 1)")} AS title,
      coalesce(nullif({_page_text("regexp_extract(block, '(?s)<br>(.*)$', 1)")}, ''), {_page_text("block")}) AS content FROM x)
SELECT page_id, CAST(id AS BIGINT) AS id, CAST((length(block) - length(replace(block, '<br>', ''))) // 4 AS BIGINT) AS score,
       regexp_extract(block, '([0-9]{{4}}[.][0-9]{{1,2}}[.][0-9]{{1,2}})', 1) AS date,
       regexp_extract(block, '([A-Z][a-z]+)', 1) AS nickname, md5(title) AS title_md5,
       md5(title || ' ' || content) AS full_text_md5, contains(block, '<b>') AS has_image,
       coalesce(TRY_CAST(regexp_extract(block, '([0-9]+)', 1) AS BIGINT), 0) AS helpful_count
FROM t"""

SQL["product_identity"] = """SELECT p_partkey,
  CASE WHEN p_size > 5 THEN CAST(p_partkey AS VARCHAR) ELSE 'UNKNOWN_ID' END || '__' ||
  CASE WHEN p_size <= 45 THEN trim(p_name) ELSE 'UNKNOWN_NAME' END AS product_key,
  trim(p_type) || ' > ' || trim(p_brand) AS path, trim(p_brand) AS leaf FROM part"""

SQL["strict_numbers"] = """SELECT o_orderpriority, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS whole,
  CAST(0 AS BIGINT) AS not_whole, sum(floor(o_totalprice) + 0.5) AS halves, CAST(0 AS BIGINT) AS numeric_n
FROM orders GROUP BY o_orderpriority"""

SQL["page_links"] = r"""WITH h AS (SELECT page_id, url, regexp_extract_all(html, 'href="([^"]*)"', 1) AS hs FROM pages),
x AS (SELECT page_id, url, unnest(generate_series(0, len(hs) - 1)) AS pos, unnest(hs) AS href FROM h),
f AS (SELECT page_id, pos, CASE WHEN starts_with(href, '/') THEN regexp_extract(url, '^(https?://[^/?#]+)', 1) || href
                                ELSE href END AS link
      FROM x WHERE href <> '' AND NOT contains(href, 'javascript') AND href <> '#'),
r AS (SELECT *, row_number() OVER (PARTITION BY link ORDER BY page_id, pos) AS rn FROM f)
SELECT link, page_id, CAST(pos AS BIGINT) AS pos FROM r WHERE rn = 1"""

SQL["regex_counts"] = r"""SELECT page_id, coalesce(TRY_CAST(replace(
  CASE WHEN regexp_matches(url, '/([0-9,]+)\?') THEN regexp_extract(url, '/([0-9,]+)\?', 1)
       WHEN regexp_matches(url, '/([0-9,]+)') THEN regexp_extract(url, '/([0-9,]+)', 1) END, ',', '') AS BIGINT), 0) AS n
FROM pages"""

SQL["classify_url"] = """SELECT page_id, CASE WHEN contains(url, 'm.') THEN 'mobile' WHEN contains(url, '.net') THEN 'net'
  WHEN contains(url, '?page=') THEN 'paged' WHEN contains(url, '#') THEN 'anchored' ELSE 'plain' END AS kind FROM pages"""

SQL["product_centroids"] = """WITH x AS (SELECT label, unnest(generate_series(0, len(embedding) - 1)) AS dim,
                         unnest(embedding) AS v FROM embeddings)
SELECT CAST(label AS BIGINT) AS label, CAST(dim AS BIGINT) AS dim, round(avg(CAST(v AS DOUBLE)), 6) AS mean
FROM x GROUP BY label, dim"""

SQL["representative_review"] = """WITH x AS (SELECT vec_id, label, unnest(generate_series(0, len(embedding) - 1)) AS dim,
                         CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
c AS (SELECT label, dim, avg(v) AS cv FROM x GROUP BY label, dim),
s AS (SELECT x.vec_id, x.label, sum(x.v * c.cv) AS dot, sqrt(sum(x.v * x.v)) AS nv, sqrt(sum(c.cv * c.cv)) AS nc
      FROM x JOIN c USING (label, dim) GROUP BY x.vec_id, x.label),
sim AS (SELECT vec_id, label, CASE WHEN nv * nc <> 0 THEN dot / (nv * nc) ELSE 0.0 END AS similarity FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY similarity DESC, vec_id) AS rn FROM sim)
SELECT CAST(label AS BIGINT) AS label, vec_id, round(similarity, 6) AS similarity FROM r WHERE rn = 1"""

SQL["similar_products"] = """WITH x AS (SELECT label, unnest(generate_series(0, len(embedding) - 1)) AS dim,
                         CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
c AS (SELECT label, dim, avg(v) AS cv FROM x GROUP BY label, dim),
l AS (SELECT label, sqrt(sum(cv * cv)) AS len FROM c GROUP BY label),
s AS (SELECT a.label, b.label AS neighbour, sum(a.cv * b.cv) AS dot FROM c a JOIN c b ON a.dim = b.dim AND a.label <> b.label
      GROUP BY a.label, b.label),
t AS (SELECT s.label, s.neighbour, dot / (p.len * q.len) AS similarity FROM s JOIN l p ON p.label = s.label
      JOIN l q ON q.label = s.neighbour),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY similarity DESC, neighbour) AS rank FROM t)
SELECT CAST(label AS BIGINT) AS label, CAST(rank AS BIGINT) AS rank, CAST(neighbour AS BIGINT) AS neighbour,
  round(similarity, 6) AS similarity FROM r WHERE rank <= 3"""

SQL["word2vec_vocab"] = f"""WITH t AS (SELECT unnest({tok('text')}) AS word FROM documents)
SELECT word, CAST(100 AS BIGINT) AS dim FROM t GROUP BY word HAVING count(*) >= 3"""

SQL["review_vectors"] = f"""WITH {RT},
l AS (SELECT * FROM rt WHERE label IS NOT NULL),
o AS (SELECT review_id, unnest(tokens) AS word FROM l),
m AS (SELECT count(*) + count(*) // 10 AS m FROM embeddings),
c AS (SELECT review_id, CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % (SELECT m FROM m) AS vec_id, count(*) AS n
      FROM o GROUP BY ALL),
e AS (SELECT vec_id, unnest(generate_series(0, len(embedding) - 1)) AS dim, CAST(unnest(embedding) AS DOUBLE) AS v
      FROM embeddings),
a AS (SELECT review_id, dim, sum(n * v) / sum(n) AS value FROM c JOIN e USING (vec_id) GROUP BY ALL),
g AS (SELECT review_id, unnest(range(64)) AS dim FROM l)
SELECT g.review_id, CAST(g.dim AS BIGINT) AS dim, round(coalesce(a.value, 0.0), 6) AS value
FROM g LEFT JOIN a ON a.review_id = g.review_id AND a.dim = g.dim"""

SQL["top_products_mean_score"] =f"""WITH {RV},
c AS (SELECT product_id, count(*) AS review_cnt FROM rv GROUP BY product_id),
t AS (SELECT * FROM c ORDER BY review_cnt DESC, product_id LIMIT 10)
SELECT t.product_id, t.review_cnt, round(avg(rv.score), 6) AS mean_score
FROM rv JOIN t USING (product_id) GROUP BY t.product_id, t.review_cnt"""

SQL["daily_review_counts"] = f"""WITH {RV},
per AS (SELECT date AS day, count(*) AS v FROM rv WHERE date IS NOT NULL GROUP BY date),
sp AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM per)
SELECT sp.day, coalesce(per.v, 0) AS count FROM sp LEFT JOIN per USING (day)"""

SQL["negative_rate_alert"] = f"""WITH {RV},
x AS (SELECT CAST(to_timestamp(floor(epoch(CAST(date AS TIMESTAMP)) / 604800) * 604800) AS DATE) AS week_start,
             CASE WHEN score >= 4 THEN 1 WHEN score <= 2 THEN 0 END AS label FROM rv WHERE date IS NOT NULL)
SELECT week_start, count(*) AS n, count(CASE WHEN label = 0 THEN 1 END) AS flagged,
       round(count(CASE WHEN label = 0 THEN 1 END) / count(*), 6) AS rate
FROM x GROUP BY week_start"""

SQL["dedupe_documents"] = r"""WITH n AS (
  SELECT doc_id, source, CASE WHEN text IS NULL OR text = '' THEN text
         ELSE trim(regexp_replace(regexp_replace(text, '[^a-zA-Z0-9 \t\n\r.,!?~]', '', 'g'), '\s+', ' ', 'g')) END AS norm
  FROM documents)
SELECT source, min(doc_id) AS doc_id FROM n GROUP BY source, norm"""

SQL["scan_nested_documents"] = """WITH r AS (SELECT count(*) AS reviews, round(avg(ceil(l_quantity / 10)), 6) AS mean_score,
                  min(CAST(l_shipdate AS DATE)) AS first_date FROM lineitem)
SELECT l_returnflag AS category, count(*) AS products, CAST(sum(floor(l_extendedprice)) AS BIGINT) AS price_sum,
       CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS declared_sum,
       (SELECT reviews FROM r) AS reviews, (SELECT mean_score FROM r) AS mean_score,
       (SELECT first_date FROM r) AS first_date
FROM lineitem GROUP BY l_returnflag"""

SQL["keywords_merged_sums"] = SQL["sentiment_keywords_all_levels"]

SQL["scan_document_files"] = """WITH x AS (
  SELECT *, l_returnflag || l_linestatus AS category, CAST(ceil(l_quantity / 10) AS INTEGER) AS score FROM lineitem),
p AS (SELECT category, l_partkey FROM x GROUP BY ALL HAVING count(*) >= 5),
o AS (SELECT x.*, row_number() OVER (PARTITION BY category, l_partkey, CAST(l_shipdate AS DATE), l_suppkey, l_linenumber
        ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                 l_returnflag, l_linestatus, l_shipdate) AS place
      FROM x JOIN p USING (category, l_partkey))
SELECT category, count(DISTINCT l_partkey) AS products, count(*) AS reviews, round(avg(score), 6) AS mean_score,
       count(*) FILTER (score >= 4) AS pos_cnt, count(*) FILTER (score <= 2) AS neg_cnt,
       min(CAST(l_shipdate AS DATE)) AS first_date, count(*) FILTER (l_returnflag = 'R') AS image_cnt
FROM o WHERE place = 1 GROUP BY category"""

SQL["sentence_vectors_weighted"] = f"""WITH {RT},
l AS (SELECT * FROM rt WHERE label IS NOT NULL),
o AS (SELECT review_id, unnest(tokens) AS word FROM l),
w AS (SELECT word, 0.001::DOUBLE / (0.001::DOUBLE + count(*) / (SELECT count(*) FROM o)::DOUBLE) AS weight
      FROM o GROUP BY word),
m AS (SELECT count(*) + count(*) // 10 AS m FROM embeddings),
c AS (SELECT review_id, CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % (SELECT m FROM m) AS vec_id, count(*) AS n,
             sum(weight) AS weight
      FROM o JOIN w USING (word) GROUP BY ALL),
e AS (SELECT vec_id, unnest(generate_series(0, len(embedding) - 1)) AS dim, CAST(unnest(embedding) AS DOUBLE) AS v
      FROM embeddings),
a AS (SELECT review_id, dim, sum(weight * v) / sum(n) AS value FROM c JOIN e USING (vec_id) GROUP BY ALL),
g AS (SELECT review_id, unnest(range(64)) AS dim FROM l)
SELECT g.review_id, CAST(g.dim AS BIGINT) AS dim, round(coalesce(a.value, 0.0), 6) AS value
FROM g LEFT JOIN a ON a.review_id = g.review_id AND a.dim = g.dim"""

SQL["keyword_volume_lag"] = f"""WITH {RV},
b AS (SELECT p_brand AS brand, date_trunc('month', date) AS month, count(*) AS n, count(*) FILTER (has_image) AS hits
      FROM rv JOIN part ON p_partkey = product_id WHERE date IS NOT NULL GROUP BY ALL),
s AS (SELECT brand, unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS month FROM b GROUP BY brand),
f AS (SELECT s.brand, CAST(s.month AS DATE) AS month, coalesce(n, 0) AS n, coalesce(hits, 0) AS hits
      FROM s LEFT JOIN b ON b.brand = s.brand AND CAST(b.month AS DATE) = CAST(s.month AS DATE)),
l AS (SELECT brand, lag, CASE WHEN n > 0 THEN hits / n END AS share,
             lead(n, CAST(lag AS INTEGER)) OVER (PARTITION BY brand, lag ORDER BY month) AS later
      FROM f, (SELECT unnest(range(4)) AS lag))
SELECT brand, lag, count(*) AS months, round(CASE WHEN min(share) <> max(share) AND min(later) <> max(later)
       THEN corr(share, later) END, 6) AS r
FROM l WHERE share IS NOT NULL AND later IS NOT NULL GROUP BY brand, lag"""

SQL["image_effect"] = f"""WITH {RV},
s AS (SELECT p_brand AS brand, score, count(*) FILTER (has_image) AS n1, count(*) FILTER (NOT has_image) AS n0,
             avg(helpful_count) FILTER (has_image) - avg(helpful_count) FILTER (NOT has_image) AS d,
             var_samp(helpful_count) FILTER (has_image) AS v1, var_samp(helpful_count) FILTER (NOT has_image) AS v0
      FROM rv JOIN part ON p_partkey = product_id WHERE helpful_count IS NOT NULL GROUP BY ALL),
w AS (SELECT *, n1 * n0 / (n1 + n0) AS w FROM s WHERE n1 >= 2 AND n0 >= 2)
SELECT brand, count(*) AS strata, CAST(sum(n1) AS BIGINT) AS n_treated, CAST(sum(n0) AS BIGINT) AS n_other,
       round(sum(w * d) / sum(w), 6) AS effect, round(sqrt(sum(w * w * (v1 / n1 + v0 / n0))) / sum(w), 6) AS std_error
FROM w GROUP BY brand"""

SQL["bucket_quantiles"] = f"""WITH {RV},
g AS (SELECT ln(1.01::DOUBLE / 0.99::DOUBLE) AS width, 1.01::DOUBLE / 0.99::DOUBLE AS gamma),
b AS (SELECT score, CAST(ceil(ln(l_extendedprice) / width - 1e-9) AS INTEGER) AS bucket, count(*) AS cnt
      FROM rv, g GROUP BY ALL),
r AS (SELECT *, sum(cnt) OVER (PARTITION BY score ORDER BY bucket) AS upto, sum(cnt) OVER (PARTITION BY score) AS n FROM b),
v AS (SELECT r.*, pow(gamma, bucket) * 2 / (gamma + 1) AS v FROM r, g)
SELECT score, CAST(max(n) AS BIGINT) AS count,
""" + ",\n".join(f"  round(max(CASE WHEN upto > floor({p} * (n - 1)) AND upto - cnt <= floor({p} * (n - 1)) THEN v END), 4) AS p{int(p * 100)}"
                for p in (0.25, 0.5, 0.9, 0.99)) + "\nFROM v GROUP BY score"

SQL["sentiment_keywords_long_weights"] = SQL["sentiment_keywords_weight_map"] = SQL["sentiment_keywords_weighted"]
SQL["stratified_quota_split"] = SQL["stratified_quota"]
SQL["cumulative_cap_split"] = SQL["cumulative_cap"]

SQL["split_views"] = f"""WITH {RV}
SELECT CASE WHEN l_returnflag <> 'N' THEN 'with_text' ELSE 'without_text' END AS view, CAST(score AS BIGINT) AS score,
       count(*) AS cnt, count(*) FILTER (l_returnflag <> 'N') AS flagged FROM rv GROUP BY ALL"""


def _group_counts_sql(groups: dict[str, list[str]]) -> str:
    def hits(t: str, k: str) -> str:
        return f"(length({t}) - length(replace({t}, '{k}', ''))) // {len(k)}"
    def equal(k: str) -> str:
        return f"len(list_filter(tokens, lambda x: x = '{k}'))"
    parts = [f"""SELECT product_id, '{g}' AS "group", CAST(sum(CASE WHEN len(tokens) > 0 THEN {' + '.join(map(equal, ks))}
       ELSE {' + '.join(hits('t', k) for k in ks)} END) AS BIGINT) AS cnt FROM r GROUP BY product_id"""
             for g, ks in groups.items()]
    return f"""WITH r AS (
  SELECT d.source AS product_id, CASE WHEN l.quality IS NOT NULL THEN {tok('d.text')} END AS tokens, coalesce(d.text, '') AS t
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
""" + "\nUNION ALL ".join(parts)


SQL["review_group_counts"] = _group_counts_sql(
    {"g_de": ["der", "die", "und"], "g_es": ["que", "es"], "g_fr": ["la", "le", "des"], "g_x": ["ci", "tion"]})

SQL["analyser_tokens"] = f"""WITH t AS (SELECT doc_id, coalesce({tok('text')}, []) AS t FROM documents)
SELECT doc_id, len(t) AS token_count, md5(array_to_string(t, ' ')) AS digest FROM t"""

SQL["file_names"] = """SELECT coalesce(lang, 'x') || ' ' || coalesce(source, 'y') AS category, count(*) AS files,
  count(*) FILTER (NOT coalesce(n_chars > 500, false)) AS without_text FROM documents GROUP BY ALL"""

SQL["rating_map_values"] = """SELECT l_returnflag, CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) AS s5,
  0::BIGINT AS s4, 0::BIGINT AS s3, CAST(sum(l_partkey) AS BIGINT) AS sx, NULL::BIGINT AS sy, count(*) AS missing_y
FROM lineitem GROUP BY l_returnflag"""
