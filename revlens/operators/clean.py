"""Cleaning, reshaping, de-duplication and splitting.

First-wins rules need an explicit order: nested inputs carry the positions
from ``posexplode`` (file, product_pos, review_pos); flat inputs pass a
total order of columns.  A ``min_by`` aggregate over the duplicate key then
keeps the first row deterministically (unlike ``dropDuplicates``) and is
combined map-side, so hot keys do not pile up in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import parse as PA
from ..functions import text as TX
from ..sources.readers import RAW_REVIEW  # noqa: F401  (raw review schema)


# ----------------------------------------------------------------- P1 / P2
def unnest(df: DataFrame, array_col: str, keep: Sequence[str], pos_name: str = "pos",
           item_name: str = "item") -> DataFrame:
    """One row per array element with its 0-based position and the parent columns."""
    return df.select(*keep, F.posexplode(array_col).alias(pos_name, item_name))


def unnest_products(raw: DataFrame, keep: Sequence[str] = ("source_file", "category_file")) -> DataFrame:
    """Search documents -> one row per product (``product_pos`` kept for first-wins)."""
    keep = [c for c in keep if c in raw.columns]
    return unnest(raw, "data", keep, "product_pos", "product")


def flatten_reviews(products: DataFrame, parent: Sequence[str],
                    reviews_col: str = "product.reviews.data") -> DataFrame:
    """Products -> one row per review with the listed parent columns (``review_pos`` kept)."""
    return products.select(*parent, F.posexplode(reviews_col).alias("review_pos", "review")) \
        .select(*parent, "review_pos", "review.*")


# ----------------------------------------------------------------- P3 / P4
def min_reviews_filter(reviews: DataFrame, products: DataFrame, key: str = "product_id",
                       n: int = P.MIN_REVIEWS_PER_PRODUCT) -> DataFrame:
    """Text side: keep products with >= n *collected* reviews (agg + semi join)."""
    ok = reviews.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= n).select(key)
    return products.join(ok, key, "left_semi")


def min_declared_filter(products: DataFrame, declared: str = "total_reviews",
                        n: int = P.MIN_REVIEWS_PER_PRODUCT) -> DataFrame:
    """No-text side: keep products whose *declared* review total is >= n."""
    return products.where(PA.lenient_int(declared) >= n)


# ----------------------------------------------------------------- P6 / P7 / P8
def nullify_defaults(df: DataFrame, string_cols: Sequence[str] = (), zero_null: Sequence[str] = (),
                     false_null: Sequence[str] = ()) -> DataFrame:
    """Blank strings, zero counts and ``False`` flags become NULL (the original
    value is kept untrimmed when non-blank)."""
    out = df
    for c in string_cols:
        out = out.withColumn(c, F.when(F.trim(F.col(c)) != "", F.col(c)))
    for c in zero_null:
        out = out.withColumn(c, F.when(F.col(c) != 0, F.col(c)))
    for c in false_null:
        out = out.withColumn(c, F.when(F.col(c), F.col(c)))
    return out


def has_text(content: str = "content", full_text: str = "full_text") -> Column:
    """Non-blank content or non-blank full text (Unicode whitespace counts as blank)."""
    def nb(c):
        return F.coalesce(F.regexp_replace(F.col(c), r"(?U)\s", "") != "", F.lit(False))
    return nb(content) | nb(full_text)


def split_by_text(reviews: DataFrame, flag: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Two filtered views over one input (cache it upstream if reused)."""
    f = flag if flag is not None else has_text()
    tagged = reviews.withColumn("has_text", f)
    return tagged.where("has_text"), tagged.where("NOT has_text")


# ----------------------------------------------------------------- W1 / W2
def key_digest(key: Sequence[str]) -> Column:
    """16 bytes for the values of ``key``: equal values (nulls too) give equal bytes."""
    parts = [F.coalesce(F.concat(F.octet_length(F.col(k).cast("string")).cast("string"), F.lit(":"),
                                 F.col(k).cast("string")), F.lit("-")) for k in key]
    return F.unhex(F.md5(F.concat(*parts)))


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """First row per key under a total (ascending) order; NULL keys group together.

    An aggregate (``min_by`` over the order struct), not a window: it is
    combined map-side, so a key with millions of copies sends one candidate
    row per task to the shuffle instead of all its rows.  Rows are grouped and
    sorted by a digest of the key, so long texts in the key travel once, with
    their row.  Only ``columns`` travel, by default all."""
    row = F.struct(*[F.col(f"`{c}`") for c in (df.columns if columns is None else columns)])
    first = F.min_by(row, F.struct(*[F.col(o) for o in order]))
    return df.groupBy(key_digest(key).alias("_key")).agg(first.alias("_first")).select("_first.*")


def dedupe_reviews(reviews: DataFrame, product: str = "product_id",
                   on: Sequence[str] = ("date", "nickname", "full_text"),
                   order: Sequence[str] = ("review_pos",)) -> DataFrame:
    """Per product, the first review of each (date, nickname, text)."""
    return keep_first(reviews, [product, *on], list(order))


# ----------------------------------------------------------------- U1 / P18
def union_sources(parts: Mapping[str, DataFrame], defaults: Mapping[str, Column] | None = None,
                  label: str = "label") -> DataFrame:
    """UNION ALL by name with a ``source`` tag; missing columns get defaults
    (or NULL), and a NULL ``label`` when absent."""
    defaults = dict(defaults or {})
    out = None
    for name, df in parts.items():
        d = df.withColumn("source", F.lit(name))
        for c, v in defaults.items():
            if c not in d.columns:
                d = d.withColumn(c, v)
        if label not in d.columns:
            d = d.withColumn(label, F.lit(None).cast("int"))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


# ----------------------------------------------------------------- F23
def standardize_products(products: DataFrame, brand: str = "brand", path: str = "category_path",
                         name: str = "product_name", brand_map=P.BRAND_MAP, groups=P.CATEGORY_GROUPS,
                         noise=P.NOISE_RULES, synonyms=P.SYNONYM_RULES, token_map=P.TOKEN_MAP,
                         drop_tokens=P.DROP_TOKENS) -> DataFrame:
    """Brand (overwritten), category_normal, product_name_clean, product_tokens in one select."""
    b = PA.normalize_brand(brand, brand_map)
    out = products.withColumn(brand, b)
    out = out.withColumn("category_normal", PA.normalize_category(path, groups))
    out = out.withColumn("product_name_clean", TX.clean_product_name(name, brand, noise, synonyms))
    return out.withColumn("product_tokens",
                          TX.map_tokens(TX.whitespace_tokens("product_name_clean"), token_map, drop_tokens))


# ----------------------------------------------------------------- raw review formatting
def format_reviews(reviews: DataFrame, use_nfc: bool = True) -> DataFrame:
    """Typed review columns from raw strings: ints default 0, dates parsed
    (raw kept), title, content and full text normalised, label from score
    (missing score -> 0 -> label 0)."""
    score = PA.strict_int(F.col("score")).cast("int")
    return reviews.select(
        "*",
        score.alias("score_int"),
        PA.parse_dot_date("date").alias("date_parsed"),
        PA.parse_dot_timestamp("collected_at").alias("collected_ts"),
        PA.lenient_int("helpful_count").alias("helpful_int"),
        *[TX.normalize_text(c, use_nfc=use_nfc).alias(f"{c}_norm") for c in ("title", "content", "full_text")],
        PA.sentiment_label(score).alias("label"),
    )


def prepare_reviews(flat: DataFrame, product_keys: Sequence[str] = ("source_file", "product_pos"),
                    order: str = "review_pos", use_nfc: bool = True, columns: Sequence[str] | None = None) -> DataFrame:
    """Typed, normalised, de-duplicated reviews of flattened raw documents.

    The duplicate key per product is (date as ISO text, or the dot-stripped raw
    date when it does not parse; nickname; normalised full text); the first
    review in document order wins.  ``columns`` are those that the caller reads, by default all."""
    f = format_reviews(flat, use_nfc)
    date_key = F.coalesce(F.date_format("date_parsed", "yyyy-MM-dd"),
                          F.regexp_replace(F.col("date"), r"^\.+|\.+$", ""))
    f = f.withColumn("_date_key", date_key)
    return keep_first(f, [*product_keys, "_date_key", "nickname", "full_text_norm"], [order], columns).drop("_date_key")
