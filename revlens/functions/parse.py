"""Parsing / coercion / classification column functions.

ANSI mode is on in Spark 4, so every conversion that may fail uses the
``try_*`` family and yields NULL instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params as P
from .text import _c, lower_strip, map_literal


# ------------------------------------------------------------ F8 / F9 / F11
def lenient_int(col) -> Column:
    """Drop commas; digits only -> BIGINT, anything else (sign, dot, blank, NULL) -> 0."""
    s = F.regexp_replace(_c(col).cast("string"), ",", "")
    return F.when(s.rlike("^[0-9]+$"), (s).try_cast("bigint")).otherwise(F.lit(0)).cast("bigint")


def strict_int(col) -> Column:
    """Integer of a number or of an integer text; blanks around it and a JSON
    fraction are dropped (`` 5 `` -> 5, ``4.0`` -> 4), anything else -> 0."""
    s = F.trim(_c(col).cast("string"))
    whole = F.regexp_extract(s, r"^([+-]?[0-9]+)([.][0-9]*)?$", 1)
    return F.coalesce(F.when(whole != "", whole.try_cast("bigint")), F.lit(0)).cast("bigint")


def safe_int(col) -> Column:
    """Strip, then integer or NULL (``"5.0"`` -> NULL)."""
    s = F.trim(_c(col).cast("string"))
    return F.when(s.rlike("^[+-]?[0-9]+$"), (s).try_cast("bigint"))


def coerce_rating_map(col, keys: Sequence[str] = ("5", "4", "3", "2", "1")) -> Column:
    """Rating-map values -> lenient ints for the listed keys; other keys kept as is (cast)."""
    keys = list(keys)
    return F.transform_values(
        _c(col), lambda k, v: F.when(k.isin(keys), lenient_int(v)).otherwise((v).try_cast("bigint")))


# ------------------------------------------------------------ F12-F14 dates
def parse_dot_date(col) -> Column:
    """``2025.12.12.`` / ``2025.1.2`` -> DATE; unparsable -> NULL (keep the raw column)."""
    s = F.regexp_replace(F.trim(_c(col)), r"^\.+|\.+$", "")
    return F.to_date(F.try_to_timestamp(s, F.lit("yyyy.M.d")))


def parse_dot_timestamp(col) -> Column:
    """``2025.12.12 10:00:00`` -> un-zoned TIMESTAMP_NTZ (the text carries no zone)."""
    return F.try_to_timestamp(F.trim(_c(col)), F.lit("yyyy.M.d H:m:s")).cast("timestamp_ntz")


def coerce_double(col) -> Column:
    return (F.trim(_c(col).cast("string"))).try_cast("double")


# ------------------------------------------------------------ F15 / F16
def category_leaf(path) -> Column:
    """Last ``>`` segment, stripped and lower-cased."""
    return lower_strip(F.element_at(F.split(_c(path), ">"), -1))


def normalize_category(path, groups: Mapping[str, Sequence[str]] = P.CATEGORY_GROUPS) -> Column:
    variants = {v: std for std, vs in groups.items() for v in vs}
    leaf = category_leaf(path)
    return F.coalesce(F.try_element_at(map_literal(variants), leaf), leaf)


def normalize_brand(col, brand_map: Mapping[str, str] = P.BRAND_MAP) -> Column:
    b = lower_strip(col)
    return F.coalesce(F.try_element_at(map_literal(brand_map), b), b)


def falsy_to_null(col) -> Column:
    """Python truthiness for strings: '' behaves like missing."""
    c = _c(col)
    return F.when(c != "", c)


def category_from_path(path, mode: str = "leaf", unknown: str = P.UNKNOWN_CATEGORY) -> Column:
    """``leaf``: last segment stripped; ``path``: whole path stripped; blank -> unknown."""
    p = F.trim(_c(path))
    val = F.trim(F.element_at(F.split(p, ">"), -1)) if mode == "leaf" else p
    return F.coalesce(falsy_to_null(val), F.lit(unknown))


def first_truthy(*cols, default=None) -> Column:
    """``a or b or c or default`` on strings (blank counts as missing)."""
    parts = [falsy_to_null(_c(c)) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


# ------------------------------------------------------------ F25 label
def sentiment_label(score, pos_min: int = P.POSITIVE_MIN_SCORE,
                    neg_max: int = P.NEGATIVE_MAX_SCORE) -> Column:
    s = _c(score)
    return F.when(s >= pos_min, F.lit(1)).when(s <= neg_max, F.lit(0)).cast("int")


# ------------------------------------------------------------ F31 / F32 keys
def product_key(category, text_kind, product_id) -> Column:
    """``{category}_{with|without}_{id}``."""
    return F.concat_ws("_", _c(category), _c(text_kind), _c(product_id).cast("string"))


def identity_key(product_id, product_name) -> Column:
    """``{id}__{name}`` with UNKNOWN_ID / UNKNOWN_NAME for a missing id or a blank name."""
    name = F.trim(_c(product_name))
    return F.concat_ws("__", F.coalesce(_c(product_id).cast("string"), F.lit("UNKNOWN_ID")),
                       F.coalesce(falsy_to_null(name), F.lit("UNKNOWN_NAME")))


def month_start(date_col) -> Column:
    return F.trunc(_c(date_col), "month")


def month_key(date_col) -> Column:
    return F.date_format(_c(date_col), "yyyy-MM")


# ------------------------------------------------------------ F33 ratios
def safe_ratio(num, den) -> Column:
    """``num/den`` with 0 when the denominator is 0 or NULL."""
    return F.coalesce(F.try_divide(_c(num), _c(den)), F.lit(0.0))


# ------------------------------------------------------------ F36 bin labels
def bin_label(lo, hi) -> Column:
    return F.when(_c(hi).isNull(), F.concat(_c(lo).cast("string"), F.lit("+"))) \
        .otherwise(F.concat(_c(lo).cast("string"), F.lit("~"), (_c(hi) - 1).cast("string")))


# ------------------------------------------------------------ F39 / F40
def classify_by_substring(col, rules: Sequence[tuple[str, str]] = P.DELIVERY_RULES,
                          default: str = P.DELIVERY_DEFAULT) -> Column:
    """First matching substring rule wins; otherwise the default."""
    c = F.coalesce(_c(col), F.lit(""))
    out = None
    for needle, label in rules:
        out = (F.when(c.contains(needle), F.lit(label)) if out is None
               else out.when(c.contains(needle), F.lit(label)))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def extract_count(col, patterns: Sequence[str] = (r"\n([0-9,]+)", r"\(([0-9,]+)\)"),
                  default: int | None = 0) -> Column:
    """First pattern (group 1) that matches, commas dropped, as BIGINT."""
    c = _c(col)
    hits = [F.when(c.rlike(p), F.regexp_extract(c, p, 1)) for p in patterns]
    raw = F.coalesce(*hits)
    val = F.regexp_replace(raw, ",", "").try_cast("bigint")
    return F.coalesce(val, F.lit(default)) if default is not None else val


# ------------------------------------------------------------ F35 weight maps
def normalize_weights(col) -> Column:
    """A per-review weight map as MAP<STRING, DOUBLE> (keys and values cast);
    NULL -> empty map.  Pair lists go through ``pairs_to_weights``."""
    c = F.transform_keys(F.transform_values(_c(col), lambda k, v: v.cast("double")), lambda k, v: k.cast("string"))
    return F.coalesce(c, F.create_map().cast("map<string,double>"))


def pairs_to_weights(col) -> Column:
    """ARRAY<STRUCT<word, weight>> -> MAP<STRING, DOUBLE>; for a repeated word
    the last pair wins (as with a dict built from the pairs)."""
    c = _c(col)
    # sorted by word and place, the last pair of a word is the one whose successor differs
    ordered = F.array_sort(F.transform(c, lambda e, i: F.struct(e["word"].cast("string").alias("k"), i.alias("i"),
                                                                e["weight"].cast("double").alias("v"))))
    last = F.filter(ordered, lambda x, i: ~F.get(ordered, i + 1)["k"].eqNullSafe(x["k"]))
    entries = F.transform(last, lambda x: F.struct(x["k"].alias("k"), x["v"].alias("v")))
    return F.coalesce(F.map_from_entries(entries), F.create_map().cast("map<string,double>"))
