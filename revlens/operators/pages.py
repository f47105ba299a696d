"""Landed page HTML -> product fields, links and review blocks.

Pages are already a table (no browser).  Field extraction is a chain of
``regexp_extract`` over the HTML column with patterns as parameters, so it
stays in the JVM; malformed pages simply yield empty fields.  A place is a
list of (tag, class, ...) steps from the outside in, or a pattern with one
group; an element ends at the next closing tag of its name, so markup that
nests equal tags inside a field needs a parser: ``parse_pages``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions.parse import classify_by_substring, extract_count
from ..functions.text import clean_page_text, strip_html

DEFAULT_FIELDS = {
    "title": r"(?s)<title[^>]*>(.*?)</title>",
    "lang": r'<html[^>]*\slang="([^"]*)"',
    "h1": r"(?s)<h1[^>]*>(.*?)</h1>",
    "nav": r"(?s)<nav[^>]*>(.*?)</nav>",
}


def _first(html: Column, pattern: str) -> Column:
    return F.regexp_extract(html, pattern, 1)


def extract_fields(pages: DataFrame, html: str = "html", fields: dict[str, str] | None = None,
                   crumb_pattern: str = r"(?s)<a[^>]*>(.*?)</a>", crumb_sep: str = " > ") -> DataFrame:
    """first match per field pattern (cleaned), and the breadcrumb =
    non-blank link texts inside ``nav`` joined by ``crumb_sep``."""
    f = dict(DEFAULT_FIELDS, **(fields or {}))
    h = F.col(html)
    cols = {k: clean_page_text(_first(h, p)) for k, p in f.items() if k != "nav"}
    nav = _first(h, f["nav"])
    crumbs = F.filter(F.transform(F.regexp_extract_all(nav, F.lit(crumb_pattern), 1),
                                  lambda x: clean_page_text(strip_html(x))), lambda x: x != "")
    return pages.select("*", *[c.alias(k) for k, c in cols.items()],
                        F.array_join(crumbs, crumb_sep).alias("breadcrumb"))


def quality_filter(extracted: DataFrame, name: str = "title", id_col: str = "page_id",
                   excluded_marker: str | None = None, html: str = "html") -> DataFrame:
    """Drop pages without an id or a name, and pages carrying an excluded marker."""
    cond = F.col(id_col).isNotNull() & (F.coalesce(F.col(name), F.lit("")) != "")
    if excluded_marker:
        cond = cond & ~F.col(html).contains(excluded_marker)
    return extracted.where(cond)


def links(pages: DataFrame, url: str = "url", html: str = "html", id_col: str = "page_id",
          host_pattern: str = r"^(https?://[^/?#]+)") -> DataFrame:
    """Hrefs in document order, blanks / javascript / '#' dropped,
    relative links made absolute against the page host."""
    hrefs = F.regexp_extract_all(F.col(html), F.lit(r'href="([^"]*)"'), 1)
    ex = pages.select(id_col, url, F.posexplode(hrefs).alias("pos", "href"))
    ok = (ex.where((F.col("href") != "") & ~F.col("href").contains("javascript") & (F.col("href") != "#")))
    host = F.regexp_extract(F.col(url), host_pattern, 1)
    absolute = F.when(F.col("href").startswith("/"), F.concat(host, F.col("href"))).otherwise(F.col("href"))
    return ok.select(id_col, "pos", absolute.alias("link"))


def blocks(pages: DataFrame, html: str = "html", id_col: str = "page_id",
           block_pattern: str = r"(?s)<p>(.*?)</p>", marker: str = "<b>") -> DataFrame:
    """one row per block with its ordinal, marker count and tag-free text."""
    ex = pages.select(id_col, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(block_pattern), 1))
                      .alias("ord", "block"))
    return ex.select(id_col, "ord", F.regexp_count("block", F.lit("\\Q" + marker + "\\E")).alias("n_marker"),
                     strip_html("block").alias("text"))


def url_kind(url: Column | str, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """first substring rule on the URL wins."""
    return classify_by_substring(url, rules, default)


def number_in(col: Column | str, patterns: Sequence[str], default: int | None = 0) -> Column:
    """first matching pattern's number (commas dropped)."""
    return extract_count(col, patterns, default)


# ----------------------------------------------------------------- product pages
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&"))


def element_pattern(tag: str, *classes: str) -> str:
    """Pattern of the inside of the first ``tag`` that carries all ``classes``."""
    if not classes:
        return rf"(?s)<{tag}\b[^>]*>(.*?)</{tag}>"
    held = "".join(rf'(?=(?:[^"]*\s)?{re.escape(c)}[\s"])' for c in classes)
    return rf'(?s)<{tag}\b[^>]*\bclass="{held}[^"]*"[^>]*>(.*?)</{tag}>'


def text_of(html: Column) -> Column:
    """Tag-free, unescaped, cleaned text of a piece of HTML."""
    x = strip_html(html)
    for entity, char in ENTITIES:
        x = F.replace(x, F.lit(entity), F.lit(char))
    return clean_page_text(x)


def text_at(html: Column, places: Sequence, default: str = "") -> Column:
    """Text of the first place that holds any, else ``default``."""
    found = []
    for place in places:
        inner = html
        for step in [place] if isinstance(place, str) else place:
            inner = _first(inner, step if isinstance(step, str) else element_pattern(*step))
        t = text_of(inner)
        found.append(F.when(t != "", t))
    return F.coalesce(*found, F.lit(default))


def product_fields(pages: DataFrame, html: str = "html", places: Mapping[str, Sequence] = P.PRODUCT_PLACES,
                   delivery_image: str = P.DELIVERY_IMAGE, delivery_rules: Sequence = P.DELIVERY_RULES,
                   delivery_default: str = P.DELIVERY_DEFAULT) -> DataFrame:
    """name (else ``Unknown``), price and declared reviews (first number, commas
    dropped, else 0), brand, badge text and delivery type of a landed product page."""
    h = F.coalesce(F.col(html), F.lit(""))

    def number(name: str) -> Column:
        digits = F.regexp_extract(text_at(h, places[name]), "([0-9][0-9,]*)", 1)
        return F.coalesce(F.replace(digits, F.lit(","), F.lit("")).try_cast("bigint"), F.lit(0))

    return pages.select(
        "*", text_at(h, places["product_name"], P.UNKNOWN_NAME).alias("product_name"),
        number("price").alias("price"), number("total_reviews").alias("total_reviews"),
        text_at(h, places["brand"]).alias("brand"), text_at(h, places["badge"]).alias("badge"),
        classify_by_substring(_first(h, delivery_image), delivery_rules, delivery_default).alias("delivery_type"))


def ingest_status(fields: DataFrame, official: str = P.OFFICIAL_BADGE) -> DataFrame:
    """``official`` (brand's own offer, left out), ``unknown`` (no name, to be
    fetched again), ``metadata`` (no reviews: kept with an empty rating map) or ``collect``."""
    status = (F.when(F.col("badge") == official, "official").when(F.col("product_name") == P.UNKNOWN_NAME, "unknown")
              .when(F.col("total_reviews") == 0, "metadata").otherwise("collect"))
    return fields.withColumn("ingest_status", status)


def star_rating_map(text: Column | str, labels: Sequence[tuple[str, int]] = P.STAR_LABELS,
                    patterns: Sequence[str] = (r"{label}\s*\n([0-9,]+)", r"{label}\s*\(([0-9,]+)\)")) -> Column:
    """MAP<score, count> from the numbers beside the star labels; 0 where a
    label or its number is missing."""
    pairs = []
    for label, score in labels:
        rules = [p.replace("{label}", re.escape(label)) for p in patterns]
        pairs += [F.lit(str(score)), extract_count(text, rules)]
    return F.create_map(*pairs)


def review_blocks(pages: DataFrame, html: str = "html", id_col: str = "page_id", block: str = P.REVIEW_BLOCK,
                  places: Mapping[str, Sequence] = P.REVIEW_PLACES, star: str = P.REVIEW_STAR,
                  image: str = P.REVIEW_IMAGE, helpful: str = P.REVIEW_HELPFUL) -> DataFrame:
    """one row per review block: id from 1, score (star marks), date, nickname,
    title, content, full text, image flag and helpful count."""
    ex = pages.select(id_col, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(block), 1)).alias("pos", "block"))
    b = F.col("block")
    out = ex.select(id_col, (F.col("pos") + 1).alias("id"),
                    F.regexp_count(b, F.lit(re.escape(star))).alias("score"),
                    *[text_at(b, p).alias(name) for name, p in places.items()],
                    b.rlike(image).alias("has_image"), extract_count(b, [helpful]).alias("helpful_count"))
    return out.withColumn("full_text", F.concat_ws(" ", "title", "content"))


def parse_pages(pages: DataFrame, parser_factory: Callable[[], Callable[[str], Mapping]], schema: str,
                html: str = "html", id_col: str = "page_id") -> DataFrame:
    """The caller's HTML parser (``html -> fields``), made once per task and fed
    by Arrow batches.  ``schema`` names the fields; a page without HTML yields nulls."""
    kind = pages.schema[id_col].dataType.simpleString()
    names = [f.name for f in pages.sparkSession.createDataFrame([], schema).schema.fields]

    def run(batches: Iterator) -> Iterator:
        import pandas as pd
        parse = parser_factory()
        for batch in batches:
            rows = [parse(h) if isinstance(h, str) else {} for h in batch[html]]
            fields = pd.DataFrame({n: [r.get(n) for r in rows] for n in names}, index=batch.index)
            yield pd.concat([batch[[id_col]], fields], axis=1)

    return pages.select(id_col, html).mapInPandas(run, f"`{id_col}` {kind}, {schema}")
