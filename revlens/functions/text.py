"""Text column functions.

All functions return ``Column`` expressions built from Spark SQL built-ins so
they run inside whole-stage codegen.  The only Python code is the NFC
normaliser (no Spark built-in exists) and the optional analyser plug-in, both
Arrow-batched UDFs.  Java regexes get ``(?U)`` so ``\\s``/``\\d`` are
Unicode-aware like Python's ``re``.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def map_literal(mapping: Mapping[str, str]) -> Column:
    """A literal MAP<STRING,STRING> (fixed, tiny parameter tables only)."""
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv) if kv else F.create_map().cast("map<string,string>")


def outside(keep: str) -> str:
    """Pattern of the characters outside the class ``keep``.

    The empty member at its end changes no match; without it Java tests a class of
    several plain ranges about ten times slower."""
    return f"(?U)[^{keep}[\\s&&\\S]]"


# --------------------------------------------------------------------- F1 NFC
#: Ranges of characters that stay as they are under NFC next to each other: Latin and
#: Cyrillic letters, punctuation, signs, kana, ideographs, precomposed Hangul, emoji.
NFC_STABLE = ((0x0, 0x2FF), (0x400, 0x482), (0x48A, 0x52F), (0x2010, 0x205E), (0x20A0, 0x20BF), (0x2190, 0x2328),
              (0x2500, 0x27BF), (0x3000, 0x3029), (0x3030, 0x303F), (0x3041, 0x3096), (0x30A1, 0x30FF),
              (0x3131, 0x318E), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3), (0xFE00, 0xFE0F),
              (0xFF01, 0xFFEE), (0x1F300, 0x1FAFF))
_UNSTABLE = "[^" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in NFC_STABLE) + "]"


@F.pandas_udf(T.StringType())
def _nfc_batch(s: pd.Series) -> pd.Series:
    def one(x):
        if x is None or (isinstance(x, float) and x != x):
            return None
        return x if unicodedata.is_normalized("NFC", x) else unicodedata.normalize("NFC", x)
    return s.map(one)


def nfc(col) -> Column:
    """Unicode NFC.  Spark evaluates an extracted pandas UDF for every row, so
    values of stable characters only (precomposed Hangul among them) are handed
    to it as NULL (no payload crosses to Python) and keep their JVM-side value."""
    c = _c(col)
    unstable = c.rlike(_UNSTABLE)
    return F.when(~unstable, c).otherwise(_nfc_batch(F.when(unstable, c)))


# ------------------------------------------------------- F2 review normaliser
def normalize_text(col, keep: str = P.REVIEW_TEXT_KEEP, use_nfc: bool = True,
                   collapse_jamo: bool = False, jamo: str = P.JAMO_CLASS) -> Column:
    """NFC -> keep whitelist chars -> (jamo collapse) -> collapse spaces -> strip.

    Empty string and NULL are returned unchanged.  ``collapse_jamo`` is off by
    default: the whitelist already removed every jamo, so the collapse rules
    never change anything on the default class.
    """
    c = _c(col)
    x = nfc(c) if use_nfc else c
    x = F.regexp_replace(x, outside(keep) + "+", "")
    if collapse_jamo:
        x = F.regexp_replace(x, f"([{jamo}])\\1+", "$1$1")
        x = F.regexp_replace(x, f"([{jamo}]{{2}})\\1+", "$1$1")
    x = F.trim(F.regexp_replace(x, r"(?U)\s+", " "))
    return F.when(c.isNull() | (c == ""), c).otherwise(x)


# ---------------------------------------------------------- F4 token cleaner
def clean_for_tokens(col, keep: str = P.TOKEN_TEXT_KEEP) -> Column:
    """Replace every char outside ``keep`` by a space, collapse, strip."""
    x = F.regexp_replace(_c(col), outside(keep) + "+", " ")
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


# ------------------------------------------------------------- F5 strip tags
def strip_html(col) -> Column:
    return F.regexp_replace(_c(col), "<[^>]+>", "")


# --------------------------------------------------------- F6 page-text clean
def clean_page_text(col) -> Column:
    """NBSP / LS / PS -> space; drop non-printables except \\n\\r\\t; strip."""
    c = _c(col)
    x = F.translate(c, "\u00a0\u2028\u2029", "   ")
    x = F.regexp_replace(x, r"[^\P{C}\n\r\t]|[^\P{Z} ]", "")   # C except \n\r\t, Z except space
    x = F.regexp_replace(x, r"^[ \n\r\t]+|[ \n\r\t]+$", "")
    return F.when(c.isNull() | (c == ""), c).otherwise(x)


# ---------------------------------------------------------- F7 lower + strip
def lower_strip(col) -> Column:
    return F.lower(F.regexp_replace(_c(col), r"(?U)^\s+|\s+$", ""))


def collapse_spaces(col) -> Column:
    return F.regexp_replace(F.regexp_replace(_c(col), r"(?U)\s+", " "), r"^ | $", "")


# ---------------------------------------------------- F17/F18 ordered rules
def apply_rules(col, rules: Sequence[tuple[str, str]]) -> Column:
    """Fold ``regexp_replace`` over an ordered rule list (order matters)."""
    x = _c(col)
    for pattern, repl in rules:
        x = F.regexp_replace(x, "(?U)" + pattern, repl)
    return x


def normalize_synonyms(col, rules=P.SYNONYM_RULES) -> Column:
    c = _c(col)
    return collapse_spaces(apply_rules(F.lower(c), rules))


def remove_noise(col, patterns: Sequence[str] = P.NOISE_RULES) -> Column:
    return apply_rules(col, [(p, " ") for p in patterns])


# ---------------------------------------------------------- F19 brand removal
def brand_pattern(brand) -> Column:
    """Column-valued regex: the brand literally, or its letters with optional
    whitespace between them.  Each character is quoted, so meta-characters in
    a brand never act as regex syntax."""
    b = _c(brand)
    chars = F.regexp_extract_all(b, F.lit("(?s)(.)"), 1)
    spaced = F.array_join(F.transform(chars, lambda ch: F.concat(F.lit("\\Q"), ch, F.lit("\\E"))),
                          "\\s*")
    return F.concat(F.lit("(?U)\\Q"), b, F.lit("\\E|"), spaced)


def remove_brand(name, brand) -> Column:
    n, b = _c(name), _c(brand)
    out = collapse_spaces(F.regexp_replace(F.lower(n), brand_pattern(b), F.lit(" ")))
    return F.when(n.isNull() | b.isNull() | (b == ""), n).otherwise(out)


# ------------------------------------------------------ F20 name cleaning
def clean_product_name(name, brand, noise=P.NOISE_RULES, synonyms=P.SYNONYM_RULES) -> Column:
    """lower+strip -> noise removal -> brand removal -> synonyms -> collapse."""
    x = remove_noise(lower_strip(name), noise)
    x = remove_brand(x, brand)
    x = normalize_synonyms(x, synonyms)
    return collapse_spaces(x)


# ------------------------------------------------------ F21/F22 tokens
def whitespace_tokens(col) -> Column:
    """Split on Unicode whitespace runs; NULL -> empty array."""
    c = _c(col)
    toks = F.filter(F.split(c, r"(?U)\s+"), lambda t: t != "")
    return F.coalesce(toks, F.array().cast("array<string>"))


def map_tokens(tokens, token_map: Mapping[str, str] = P.TOKEN_MAP,
               drop: Iterable[str] = P.DROP_TOKENS) -> Column:
    """Drop listed tokens, map the rest (unknown pass through); duplicates kept."""
    drop = list(drop)
    t = _c(tokens)
    if drop:
        t = F.filter(t, lambda x: ~x.isin(drop))
    if token_map:
        m = map_literal(token_map)
        t = F.transform(t, lambda x: F.coalesce(F.try_element_at(m, x), x))
    return t


def remove_stopwords(tokens, stopwords: Iterable[str]) -> Column:
    """Order- and duplicate-preserving stop-list filter.  ``isin`` with more
    than a handful of values is planned as a hash-set lookup (InSet)."""
    stop = list(stopwords)
    if not stop:
        return _c(tokens)
    return F.filter(_c(tokens), lambda x: ~x.isin(stop))


# ------------------------------------------------------ F24 tokenisation
def regex_tokens(col, split_pattern: str = r"[^a-z0-9]+", lowercase: bool = True,
                 stopwords: Iterable[str] = ()) -> Column:
    """Built-in tokeniser: (lower) -> split on a separator class -> drop
    blanks -> drop stop words.  Used for the Latin-script bindings."""
    c = _c(col)
    x = F.lower(c) if lowercase else c
    toks = F.filter(F.split(x, split_pattern), lambda t: t != "")
    toks = F.coalesce(toks, F.array().cast("array<string>"))
    return remove_stopwords(toks, stopwords)


def review_tokens(col, stopwords: Iterable[str] = (), keep: str = P.TOKEN_TEXT_KEEP) -> Column:
    """Default Korean-review tokeniser without an analyser: clean to the token
    class (F4), split on whitespace, stop-list."""
    return remove_stopwords(whitespace_tokens(clean_for_tokens(col, keep)), stopwords)


def _slices(texts: pa.Array, most: int = 1 << 20) -> Iterator[pa.Array]:
    """The rows in pieces of about ``most`` bytes of text, one row at least."""
    start = held = 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        if held and held + (n or 0) > most:
            yield texts.slice(start, i - start)
            start, held = i, 0
        held += n or 0
    yield texts.slice(start)


def analyzer_tokens(col, analyzer_factory: Callable[[], Callable[[str], list]],
                    stopwords: Iterable[str] = (), keep: str = P.TOKEN_TEXT_KEEP) -> Column:
    """Plug-in morphological analyser (iterator Arrow UDF).

    ``analyzer_factory()`` is called once per Python worker and must return a
    function ``text -> list[str]`` (e.g. POS-filtered, stemmed morphemes).  Only the
    tokens of about a megabyte of text are Python objects at a time.  Text
    is cleaned with F4 on the JVM side first; the stop-list runs JVM side after.
    """
    @F.arrow_udf(T.ArrayType(T.StringType()))
    def _analyse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fn = analyzer_factory()
        for texts in batches:
            for part in _slices(texts):
                yield pa.array([[] if x is None else list(fn(x)) for x in part.to_pylist()], pa.list_(pa.string()))

    return remove_stopwords(_analyse(clean_for_tokens(col, keep)), stopwords)


# ------------------------------------------------------ F37 token strings
def parse_token_string(col) -> Column:
    """Tokens out of a stringified Python list such as "['a', 'b']"."""
    return F.regexp_extract_all(_c(col), F.lit("'([^']+)'"), 1)
