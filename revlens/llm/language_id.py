"""Language identification by compression.

Each language has a raw-content zstandard dictionary of its words.  A text is
compressed with every dictionary, in blocks so that long texts keep using it,
and takes the language with the smallest total; a narrow margin is rejected.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revlens.llm.common import fold

NOT_LETTERS = re.compile(r"[\W\d_]+")
UNKNOWN = "und"
LEVEL = 6
BLOCK = 1024
SHORT = 64
#: Confidence gained per byte of margin (score is a softmax over sizes).
PER_BYTE = 0.5
#: Sizes of a text that fits no dictionary differ by chance, by about the root of the size: where the best
#: dictionary leaves more than FIT of the letters' bytes, a margin of fewer than NOISE roots is narrow.
NOISE, FIT = 0.36, 0.55


def letters(text: str) -> str:
    """Lower-case words of letters between single spaces."""
    words = NOT_LETTERS.sub(" ", text.lower()).strip()
    return f" {words} " if words else ""


def learn(docs: DataFrame, train: Column, text: str = "text", lang: str = "lang", per_lang: int = 600,
          per_text: int = 4000, size: int = 8192) -> list[tuple[str, bytes]]:
    """Dictionaries (language, content), most frequent language first.

    Learned from a bounded sample: at most ``per_lang`` distinct training texts of
    each language (smallest hashes) and ``per_text`` characters of each, from a place
    given by its hash; the content is the distinct words, the frequent ones last, in
    at most ``size`` bytes.
    """
    rows = docs.filter(train & F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    found = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("h").alias("d")).collect()
    counts = {r["lang"]: r["n"] for r in found}
    if not counts:
        return []
    # a hash threshold first, so that no window holds a whole language; copies count once
    share = F.lit(0.0)
    for r in found:
        share = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, 2.0 * per_lang / r["d"]))).otherwise(share)
    unit = F.pmod("h", F.lit(1 << 30)) / float(1 << 30)
    room = F.greatest(F.char_length("text") - F.lit(per_text - 1), F.lit(1))
    start = (F.pmod(F.xxhash64("h"), room) + 1).cast("int")
    few = (rows.withColumn("u", unit).filter(F.col("u") <= share)
           .select("lang", "h", "u", F.substring("text", start, F.lit(per_text)).alias("text"))
           .groupBy("lang", "h", "u").agg(F.min("text").alias("text")))
    pick = few.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("u", "text"))).filter(
        F.col("r") <= per_lang).select("lang", "text").collect()
    seen: dict[str, Counter] = {name: Counter() for name in counts}
    for r in pick:
        seen[r["lang"]].update(letters(r["text"]).split())
    out = []
    for name in sorted(counts, key=lambda x: (-counts[x], x)):
        content, left = [], size
        for w, _ in sorted(seen[name].items(), key=lambda x: (-x[1], x[0])):
            left -= len(w.encode()) + 1
            if left < 1:
                break
            content.append(w)
        out.append((name, (" " + " ".join(reversed(content)) + " ").encode()))
    return out


@lru_cache(maxsize=4)
def _compressors(dictionaries: tuple[tuple[str, bytes], ...]):
    import zstandard as z
    out = []
    for _, content in dictionaries:
        d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        out.append(z.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False,
                                    write_dict_id=False).compress)
    return out


def sizes(text: str, dictionaries: tuple[tuple[str, bytes], ...]) -> list[int]:
    """Compressed bytes of the letters of ``text`` under each dictionary, [] without letters."""
    line = letters(text).encode()
    if not line:
        return []
    # a few words alone are too short for any match: say them again until they fill a line
    line *= -(-SHORT // len(line))
    total = [0] * len(dictionaries)
    for at in range(0, len(line), BLOCK):
        block = line[at:at + BLOCK]
        for k, compress in enumerate(_compressors(dictionaries)):
            total[k] += len(compress(block))
    return total


def verdict(dictionaries: list[tuple[str, bytes]], min_margin: float = 0.002, noise: float = NOISE, fit: float = FIT):
    """Column function: text -> struct(lang_pred, score, margin, rejected)."""
    known = tuple(dictionaries)

    def each(texts):
        import pandas as pd
        out = []
        for t in texts:
            got = sizes(t, known) if t and known else []
            if not got:
                out.append((UNKNOWN, 0.0, 0.0, True))
                continue
            order = sorted(range(len(got)), key=lambda i: (got[i], i))
            best = got[order[0]]
            gap = (got[order[1]] - best) / best if len(order) > 1 else 1.0
            narrow = min_margin
            if gap < noise / math.sqrt(best) and best > fit * len(letters(t).encode()):
                narrow = max(narrow, noise / math.sqrt(best))
            p = 1.0 / sum(math.exp(-PER_BYTE * (s - best)) for s in got)
            out.append((known[order[0]][0], p, gap, gap < narrow))
        return pd.DataFrame(out, columns=["lang_pred", "score", "margin", "rejected"])

    return F.pandas_udf(each, "lang_pred string, score double, margin double, rejected boolean")


def identify(docs: DataFrame, dictionaries: list[tuple[str, bytes]], key: str = "doc_id", text: str = "text",
             min_margin: float = 0.002, noise: float = NOISE, fit: float = FIT) -> DataFrame:
    """(key, lang_pred, score, margin, rejected) per row of ``docs``.

    ``margin`` is the gap to the second language as a share of the smallest size;
    below ``min_margin`` the text is rejected, and below ``noise`` over the root of the
    smallest size if that is more than ``fit`` of the bytes of its letters.  Equal sizes go to the more frequent
    language.  Texts that are null or have no letter, and all texts if nothing was
    learned, are ``und`` with score 0 and rejected.  Null keys and repeated rows
    stay; an empty table gives an empty table.
    """
    found = verdict(dictionaries, min_margin, noise, fit)(F.col(text))
    return docs.select(F.col(key).alias("k"), found.alias("v")).select(F.col("k").alias(key), "v.*")


def training_rows(key: str = "doc_id") -> Column:
    return fold(F.col(key), 4) != 2
