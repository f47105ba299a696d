"""Language-model scoring by context-tree weighting.

The model predicts the bytes of a text bit by bit: the next byte is a path of eight
binary nodes.  Its context is the word so far and the space before it, for the first
three bytes of a word (its closing space included) and for the end mark also the
last two bytes of the word before that space.  Contexts have ``DEPTH`` places,
nearest byte first, filled up with zeros; at every binary node the
Krichevsky-Trofimov estimates of all depths are mixed with the weights of the
context tree, so a text costs the sum of its code lengths.  Every context of the
training rows counts, however rare it is.

Training rows fall into a few classes (their language); each class has a tree, and
a text is scored by the mixture of the trees, so its class is inferred from the text.

A text is cut into units, each measured once: its words (bytes from the fourth on)
and its joints (the end of a word and the start of the next).  The (context, byte)
pairs of all units are shuffled by their nearest ``CUT`` context bytes, so a task
holds whole subtrees of the tree: one pass weighs the subtrees upwards, the few
nodes above them are weighted on the driver, a second pass goes down again and
gives every pair its code length, which goes back to the units it came from.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import fold, stage, task_partitions

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SPACE, END = 0x20, 0x0A
END_WORD = b"\n"
#: Places of a context; of these, places that name a subtree; bytes of a word that see the word before.
DEPTH, CUT, HEAD = 6, 2, 3
#: Stands for a zero byte of a text (white space is in no word): zero fills up contexts.
NUL = 0x0B
LOG2 = math.log(2.0)

#: Rows of text taken to Python objects at a time, distinct units held by a task, pairs
#: measured together, bytes of a block of units: bound memory.
ROWS, HELD, PAIRS, BLOCK = 500, 300_000, 100_000, 1_500_000


def small(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def _bytes(line: bytes) -> np.ndarray:
    buf = np.frombuffer(line, dtype=np.uint8)
    return np.where(buf == 0, NUL, buf).astype(np.int64)


def line_of(words: list[bytes]) -> bytes:
    """A text as ``joints`` takes it."""
    return b"\n " + b" ".join(words) + b" " if words else b"\n "


def joints(lines: list[bytes]) -> np.ndarray:
    """Joint of every word and of the end mark of some texts, in order: two bytes of the
    word before and three from the start, zeros where there is none, as one number."""
    buf = _bytes(b"".join(lines) + b"\n\n\n")
    at = np.flatnonzero(buf == SPACE)
    near, far, one, two, three = (buf[at + i] for i in (-1, -2, 1, 2, 3))
    near = np.where(near == END, 0, near)
    far = np.where((near == 0) | (far == SPACE) | (far == END), 0, far)
    two = np.where(one == END, 0, two)
    three = np.where((two == 0) | (two == SPACE), 0, three)
    return far << 32 | near << 24 | one << 16 | two << 8 | three


def joint_units(code: np.ndarray) -> pa.Array:
    """Joints as binary values: a space, then five bytes (no word begins with a space)."""
    raw = np.empty((len(code), 6), dtype=np.uint8)
    raw[:, 0] = SPACE
    for i in range(5):
        raw[:, 1 + i] = code >> (32 - 8 * i) & 255
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(6), len(code), [None, pa.py_buffer(raw.tobytes())]).cast(pa.binary())


def joint_codes(units: list[bytes]) -> np.ndarray:
    return np.array([int.from_bytes(u[1:], "big") for u in units], dtype=np.int64)


def _joint_pairs(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    context = SPACE << 40 | (code >> 24 & 255) << 32 | (code >> 32 & 255) << 24
    keys, owner = [], []
    for i in range(HEAD):
        sym = code >> (16 - 8 * i) & 255
        here = np.flatnonzero(sym)
        keys.append((context << 8 | sym)[here])
        owner.append(here)
        context = sym << 40 | context >> 8
    return np.concatenate(keys), np.concatenate(owner)


def _word_pairs(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    buf = _bytes(b" " * DEPTH + b" ".join(words) + b" ")
    n = len(buf) - DEPTH
    key, alive = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
    for d in range(1, DEPTH + 1):
        byte = buf[DEPTH - d:DEPTH - d + n]
        key = (key << 8) | np.where(alive, byte, 0)
        alive &= byte != SPACE
    owner = np.repeat(np.arange(len(words)), size)
    inner = np.flatnonzero(np.arange(n) - np.repeat(np.cumsum(size) - size, size) >= HEAD)
    return ((key << 8) | buf[DEPTH:])[inner], owner[inner]


def pairs(units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Packed (context, byte) of all positions of some units, and the index of its unit."""
    j = np.array([i for i, u in enumerate(units) if u[:1] == b" "], dtype=np.int64)
    w = np.array([i for i, u in enumerate(units) if len(u) >= HEAD and u[:1] != b" "], dtype=np.int64)
    keys, owner = _joint_pairs(joint_codes([units[i] for i in j]))
    owner = j[owner]
    if len(w):
        more, own = _word_pairs([units[i] for i in w])
        keys, owner = np.append(keys, more), np.append(owner, w[own])
    return keys, owner


def unit_table(rows: DataFrame, classes: int) -> DataFrame:
    """(w binary, c array, a): every distinct unit with its count in the training rows of
    each class and in all rows, from (t binary, cls; -1 outside training).  The
    end mark is the word of one line end."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, Counter] = {}
        codes: dict[int, list] = {}

        def out(units, cls, n):
            return pa.RecordBatch.from_arrays([units, pa.array(np.full(len(n), cls, dtype=np.int32)), pa.array(n, pa.int64())],
                                              names=["w", "cls", "n"])

        def flush(cls: int):
            one = seen.pop(cls)
            words, n = list(one.keys()), list(one.values())
            for at in range(0, len(words), 50_000):
                yield out(pa.array(words[at:at + 50_000], pa.binary()), cls, n[at:at + 50_000])

        def flush_joints(cls: int):
            code, n = (np.concatenate(x) for x in zip(*codes.pop(cls)))
            code, n = _sum_by(code, n[:, None])
            for at in range(0, len(code), 50_000):
                yield out(joint_units(code[at:at + 50_000]), cls, n[at:at + 50_000, 0])

        for b in small(batches, ROWS):
            lines: dict[int, list[bytes]] = {}
            for t, cls in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got = (t or b"").translate(LOWER).split()
                one = seen.setdefault(cls, Counter())
                one.update(got)
                one[END_WORD] += 1
                lines.setdefault(cls, []).append(line_of(got))
            for cls, some in lines.items():
                codes.setdefault(cls, []).append(np.unique(joints(some), return_counts=True))
            while sum(map(len, seen.values())) > HELD:          # of all classes together
                yield from flush(max(seen, key=lambda c: len(seen[c])))
            while sum(len(x[0]) for one in codes.values() for x in one) > 10 * HELD:
                yield from flush_joints(max(codes, key=lambda c: sum(len(x[0]) for x in codes[c])))
        for cls in list(seen):
            yield from flush(cls)
        for cls in list(codes):
            yield from flush_joints(cls)

    counts = [F.coalesce(F.sum(F.when(F.col("cls") == i, F.col("n"))), F.lit(0)) for i in range(classes)]
    return (rows.mapInArrow(each, "w binary, cls int, n long").groupBy("w")
            .agg(F.array(*counts).alias("c"), F.sum("n").alias("a")))


def _sum_by(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of the rows of ``n``."""
    if not len(key):
        return key, n
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[first], np.add.reduceat(n[order], first, axis=0)


def _matrix(column, classes: int) -> np.ndarray:
    """A column of lists of one length as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, classes)


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), rows.shape[1]).cast(
        pa.list_(pa.from_numpy_dtype(rows.dtype)))


def pair_table(units: DataFrame, classes: int) -> DataFrame:
    """(block, key, c): the pairs of each block of units with their training counts."""

    def each(table: pa.Table) -> pa.Table:
        key, owner = pairs(table["w"].to_pylist())
        key, n = _sum_by(key, _matrix(table["c"], classes)[owner])
        return pa.Table.from_arrays([pa.array(np.full(len(key), table["block"][0].as_py(), dtype=np.int64)), pa.array(key),
                                     _lists(n)], names=["block", "key", "c"])

    return units.select("block", "w", "c").groupBy("block").applyInArrow(each, "block long, key long, c array<long>")


def _lgamma(x: np.ndarray) -> np.ndarray:
    """log gamma for x > 0: shifted above 8, then Stirling's series."""
    x = x.astype(float)
    shift = np.zeros_like(x)
    for _ in range(8):
        low = x < 8
        shift[low] -= np.log(x[low])
        x = np.where(low, x + 1, x)
    return shift + (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x ** 3)


_SMALL = 4096
_OF_SMALL = {s: _lgamma(np.arange(_SMALL) + s) for s in (0.5, 1.0)}


def _lgamma_of(n: np.ndarray, shift: float) -> np.ndarray:
    """log gamma of counts plus 0.5 or 1, from a table where they are small."""
    out = _OF_SMALL[shift][np.minimum(n, _SMALL - 1)]
    big = n >= _SMALL
    if big.any():
        out[big] = _lgamma(n[big] + shift)
    return out


def _log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log probability of a zeros and b ones under the Krichevsky-Trofimov estimator."""
    return _lgamma_of(a, 0.5) + _lgamma_of(b, 0.5) - math.log(math.pi) - _lgamma_of(a + b, 1.0)


def _add(n: int, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of rows by the index ``at``."""
    out = np.empty((n, rows.shape[1]))
    for k in range(rows.shape[1]):
        out[:, k] = np.bincount(at, weights=rows[:, k], minlength=n)
    return out


def _shorter(code: np.ndarray) -> np.ndarray:
    """context << 8 | byte with the farthest place of the context gone."""
    return (code >> 16) << 8 | (code & 255)


def _weigh(own: np.ndarray, split: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted probability of inner nodes (log) and the weight of their own estimate."""
    total = np.logaddexp(own, split) - LOG2
    return total, np.exp(np.minimum(0.0, own - LOG2 - total))


class Subtrees:
    """Whole subtrees below depth ``CUT``, from sorted distinct pairs and their counts (a
    column for each class).  Binary nodes of one level of the byte are walked at a time."""

    def __init__(self, key: np.ndarray, counts: np.ndarray):
        self.level, self.up = {DEPTH: (key, counts)}, {}
        for d in range(DEPTH - 1, CUT - 1, -1):
            key, up = np.unique(_shorter(key), return_inverse=True)
            counts = _add(len(key), up, counts).astype(np.int64)
            self.level[d], self.up[d + 1] = (key, counts), up

    def _walk(self, k: int) -> dict:
        """For each depth: first pair and parent of every binary node, node of every pair,
        counts, weighted probability, weight and estimate."""
        out, below = {}, None
        for d in range(DEPTH, CUT - 1, -1):
            key, counts = self.level[d]
            path = key >> (8 - k)
            new = np.append(True, path[1:] != path[:-1])
            first, node = np.flatnonzero(new), np.cumsum(new) - 1
            b = np.add.reduceat(counts * (key >> (7 - k) & 1)[:, None], first, axis=0)
            a = np.add.reduceat(counts, first, axis=0) - b
            own = _log_kt(a, b)
            if below is None:
                total, stay = own, np.ones_like(own)
            else:
                parent = node[self.up[d + 1][out[d + 1]["first"]]]
                out[d + 1]["parent"] = parent
                total, stay = _weigh(own, _add(len(first), parent, below))
            out[d] = {"first": first, "node": node, "a": a, "b": b, "total": total, "stay": stay,
                      "one": (b + 0.5) / (a + b + 1.0), "code": (key[first] >> 8) << 8 | 1 << k | (key[first] & 255) >> (8 - k)}
            below = total
        return out

    def roots(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Binary nodes of depth ``CUT``: context << 8 | node, counts, weighted probability."""
        top = [self._walk(k)[CUT] for k in range(8)]
        return tuple(np.concatenate([x[c] for x in top]) for c in ("code", "a", "b", "total"))

    def bits(self, above: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """Code length of every pair in every class, under the nodes ``above``."""
        codes, gathered_above, left_above = above
        key = self.level[DEPTH][0]
        out = np.zeros(self.level[DEPTH][1].shape)
        for k in range(8):
            walk = self._walk(k)
            for d in range(CUT, DEPTH + 1):
                here = walk[d]
                if d == CUT:
                    at = np.searchsorted(codes, _shorter(here["code"]))
                    gathered, left = gathered_above[at], left_above[at]
                else:
                    gathered, left = gathered[here["parent"]], left[here["parent"]]
                gathered, left = gathered + left * here["stay"] * here["one"], left * (1 - here["stay"])
            one = np.clip(gathered, 1e-12, 1 - 1e-12)[walk[DEPTH]["node"]]
            out -= np.log2(np.where((key >> (7 - k) & 1)[:, None] == 1, one, 1 - one))
        return out


def weigh_above(code: np.ndarray, a: np.ndarray, b: np.ndarray, total: np.ndarray):
    """The nodes above the subtrees: (codes of depth ``CUT`` - 1, probability of a one
    gathered on the way down to them, mass left there)."""
    down = []
    for _ in range(CUT):
        code, up = np.unique(_shorter(code), return_inverse=True)
        a, b, split = (_add(len(code), up, x) for x in (a, b, total))
        a, b = a.astype(np.int64), b.astype(np.int64)
        total, stay = _weigh(_log_kt(a, b), split)
        down.append((code, up, stay, (b + 0.5) / (a + b + 1.0)))
    gathered, left = np.zeros_like(total), np.ones_like(total)
    for i, (code, _, stay, one) in enumerate(reversed(down)):
        if i:
            up = down[CUT - i][1]
            gathered, left = gathered[up], left[up]
        gathered, left = gathered + left * stay * one, left * (1 - stay)
    return down[0][0], gathered, left


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by key as tables of whole subtrees."""
    held, n = [], 0
    shift = 8 + 8 * (DEPTH - CUT)
    for b in batches:
        if not b.num_rows:
            continue
        top = b.column(b.schema.get_field_index("key")).to_numpy() >> shift
        first = int(np.searchsorted(top, top[-1]))          # the last subtree may go on
        if held and n + first >= PAIRS and (first or held[-1][1] != top[0]):
            yield pa.Table.from_batches([x for x, _ in held] + [b.slice(0, first)])
            held, n, b = [], 0, b.slice(first)
        held.append((b, top[-1]))
        n += b.num_rows
    if held:
        yield pa.Table.from_batches([x for x, _ in held])


def pair_bits(table: DataFrame, classes: int) -> DataFrame:
    """(block, key, bits): code length of every pair in every class."""
    spark = table.sparkSession
    shift = 8 + 8 * (DEPTH - CUT)
    near = table.repartition(task_partitions(spark), F.shiftright("key", shift)).sortWithinPartitions("key")

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole(batches):
            code, a, b, total = Subtrees(*_sum_by(t["key"].to_numpy(), _matrix(t["c"], classes))).roots()
            yield pa.RecordBatch.from_arrays([pa.array(code), _lists(a), _lists(b), _lists(total)],
                                             names=["code", "a", "b", "total"])

    # at most 255 binary nodes for each of the 256 ** CUT contexts, whatever the input
    top = (near.select("key", "c").mapInArrow(up, "code long, a array<long>, b array<long>, total array<double>")
           .toArrow().combine_chunks())
    above = spark.sparkContext.broadcast(
        weigh_above(top["code"].to_numpy(), *(_matrix(top[x], classes) for x in ("a", "b", "total"))))

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole(batches):
            asked = t["key"].to_numpy()
            key, counts = _sum_by(asked, _matrix(t["c"], classes))
            bits = Subtrees(key, counts).bits(above.value).astype(np.float32)
            bits = bits[np.searchsorted(key, asked)]
            yield pa.RecordBatch.from_arrays([t["block"].combine_chunks(), t["key"].combine_chunks(), _lists(bits)],
                                             names=["block", "key", "bits"])

    return near.mapInArrow(down, "block long, key long, bits array<float>")


def rate_units(units: DataFrame, classes: int) -> DataFrame:
    """``units`` with their code length in every class (bits)."""
    size = units.agg(F.sum(F.length("w") + 8)).first()[0] or 0
    units = units.withColumn("block", F.pmod(F.xxhash64("w"), F.lit(size // BLOCK + 1)))
    found = pair_bits(stage(pair_table(units, classes), "ctw-pairs"), classes)

    def each(left: pa.Table, right: pa.Table) -> pa.Table:
        key, owner = pairs(left["w"].to_pylist())
        out = np.zeros((left.num_rows, classes))
        if len(key):
            known = right["key"].to_numpy()
            order = np.argsort(known)
            at = order[np.searchsorted(known, key, sorter=order)]
            out = _add(left.num_rows, owner, _matrix(right["bits"], classes)[at])
        return pa.Table.from_arrays([left["w"], left["c"], left["a"], _lists(out)], names=["w", "c", "a", "bits"])

    return (units.groupBy("block").cogroup(found.groupBy("block"))
            .applyInArrow(each, "w binary, c array<long>, a long, bits array<double>"))


def _classes(base: DataFrame, train: Column, most: int) -> tuple[Column, list[float]]:
    """Class of a row (-1 outside training) and the share of each class: the ``most``
    frequent values and one class for all others, null among them."""
    found = base.filter(train).groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    every = found.agg(F.sum("n")).first()[0] or 0
    top = found.filter("g IS NOT NULL").orderBy(F.col("n").desc(), "g").limit(most).collect()
    names, sizes = [r["g"] for r in top], [r["n"] for r in top]
    others = every - sum(sizes)
    cls = F.lit(len(names))
    for i, x in enumerate(names):
        cls = F.when(F.col("g") == F.lit(x), F.lit(i)).otherwise(cls)
    sizes += [others] if others or not sizes else []
    return F.when(train, cls).otherwise(F.lit(-1)).cast("int"), [(x + 1) / (sum(sizes) + len(sizes)) for x in sizes]


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", group: str | None = "lang", held_out: int = 10,
          frequent: float = 1e-6, extra: float = 0.1, most: int = 8) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte) per row of ``docs``.

    Learns from rows whose crc32(key as text) mod ``held_out`` is not 0, in classes by
    the ``most`` frequent values of ``group``; the group of a scored row is not used.
    ``score`` is the log10 probability of the token sequence under the mixture of
    the trees; ``base_score`` that of single token counts with ``extra`` added.
    Words and joints that occur at least ``frequent`` times the number of all tokens
    (at most 1 / frequent of each) are sent to every task; all others are joined.
    Null text counts as empty: one end mark.  A null key counts as empty text for the
    fold.  Repeated rows stay repeated.  Without training rows every byte costs 8
    bits.  An empty table gives an empty table.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(key).alias("k"), F.col(text).cast("binary").alias("t"),
                       (F.col(group).cast("string") if group else F.lit(None).cast("string")).alias("g"))
    cls, prior = _classes(base, fold(F.col("k"), held_out) != 0, most)
    classes = len(prior)
    units = stage(unit_table(base.select("t", cls.alias("cls")), classes), "ctw-units")
    total = F.aggregate("c", F.lit(0).cast("long"), lambda x, y: x + y)
    joint = F.substring("w", 1, 1) == F.lit(bytearray(b" "))
    tokens, distinct, every = (units.filter(~joint).withColumn("all", total)
                               .agg(F.sum("all"), F.count(F.when(F.col("all") > 0, 1)), F.sum("a")).first())
    tokens, every = tokens or 0, every or 0
    below = tokens + extra * (distinct + 1)
    rated = stage(rate_units(units, classes).select("w", total.alias("c"), "a", "bits"), "ctw-rated")
    least = max(1.0, frequent * every)
    often = (rated.filter((F.col("a") >= least) | (F.col("w") == F.lit(bytearray(END_WORD)))).select("w", "c", "bits")
             .toArrow().combine_chunks())
    names, bits_of = often["w"].to_pylist(), _matrix(often["bits"], classes)
    is_word = np.array([x[:1] != b" " for x in names], dtype=bool)
    words, seams = np.flatnonzero(is_word), np.flatnonzero(~is_word)
    codes = joint_codes([names[i] for i in seams])
    seams, codes = seams[np.argsort(codes)], np.sort(codes)
    c = often["c"].to_numpy()[words]
    known = spark.sparkContext.broadcast((
        {names[i]: at for at, i in enumerate(words)}, bits_of[words], np.log10((c + extra) / below) if len(c) else np.zeros(0),
        (c > 0).astype(np.int64), codes, bits_of[seams]))
    kind = docs.schema[key].dataType.simpleString()

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, bits, logs, seen, codes, seam_bits = known.value
        get, end = place.get, place.get(END_WORD)
        for b in small(batches, ROWS):
            rid, w, n, row, own, facts, lines = [], [], [], [], [], [], []
            rids = b.column(0).to_pylist()
            for i, (r, t) in enumerate(zip(rids, b.column(2).to_pylist())):
                got = (t or b"").translate(LOWER).split()
                at = np.fromiter((get(x, -1) for x in got), dtype=np.int64, count=len(got))
                rest = Counter(got[j] for j in np.flatnonzero(at < 0))
                at = np.append(at[at >= 0], end)
                rid += [r] * (1 + len(rest))
                w.append(b"  %d" % r)                # no unit begins with two spaces: joins with nothing
                w += rest.keys()
                n.append(1)
                n += rest.values()
                row.append(i)
                row += [None] * len(rest)
                own.append(bits[at].sum(axis=0))
                facts.append((logs[at].sum(), seen[at].sum(), len(got) + 1, len(t or b"")))
                lines.append(line_of(got))
            f = np.array(facts, dtype=float).reshape(-1, 4)
            doc = np.repeat(np.arange(len(lines)), f[:, 2].astype(np.int64))
            one, count = np.unique(doc << 40 | joints(lines), return_counts=True)
            doc, one = one >> 40, one & ((1 << 40) - 1)
            at = np.minimum(np.searchsorted(codes, one), max(len(codes) - 1, 0))
            hit = codes[at] == one if len(codes) else np.zeros(len(one), dtype=bool)
            own = np.array(own).reshape(-1, classes)
            own += _add(len(lines), doc[hit], seam_bits[at[hit]] * count[hit][:, None])
            miss = ~hit
            rid = pa.array(np.append(np.array(rid, dtype=np.int64), np.array(rids, dtype=np.int64)[doc[miss]]))
            w = pa.concat_arrays([pa.array(w, pa.binary()), joint_units(one[miss])])
            is_token = np.append(np.ones(len(n), dtype=np.int64), np.zeros(miss.sum(), dtype=np.int64))
            n = np.append(np.array(n, dtype=np.int64), count[miss])
            row = pa.array(row + [None] * int(miss.sum()), pa.int64())
            whole = pa.StructArray.from_arrays(
                [b.column(1), _lists(own), pa.array(f[:, 0]), *[pa.array(f[:, j].astype(np.int64)) for j in (1, 2, 3)]],
                names=["k", "bits", "logs", "known", "tokens", "bytes"])
            yield pa.RecordBatch.from_arrays([rid, w, pa.array(n), pa.array(n * is_token), whole.take(row)],
                                             names=["rid", "w", "n", "m", "doc"])

    rows = (base.select(F.monotonically_increasing_id().alias("rid"), "k", "t")
            .mapInArrow(look_up, f"rid long, w binary, n long, m long, doc struct<k: {kind}, bits: array<double>, logs: double, "
                                 "known: long, tokens: long, bytes: long>"))
    rare = rated.filter(F.col("a") < least).select("w", "c", "bits")
    c, doc = F.coalesce("c", F.lit(0)), F.col("doc").isNotNull()
    joined = rows.join(rare, "w", "left").select(
        "rid", "doc.k", "doc.tokens", "doc.bytes",
        *[F.when(doc, F.col("doc.bits")[i]).otherwise(F.col("n") * F.col("bits")[i]).alias(f"b{i}") for i in range(classes)],
        F.when(doc, F.col("doc.logs")).otherwise(F.col("m") * F.log10((c + extra) / F.lit(below))).alias("logs"),
        F.when(doc, F.col("doc.known")).otherwise(F.when(c > 0, F.col("m")).otherwise(0)).alias("known"))
    per = joined.groupBy("rid").agg(
        F.max("k").alias("k"), F.max("tokens").alias("n_tokens"), F.max("bytes").alias("bytes"),
        F.sum("known").alias("n_known"), F.sum("logs").alias("base_score"),
        *[F.sum(f"b{i}").alias(f"b{i}") for i in range(classes)])
    best = F.least(*[F.col(f"b{i}") for i in range(classes)]) if classes > 1 else F.col("b0")
    rest = sum((F.lit(p) * F.pow(F.lit(2.0), F.greatest(best - F.col(f"b{i}"), F.lit(-1000.0)))
                for i, p in enumerate(prior)), F.lit(0.0))
    bits = best - F.log2(rest)
    return per.select(F.col("k").alias(key), (fold(F.col("k"), held_out) == 0).alias("held_out"), "n_tokens", "n_known",
                      F.lit(tokens).cast("long").alias("train_tokens"), "base_score",
                      (-bits * math.log10(2.0)).alias("score"), (bits / F.greatest("bytes", F.lit(1))).alias("bits_per_byte"))
