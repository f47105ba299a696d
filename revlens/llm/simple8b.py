"""Simple-8b word-aligned coding of token ids, and a file source for it.

A 64-bit word holds a selector (its top four bits) and 60 bits of payload.
Selectors 2 to 15 pack 60 ids of one bit, 30 of two, ... or one of sixty; the
largest count whose ids all fit is taken.  Selector 1 is a run of one repeated id,
selector 0 an escape: the place of a 64-bit id in the block's list of escapes.

A file is a sequence of blocks of at most ``BLOCK`` ids, cut without regard to
documents, so a block is decoded in one piece of bounded size: selectors give the
counts, their running sums the offsets, and all words of one selector are
unpacked together.  A block lists the pieces of documents that lie in it and the
words of each lane of ``LANE`` ids; the offsets of the blocks stand at the end of
the file.

``Simple8bSource`` writes and reads a folder of such files through Spark's data
source interface (``df.write.format("simple8b")``).  A task writes one file of its
own name; the commit writes a manifest of the files of successful tasks, in the
order of the partitions.  Files of failed or repeated attempts are not in it, and
without a manifest there is nothing to read.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)
from pyspark.sql.types import StructType

#: (ids in a word, bits of an id) of the selectors 2 to 15.
PACKS = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20),
         (2, 30), (1, 60)]
ESCAPE, RUN, FIRST = 0, 1, 2
RUN_BITS = 28                                  # a run word: 28 bits of length, 32 bits of id
BLOCK = 1 << 16
LANE = 1 << 10                                 # ids of a lane: a block has the words of each lane in its header
CONTINUED, NULL_KEY = 1, 2                     # flags of a piece
HEADER = struct.Struct("<IIIIIQ")              # ids, words, lanes, escapes, pieces, ids before the block
MAGIC = b"S8B1"
MANIFEST = "_manifest.json"


def _choices(ids: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """Best selector at every place of every lane and the number of ids it takes."""
    n = len(ids)
    bits = np.full((lanes, LANE + 60), 255, np.uint8)                # nothing fits beyond the end of a lane
    flat = np.full(lanes * LANE, 255, np.uint8)
    flat[:n] = np.frexp(ids.astype(np.float64))[1]                   # rounding up only widens
    bits[:, :LANE] = flat.reshape(lanes, LANE)
    selector, count = np.zeros((lanes, LANE), np.uint8), np.ones((lanes, LANE), np.int64)   # no pack: an escape
    window = {1: bits}
    for slot in range(len(PACKS) - 1, -1, -1):                       # from one id a word to sixty
        take, width = PACKS[slot]
        if take not in window:                                       # two overlapping windows
            k = max(window)
            window[take] = np.maximum(window[k][:, :k - take], window[k][:, take - k:])
        fits = window[take][:, :LANE] <= width
        selector[:, :fits.shape[1]][fits], count[:, :fits.shape[1]][fits] = slot + FIRST, take
    padded = np.zeros(lanes * LANE, np.uint64)
    padded[:n] = ids
    grid = padded.reshape(lanes, LANE)
    last = np.full((lanes, LANE), LANE - 1, np.int64)                # end of the run at every place
    differs = grid[:, 1:] != grid[:, :-1]
    last[:, :-1][differs] = np.broadcast_to(np.arange(LANE - 1), differs.shape)[differs]
    last = np.minimum.accumulate(last[:, ::-1], axis=1)[:, ::-1]
    room = np.minimum(LANE, n - LANE * np.arange(lanes))[:, None]
    left = np.minimum(last + 1, room) - np.arange(LANE)
    run = (left > count) & (bits[:, :LANE] <= 32)
    selector[run], count[run] = RUN, left[run]
    return selector, count


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, escapes, words of each lane) of unsigned 64-bit ids.

    Lanes of ``LANE`` ids are coded side by side; no word goes over the end of a lane."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    lanes = -(-len(ids) // LANE)
    if not lanes:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    selector, count = _choices(ids, lanes)
    lane, place = np.arange(lanes), np.zeros(lanes, np.int64)
    ends = np.minimum(LANE, len(ids) - LANE * lane)
    seen = []
    while len(lane):                                                 # one word of every open lane a time
        seen.append(lane * LANE + place)
        place = place + count[lane, place]
        stays = place < ends[lane]
        if not stays.all():
            lane, place = lane[stays], place[stays]
    at = np.sort(np.concatenate(seen))
    chosen = selector.reshape(-1)[at]
    words = np.zeros(len(at), np.uint64)
    for slot, (take, width) in enumerate(PACKS):
        of = np.flatnonzero(chosen == slot + FIRST)
        if len(of):
            start, word = at[of], np.full(len(of), (slot + FIRST) << 60, np.uint64)
            for j in range(take):
                word |= ids[start + j] << np.uint64(j * width)
            words[of] = word
    of = np.flatnonzero(chosen == RUN)
    words[of] = (np.uint64(RUN << 60) | (ids[at[of]] << np.uint64(RUN_BITS))
                 | count.reshape(-1)[at[of]].astype(np.uint64))
    of = np.flatnonzero(chosen == ESCAPE)
    words[of] = np.arange(len(of), dtype=np.uint64)
    return words, ids[at[of]], np.bincount(at // LANE, minlength=lanes)


COUNTS = np.array([1, 0, *[take for take, _ in PACKS]], np.int64)


def decode(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The ids of ``encode``'s words, all words of a selector at once."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    count = COUNTS[chosen]
    runs = np.flatnonzero(chosen == RUN)
    count[runs] = (words[runs] & np.uint64((1 << RUN_BITS) - 1)).astype(np.int64)
    end = np.cumsum(count)
    at = end - count
    out = np.empty(int(end[-1]) if len(end) else 0, np.uint64)
    for slot, (take, width) in enumerate(PACKS):
        of = np.flatnonzero(chosen == slot + FIRST)
        if len(of):
            word, start, mask = words[of], at[of], np.uint64((1 << width) - 1)
            for j in range(take):
                out[start + j] = (word >> np.uint64(j * width)) & mask
    for i in runs.tolist():
        out[at[i]:end[i]] = (int(words[i]) >> RUN_BITS) & 0xFFFFFFFF
    of = np.flatnonzero(chosen == ESCAPE)
    out[at[of]] = escapes[words[of].astype(np.int64)]
    return out


# ------------------------------------------------------------------ files
def block_bytes(ids: np.ndarray, keys: np.ndarray, lengths: np.ndarray, flags: np.ndarray, before: int) -> bytes:
    words, escapes, lanes = encode(ids)
    body = b"".join([words.tobytes(), escapes.tobytes(), keys.astype("<i8").tobytes(),
                     lengths.astype("<u4").tobytes(), lanes.astype("<u4").tobytes(), flags.astype("u1").tobytes()])
    head = HEADER.pack(len(ids), len(words), len(lanes), len(escapes), len(keys), before)
    return head + struct.pack("<I", zlib.crc32(body)) + body


class Blocks:
    """Cuts documents into blocks; ``add`` and ``close`` return finished blocks."""

    def __init__(self):
        self.ids: list[np.ndarray] = []
        self.pieces: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = self.before = self.docs = 0

    def add(self, keys: np.ndarray, nulls: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> Iterator[bytes]:
        """Documents given by their keys, null marks, lengths and joined ids."""
        self.docs += len(keys)
        flags = np.where(nulls, NULL_KEY, 0).astype(np.uint8)
        ends, row, at = np.cumsum(lengths), 0, 0
        while row < len(keys):
            room = BLOCK - self.held
            last = int(np.searchsorted(ends, at + room, "right"))       # documents that fit whole
            if last > row:
                take = int(ends[last - 1]) - at
                self._hold(keys[row:last], np.diff(np.append(at, ends[row:last])), flags[row:last], ids[at:at + take])
                row, at = last, at + take
            elif room:
                self._hold(keys[row:row + 1], np.array([room]), flags[row:row + 1], ids[at:at + room])
                flags[row] |= CONTINUED
                at += room
            if self.held == BLOCK or (row < len(keys) and last <= row and not room):
                yield self.flush()
        if sum(len(p[0]) for p in self.pieces) > BLOCK:                 # many empty documents
            yield self.flush()

    def _hold(self, keys, lengths, flags, ids) -> None:
        self.pieces.append((keys, lengths, flags.copy()))
        self.ids.append(ids)
        self.held += len(ids)

    def flush(self) -> bytes:
        keys, lengths, flags = (np.concatenate(x) for x in zip(*self.pieces))
        ids = np.concatenate(self.ids)
        out = block_bytes(ids, keys, lengths, flags, self.before)
        self.before += self.held
        self.ids, self.pieces, self.held = [], [], 0
        return out

    def close(self) -> Iterator[bytes]:
        if self.pieces:
            yield self.flush()


def read_block(data: memoryview) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids before the block in its file, ids, keys, lengths, flags)."""
    n, words, lanes, escapes, pieces, before = HEADER.unpack_from(data)
    crc, = struct.unpack_from("<I", data, HEADER.size)
    at = HEADER.size + 4
    body = data[at:at + 8 * (words + escapes + pieces) + 4 * (pieces + lanes) + pieces]
    if zlib.crc32(body) != crc:
        raise ValueError("a block of a simple8b file is damaged")
    w = np.frombuffer(body, "<u8", words + escapes)
    at = 8 * (words + escapes)
    keys, at = np.frombuffer(body, "<i8", pieces, at), at + 8 * pieces
    lengths, at = np.frombuffer(body, "<u4", pieces, at), at + 4 * (pieces + lanes)
    flags = np.frombuffer(body, "u1", pieces, at)
    ids = decode(w[:words], w[words:])
    if len(ids) != n:
        raise ValueError("a block of a simple8b file has the wrong number of ids")
    return before, ids, keys, lengths.astype(np.int64), flags


def file_system(path: str):
    """(file system, path in it) of a local path or an address such as s3:// or hdfs://."""
    from pyarrow import fs
    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), path.removeprefix("file:").replace("///", "/", 1)
    return fs.FileSystem.from_uri(path)


def read_file(path: str, name: str, base: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(key, start, ids) of every document of one file; one block in memory at a time."""
    system, root = file_system(path)
    with system.open_input_file(f"{root}/{name}") as f:
        size = f.size()
        f.seek(size - 12)
        foot, magic = struct.unpack("<Q4s", f.read(12))
        if magic != MAGIC:
            raise ValueError(f"{name} is no simple8b file")
        f.seek(foot)
        offsets = np.frombuffer(f.read(size - 12 - foot), "<u8")
        held: list[np.ndarray] = []
        key, start = None, 0
        for lo, hi in zip(offsets.tolist(), [*offsets[1:].tolist(), foot]):
            f.seek(lo)
            before, ids, keys, lengths, flags = read_block(memoryview(f.read(hi - lo)))
            at = 0
            for k, length, flag in zip(keys.tolist(), lengths.tolist(), flags.tolist()):
                piece = ids[at:at + length]
                if flag & CONTINUED:
                    held.append(piece)
                else:
                    if held:
                        yield key, start, np.concatenate(held) if len(held) > 1 else held[0]
                    held, key, start = [piece], None if flag & NULL_KEY else k, base + before + at
                at += length
        if held:
            yield key, start, np.concatenate(held) if len(held) > 1 else held[0]


class _Written(WriterCommitMessage):
    def __init__(self, part: int, name: str, ids: int, docs: int):
        self.part, self.name, self.ids, self.docs = part, name, ids, docs


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.run = path, uuid.uuid4().hex
        system, root = file_system(path)
        from pyarrow import fs
        if not overwrite and system.get_file_info(f"{root}/{MANIFEST}").type != fs.FileType.NotFound:
            raise ValueError(f"{path} holds a table already")
        system.create_dir(root, recursive=True)

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext
        task = TaskContext.get()
        system, root = file_system(self.path)
        name = f"part-{task.partitionId():06d}-{self.run}-{task.taskAttemptId()}.s8b"
        blocks, offsets, at = Blocks(), [], 0
        with system.open_output_stream(f"{root}/{name}") as out:
            def put(found: Iterator[bytes]) -> None:
                nonlocal at
                for data in found:
                    offsets.append(at)
                    out.write(data)
                    at += len(data)

            for b in batches:
                key, lists = b.column(0), b.column(1)
                if lists.null_count:
                    lists = pa.compute.fill_null(lists, pa.scalar([], lists.type))
                off = lists.offsets.to_numpy().astype(np.int64)
                ids = lists.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]]
                if len(ids) and ids.dtype.kind == "i" and ids.min() < 0:
                    raise ValueError("a token id is below zero")
                put(blocks.add(pa.compute.fill_null(key, 0).to_numpy(zero_copy_only=False),
                               key.is_null().to_numpy(zero_copy_only=False), np.diff(off), ids.astype(np.uint64)))
            put(blocks.close())
            out.write(np.array(offsets, "<u8").tobytes() + struct.pack("<Q4s", at, MAGIC))
        return _Written(task.partitionId(), name, blocks.before, blocks.docs)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        done = sorted((m for m in messages if m is not None and m.docs), key=lambda m: m.part)
        system, root = file_system(self.path)
        body = json.dumps({"files": [[m.name, m.ids, m.docs] for m in done]}).encode()
        with system.open_output_stream(f"{root}/{MANIFEST}") as out:
            out.write(body)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, root = file_system(self.path)
        for m in messages:
            if m is not None:
                system.delete_file(f"{root}/{m.name}")


class _File(InputPartition):
    def __init__(self, name: str, base: int):
        super().__init__((name, base))
        self.name, self.base = name, base


class _Reader(DataSourceReader):
    def __init__(self, path: str, with_ids: bool, batch_ids: int):
        self.path, self.with_ids, self.batch_ids = path, with_ids, batch_ids

    def partitions(self) -> list[InputPartition]:
        system, root = file_system(self.path)
        with system.open_input_file(f"{root}/{MANIFEST}") as f:
            files = json.loads(f.read())["files"]
        out, base = [], 0
        for name, ids, _ in files:
            out.append(_File(name, base))
            base += ids
        return out or [_File("", 0)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        rows: list[tuple] = []
        held = 0
        for key, start, ids in read_file(self.path, partition.name, partition.base):
            row = (key, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
            rows.append((*row, ids.astype(np.int64)) if self.with_ids else row)
            held += len(ids)
            if len(rows) == 10_000 or held > self.batch_ids:
                yield self._batch(rows)
                rows, held = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows))
        arrays = [pa.array(c, pa.int64()) for c in cols[:4]]
        names = ["key", "start", "n_tokens", "ids_crc32"]
        if self.with_ids:
            off = np.cumsum([0, *map(len, cols[4])])
            arrays.append(pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(np.concatenate(cols[4]))))
            names.append("ids")
        return pa.RecordBatch.from_arrays(arrays, names=names)


class Simple8bSource(DataSource):
    """Format ``simple8b``: rows (key long, ids array<int> or array<long>) in the order of
    their partitions.  Reading gives (key, start, n_tokens, ids_crc32) of every
    document and, with the option ``ids`` = true, its ids.  A null list is written as
    an empty one, a null key stays null; a table without rows is read back empty."""

    @classmethod
    def name(cls) -> str:
        return "simple8b"

    def schema(self) -> str:
        ids = ", ids array<bigint>" if self.options.get("ids", "false").lower() == "true" else ""
        return f"key bigint, start bigint, n_tokens bigint, ids_crc32 bigint{ids}"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        kinds = [f.dataType.simpleString() for f in schema.fields]
        if len(kinds) != 2 or kinds[0] != "bigint" or kinds[1] not in ("array<int>", "array<bigint>"):
            raise ValueError(f"simple8b takes (key long, ids array<int>), not {schema.simpleString()}")
        return _Writer(self.options["path"], overwrite)

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], self.options.get("ids", "false").lower() == "true",
                       int(self.options.get("batchIds", 2_000_000)))
