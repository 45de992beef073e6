"""Byte-level dedup: repeated byte strings by merging shard Burrows-Wheeler transforms.

Every byte is removed that is covered by a string of ``length`` bytes which also
starts anywhere else, in the same document or another.  Overlaps count, strings
are judged on the input, and matches never cross documents.

1. A text is parsed into phrases by its own content: of every ``WINDOW``
   consecutive grams of ``GRAM`` bytes the first with the least hash is an
   anchor, and a phrase reaches from an anchor over the gram of the next one.
   Two equal strings have the same anchors between the first and the last that
   is chosen inside them.  The part from the first such anchor to the last is
   the core of a string; strings of one document with equal ends of the core
   form a cell, a range of starts.
2. A shard is some megabytes of documents.  Its Burrows-Wheeler transform over
   phrases is built in the task that reads them: suffixes in order, the phrase
   before each and the place of the suffix that begins with it.
3. The transforms are merged by refining their interleave.  A block of the
   merged order is one interval in each shard; at depth k its suffixes share k
   phrases.  A round maps every interval through the shard's transform, one
   phrase to the left, and equal (phrase, block) pairs of all shards meet in a
   new block.  Blocks of one suffix are settled and leave, as do intervals that
   no deeper cell needs; no suffix is sorted again.  Blocks that stay are
   repeated intervals, their depth the common prefix.
4. A cell whose core is a repeated interval is compared in whole with the others
   of its block.  Cells that are alone, at the borders of a repeat, are compared
   string by string with one representative of each other kind of cell in the
   block.  Blocks are named by 64 bits and contents inside a block by 64 more.
5. Strings without any anchor have a period under ``PERIOD`` throughout.  They
   are compared by 128-bit hashes, each different one once a document.

A document is named by two hashes of its text, so equal texts count as often as
they occur but travel once, and no table of texts is written.

Defined results: null text is empty and stays null; texts shorter than
``length`` lose nothing.  Repeated rows are documents of their own, so copies of
``length`` bytes or more remove each other.  ``doc_id`` plays no part and may
be null or repeated.  Empty tables give no rows.  All columns are kept, whatever
their names.  ``removed`` holds the maximal removed runs (start, end exclusive,
in bytes) and ``kept`` the remaining bytes, which may cut a character.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from .common import bounded_batches, forget, free_shuffles, mix64, save, text_bytes

LENGTH = 400
WINDOW = 128  # at most; a power of two
GRAM = 32
PERIOD = 16
SHARD_BYTES = 2 << 20
PIECE = 1 << 19
BASE = 0x9E3779B97F4A7C15
NONE = np.uint64(0xFFFFFFFF)  # the hash of a gram that cannot be an anchor

#: A shard's columns: numbers packed as bytes.  By anchor, in order of the texts:
#: the phrase that begins there (0: none), the gram, the depth that cells need, the
#: place of its suffix in the suffix order, the position, and how many cells begin
#: there.  By cell: depth, first and last start as distances before the first
#: anchor, hash.  By document: two names, copies in the shard, and anchors.  Then
#: strings without anchor, by document.
_SHARD = {"phrase": "<i8", "gram": "<i8", "need": "<i2", "place": "<i4", "at": "<i4", "n_cells": "<i2",
          "cell_depth": "<i2", "cell_back": "<i2", "cell_reach": "<i2", "cell_hash": "<i8",
          "doc": "<i8", "doc2": "<i8", "copies": "<i4", "n_anchors": "<i4"}
_LONE = {"lone_own": "<i4", "lone_from": "<i4", "lone_n": "<i4", "lone_h1": "<i8", "lone_h2": "<i8",
         "sure_own": "<i4", "sure_from": "<i4"}
#: what the rounds read
_HELD = [c for c in _SHARD if c != "gram"]
MOST_LENGTH = 30_000  # distances within a string are packed in two bytes


def window_for(length: int) -> int:
    """The largest window of grams, a power of two, that a string contains whole."""
    room = length - GRAM + 1
    if room < 2 or length > MOST_LENGTH:
        raise ValueError(f"length must be from {GRAM + 1} to {MOST_LENGTH}")
    return min(WINDOW, 1 << (room.bit_length() - 1))


class Grams:
    """Hashes of all grams of a buffer of bytes, and the anchor of every window."""

    def __init__(self, window: int, piece: int = PIECE):
        self.window, self.piece = window, piece
        room = piece + window + GRAM
        with np.errstate(over="ignore"):
            self.up, self.down = (np.multiply.accumulate(np.array([1] + [b] * room, np.uint64))
                                  for b in (BASE, pow(BASE, -1, 1 << 64)))
        self.table = mix64(np.arange(1, 257, dtype=np.uint64))

    def hashes(self, data: np.ndarray) -> np.ndarray:
        """32 bits a gram; ``NONE`` for grams with a period under ``PERIOD``."""
        n, half = len(data), GRAM // 2
        count = n - GRAM + 1
        with np.errstate(over="ignore"):
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(self.table[data] * self.up[:n], out=total[1:])
            short = (total[half:] - total[:-half]) * self.down[:n - half + 1]
            out = mix64((total[GRAM:] - total[:-GRAM]) * self.down[:count]) >> np.uint64(32)
        plain = short[:count] == short[1:1 + count]
        for d in range(2, PERIOD):
            plain |= short[:count] == short[d:d + count]
        out[out == NONE] = 0
        out[plain] = NONE
        return out

    def anchors(self, hashes: np.ndarray) -> np.ndarray:
        """The place of the first least hash in every window; -1 if all are NONE."""
        least = (hashes << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)
        step = 1
        while step < self.window:
            least = np.minimum(least[step:], least[:-step])
            step *= 2
        return np.where(least >> np.uint64(32) == NONE, -1, (least & NONE).astype(np.int64))


def anchor_runs(texts: list[bytes], length: int, grams: Grams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, anchor): runs of windows with one anchor, in order; -1 for none.

    Places count over all texts laid end to end.  Buffers hold several texts; a
    long one is cut into pieces that overlap by the reach of a window, so memory
    does not grow with it."""
    reach = grams.window + GRAM - 2  # bytes after a window's first byte
    found: list[tuple] = []
    held: list[tuple[int, int, bytes]] = []

    def flush():
        anchors = grams.anchors(grams.hashes(np.frombuffer(b"".join(p for _, _, p in held), np.uint8)))
        at = 0
        for k, offset, piece in held:
            own = anchors[at:at + len(piece) - reach]
            starts = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1])
            value = own[starts]
            found.append((np.full(len(starts), k), starts + offset, np.where(value < 0, -1, value + (offset - at))))
            at += len(piece)
        held.clear()

    size = base = 0
    for k, text in enumerate(texts):
        for offset in range(0, len(text) - reach if len(text) >= length else 0, grams.piece):
            piece = text[offset:offset + grams.piece + reach]
            if size + len(piece) > grams.piece + reach and held:
                flush()
                size = 0
            held.append((k, base + offset, piece))
            size += len(piece)
        base += len(text)
    if held:
        flush()
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(3))
    text, start, anchor = (np.concatenate(x) for x in zip(*found, strict=True))
    new = np.concatenate([[True], (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])])
    return text[new], start[new], anchor[new]


def cells_of(text: np.ndarray, start: np.ndarray, anchor: np.ndarray, last: np.ndarray, inner: int):
    """Cells (first anchor's ordinal, depth, first start, last start), and ranges
    (text, first start, last start) of strings without anchor.  ``last`` is the
    last start of a string of each text, ``inner`` the distance from a string's
    start to that of its last window."""
    finite = anchor >= 0
    ordinal = np.cumsum(finite) - 1
    runs = np.arange(len(start))
    after = np.minimum.accumulate(np.where(finite, runs, len(runs))[::-1])[::-1]
    before = np.maximum.accumulate(np.where(finite, runs, -1))
    head = np.concatenate([[True], text[1:] != text[:-1]])
    begin = start[head][np.cumsum(head) - 1]  # of each run's text
    earlier = start - inner
    points = np.concatenate([start[start <= last[text]], earlier[earlier >= begin]])
    owner = np.concatenate([text[start <= last[text]], text[earlier >= begin]])
    points, first_of = np.unique(points, return_index=True)
    owner = owner[first_of]
    follows = np.append(owner[1:] == owner[:-1], False)
    until = np.where(follows, np.append(points[1:], 0) - 1, last[owner])
    lo = np.searchsorted(start, points, "right") - 1
    hi = np.searchsorted(start, points + inner, "right") - 1
    first, final = after[lo], before[hi]
    has = first <= hi
    own = np.flatnonzero(has)
    cells = (ordinal[first[own]], ordinal[final[own]] - ordinal[first[own]], points[own], until[own])
    bare = np.flatnonzero(~has)
    return cells, (owner[bare], points[bare], until[bare])


def suffix_order(symbols: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The order of all suffixes of symbol sequences, by prefix doubling inside
    one shard; equal suffixes stand in order of their places."""
    rank = symbols
    classes, step = int(rank.max()) + 1 if len(rank) else 0, 1
    while classes < len(rank):
        ahead = np.zeros(len(rank), np.int64)
        if step < len(rank):
            same = doc[step:] == doc[:-step]
            ahead[:-step] = np.where(same, rank[step:] + 1, 0)
        values, rank = np.unique(rank * (classes + 1) + ahead, return_inverse=True)
        if len(values) == classes:
            break
        classes, step = len(values), step * 2
    return np.argsort(rank, kind="stable")


def _hashes64(view, lo, hi) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(view[a:b]) for a, b in zip(lo.tolist(), hi.tolist(), strict=True)], np.uint64).view(np.int64)


def _lone(view, base: np.ndarray, copies: np.ndarray, length: int, bare) -> dict:
    """Strings without anchor: each different one of a text once, and the starts
    of those that the text itself, or a copy of it, repeats.

    As far as a range keeps one period under ``PERIOD``, its first few strings
    tell the others."""
    digest = xxhash.xxh3_128_digest
    seen: dict[tuple, list] = {}  # (text, hash): number, (first start, step, number) of each part
    for k, a, b in zip(*(x.tolist() for x in bare), strict=True):
        n = b - a + 1
        digests = [digest(view[i:i + length]) for i in range(a, a + min(n, PERIOD))]
        step = next((d for d in range(1, len(digests)) if digests[d] == digests[0]), 0)
        periodic = 0
        if step:
            data = np.frombuffer(view[a:b + length], np.uint8)
            differ = np.flatnonzero(data[:-step] != data[step:])
            periodic = min(n, (int(differ[0]) if len(differ) else len(data) - step) - (length - step) + 1)
        parts = [(digests[r], a + r, step, (periodic - 1 - r) // step + 1) for r in range(min(step, periodic))]
        parts += [(digest(view[i:i + length]), i, 1, 1) for i in range(a + periodic, b + 1)]
        for name, at, by, many in parts:
            found = seen.setdefault((k, name), [0, []])
            found[0] += many
            found[1].append((at, by, many))
    pairs = np.frombuffer(b"".join(h for _, h in seen), np.int64).reshape(-1, 2)
    own = np.array([k for k, _ in seen], np.int64)
    times = np.array([n for n, _ in seen.values()], np.int64) * copies[own]
    sure = [(k, np.arange(at, at + n * step, step)) for (k, _), (_, parts), total in zip(seen, seen.values(), times.tolist(), strict=True)
            if total > 1 for at, step, n in parts]
    sure_own = np.repeat(np.array([k for k, _ in sure], np.int64), [len(x) for _, x in sure])
    sure_from = np.concatenate([x for _, x in sure]) if sure else np.empty(0, np.int64)
    return {"lone_own": own, "lone_from": np.array([x[1][0][0] for x in seen.values()], np.int64) - base[own],
            "lone_n": times, "lone_h1": pairs[:, 0], "lone_h2": pairs[:, 1],
            "sure_own": sure_own, "sure_from": sure_from - base[sure_own]}


def build_shard(named: dict[tuple[int, int], list], length: int, grams: Grams) -> dict:
    """The transform over phrases of some texts, their cells and lone strings,
    for {(name, second name): [text, copies]}."""
    texts = [t for t, _ in named.values()]
    doc, doc2 = np.array(list(named), np.int64).T
    copies = np.array([n for _, n in named.values()], np.int64)
    size = np.array([len(t) for t in texts], np.int64)
    base = np.cumsum(size) - size
    inner = length - grams.window - GRAM + 1
    text, start, anchor = anchor_runs(texts, length, grams)
    (first, depth, lo, hi), bare = cells_of(text, start, anchor, base + size - length, inner)
    view = memoryview(b"".join(texts))
    at, own = anchor[anchor >= 0], text[anchor >= 0]
    m = len(at)
    follows = np.append(own[1:] == own[:-1], False)[:m]
    phrase = np.zeros(m, np.int64)  # the last anchor of a text begins no whole phrase
    begins = np.flatnonzero(follows)
    phrase[begins] = _hashes64(view, at[begins], at[np.minimum(begins + 1, m - 1)] + GRAM) | 1
    gram = _hashes64(view, at, at + GRAM)
    # symbols in order of (gram, phrase), so that equal grams stand together
    order = np.lexsort((phrase, gram))
    symbols = np.empty(m, np.int64)
    symbols[order] = np.cumsum(np.concatenate([[False], (np.diff(gram[order]) != 0) | (np.diff(phrase[order]) != 0)])[:m])
    place = np.empty(m, np.int64)
    place[suffix_order(symbols, own)] = np.arange(m)
    # how deep a suffix must be known, for its own cells and those before it
    number, apart = np.arange(m), own * (2 * m + 2)
    deepest = np.full(m, -1)
    np.maximum.at(deepest, first, depth)
    need = np.maximum.accumulate(deepest + number + apart) - number - apart
    return {"phrase": phrase, "gram": gram, "need": need, "place": place, "at": at - base[own],
            "n_cells": np.bincount(first, minlength=m), "cell_depth": depth, "cell_back": at[first] - lo,
            "cell_reach": at[first] - hi, "cell_hash": _hashes64(view, lo, hi + length), "doc": doc, "doc2": doc2,
            "copies": copies, "n_anchors": np.bincount(own, minlength=len(texts)),
            **_lone(view, base, copies, length, bare)}


def _build(length: int):
    def run(batches):
        number = TaskContext.get().partitionId() << 32
        grams = Grams(window_for(length))
        names = {**_SHARD, **_LONE}

        def row(named):
            shard = build_shard(named, length, grams)
            arrays = [pa.array([shard[k].astype(t).tobytes()], pa.binary()) for k, t in names.items()]
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *arrays], names=["shard", *names])

        named: dict[tuple[int, int], list] = {}  # equal texts of a shard are one
        held = 0
        for batch in batches:
            for text, a, b in zip(*(batch.column(c).to_pylist() for c in ("text", "doc", "doc2")), strict=True):
                known = named.setdefault((a, b), [text, 0])
                known[1] += 1
                held += len(text) if known[1] == 1 else 0
                if held >= SHARD_BYTES:
                    yield row(named)
                    number, named, held = number + 1, {}, 0
        if named:
            yield row(named)
    return run


@contextmanager
def _few_rows_at_once(spark):
    """Rows of shards are large: the Parquet reader takes a few at a time."""
    key = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(key)
    spark.conf.set(key, "8")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def text_names(text: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a text."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def named_texts(texts: DataFrame, length: int) -> DataFrame:
    """(doc, doc2, text) of texts that hold a string of ``length`` bytes."""
    a, b = text_names(F.col("text"))
    return texts.where(F.length("text") >= length).select(a.alias("doc"), b.alias("doc2"), "text")


def shards(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row a shard of (doc, doc2, text) rows: its transform, cells and lone strings."""
    bounded_batches(texts.sparkSession)
    schema = ", ".join(["shard long", *(f"{k} binary" for k in {**_SHARD, **_LONE})])
    return save(texts.mapInArrow(_build(length), schema), "shards")


_INTERVAL = {"block": pa.int64(), "shard": pa.int64(), "lo": pa.int32(), "hi": pa.int32()}
_CELL = {"back": pa.int32(), "reach": pa.int32(), "hash": pa.int64(), "doc": pa.int64(), "doc2": pa.int64(),
         "at": pa.int32(), "copies": pa.int32()}
_STRING = {"block": pa.int64(), "hash": pa.int64(), "alone": pa.bool_(), "doc": pa.int64(), "doc2": pa.int64(),
           "start": pa.int32()}
_LONE_ROW = {"h1": pa.int64(), "h2": pa.int64(), "n": pa.int64(), "doc": pa.int64(), "doc2": pa.int64(),
             "start": pa.int32()}
_DDL = {pa.int64(): "long", pa.int32(): "int", pa.bool_(): "boolean"}


def _ddl(columns: dict) -> str:
    return ", ".join(f"{k} {_DDL[t]}" for k, t in columns.items())


def _rows(columns: dict, parts: list[tuple]) -> pa.RecordBatch:
    """Parts are tuples of arrays, one for each of the first columns; other columns are null."""
    joined = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else []
    n = len(joined[0]) if joined else 0
    arrays = [pa.array(x, t) for x, t in zip(joined, columns.values(), strict=False)]
    arrays += [pa.nulls(n, t) for t in list(columns.values())[len(arrays):]]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def _unpacked(batch, k: int, *names) -> list[np.ndarray]:
    kinds = {**_SHARD, **_LONE}
    return [np.frombuffer(batch.column(c)[k].as_buffer(), kinds[c]) for c in names]


def _grams_first(batches):
    """The interleave by grams alone: one interval for every gram of a shard."""
    for batch in batches:
        out = []
        for k, shard in enumerate(batch.column("shard").to_pylist()):
            gram, need, place = _unpacked(batch, k, "gram", "need", "place")
            if len(gram):
                order = np.empty(len(place), np.int64)
                order[place] = np.arange(len(place))
                gram, need = gram[order], need[order]
                lo = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
                own = np.flatnonzero(np.maximum.reduceat(need, lo) >= 0)
                out.append((gram[lo[own]], np.full(len(own), shard), lo[own], np.append(lo[1:], len(gram))[own]))
        yield _rows(_INTERVAL, out)


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and the ordinal of the range of each."""
    size = hi - lo
    which = np.repeat(np.arange(len(lo)), size)
    return np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + lo[which], which


def _moved(shard: int, depth: int, block, lo, hi, phrase, need, place, n_anchors) -> tuple | None:
    """Intervals mapped one phrase to the left, to ``depth``; those whose
    suffixes no cell needs so deep are left out."""
    order = np.empty(len(place), np.int64)  # anchors by suffix order
    order[place] = np.arange(len(place))
    head = np.zeros(len(place) + 1, bool)  # first anchors of texts, which nothing precedes
    head[np.cumsum(n_anchors) - n_anchors] = True
    at, which = _ranges(lo, hi)
    after = order[at]
    kept = ~head[after]
    before, which = after[kept] - 1, which[kept]
    to = place[before].astype(np.int64)
    by = np.lexsort((to, phrase[before], which))
    before, which, to = before[by], which[by], to[by]
    if not len(to):
        return None
    new = np.flatnonzero(np.concatenate([[True], (np.diff(which) != 0) | (np.diff(phrase[before]) != 0)]))
    size = np.diff(np.append(new, len(to)))
    own = np.flatnonzero(np.maximum.reduceat(need[before], new) >= depth)
    new, size = new[own], size[own]
    with np.errstate(over="ignore"):
        name = mix64(mix64(block[which[new]].view(np.uint64)) * np.uint64(3) + phrase[before[new]].view(np.uint64))
    # places of one phrase before one block are consecutive in the shard's order
    return name.view(np.int64), np.full(len(new), shard), to[new], to[new] + size


def _repeated_cells(shard: int, depth: int, block, lo, hi, batch, k: int) -> tuple:
    """Cells of this depth whose core is a repeated interval, named by its block."""
    level, back, reach, digest = _unpacked(batch, k, "cell_depth", "cell_back", "cell_reach", "cell_hash")
    place, pos, n_cells, doc, doc2, copies, n_anchors = _unpacked(batch, k, "place", "at", "n_cells", "doc", "doc2", "copies", "n_anchors")
    own = np.flatnonzero(level == depth)
    anchor = np.repeat(np.arange(len(place)), n_cells)[own]
    order = np.argsort(lo)
    at = order[np.maximum(np.searchsorted(lo[order], place[anchor], "right") - 1, 0)]
    held = (lo[at] <= place[anchor]) & (place[anchor] < hi[at])
    own, at, anchor = own[held], at[held], anchor[held]
    none, of = np.zeros(len(own), np.int64), np.repeat(np.arange(len(doc)), n_anchors)[anchor]
    return (block[at], np.full(len(own), shard), none, none, back[own], reach[own], digest[own], doc[of], doc2[of],
            pos[anchor], copies[of])


def _round(depth: int):
    """A round in each shard: its repeated cells of this depth, and its intervals one deeper."""
    def run(batches):
        for batch in batches:
            for k, shard in enumerate(batch.column("shard").to_pylist()):
                flat = batch.column("intervals")[k].values
                block, lo, hi = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("block", "lo", "hi"))
                yield _rows(_INTERVAL | _CELL, [_repeated_cells(shard, depth, block, lo, hi, batch, k)])
                moved = _moved(shard, depth + 1, block, lo, hi, *_unpacked(batch, k, "phrase", "need", "place", "n_anchors"))
                if moved is not None:
                    yield _rows(_INTERVAL | _CELL, [moved])
    return run


def _unsettled(intervals: DataFrame) -> DataFrame:
    """Intervals of blocks that hold more than one suffix (a block has one row a shard at most)."""
    total = F.sum(F.col("hi") - F.col("lo")).over(Window.partitionBy("block"))
    return intervals.withColumn("total", total).where("total > 1").drop("total")


def merge(shard_rows: DataFrame) -> list[DataFrame]:
    """By depth, the cells whose core is a repeated interval of the merged transforms:
    (block, back, reach, hash, doc, doc2, at, copies); ``block`` names core and depth."""
    spark = shard_rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = shard_rows.select("shard", *_HELD).repartition(parts, "shard").persist(StorageLevel.MEMORY_AND_DISK)
    intervals = shard_rows.select("shard", "gram", "need", "place").mapInArrow(_grams_first, _ddl(_INTERVAL))
    rounds: list[DataFrame] = []
    while True:
        here = _unsettled(intervals).groupBy("shard").agg(F.collect_list(F.struct("block", "lo", "hi")).alias("intervals"))
        out = save(held.join(here, "shard").mapInArrow(_round(len(rounds)), _ddl(_INTERVAL | _CELL)), "round")
        rounds.append(out.where("doc IS NOT NULL").select("block", *_CELL))
        intervals = out.where("doc IS NULL").select(*_INTERVAL)
        free_shuffles(spark)
        if intervals.isEmpty():
            break
    held.unpersist()
    return rounds


def _strings(length: int):
    """Every string of the given cells by itself."""
    digest64 = xxhash.xxh3_64_intdigest

    def run(batches):
        for batch in batches:
            cells = batch.column("cells")
            flat, many = cells.flatten(), cells.value_lengths().to_numpy()
            block, back, reach, at, alone = (flat.field(c).to_numpy(zero_copy_only=False)
                                             for c in ("block", "back", "reach", "at", "alone"))
            lo, hi = at - back, at - reach + 1
            digests: list[int] = []
            k = 0
            for text, n in zip(batch.column("text").to_pylist(), many.tolist(), strict=True):
                view = memoryview(text)
                for a, b in zip(lo[k:k + n].tolist(), hi[k:k + n].tolist(), strict=True):
                    digests += [digest64(view[i:i + length]) for i in range(a, b)]
                k += n
            start, cell = _ranges(lo, hi)
            with np.errstate(over="ignore"):  # the place in the block's strings is part of the name
                name = mix64(np.array(digests, np.uint64) + (at[cell] - start).astype(np.uint64)).view(np.int64)
            doc, doc2 = (np.repeat(batch.column(c).to_numpy(), many)[cell] for c in ("doc", "doc2"))
            yield _rows(_STRING, [(block[cell], name, alone[cell].astype(bool), doc, doc2, start)])
    return run


def _lone_rows(batches):
    """Strings without anchor, and (n null) starts known to repeat."""
    for batch in batches:
        out, sure = [], []
        for k in range(batch.num_rows):
            own, start, n, h1, h2, own2, start2, doc, doc2 = _unpacked(batch, k, *_LONE, "doc", "doc2")
            out.append((h1, h2, n, doc[own], doc2[own], start))
            sure.append((doc[own2], doc2[own2], start2))
        yield _rows(_LONE_ROW, out)
        found = [np.concatenate(x) for x in zip(*sure, strict=True)] if sure else [np.empty(0, np.int64)] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(found[0]), pa.int64())] * 3 + [pa.array(x, t) for x, t in zip(found, list(_LONE_ROW.values())[3:], strict=True)],
            names=list(_LONE_ROW))


def repeated_starts(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc, doc2, whole, border, lone): where strings start that also start elsewhere,
    one row a text of (doc, doc2, text) rows: packed ranges and single starts."""
    rows = shards(texts, length)
    with _few_rows_at_once(texts.sparkSession):
        rounds = merge(rows)
        cells = reduce(DataFrame.unionByName, rounds)
        lone = save(rows.select("doc", "doc2", *_LONE).mapInArrow(_lone_rows, _ddl(_LONE_ROW)), "lone")
    forget(rows)
    doc = ["doc", "doc2"]

    # cells of repeated intervals, compared in whole
    kind = ["block", "back", "reach", "hash"]
    kinds = save(cells.groupBy(*kind).agg(F.sum("copies").alias("n"), F.min(F.struct(*doc, "at")).alias("one")), "kinds")
    free_shuffles(texts.sparkSession)
    # equal texts, which are one suffix in a shard, hold every string of each other
    equal = texts.groupBy(*doc).agg(F.count("*").alias("n"), F.max(F.length("text")).alias("size")).where("n > 1")
    equal = equal.select(*doc, _packed(F.lit(0), F.col("size") - length).alias("range"))
    whole = cells.join(kinds.where("n > 1").select(*kind), kind).select(
        *doc, _packed(F.col("at") - F.col("back"), F.col("at") - F.col("reach")).alias("range"))
    whole = save(whole.unionByName(equal).groupBy(*doc).agg(F.collect_set("range").alias("whole")), "whole")
    for table in rounds:
        forget(table)
    free_shuffles(texts.sparkSession)

    # cells that are alone, string by string against one of each kind in the block
    several = kinds.groupBy("block").agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
    several = several.where("kinds > 1 and least = 1").select("block")
    ones = kinds.join(several, "block").groupBy("one.doc", "one.doc2").agg(F.collect_list(F.struct(
        "block", "back", "reach", F.col("one.at").alias("at"), (F.col("n") == 1).alias("alone"))).alias("cells"))
    strings = save(texts.join(ones, doc).mapInArrow(_strings(length), _ddl(_STRING)), "strings")
    free_shuffles(texts.sparkSession)
    again = strings.groupBy("block", "hash").agg(F.count("*").alias("n"), F.max("alone").alias("any"))
    again = again.where("n > 1 and any").select("block", "hash")
    border = save(strings.where("alone").join(again, ["block", "hash"]).groupBy(*doc).agg(
        F.collect_list("start").alias("border")), "border")
    forget(strings)
    free_shuffles(texts.sparkSession)

    # strings without an anchor
    some = lone.where("n IS NOT NULL")
    twice = some.groupBy("h1", "h2").agg(F.sum("n").alias("total")).where("total > 1").select("h1", "h2")
    rest = some.where("n = 1").join(twice, ["h1", "h2"]).unionByName(lone.where("n IS NULL"))
    rest = rest.groupBy(*doc).agg(F.collect_set("start").alias("lone"))
    return save(whole.join(border, doc, "full").join(rest, doc, "full"), "ranges")


def _packed(first: Column, last: Column) -> Column:
    """A range of starts as one number."""
    return F.shiftleft(first.cast("long"), 32).bitwiseOR(last.cast("long"))


def covered(first: np.ndarray, last: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs (start, end) of bytes covered by strings that start in the given ranges."""
    order = np.argsort(first)
    start, end = first[order], np.maximum.accumulate(last[order] + length) if len(first) else last
    new = np.append(True, start[1:] > end[:-1])[:len(start)]
    return start[new], end[np.append(new[1:], True)[:len(start)]]


def _cut(length: int, at: int):
    def run(batches):
        for batch in batches:
            texts = batch.column("_bytes").to_pylist()
            size = np.array([len(t) for t in texts], np.int64)
            base = np.cumsum(size + 1) - size  # all texts in a row, apart, so that runs end with their text
            first, last = [], []
            for name in ("whole", "border", "lone"):
                lists = batch.column(name)
                flat = lists.flatten().to_numpy().astype(np.int64)
                own = np.repeat(base, np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64))
                first.append(own + (flat >> 32 if name == "whole" else flat))
                last.append(own + (flat & 0xFFFFFFFF if name == "whole" else flat))
            start, end = covered(np.concatenate(first), np.concatenate(last), length)
            of = np.searchsorted(base, start, "right") - 1
            start, end = start - base[of], end - base[of]
            offsets = np.searchsorted(of, np.arange(len(texts) + 1))
            kept = []
            for k, text in enumerate(texts):
                a, b = offsets[k], offsets[k + 1]
                if a == b:
                    kept.append(text)
                    continue
                edges = [0, *np.column_stack([start[a:b], end[a:b]]).ravel().tolist(), len(text)]
                kept.append(b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)))
            runs = pa.StructArray.from_arrays([pa.array(start, pa.int32()), pa.array(end, pa.int32())], ["start", "end"])
            names = [f"_{i}" for i in range(at)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs),
                 pa.array(kept, pa.binary())], names=[*names, "_removed", "_kept"])
    return run


def cut_repeats(docs: DataFrame, length: int = LENGTH, names: tuple[str, str] = ("removed", "kept"),
                keep: Sequence[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all) with two added: the removed
    runs and the remaining bytes."""
    bounded_batches(docs.sparkSession)
    columns = docs.columns
    own = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(columns)])
    text = text_bytes(f"_{columns.index('text')}")
    ranges = repeated_starts(named_texts(own.select(text.alias("text")), length), length)
    free_shuffles(docs.sparkSession)
    wanted = [columns.index(c) for c in (columns if keep is None else keep)]
    a, b = text_names(text)
    joined = own.withColumns({"_bytes": text, "doc": a, "doc2": b}).join(ranges, ["doc", "doc2"], "left").select(
        *[F.col(f"_{i}").alias(f"_{k}") for k, i in enumerate(wanted)], "_bytes", "whole", "border", "lone")
    fields = [StructField(f"_{k}", docs.schema[i].dataType) for k, i in enumerate(wanted)]
    spans = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))
    out = joined.mapInArrow(_cut(length, len(wanted)), StructType(
        [*fields, StructField("_removed", spans), StructField("_kept", BinaryType())]))
    return out.toDF(*[columns[i] for i in wanted], *names)
