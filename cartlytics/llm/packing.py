"""Sequence packing by best-fit decreasing over a segment tree.

Documents are tokenized and closed with an end id.  A document longer than a
window is first cut into full windows, each a sequence of its own; the tail
that remains (or the whole short document) is one item.  Items are dealt at
random into groups of about ``GROUP_ITEMS`` items, and each group is packed
longest first: a segment tree over remaining capacity finds the tightest open
window that still takes the item, otherwise a window opens.

Cut points depend on a document alone, so token ids never have to be
shuffled: checksums (or the ids, where wanted) are made where the text is read
and only pieces travel.

Tokenizing goes word by word: the vocabulary's pieces never cross white
space, so the ids of a text are those of its white-space-separated parts in
order, and a bounded table per worker remembers the ids of parts seen.

Defined results: null or empty text is the end id alone.  A null doc_id stays
null; rows that repeat are documents of their own.  Ties between items of
equal length are ordered by their random key, then doc_id and checksum.  An
empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import math
import os
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, text_bytes

WINDOW = 2048
END_ID = 1
GROUP_ITEMS = 20_000
REMEMBERED = 250_000      # parts a worker keeps, each at most LONGEST_PART bytes
LONGEST_PART = 48
TOGETHER = 64             # parts tokenized in one call
_MARK = "\x01"
_BETWEEN = f" {_MARK} ".encode()


#: Latin letters, then ASCII marks: the marks are a piece of their own.
_WORD = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-/:-@\[-`{-~]*)").fullmatch

_USUAL = frozenset((b",", b".", b"!", b"?", b";", b":"))


def _byte_alphabet() -> dict[int, str]:
    """Byte-level BPE spells a byte by its own character if that is printable,
    else by the next free character from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, free = {}, 256
    for byte in range(256):
        out[byte] = chr(byte) if byte in printable else chr(free)
        free += byte not in printable
    return out


class WordTokenizer:
    """Ids (little-endian uint32 bytes) of texts, part by part."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.alphabet = _byte_alphabet()
        self.packed = [np.uint32(i).tobytes() for i in range(self.tokenizer.get_vocab_size())]
        mark = self._whole(_MARK)
        self.mark = int(mark[0]) if len(mark) == 1 else None
        self.known: dict[bytes, bytes] = {}
        self.plain = self._whole("Déjà vu").tobytes() == self._letters("Déjà".encode()) + self._letters(b"vu")

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _letters(self, word: bytes) -> bytes:
        """Ids of one run of Latin letters, straight from the merges."""
        if word.isascii():
            spelled = word.lower().decode()
        else:
            spelled = word.decode().lower().encode().decode("latin-1").translate(self.alphabet)
        packed = self.packed
        return b"".join([packed[t.id] for t in self.model.tokenize(spelled)])

    def learn(self, parts: list[bytes]) -> None:
        """Tokenize unknown parts: letters and marks by themselves, the others
        many in one call, told apart by a mark of its own."""
        known, others = self.known, []
        for p in parts:
            if not self.plain:
                others.append(p)
                continue
            if p.isalpha():  # the usual cases, without a search
                word, marks = p, b""
            elif p[:-1].isalpha() and p[-1:] in _USUAL:
                word, marks = p[:-1], p[-1:]
            elif found := _WORD(p):
                word, marks = found.groups()
            else:
                others.append(p)
                continue
            ids = known.get(word) or self._letters(word)
            if marks:
                known[word] = ids
                if marks not in known:
                    known[marks] = self._whole(marks.decode()).tobytes()
                known[p] = ids + known[marks]
            else:
                known[p] = ids
        marked = {p for p in others if b"\x01" in p} if self.mark is not None else set(others)
        plain = [p for p in others if p not in marked]
        for start in range(0, len(plain), TOGETHER):
            some = plain[start:start + TOGETHER]
            ids = self._whole(_BETWEEN.join(some).decode("utf-8", "replace"))
            cuts = np.flatnonzero(ids == self.mark).tolist()
            if len(cuts) == len(some) - 1:  # else a part holds the mark's own id
                data = ids.tobytes()
                known.update(zip(some, [data[4 * a:4 * b] for a, b in
                                        zip([0, *[c + 1 for c in cuts]], [*cuts, len(ids)], strict=True)], strict=True))
        for p in others:
            if p not in known:
                known[p] = self._whole(p.decode("utf-8", "replace")).tobytes()

    def batch(self, texts: list[bytes]) -> list[bytes]:
        split = [(t.lower() if t.isascii() else t).split() for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        special = [b"<|" in t for t in texts]  # may hold an added token's string
        new = set().union(*(s for s, odd in zip(split, special, strict=True) if not odd)).difference(self.known)
        self.learn(list(new))
        get = self.known.__getitem__
        out = [self._whole(t.decode("utf-8", "replace")).tobytes() if odd else b"".join(map(get, s))
               for t, s, odd in zip(texts, split, special, strict=True)]
        for p in new:  # long parts and what came with them are not kept
            if len(p) > LONGEST_PART:
                found = _WORD(p)
                self.known.pop(p, None)
                self.known.pop(found[1] if found else p, None)
        return out


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def pieces(docs: DataFrame, path: str, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]) of every document's
    pieces: full windows and one tail."""
    bounded_batches(docs.sparkSession)
    end = np.array([END_ID], np.uint32).tobytes()

    def run(batches):
        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            for at in range(0, len(texts), 512):
                out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids")}
                for doc, data in zip(ids[at:at + 512], tokenizer(path).batch(texts[at:at + 512]), strict=True):
                    data += end
                    for start in range(0, len(data), 4 * window):
                        part = data[start:start + 4 * window]
                        out["doc_id"].append(doc)
                        out["start"].append(start // 4)
                        out["length"].append(len(part) // 4)
                        out["ids_crc32"].append(zlib.crc32(part))
                        out["doc_tokens"].append(len(data) // 4)
                        out["ids"].append(np.frombuffer(part, np.uint32).astype(np.int32) if with_ids else None)
                names = list(out) if with_ids else list(out)[:5]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[k], pa.list_(pa.int32()) if k == "ids" else pa.int64()) for k in names], names=names)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
            .mapInArrow(run, schema + (", ids array<int>" if with_ids else "")))


class OpenWindows:
    """Segment tree over remaining capacity: is any open window left with it?"""

    def __init__(self, window: int):
        self.size = 1 << max(1, window).bit_length()
        self.count = [0] * (2 * self.size)
        self.at: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, capacity: int, number: int) -> None:
        self.at[capacity].append(number)
        i = capacity + self.size
        while i:
            self.count[i] += 1
            i >>= 1

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Takes the window with the least capacity of at least ``need``."""
        i = need + self.size
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        capacity = i - self.size
        number = self.at[capacity].pop()
        while i:
            self.count[i] -= 1
            i >>= 1
        return capacity, number


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window number and offset of each item; ``lengths`` in any order."""
    tree, opened = OpenWindows(window), 0
    where, offset = [0] * len(lengths), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.tightest(lengths[i])
        capacity, number = found if found else (window, opened)
        opened += found is None
        where[i], offset[i] = number, window - capacity
        if capacity > lengths[i]:
            tree.add(capacity - lengths[i], number)
    return where, offset


def pack(cut: DataFrame, n_items: int, window: int = WINDOW) -> DataFrame:
    """Adds sequence_id and offset to ``pieces``; ``n_items`` documents or so."""
    n_groups = max(1, math.ceil(n_items / GROUP_ITEMS))
    key = F.xxhash64("doc_id", "ids_crc32", "doc_tokens", "start")
    dealt = cut.withColumn("_key", key).withColumn("_group", F.pmod(F.col("_key"), F.lit(n_groups)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        group = int(pdf["_group"].iloc[0])
        pdf = pdf.sort_values(["_key", "doc_id", "ids_crc32"], kind="stable")
        where, offset = best_fit_decreasing(pdf["length"].tolist(), window)
        pdf["sequence_id"] = (np.array(where, np.int64) * n_groups) + group
        pdf["offset"] = np.array(offset, np.int64)
        return pdf.drop(columns=["_key", "_group"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return dealt.groupBy("_group").applyInPandas(run, schema + ", sequence_id long, offset long")
