"""Benchmark decontamination by SimHash over item-sized windows.

Texts are lower-cased (A-Z) word sequences.  A shingle is ``SHINGLE`` words (a
shorter item is one shingle) and weighs as many bytes as its words have, so
that runs of short common words count little.  For every benchmark item the
windows of as many words as the item are compared with it:

1. Only windows that share a shingle with some item can be similar at all, so
   the windows around such shingles are the ones that are fingerprinted.
2. A window's fingerprint is a 64-bit SimHash of its weighted shingles.
   Fingerprints are cut into ``RADIUS + 1`` blocks; by the pigeonhole principle
   every item fingerprint within ``RADIUS`` bits agrees on a whole block, so the
   block tables give all of them; the distance is then checked.  ``RADIUS`` lies
   five standard deviations above the distance expected at similarity 0.8.
3. Candidates are verified by the exact weighted Jaccard similarity of the
   shingle sets; ``similarity`` or more is a match.

Items are collected in chunks of at most ``MAX_CHUNK_BYTES`` of text, one pass
over the documents each, so what is sent to the executors is bounded.

Defined results: null or empty texts, and documents with fewer words than a
shingle, match nothing unless an item has as few words; a document shorter
than an item is compared as one window.  Items without words and null items
are ignored; repeated items count once per item_id.  Of several windows the
first one in order of distance, then place, that reaches the similarity is
reported.  Repeated rows and null ids are treated as any other row.  Other
columns are ignored by ``matches`` and kept by ``filter_contaminated``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, mix64, text_bytes, word_hashes, words

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 24
MAX_CHUNK_BYTES = 16_000_000
_BITS = np.arange(64, dtype=np.uint64)
_EDGES = [64 * b // (RADIUS + 1) for b in range(RADIUS + 2)]


def sequence(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width``-word shingle at every place."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        acc = np.full(n, np.uint64(width), np.uint64)
        for k in range(width):
            acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + hashes[k:n + k])
    return acc


def weights(tokens: list[bytes], width: int) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
    return (total[width:] - total[:-width]).astype(np.int64)


def fingerprints(shingles: np.ndarray, weight: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the ``size`` shingles from each start."""
    signed = np.where((shingles[:, None] >> _BITS) & np.uint64(1), weight[:, None], -weight[:, None])
    total = np.concatenate([np.zeros((1, 64), np.int64), np.cumsum(signed, axis=0)])
    votes = total[starts + size] - total[starts]
    return ((votes > 0).astype(np.uint64) << _BITS).sum(axis=1, dtype=np.uint64)


def blocks(prints: np.ndarray) -> np.ndarray:
    """[fingerprint, block] values."""
    return np.stack([(prints >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)
                     for a, b in zip(_EDGES, _EDGES[1:])], axis=1).astype(np.int64)


class Items:
    """Items of one length: shingle weights, fingerprints and block tables."""

    def __init__(self, length: int, rows: list[tuple]):
        self.length, self.width = length, min(SHINGLE, length)
        self.ids = [r[0] for r in rows]
        self.weights = []
        prints = []
        for _, tokens in rows:
            shingles, weight = sequence(word_hashes(tokens), self.width), weights(tokens, self.width)
            self.weights.append(dict(zip(shingles.tolist(), weight.tolist(), strict=True)))
            prints.append(fingerprints(shingles, weight, np.array([0]), len(shingles))[0])
        self.prints = np.array(prints, np.uint64)
        cut = blocks(self.prints)
        longest = max(b - a for a, b in zip(_EDGES, _EDGES[1:]))
        self.tables = np.zeros((RADIUS + 1, 1 << longest, len(rows)), bool)
        for b in range(RADIUS + 1):
            self.tables[b, cut[:, b], np.arange(len(rows))] = True

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of all pairs within RADIUS, nearest first."""
        cut = blocks(prints)
        found = np.zeros((len(prints), len(self.ids)), bool)
        for b in range(RADIUS + 1):
            found |= self.tables[b, cut[:, b]]
        window, item = np.nonzero(found)
        distance = np.bitwise_count(prints[window] ^ self.prints[item]).astype(np.int64)
        keep = distance <= RADIUS
        window, item, distance = window[keep], item[keep], distance[keep]
        order = np.lexsort((window, distance))
        return window[order], item[order], distance[order]

    def similarity(self, window: dict, item: int) -> float:
        own = self.weights[item]
        both = sum(w for s, w in window.items() if s in own)
        return both / (sum(window.values()) + sum(own.values()) - both)


class Benchmark:
    """All items of a chunk, by length, with the set of their shingles."""

    def __init__(self, rows: list[tuple], similarity: float = SIMILARITY):
        by_length: dict[int, list] = {}
        for item, text in rows:
            tokens = words(text)
            if tokens:
                by_length.setdefault(len(tokens), []).append((item, tokens))
        self.similarity = similarity
        self.by_length = {n: Items(n, rows) for n, rows in sorted(by_length.items())}
        self.known: dict[int, np.ndarray] = {}
        self.lengths: dict[int, dict[int, list[int]]] = {}
        for items in self.by_length.values():
            owners = self.lengths.setdefault(items.width, {})
            for shingles in items.weights:
                for s in shingles:
                    if items.length not in owners.setdefault(s, []):
                        owners[s].append(items.length)
        for width, owners in self.lengths.items():
            self.known[width] = np.array(sorted(owners), np.uint64)

    def find(self, text: bytes) -> Iterator[tuple]:
        """(item_id, start, words, distance, similarity) of one text."""
        tokens = words(text)
        hashes = word_hashes(tokens)
        for width, known in self.known.items():
            shingles = sequence(hashes, width)
            if not len(shingles):
                continue
            at = np.searchsorted(known, shingles)
            at[at == len(known)] = 0
            hits = np.flatnonzero(known[at] == shingles)
            if len(hits):
                yield from self._around(tokens, shingles, hits, width)

    def _around(self, tokens, shingles, hits, width):
        weight = weights(tokens, width)
        places: dict[int, list[int]] = {}
        for p in hits.tolist():
            for length in self.lengths[width][int(shingles[p])]:
                places.setdefault(length, []).append(p)
        for length, where in sorted(places.items()):
            items = self.by_length[length]
            size = min(length - width + 1, len(shingles))
            last = len(shingles) - size
            starts = np.unique(np.concatenate(
                [np.arange(max(0, min(p - size + 1, last)), min(p, last) + 1) for p in where]))
            found: set = set()
            for part in np.split(starts, np.flatnonzero(np.diff(starts) > size) + 1):
                base, end = int(part[0]), int(part[-1]) + size
                prints = fingerprints(shingles[base:end], weight[base:end], part - base, size)
                for window, item, distance in zip(*map(np.ndarray.tolist, items.near(prints)), strict=True):
                    if item in found:
                        continue
                    start = int(part[window])
                    own = dict(zip(shingles[start:start + size].tolist(), weight[start:start + size].tolist(), strict=True))
                    similarity = items.similarity(own, item)
                    if similarity >= self.similarity:
                        found.add(item)
                        yield items.ids[item], start, min(length, len(tokens)), distance, similarity


def chunks(items: DataFrame, similarity: float) -> Iterator[Benchmark]:
    """The benchmark in parts of bounded size."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), text_bytes().alias("text")).where(
        "length(text) > 0").distinct()
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(2 * size / MAX_CHUNK_BYTES))
    for k in range(n if size else 0):
        part = rows.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k).collect()
        yield Benchmark(sorted(((r["item_id"], bytes(r["text"])) for r in part), key=lambda r: (r[0] is None, r)),
                        similarity)


MATCHES = "doc_id long, item_id long, start_word long, n_words long, distance int, similarity double"


def matches(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document and benchmark item that it contains."""
    spark = docs.sparkSession
    bounded_batches(spark)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    out = spark.createDataFrame([], MATCHES)
    for benchmark in chunks(items, similarity):
        out = out.unionByName(own.mapInArrow(_finder(spark.sparkContext.broadcast(benchmark)), MATCHES))
    return out


def _finder(shared):
    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                out += [(doc, *hit) for hit in shared.value.find(text)]
            columns = list(zip(*out)) if out else [()] * 6
            kinds = [pa.int64()] * 4 + [pa.int32(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["doc_id", "item_id", "start_word", "n_words", "distance", "similarity"])
    return run


def filter_contaminated(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without the documents that contain a benchmark item."""
    bounded_batches(docs.sparkSession)
    at = docs.columns.index("text")
    for benchmark in chunks(items, similarity):
        docs = docs.mapInArrow(_keeper(docs.sparkSession.sparkContext.broadcast(benchmark), at), docs.schema)
    return docs


def _keeper(shared, at):
    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            clean = [t is None or next(shared.value.find(t.encode("utf-8", "surrogatepass")), None) is None for t in texts]
            yield batch.filter(pa.array(clean, pa.bool_()))
    return run
