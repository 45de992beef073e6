"""Near-duplicate groups by HyperMinHash, confirmed on full shingle sets.

1. A document's set is its distinct word shingles (64-bit hashes).  Documents
   with equal sets form a class (128-bit set digest); its smallest doc_id
   represents it.
2. Each representative gets ``BANDS`` HyperMinHash sketches of ``WIDTH``
   buckets.  A bucket's register holds the leading-zero count and 10 mantissa
   bits of its smallest hash.  A band is the compressed registers of one
   sketch; representatives that agree on a band share a bucket of candidates.
3. Candidates are filtered by the Jaccard estimate over all registers, with
   the expected register collisions taken off, and the rest is confirmed
   exactly on the full sets.
4. First every member of a bucket is compared with the bucket's smallest
   member, and components are formed.  Then, since two members may be linked
   without being linked to that one, all pairs of a bucket that still lie in
   different components are compared as well: small buckets pair by pair,
   large ones in blocks of ``BLOCK`` members, where a block cell computes all
   its intersections at once and returns only links that join components.
   Members of one component are never compared again, so groups of copies
   cost a linear number of comparisons.

Two sets with a similarity of 0.8 share no band with a probability of
(1 - 0.8^5)^40, about 1e-7.

Defined results: null or empty text, or text without words, has the empty set
and is linked with nothing; fewer words than a shingle count as one shingle.
Rows with a null doc_id are their own group (component_id null, kept).  Rows
that repeat a doc_id are one document with several texts.  Ties have no
effect: the smallest doc_id names a group.  Empty tables give empty results.
Other columns are ignored by ``groups`` and kept by ``filter_duplicates``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, free_shuffles, mix64, save, shingle_hashes, text_bytes, word_hashes, words
from .components import connected_components

BANDS, WIDTH, MANTISSA = 40, 5, 10
REGISTERS = BANDS * WIDTH
EMPTY = np.uint16(0xFFFF)
MARGIN = 0.15       # five standard deviations of the estimate at 0.8
SMALL_BUCKET = 32   # up to here pairs are listed, beyond that compared in blocks
BLOCK = 256
MAX_BROADCAST_IDS = 1_000_000

_SALTS = mix64(np.arange(1, BANDS + 1, dtype=np.uint64))
_ODD = mix64(_SALTS) | np.uint64(1)
_STEP = np.uint64((1 << 64) // WIDTH)
_EXPECTED_COLLISIONS = 0.169919487159739 / 2 ** MANTISSA


def shingles(text: bytes, size: int) -> np.ndarray:
    return shingle_hashes(word_hashes(words(text)), size)


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """uint16 registers [document, BANDS * WIDTH] of non-empty sets."""
    low = np.empty((len(sets), BANDS, WIDTH), np.uint64)
    with np.errstate(over="ignore"):
        for i, s in enumerate(sets):
            hashed = (s[None, :] ^ _SALTS[:, None]) * _ODD[:, None]
            for b in range(WIDTH):  # distance of the first hash past the bucket's lower end
                low[i, :, b] = (hashed - np.uint64(b) * _STEP).min(axis=1)
    mantissa, exponent = np.frexp(low.astype(np.float64) + 1.0)
    zeros = 64 - np.minimum(exponent, 64)
    bits = ((mantissa - 0.5) * (1 << (MANTISSA + 1))).astype(np.int64)
    registers = ((np.minimum(zeros, 62) << MANTISSA) | np.minimum(bits, (1 << MANTISSA) - 1)).astype(np.uint16)
    registers[low >= _STEP] = EMPTY
    return registers.reshape(len(sets), REGISTERS)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key per band (compressed registers and the band's number)."""
    r = registers.reshape(-1, BANDS, WIDTH).astype(np.uint64)
    key = np.broadcast_to(_SALTS, r.shape[:2]).copy()
    with np.errstate(over="ignore"):
        for b in range(WIDTH):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + r[:, :, b])
    return key


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimates of register rows (broadcasting)."""
    used = ((a != EMPTY) | (b != EMPTY)).sum(axis=-1)
    equal = ((a == b) & (a != EMPTY)).sum(axis=-1) / np.maximum(used, 1)
    return (equal - _EXPECTED_COLLISIONS) / (1 - _EXPECTED_COLLISIONS)


def linked(both: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * both >= percent * (a + b - both)


def _sketches(size: int):
    def run(batches):
        for batch in batches:
            sets = [shingles(t, size) for t in batch.column("text").to_pylist()]
            n = np.array([len(s) for s in sets], np.int64)
            with np.errstate(over="ignore"):
                digest = np.array([(mix64(s).sum(), mix64(s ^ np.uint64(0x5851F42D4C957F2D)).sum()) if len(s) else (0, 0)
                                   for s in sets], np.uint64).reshape(-1, 2).view(np.int64)
            full = np.flatnonzero(n)
            registers = sketch([sets[i] for i in full])
            packed: list = [None] * len(sets)
            for i, row in zip(full, registers, strict=True):
                packed[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(digest[:, 0]), pa.array(digest[:, 1]),
                 pa.array(packed, pa.binary())], names=["doc_id", "n", "k1", "k2", "registers"])
    return run


def _bands(batches):
    for batch in batches:
        rows = batch.column("registers").to_pylist()
        keys = band_keys(np.frombuffer(b"".join(rows), np.uint16)).reshape(-1).view(np.int64)
        ids = np.repeat(batch.column("rep").to_numpy(zero_copy_only=False), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids)], names=["key", "rep"])


class _Search:
    """Sketches, candidates and exact checks over one table of documents."""

    def __init__(self, docs: DataFrame, size: int, percent: int):
        bounded_batches(docs.sparkSession)
        self.size, self.percent = size, percent
        self.texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
        self.sketches = save(self.texts.mapInArrow(
            _sketches(size), "doc_id long, n long, k1 long, k2 long, registers binary"), "sketches")
        used = self.sketches.where("doc_id is not null and n > 0")
        self.classes = save(used.groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("rep")), "classes")
        self.reps = used.withColumnRenamed("doc_id", "rep").join(self.classes, ["k1", "k2", "n", "rep"]).select(
            "rep", "n", "registers").dropDuplicates(["rep", "n", "registers"])

    def buckets(self) -> DataFrame:
        """(key, rep, center, members) of every bucket with several members."""
        rows = self.reps.select("rep", "registers").mapInArrow(_bands, "key long, rep long")
        several = (rows.groupBy("key").agg(F.min("rep").alias("center"), F.max("rep").alias("last"),
                                           F.count("*").alias("members"))
                   .where("center <> last").drop("last"))
        return save(rows.join(several, "key"), "buckets")

    def sets(self, ids: DataFrame) -> DataFrame:
        """(rep, set) of the texts with those ids, read and shingled again."""
        ids = save(ids.distinct(), "ids")
        own = F.broadcast(ids) if ids.count() <= MAX_BROADCAST_IDS else ids  # size checked
        size = self.size

        def run(batches):
            for batch in batches:
                out = [shingles(t, size).view(np.int64) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.list_(pa.int64()))],
                                                 names=["rep", "set"])

        chosen = self.texts.join(own.withColumnRenamed("rep", "doc_id"), "doc_id", "left_semi").where("doc_id is not null")
        return chosen.mapInArrow(run, "rep long, set array<long>").where(F.size("set") > 0)

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """The candidate pairs (a, b) whose full sets reach the similarity."""
        least, percent = self.percent / 100 - MARGIN, self.percent
        own = self.reps.select("rep", "n", "registers")
        both = (pairs.join(own.toDF("a", "na", "ra"), "a").join(own.toDF("b", "nb", "rb"), "b")
                .where((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))))

        def likely(batches):
            for batch in batches:
                ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                          for c in ("ra", "rb"))
                keep = pa.array(estimate(ra, rb) >= least)
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])

        near = save(both.select("a", "b", "ra", "rb").mapInArrow(likely, "a long, b long").distinct(), "near")
        sets = save(self.sets(near.select(F.col("a").alias("rep")).unionByName(near.select(F.col("b").alias("rep")))), "sets")
        common = F.size(F.array_intersect("sa", "sb"))
        return (near.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
                .select("a", "b", common.alias("both"), F.size("sa").alias("na"), F.size("sb").alias("nb"))
                .where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both")))
                .select("a", "b").distinct())

    def links(self) -> DataFrame:
        buckets = self.buckets()
        first = save(self.confirm(buckets.where("rep <> center").select(
            F.col("rep").alias("a"), F.col("center").alias("b")).distinct()), "links")
        parts = connected_components(first).withColumnRenamed("node", "rep")
        placed = buckets.where("members > 2").join(parts, "rep", "left").withColumn(
            "component", F.coalesce("component", "rep"))
        open_keys = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where(
            "lo <> hi").select("key")
        rest = save(placed.join(open_keys, "key"), "open")
        small = rest.where(F.col("members") <= SMALL_BUCKET).select("key", "rep", "center", "component")
        other = small.select("key", F.col("rep").alias("b"), F.col("component").alias("cb"))
        pairs = (small.where("rep <> center").join(other, "key")
                 .where("rep > b and component <> cb and b <> center")
                 .select(F.col("rep").alias("a"), "b").distinct())
        more = self.confirm(pairs)
        large = self.blocks(rest.where(F.col("members") > SMALL_BUCKET), parts)
        return first.unionByName(more).unionByName(large)

    def blocks(self, rest: DataFrame, parts: DataFrame) -> DataFrame:
        """Links between components inside large buckets.  Buckets whose centers
        lie in one component are taken together; pairs inside it are skipped."""
        center = parts.select(F.col("rep").alias("center"), F.col("component").alias("cluster"))
        rows = (rest.join(center, "center", "left")
                .select(F.coalesce("cluster", "center").alias("cluster"), "rep", "component").distinct()
                .withColumn("outside", F.col("component") != F.col("cluster")))
        rows = save(rows, "clusters")
        sizes = rows.groupBy("cluster").agg(
            F.ceil(F.count(F.when(~F.col("outside"), 1)) / BLOCK).cast("int").alias("inner"),
            F.ceil(F.count(F.when(F.col("outside"), 1)) / BLOCK).cast("int").alias("outer")).where("outer > 0")
        rows = rows.join(sizes, "cluster")
        place = F.when(F.col("outside"), F.pmod(F.xxhash64("rep"), F.col("outer"))).otherwise(
            F.col("outer") + F.pmod(F.xxhash64("rep"), F.greatest("inner", F.lit(1)))).cast("int")
        rows = rows.withColumn("block", place)
        outer = F.sequence(F.lit(0), F.col("outer") - 1)
        everywhere = F.sequence(F.lit(0), F.col("outer") + F.col("inner") - 1)
        cells = F.when(F.col("outside"), F.transform(everywhere, lambda j: F.struct(
            F.least(j, F.col("block")).alias("i"), F.greatest(j, F.col("block")).alias("j")))).otherwise(
            F.transform(outer, lambda i: F.struct(i.alias("i"), F.col("block").alias("j"))))
        dealt = rows.select("cluster", "rep", "component", F.explode(cells).alias("cell"))
        own = self.sets(rows.select("rep"))
        percent = self.percent

        def cell(pdf):
            import pandas as pd
            found = block_links(pdf["rep"].tolist(), pdf["component"].tolist(), list(pdf["set"]), percent)
            return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

        return (dealt.join(own, "rep").groupBy("cluster", "cell").applyInPandas(cell, "a long, b long").distinct())


def block_links(reps: list, component: list, sets: list, percent: int, width: int = 8192) -> list:
    """Links between different components of one cell (a spanning choice)."""
    lengths = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), lengths)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(count > 1) - 1
    keep = count[column] > 1
    owner, column = owner[keep], shared[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, (start, start + width))
        m = np.zeros((len(sets), width), np.float32)
        m[owner[lo:hi], column[lo:hi] - start] = 1
        both += m @ m.T
    hits = np.argwhere(np.triu(linked(both.astype(np.int64), lengths[:, None], lengths[None, :], percent), 1))
    root = {c: c for c in component}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in hits:
        a, b = find(component[i]), find(component[j])
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((reps[i], reps[j]))
    return out


def groups(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``."""
    free_shuffles(docs.sparkSession)  # what came before
    search = _Search(docs, shingle_words, percent)
    parts = connected_components(search.links()).withColumnRenamed("node", "rep")
    named = search.classes.join(parts, "rep", "left").select(
        "k1", "k2", "n", F.coalesce("component", "rep").alias("component_id"))
    rows = search.sketches.select("doc_id", "n", "k1", "k2")
    full = rows.where("doc_id is not null and n > 0").join(named, ["k1", "k2", "n"])
    alone = rows.where("doc_id is null or n = 0").withColumn("component_id", F.col("doc_id"))
    return (full.select("doc_id", "n", "component_id").unionByName(alone.select("doc_id", "n", "component_id"))
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def filter_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id."""
    dropped = save(groups(docs, shingle_words, percent).where(~F.col("kept")).select("doc_id").distinct(), "dropped")
    out = F.broadcast(dropped) if dropped.count() <= MAX_BROADCAST_IDS else dropped  # size checked
    return docs.join(out, docs["doc_id"].cast("long") == out["doc_id"], "left_anti")
