"""Line dedup: maximal repeated line runs by a distributed suffix array.

A text is a sequence of line ids (64-bit line hashes).  A run is a sequence of
consecutive lines of one document.  Wherever a run of at least ``min_words``
words also begins at an earlier place, the later copy's lines are deleted;
places are ordered by doc_id (null last), then text hash, then line number.

1. Lines that occur once break runs, so documents are reduced to segments of
   consecutive repeated lines; segments with too few words are dropped.  Equal
   segments form a class: all but the earliest are copies as a whole.
2. Over the earliest segments a suffix array is built by prefix doubling: the
   rank of a suffix by its first 2h lines follows from the ranks, by h lines,
   of itself and of the suffix h lines on.  Rows are (segment, line, rank);
   ranks are counts of smaller suffixes, summed per group over distinct pairs.
3. Suffixes that share their first two lines are neighbours in the array.
   Their longest common prefixes span the intervals; for each suffix the
   nearest neighbours with an earlier place, left and right, give the longest
   run that has an earlier copy.  Groups whose members all follow the same line
   are skipped, since their runs are parts of longer ones.  A single line of
   ``min_words`` words is compared by its id alone.

Defined results: null or empty text has one empty line, which is too short to
be deleted alone; the text stays as it is (null stays null).  Rows that repeat
both doc_id and text are one document and get the same text.  Of equal copies
the earliest stays whole.  Overlapping copies within one document count.
Empty tables give no rows.  Other columns are kept (``n_chars``, if there, is
brought up to date by ``filter_lines``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, free_shuffles, save, text_bytes

MIN_WORDS = 25
MAX_BROADCAST_DOCS = 500_000
BREAK = -1

_PLACE = ("place_id", "text_hash")


def _line_ids(batches):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        lines = [t.split(b"\n") for t in texts]
        ids = [np.fromiter(map(xxhash.xxh64_intdigest, x), np.uint64, len(x)).view(np.int64) for x in lines]
        counts = [np.fromiter((len(line.split()) for line in x), np.int32, len(x)) for x in lines]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(ids, pa.list_(pa.int64())),
             pa.array(counts, pa.list_(pa.int32()))], names=["doc_id", "text_hash", "ids", "counts"])


def line_table(docs: DataFrame) -> DataFrame:
    """(doc, place_id, text_hash, ids, counts): one row per document, ``doc`` unique."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        _line_ids, "doc_id long, text_hash long, ids array<long>, counts array<int>")
    return save(rows.dropDuplicates(["doc_id", "text_hash"]).select(
        F.monotonically_increasing_id().alias("doc"),
        F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("place_id"), "text_hash", "ids", "counts"), "lines")


def repeated_lines(lines: DataFrame) -> DataFrame:
    """(doc, place_id, text_hash, line, id, words) of lines that occur more than once."""
    rows = lines.select("doc", *_PLACE, F.posexplode(F.arrays_zip("ids", "counts")).alias("line", "l")).select(
        "doc", *_PLACE, "line", F.col("l.ids").alias("id"), F.col("l.counts").alias("words"))
    several = rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    return save(rows.join(several, "id"), "repeated")


def _islands(min_words: int):
    def run(batches):
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("doc", "place_id", "text_hash", "start", "ids", "counts", "k1", "k2")}
            for doc, place, text_hash, rows in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                line = np.array([r["line"] for r in rows])
                ids = np.array([r["id"] for r in rows], np.int64)
                counts = np.array([r["words"] for r in rows], np.int32)
                for at in np.split(np.arange(len(line)), np.flatnonzero(np.diff(line) != 1) + 1):
                    if counts[at].sum() < min_words:
                        continue
                    data = ids[at].tobytes()
                    for k, v in zip(out, (doc, place, text_hash, int(line[at[0]]), ids[at], counts[at],
                                          xxhash.xxh64_intdigest(data), xxhash.xxh64_intdigest(data, 1)), strict=True):
                        out[k].append(v)
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.list_(pa.int32())]
            arrays = [pa.array(v, t) for v, t in zip(out.values(), kinds, strict=False)]
            arrays += [pa.array(np.array(out[k], np.uint64).view(np.int64)) for k in ("k1", "k2")]
            yield pa.RecordBatch.from_arrays(arrays, names=list(out))
    return run


def segments(repeated: DataFrame, min_words: int) -> DataFrame:
    """Runs of consecutive repeated lines with at least ``min_words`` words."""
    by_doc = repeated.groupBy("doc", *_PLACE).agg(
        F.array_sort(F.collect_list(F.struct("line", "id", "words"))).alias("rows"))
    return save(by_doc.mapInArrow(_islands(min_words), (
        "doc long, place_id long, text_hash long, start long, ids array<long>, counts array<int>, k1 long, k2 long")),
        "segments")


def _first_ranks(rows: DataFrame) -> DataFrame:
    """Adds ``rank``: how many rows have a smaller id."""
    sizes = rows.groupBy("id").agg(F.count("*").alias("n")).withColumn("part", F.shiftright("id", 54))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))  # 1024 rows at most
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    ranks = sizes.join(F.broadcast(parts), "part").select(
        "id", (F.col("base") + F.coalesce(F.sum("n").over(within), F.lit(0))).alias("rank"))
    return rows.join(ranks, "id")


def suffix_ranks(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Prefix doubling over rows (doc, line, id): (doc, line, rank) by the first
    two lines, and by whole suffixes (up to the end of the segment)."""
    ranked = save(_first_ranks(rows).select("doc", "line", "rank"), "ranks")
    by_two, step = None, 1
    while True:
        ahead = ranked.select("doc", (F.col("line") - step).alias("line"), F.col("rank").alias("ahead"))
        pairs = ranked.join(ahead, ["doc", "line"], "left").withColumn("ahead", F.coalesce("ahead", F.lit(BREAK)))
        sizes = pairs.groupBy("rank", "ahead").agg(F.count("*").alias("n"))
        before = Window.partitionBy("rank").orderBy("ahead").rowsBetween(Window.unboundedPreceding, -1)
        moved = sizes.select("rank", "ahead", "n",
                             (F.col("rank") + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("next"))
        ranked = save(pairs.join(moved, ["rank", "ahead"]).select(
            "doc", "line", F.col("next").alias("rank"), (F.col("ahead") != BREAK).alias("whole"), "n"), "ranks")
        by_two = by_two or ranked.where("whole").select("doc", "line", "rank")
        open_ = ranked.where("whole and n > 1").limit(1).count()
        free_shuffles(rows.sparkSession)  # and the plans of the round, of which the driver's JVM holds all until then
        ranked = ranked.select("doc", "line", "rank")
        step *= 2
        if not open_:
            return by_two, ranked


def earlier_prefixes(places: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For rows in suffix order: the longest common prefix with any row of an
    earlier place.  ``places`` are distinct ordinals; ``common[i]`` is the
    common prefix of rows i - 1 and i."""
    best = np.zeros(len(places), np.int64)
    for forward in (True, False):
        stack: list[tuple[int, int]] = []  # (place, common prefix with the row above on the stack)
        order = range(len(places)) if forward else range(len(places) - 1, -1, -1)
        for i in order:
            edge = int(common[i]) if forward else (int(common[i + 1]) if i + 1 < len(places) else 0)
            if not stack:
                edge = 0
            while stack and stack[-1][0] > places[i]:
                edge = min(edge, stack.pop()[1])
            if stack:
                best[i] = max(best[i], edge)
            stack.append((int(places[i]), edge))
    return best


def _group_runs(places: np.ndarray, suffixes: list, counts: list, min_words: int) -> np.ndarray:
    """Lengths of the runs of one group, in suffix order, that have an earlier
    copy; 0 where that is a single line or too few words."""
    common = np.zeros(len(places), np.int64)
    for i in range(1, len(places)):
        n = min(len(suffixes[i - 1]), len(suffixes[i]))
        differ = suffixes[i - 1][:n] != suffixes[i][:n]
        at = int(differ.argmax()) if n else 0
        common[i] = at if n and differ[at] else n
    length = earlier_prefixes(places, common)
    enough = [n > 1 and int(c[:n].sum()) >= min_words for n, c in zip(length, counts, strict=True)]
    return np.where(enough, length, 0)


def _runs(min_words: int):
    """Over rows in order of (pair, rank, place): one group after another."""
    names = ["pair", "place_id", "text_hash", "doc", "line", "ids", "counts"]

    def finish(rows):
        place = np.array([(r[1], r[2], r[4]) for r in rows], np.int64)
        order = np.lexsort(place.T[::-1])
        places = np.empty(len(rows), np.int64)
        places[order] = np.arange(len(rows))
        length = _group_runs(places, [r[5] for r in rows], [r[6] for r in rows], min_words)
        return [(r[3], r[4], r[4] + int(n)) for r, n in zip(rows, length, strict=True) if n]

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            out: list[tuple] = []
            ids, counts = (batch.column(c) for c in ("ids", "counts"))
            flat, at = ids.flatten().to_numpy(), np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())])
            words = counts.flatten().to_numpy()
            plain = zip(*(batch.column(c).to_pylist() for c in names[:5]), strict=True)
            for i, row in enumerate(plain):
                if held and held[-1][0] != row[0]:
                    out += finish(held)
                    held = []
                part = slice(at[i], at[i + 1])
                held.append((*row, flat[part], words[part]))
            yield _ranges(out)
        if held:
            yield _ranges(finish(held))
    return run


def _ranges(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc", "line", "until"])


def later_copies(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, line, until): line ranges that are later copies of earlier runs."""
    repeated = repeated_lines(lines)
    place = F.struct(*_PLACE, F.col("line").cast("long").alias("line"), "doc")

    # single lines that are long enough
    long_lines = repeated.where(F.col("words") >= min_words)
    earliest = long_lines.groupBy("id").agg(F.min(place).alias("first"))
    single = long_lines.join(earliest, "id").where(place != F.col("first")).select(
        "doc", F.col("line").cast("long").alias("line"), (F.col("line") + 1).cast("long").alias("until"))

    # segments that are copies as a whole
    found = segments(repeated, min_words).withColumn("size", F.size("ids"))
    at = F.struct(*_PLACE, "start", "doc")
    classes = found.groupBy("k1", "k2", "size").agg(F.min(at).alias("first"))
    placed = found.join(classes, ["k1", "k2", "size"])
    whole = placed.where(at != F.col("first")).select(
        "doc", F.col("start").alias("line"), (F.col("start") + F.col("size")).alias("until"))
    kept = save(placed.where(at == F.col("first")).select("doc", *_PLACE, "start", "ids", "counts"), "earliest")

    # runs inside the earliest segments
    rows = kept.select("doc", "start", F.posexplode("ids").alias("at", "id"), "ids").select(
        "doc", "start", (F.col("start") + F.col("at")).alias("line"), "id",
        F.when(F.col("at") > 0, F.get("ids", F.col("at") - 1)).alias("before"))
    shared = rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    rows = save(rows.join(shared, "id"), "suffixes")  # other lines break runs
    by_two, by_all = suffix_ranks(rows.select("doc", "line", "id"))
    members = rows.select("doc", "start", "line", "before").join(
        by_two.withColumnRenamed("rank", "pair"), ["doc", "line"])
    diverse = members.groupBy("pair").agg(
        F.count("*").alias("n"), F.min("before").alias("lo"), F.max("before").alias("hi"),
        F.count(F.when(F.col("before").isNull(), 1)).alias("starts")).where(
        "n > 1 and (starts > 0 or lo <> hi)").select("pair")
    members = (members.join(diverse, "pair").join(by_all, ["doc", "line"])
               .join(kept, ["doc", "start"])
               .select("pair", "rank", "doc", *_PLACE, "line",
                       F.slice("ids", (F.col("line") - F.col("start") + 1).cast("int"), F.size("ids")).alias("ids"),
                       F.slice("counts", (F.col("line") - F.col("start") + 1).cast("int"), F.size("ids")).alias("counts")))
    ordered = members.repartition("pair").sortWithinPartitions("pair", "rank", *_PLACE, "line")
    inner = ordered.mapInArrow(_runs(min_words), "doc long, line long, until long")
    return single.unionByName(whole).unionByName(inner)


def kept_lines(docs: DataFrame, min_words: int = MIN_WORDS, name: str = "kept") -> DataFrame:
    """``docs`` with a column ``name`` added: the remaining lines, null where
    nothing was deleted."""
    free_shuffles(docs.sparkSession)  # what came before, such as broadcasts
    lines = line_table(docs)
    gone = later_copies(lines, min_words).groupBy("doc", "until").agg(F.min("line").alias("line"))
    gone = gone.groupBy("doc").agg(F.collect_set(F.struct("line", "until")).alias("gone"))
    gone = save(gone.join(lines.select("doc", *_PLACE), "doc").drop("doc"), "gone")
    gone = F.broadcast(gone) if gone.count() <= MAX_BROADCAST_DOCS else gone  # size checked
    names = docs.columns
    own = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(names)],
                      F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("place_id"),
                      F.xxhash64(text_bytes()).alias("text_hash"))
    text = F.col(f"_{names.index('text')}")
    rest = F.filter(F.split(text, "\n", -1), lambda x, i: ~F.exists(
        "gone", lambda g: (g["line"] <= i) & (i < g["until"])))
    own = own.join(gone, list(_PLACE), "left").withColumn("_rest", F.when(F.col("gone").isNotNull(), rest))
    return own.select(*[f"_{i}" for i in range(len(names))], "_rest").toDF(*names, name)


def filter_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without later copies; all rows and columns stay."""
    name = "kept"
    while name in (c.lower() for c in docs.columns):
        name += "_"
    text = F.coalesce(F.array_join(name, "\n"), F.col("text"))
    out = kept_lines(docs, min_words, name).withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
