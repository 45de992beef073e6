"""Spelling variants: words one edit apart, by pivotal bigrams.

Words are maximal runs of Latin letters, lower-cased in A-Z only.  As a planted
error, a run of a document loses one letter where a checksum of document id and
run says so.  Counts are summed in the tasks that read the texts, so only
distinct words travel.

1. Bigrams are numbered by how many words hold them, rare ones first.  The
   alphabet bounds the table (``LETTERS`` squared), so it goes to every task.
2. The prefix of a word is its three rarest bigrams, with all that tie with the
   third.  Two bigrams of it that share no letter are its pivots: dynamic
   programming over places finds the pair with the least total number of words.
3. One edit breaks at most two overlapping bigrams, hence one pivot at most.
   Of two words one edit apart let the first be the one whose prefix ends no
   later in the order: a pivot of it stands in the prefix of the other, at the
   same place or the next, as the lengths say.  Pivots are joined with prefixes
   on bigram, place and length.
4. Candidates are verified in the join: one edit changes two letters of a word's
   set at most, which a few bits tell before the edit distance is worked out.

A word's form is the near word that occurs most, if that is ``factor`` times as
often as the word itself; ties go to the smaller in code-point order.  The root
follows forms to the last; rounds of pointer doubling find it, few since every
step multiplies the count.

Defined results: null and empty texts have no words; repeated rows count again;
rows with a null id lose no letter.  Words are compared however long they are.
Empty tables give no rows.  Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, save, text_bytes

RUN = re.compile("[a-zÀ-ÿ]+")
LETTERS = 26 + 64
ERROR_EVERY = 31
MIN_LENGTH, MIN_COUNT, FACTOR = 7, 2, 10
HELD_WORDS = 200_000


def _counts(min_length: int, error_every: int):
    def run(batches):
        total: Counter[str] = Counter()

        def rows():
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                             names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = Counter(RUN.findall(text.lower().decode("utf-8", "replace")))
                start = None if doc is None else zlib.crc32(f"{doc}:".encode())
                for word, n in found.items():
                    if len(word) < min_length:
                        continue
                    if start is not None and (h := zlib.crc32(word.encode(), start)) % error_every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < min_length:
                            continue
                    total[word] += n
            if len(total) >= HELD_WORDS:
                yield rows()
        if total:
            yield rows()
    return run


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                error_every: int = ERROR_EVERY) -> DataFrame:
    """(word, n): words of ``min_length`` letters or more that occur ``min_count`` times or more."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_bytes().alias("text"))
    counted = rows.mapInArrow(_counts(min_length, error_every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def bigram_order(words: DataFrame) -> dict[str, tuple[int, int]]:
    """{bigram: (number, words)}, rare ones first; no larger than the alphabet squared."""
    grams = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.col("word").substr(i, F.lit(2)))
    sizes = words.select(F.explode(F.array_distinct(grams)).alias("gram")).groupBy("gram").count()
    rows = sizes.orderBy("count", "gram").limit(LETTERS ** 2).collect()
    return {r.gram: (k, r["count"]) for k, r in enumerate(rows)}


def prefix_and_pivots(word: str, order: dict[str, tuple[int, int]]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Prefix and two pivots of a word, as (bigram number, place)."""
    grams = sorted((order[word[i:i + 2]][0], i) for i in range(len(word) - 1))
    prefix = [g for g in grams if g[0] <= grams[2][0]]
    by_place = sorted((i, order[word[i:i + 2]][1], number) for number, i in prefix)
    # least[k]: the cheapest of the first k bigrams; a partner may not touch the next
    cost, best, least, behind = None, [], None, 0
    for i, words, number in by_place:
        while by_place[behind][0] <= i - 2:
            if least is None or by_place[behind][1] < least[1]:
                least = by_place[behind]
            behind += 1
        if least is not None and (cost is None or least[1] + words < cost):
            cost, best = least[1] + words, [(least[2], least[0]), (number, i)]
    return prefix, best


def letter_set(word: str) -> int:
    """The letters of a word as 63 bits."""
    bits = 0
    for c in word:
        bits |= 1 << ord(c) % 63
    return bits


_GRAM = pa.struct([("gram", pa.int32()), ("at", pa.int32())])


def _signatures(order: dict[str, tuple[int, int]]):
    def run(batches):
        for batch in batches:
            made = [prefix_and_pivots(w, order) for w in batch.column("word").to_pylist()]
            sides = [pa.array([[{"gram": g, "at": i} for g, i in m[side]] for m in made], pa.list_(_GRAM)) for side in (0, 1)]
            last = pa.array([max(m[0])[0] for m in made], pa.int32())
            letters = pa.array([letter_set(w) for w in batch.column("word").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), last, letters, *sides],
                                             names=["word", "n", "last", "letters", "prefix", "pivots"])
    return run


def near_words(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n), a < b: pairs of ``words`` (word, n; unique) exactly one edit apart.

    Words need four letters at least, for three bigrams."""
    gram = "array<struct<gram:int,at:int>>"
    signed = save(words.mapInArrow(_signatures(bigram_order(words)), (
        f"word string, n long, last int, letters long, prefix {gram}, pivots {gram}")), "signatures")
    size = F.length("word")
    # where a pivot may stand in the other word: (difference of lengths, of places)
    moves = F.array(*[F.struct(F.lit(a).alias("size"), F.lit(b).alias("at"))
                      for a, b in ((0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1))])
    left = signed.select(F.col("word").alias("x"), F.col("n").alias("x_n"), F.col("last").alias("x_last"),
                         F.col("letters").alias("x_letters"), size.alias("own"), F.explode("pivots").alias("p")).select(
        "*", F.explode(moves).alias("m")).select(
        "x", "x_n", "x_last", "x_letters", F.col("p.gram").alias("gram"), (F.col("p.at") + F.col("m.at")).alias("at"),
        (F.col("own") + F.col("m.size")).alias("size"))
    right = signed.select(F.col("word").alias("y"), F.col("n").alias("y_n"), F.col("last").alias("y_last"),
                          F.col("letters").alias("y_letters"), size.alias("size"), F.explode("prefix").alias("p")).select(
        "y", "y_n", "y_last", "y_letters", "size", F.col("p.gram").alias("gram"), F.col("p.at").alias("at"))
    few = F.bit_count(F.col("x_letters").bitwiseXOR(F.col("y_letters"))) <= 2
    pairs = left.join(right, ["gram", "at", "size"]).where(
        few & (F.col("x_last") <= F.col("y_last")) & (F.col("x") != F.col("y")) & (F.levenshtein("x", "y", 1) == 1))
    first = F.col("x") < F.col("y")
    return pairs.select(*[F.when(first, F.col(a)).otherwise(F.col(b)).alias(name) for a, b, name in (
        ("x", "y", "a"), ("x_n", "y_n", "a_n"), ("y", "x", "b"), ("y_n", "x_n", "b_n"))]).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word of (word, form): forms followed to the last, by pointer doubling."""
    at = save(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = save(at.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        at = moved.select("word", "root")


def variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of (word, n)."""
    words = save(words, "words")
    pairs = save(near_words(words), "pairs")
    sides = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    best = sides.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct(
        (-F.col("near_n")).alias("less"), "near")).alias("best"))
    joined = words.join(best, "word", "left").withColumn("form_n", -F.col("best.less"))
    enough = F.col("form_n") >= factor * F.col("n")
    rows = save(joined.select(
        "word", F.when(enough, F.col("best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(enough, F.col("form_n")).alias("form_n")), "forms")
    out = rows.join(roots(rows.where("form IS NOT NULL")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
