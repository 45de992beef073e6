"""Toxicity by class-conditional Kneser-Ney models.

A document is the sequence of all its lower-cased words up to an end mark.  A
character of a script written without spaces (Chinese, Japanese, Thai and the
like) is a word.  Two Kneser-Ney models per class (toxic, ordinary) count every
occurrence: one spells each word byte by byte up to an end symbol, its context
being the ``ORDER`` bytes before within the word; the other predicts each word
from the word before it.  What a class has not seen in a context backs off to
the counts of both classes in it, and those to continuation counts (in how many
different contexts a byte follows a byte pair, or a word follows another), which
both classes share.  Rare expressions thus inherit the evidence of their
beginnings, and words that neither class knows cancel out.

The score compares the length-normalised log-likelihoods: for either model the
mean log ratio over the occurrences, the same scaled by the root of their
number, and the strongest single one, weighed by a logistic calibration on rows
that the counts have not seen.

Bounds (parameters): ``max_per_class`` documents of each class give the
counts, ``max_calibration`` rows the calibration.  The model that goes to every
executor holds the contexts of those documents.

Defined results: null or empty text, or text without words, has log ratio 0
on all features and gets the calibrated score for that.  A null doc_id
is never a training row and is not held out.  Without usable labels of both
classes every score is the share of toxic rows seen (0 without any).
Repeated rows are scored alike; a doc_id labelled more than once counts as
toxic if any of its labels is 1.  Other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, forget, free_shuffles, mix64, save, text_bytes, word_hashes

ORDER = 8
TIMES = (1.0, 2.0, 4.0)  # of the estimated discounts, for what a class yields to both; the calibration rows choose
PAIR = ORDER + 1         # level of the contexts that are a whole word
N_FEATURES = 6
KNOWN_WORDS = 200_000
RANGE_BITS = 6          # the first bits of a key, by which the driver puts keys in order
RANGES = 1 << RANGE_BITS
RANGES_AT_ONCE = 8      # that the driver reads
HELD_KEYS = 500_000     # that a task holds at once
#: Characters of scripts written without spaces: Thai, Lao, Tibetan, Myanmar,
#: Khmer, kana and ideographs; and all of four bytes.
_ALONE = rb"\xe0[\xb8-\xbf].|\xe1[\x80-\x82\x9e\x9f].|\xe2[\xba-\xbf].|[\xe3-\xe9]..|\xf0..."
WORD = re.compile(rb"(?:[a-z0-9'\x80-\xdf\xea-\xef\xf1-\xff]+|(?!" + _ALONE + rb")[\xe0-\xe2].)+|" + _ALONE + rb"|[\xe0-\xf0]",
                  re.DOTALL)
_START, _END = np.array([0x5BD1E995A3B8C6F1, 0x3C6EF372FE94F82B], np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _spelled(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(level, context, symbol, word number) of every byte and end symbol."""
    x = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    n = len(x)
    number = np.concatenate([[0], np.cumsum(x == 0x20)[:-1]])
    opens = np.concatenate([[True], x[:-1] == 0x20])
    place = np.arange(n) - np.maximum.accumulate(np.where(opens, np.arange(n), 0))
    context = np.zeros(n, np.uint64)
    for k in range(1, ORDER + 1):
        previous = np.zeros(n, np.uint64)
        previous[k:] = x[:-k]
        context |= np.where(place >= k, previous, np.uint64(0)) << np.uint64(8 * (k - 1))
    return np.minimum(place, ORDER), context, x.astype(np.uint64), number


def context_keys(level: np.ndarray, context: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(mix64(context) * _ODD + (np.asarray(level) + 1).astype(np.uint64))


def node_keys(contexts: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(contexts * _ODD + mix64(symbol + np.uint64(1)))


@dataclass
class Words:
    """A batch: distinct words, the occurrences of each text one after another,
    and the occurrences with the start and end mark of texts that have words."""
    known: list[bytes]
    at: np.ndarray
    lengths: np.ndarray

    def hashes(self) -> np.ndarray:
        return np.concatenate([word_hashes(self.known), [_START, _END]])

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word before, word, pairs per text), as places in ``hashes``."""
        start, end = len(self.known), len(self.known) + 1
        closing = np.cumsum(self.lengths)[self.lengths > 0]
        words = np.insert(self.at, closing, end)
        before = np.concatenate([[start], words[:-1]])[:len(words)]
        before[before == end] = start
        return before, words, np.where(self.lengths > 0, self.lengths + 1, 0)


def batch_words(texts: list) -> Words:
    lists = [WORD.findall(t.lower()) for t in texts]
    flat = [w for x in lists for w in x]
    index = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    return Words(list(index), np.fromiter(map(index.__getitem__, flat), np.int64, len(flat)),
                 np.array([len(x) for x in lists], np.int64))


@dataclass
class Model:
    """Sorted keys with log ratios: of a symbol after a context where either
    class has seen it, and of any other symbol after a known context."""
    keys: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    ratios: np.ndarray = field(default_factory=lambda: np.empty(0, np.float16))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(N_FEATURES + 1))
    #: spelled ratios of words met before in this worker, ``KNOWN_WORDS`` at most
    met: dict[bytes, float] = field(default_factory=dict, repr=False, compare=False)

    def __getstate__(self):
        return {**self.__dict__, "met": {}}

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(keys)  # in order, neighbours' searches touch the same places
        at = np.empty(len(keys), np.int64)
        at[order] = np.searchsorted(self.keys, keys[order])
        at[at == len(self.keys)] = 0
        return self.ratios[at].astype(float), self.keys[at] == keys

    def steps(self, level, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """log P(symbol | context, toxic) - log P(symbol | context, ordinary)."""
        if not len(self.keys) or not len(context):
            return np.zeros(len(context))
        contexts = context_keys(level, context)
        out, seen = self.find(node_keys(contexts, symbol))
        leaving, known = self.find(contexts[~seen])
        out[~seen] = np.where(known, leaving, 0.0)
        return out

    def spelled_ratios(self, words: list[bytes]) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary) by spelling."""
        if not words:
            return np.empty(0)
        level, context, symbol, number = _spelled(words)
        return np.bincount(number, weights=self.steps(level, context, symbol), minlength=len(words))

    def known_ratios(self, words: list[bytes]) -> np.ndarray:
        """``spelled_ratios``, spelling only words that this worker has not met."""
        if len(self.met) > KNOWN_WORDS:
            self.met.clear()
        new = [w for w in words if w not in self.met]
        self.met.update(zip(new, self.spelled_ratios(new).tolist(), strict=True))
        return np.fromiter(map(self.met.__getitem__, words), float, len(words))

    def features(self, words: Words) -> np.ndarray:
        """Per text mean, root-scaled sum and maximum of the log ratios, of the
        words as spelled and of the words after the word before."""
        out = np.zeros((len(words.lengths), N_FEATURES))
        if not len(words.at):
            return out
        before, after, lengths = words.pairs()
        known, inverse = np.unique(before * (len(words.known) + 2) + after, return_inverse=True)
        hashes = words.hashes()
        pairs = self.steps(PAIR, hashes[known // len(hashes)], hashes[known % len(hashes)])[inverse]
        for k, ratios, n in ((0, self.known_ratios(words.known)[words.at], words.lengths), (3, pairs, lengths)):
            full = np.flatnonzero(n)
            starts = (np.cumsum(n) - n)[full]
            sums = np.add.reduceat(ratios, starts)
            out[full, k] = sums / n[full]
            out[full, k + 1] = sums / np.sqrt(n[full])
            out[full, k + 2] = np.maximum.reduceat(ratios, starts)
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        z = np.clip(features @ self.weights[1:] + self.weights[0], -30, 30)
        return 1 / (1 + np.exp(-z))


def _count_words(batches):
    for batch in batches:
        words = batch_words(batch.column("text").to_pylist())
        if not len(words.at):
            continue
        toxic = np.asarray(batch.column("toxic").to_numpy(zero_copy_only=False), float)
        n_all = np.bincount(words.at)
        n_toxic = np.bincount(words.at, weights=np.repeat(toxic, words.lengths))
        level, context, symbol, number = _spelled(words.known)
        contexts = context_keys(level, context)
        _, first, inverse = np.unique(node_keys(contexts, symbol), return_index=True, return_inverse=True)
        tail = (context & np.uint64(0xFFFF)) << np.uint64(8) | symbol
        rows = [(contexts[first], tail[first], False,
                 np.bincount(inverse, weights=n_toxic[number]), np.bincount(inverse, weights=n_all[number]))]
        before, after, lengths = words.pairs()
        hashes = words.hashes()
        known, inverse = np.unique(before * len(hashes) + after, return_inverse=True)
        contexts, symbol = context_keys(PAIR, hashes[known // len(hashes)]), hashes[known % len(hashes)]
        rows.append((contexts, symbol, True,
                     np.bincount(inverse, weights=np.repeat(toxic, lengths)), np.bincount(inverse)))
        for *longs, pair, n1, n in rows:
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(x.view(np.int64)) for x in longs], pa.array(np.full(len(n), pair)),
                 pa.array(n1.astype(np.int64)), pa.array((n - n1).astype(np.int64))],
                names=["context", "tail", "pair", "n_toxic", "n_ordinary"])


def discounts(n: list[int]) -> list[float]:
    """What is taken off counts of 1, 2 and more: the modified Kneser-Ney
    discounts from ``n``, how many counts are 1, 2, 3 and 4; halves of the count
    (at most 1.5) where one of those is missing."""
    if not all(n):
        return [0.5, 1.0, 1.5]
    share = n[0] / (n[0] + 2 * n[1])
    return [min(max(k - (k + 1) * share * n[k] / n[k - 1], 0.05 * k), 0.95 * k) for k in (1, 2, 3)]


def shared_counts(nodes: DataFrame, sizes: dict[bool, int]) -> DataFrame:
    """(pair, tail, shared): continuation probabilities that both classes share,
    of a byte after the two bytes before it and of a word after any; ``sizes``
    are the numbers of nodes that spell and of those that pair words.

    Tails of bytes are three bytes, so their tables are bounded by the alphabet."""
    tails = nodes.groupBy("pair", "tail").agg(F.count("*").alias("n"))
    spelled, paired = tails.where("NOT pair"), tails.where("pair")
    before, byte = F.shiftright("tail", 8).alias("_before"), F.col("tail").bitwiseAND(255).alias("_byte")
    by_byte = (spelled.select("*", before, byte)
               .join(spelled.groupBy(before).agg(F.sum("n").alias("before_n")), "_before")
               .join(spelled.groupBy(byte).agg(F.sum("n").alias("byte_n")), "_byte"))
    alone = (F.col("byte_n") + 1) / (sizes.get(False, 0) + 256)
    by_byte = by_byte.select("pair", "tail", ((F.col("n") + alone) / (F.col("before_n") + 1)).alias("shared"))
    return by_byte.unionByName(paired.select("pair", "tail", (F.col("n") / (sizes.get(True, 0) + 1)).alias("shared")))


def node_ratios(nodes: DataFrame, times=TIMES) -> DataFrame:
    """Log ratios of pooled (context, tail, pair, n_toxic, n_ordinary) rows, with
    the discounts of the classes taken each of ``times``: (context, tail, pair,
    r0, r1, ..., first, e0, e1, ...).  r is of the symbol after its context, e of
    any other symbol, to be read from one row of each context, the ``first``.

    The tail is the word, or the symbol and the two bytes before it."""
    every = ("toxic", "ordinary", "both")
    nodes = nodes.withColumn("n_both", F.col("n_toxic") + F.col("n_ordinary"))
    counted = nodes.groupBy("pair").agg(F.count("*").alias("n"), *[  # two rows
        F.count_if(F.col(f"n_{c}") == k).alias(f"{c}{k}") for c in every for k in range(1, 5)]).collect()
    taken = {(c, r["pair"]): discounts([r[f"{c}{k}"] for k in range(1, 5)]) for r in counted for c in every}

    def off(c: str, t: float) -> Column:
        n, out = F.col(f"n_{c}"), F.lit(0.0)
        for (name, pair), steps in taken.items():
            if name == c:
                by_count = F.when(n == 1, t * steps[0]).when(n == 2, t * steps[1]).otherwise(t * steps[2])
                out = F.when((F.col("pair") == pair) & (n > 0), F.least(by_count, n.cast("double"))).otherwise(out)
        return out

    full = nodes.join(shared_counts(nodes, {r["pair"]: r["n"] for r in counted}), ["pair", "tail"])
    context = Window.partitionBy("context")  # a context's symbols, of a bounded number of documents
    classes = [(c, t, f"{c}{k}") for c in every[:2] for k, t in enumerate(times)] + [("both", 1.0, "both")]
    full = full.select("context", "tail", "pair", "shared", *[f"n_{c}" for c in every],
                       *[F.sum(f"n_{c}").over(context).alias(f"total_{c}") for c in every],
                       *[F.sum(off(c, t)).over(context).alias(f"given_{name}") for c, t, name in classes],
                       (F.min("tail").over(context) == F.col("tail")).alias("first"))

    def left(c: str, name: str) -> Column:
        """What a context gives away."""
        share = F.when(F.col(f"total_{c}") > 0, F.col(f"given_{name}") / F.col(f"total_{c}")).otherwise(1.0)
        return F.greatest(F.lit(1e-4), F.least(F.lit(1.0), share))

    def kept(c: str, t: float) -> Column:
        """What a count keeps of its context's total."""
        return (F.col(f"n_{c}") - off(c, t)) / F.greatest(F.col(f"total_{c}"), F.lit(1))

    both = kept("both", 1.0) + left("both", "both") * F.col("shared")

    def log_of(c: str, k: int) -> Column:
        return F.log(kept(c, times[k]) + left(c, f"{c}{k}") * both)

    return full.select("context", "tail", "pair", "first", *[
        (log_of("toxic", k) - log_of("ordinary", k)).cast("float").alias(f"r{k}") for k in range(len(times))], *[
        (F.log(left("toxic", f"toxic{k}")) - F.log(left("ordinary", f"ordinary{k}"))).cast("float").alias(f"e{k}")
        for k in range(len(times))])


def _keyed(width: int):
    """Rows of ``node_ratios`` as sorted keys with ratios, the contexts among
    them: a few rows of bytes for each of ``RANGES`` ranges of keys.  Beginnings
    that neither class knows cancel, so the empty context has no row."""
    empty = context_keys(np.zeros(1), np.zeros(1, np.uint64))[0]
    names = [f"r{k}" for k in range(width)]

    def packed(held):
        key, *ratios = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(key)
        key, ratios = key[order], [r[order] for r in ratios]
        cuts = np.searchsorted(key >> np.uint64(64 - RANGE_BITS), np.arange(RANGES + 1))
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            yield pa.RecordBatch.from_pydict({"range": pa.array([k], pa.int32()), **{
                name: [x[cuts[k]:cuts[k + 1]].tobytes()] for name, x in zip(("key", *names), (key, *ratios), strict=True)}})

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            context, tail = (batch.column(c).to_numpy().view(np.uint64) for c in ("context", "tail"))
            pair, first = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "first"))
            key = node_keys(context, np.where(pair, tail, tail & np.uint64(255)))
            own = first & (context != empty)
            held.append((np.concatenate([key, context[own]]), *[
                np.concatenate([batch.column(f"r{k}").to_numpy(), batch.column(f"e{k}").to_numpy()[own]])
                .astype(np.float16) for k in range(width)]))  # two bytes each to the driver
            if sum(len(h[0]) for h in held) >= HELD_KEYS:
                yield from packed(held)
                held.clear()
        if held:
            yield from packed(held)
    return run


def build_models(nodes: DataFrame, times=TIMES) -> list[Model]:
    """One model for each of ``times``.  Only keys and ratios reach the driver,
    as many as the ``max_per_class`` documents of each class have contexts: some
    ranges of keys at a time, each put in order in its place, so that neither the
    driver's JVM holds them nor its Python two copies of all."""
    nodes = save(nodes, "nodes")
    names = [f"r{k}" for k in range(len(times))]
    schema = ", ".join(["range int, key binary", *[f"{n} binary" for n in names]])
    keyed = save(node_ratios(nodes, times).mapInArrow(_keyed(len(times)), schema), "keyed")
    forget(nodes)
    n = (keyed.agg(F.sum(F.length("key").cast("long"))).first()[0] or 0) // 8
    keys, ratios, at = np.empty(n, np.uint64), [np.empty(n, np.float16) for _ in names], 0
    free_shuffles(nodes.sparkSession)
    for a in range(0, RANGES, RANGES_AT_ONCE):
        pieces: dict[int, list] = {}
        for r in keyed.where(F.col("range").between(a, a + RANGES_AT_ONCE - 1)).toLocalIterator():
            pieces.setdefault(r["range"], []).append([bytes(r[n]) for n in ("key", *names)])
        for k in sorted(pieces):
            own, *of_own = (b"".join(x) for x in zip(*pieces.pop(k), strict=True))
            own = np.frombuffer(own, np.uint64)
            order = np.argsort(own)
            keys[at:at + len(own)] = own[order]
            for out, x in zip(ratios, of_own, strict=True):
                out[at:at + len(own)] = np.frombuffer(x, np.float16)[order]
            at += len(own)
    forget(keyed)
    return [Model(keys, r) for r in ratios]


def calibrate(features: np.ndarray, labels: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Logistic weights (intercept first) by damped Newton steps on centred and
    scaled features; those that never vary get no weight.  A log ratio never
    counts against its sign: the most negative weight is set to 0 until none is
    left."""
    n, width = len(labels), features.shape[1]
    if n == 0 or labels.min() == labels.max():
        share = float(labels.mean()) if n else 0.0
        return np.concatenate([[np.log((share + 1e-9) / (1 - share + 1e-9))], np.zeros(width)])
    middle, spread = features.mean(axis=0), features.std(axis=0)
    varies = spread > 1e-9 * (1 + np.abs(middle))
    scale = np.where(varies, spread, 1.0)
    x = np.hstack([np.ones((n, 1)), (features - middle) / scale])
    penalty = ridge * np.diag([0.0] + [1.0] * width)
    used = np.concatenate([[0], 1 + np.flatnonzero(varies)])
    while True:
        w = np.zeros(width + 1)
        w[used] = _newton(x[:, used], labels, penalty[np.ix_(used, used)])
        if w[1:].min() >= 0:
            return np.concatenate([[w[0] - (w[1:] / scale * middle).sum()], w[1:] / scale])
        used = used[used != 1 + int(w[1:].argmin())]


def _newton(x: np.ndarray, labels: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    def cost(w):
        z = x @ w
        return (np.logaddexp(0, z) - labels * z).sum() + w @ penalty @ w / 2

    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty
        step, now = np.linalg.lstsq(hessian, x.T @ (labels - p) - penalty @ w, rcond=None)[0], cost(w)
        while cost(w + step) > now and np.abs(step).max() > 1e-8:
            step = step / 2
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, train_rows: Column | None = None, *,
          max_per_class: int = 10_000, max_calibration: int = 6_000) -> Model:
    """Fit on labelled documents.  ``labels`` has doc_id and toxic;
    ``train_rows`` is a condition on doc_id that a training row must meet."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
            .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    if train_rows is not None:
        rows = rows.where(train_rows)
    order = F.xxhash64("doc_id", F.lit(17))
    rows = rows.withColumn("_order", order).withColumn("_fit", F.pmod(F.shiftrightunsigned(order, 33), F.lit(10)) < 7)
    found = {r["toxic"]: r["n"] for r in rows.where("_fit").groupBy("toxic").agg(F.count("*").alias("n")).collect()}

    def first(df, n):
        return df.orderBy("_order", "doc_id").limit(n)

    own = docs.select("doc_id", text_bytes().alias("text"))

    def texts(sample):  # at most max_per_class * 2 or max_calibration ids
        return own.join(F.broadcast(sample.select("doc_id", "toxic")), "doc_id")

    models = [Model()]
    if found.get(0) and found.get(1):
        chosen = first(rows.where("_fit and toxic = 1"), max_per_class).unionByName(
            first(rows.where("_fit and toxic = 0"), max_per_class))
        n_toxic, n_ordinary = (F.sum(c).cast("int").alias(c) for c in ("n_toxic", "n_ordinary"))
        nodes = (texts(chosen).select("text", "toxic")
                 .mapInArrow(_count_words, "context long, tail long, pair boolean, n_toxic long, n_ordinary long")
                 .groupBy("context", "tail", "pair").agg(n_toxic, n_ordinary))
        models = build_models(nodes)
    shared = spark.sparkContext.broadcast(models)
    names = [f"f{k}" for k in range(N_FEATURES * len(models))]

    def features(batches):
        for batch in batches:
            words = batch_words(batch.column("text").to_pylist())
            f = np.hstack([model.features(words) for model in shared.value])
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *map(pa.array, f.T)], names=["toxic", *names])

    seen = (texts(first(rows.where("not _fit"), max_calibration)).select("text", "toxic")
            .mapInArrow(features, ", ".join(["toxic int", *[f"{n} double" for n in names]])).toPandas())
    shared.destroy(blocking=True)  # every executor holds a file of it
    free_shuffles(spark)  # what the JVM held for the model build goes before the next broadcast
    labels_seen, losses = seen["toxic"].to_numpy(float), []
    for k, model in enumerate(models):
        own = seen[names[k * N_FEATURES:(k + 1) * N_FEATURES]].to_numpy(float)
        model.weights = calibrate(own, labels_seen)
        p = np.clip(model.score(own), 1e-9, 1 - 1e-9)
        losses.append(-np.log(np.where(labels_seen > 0, p, 1 - p)).sum())
    return models[int(np.argmin(losses))]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, words, mean_log_ratio) for every whole text."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            words = batch_words(batch.column("text").to_pylist())
            f = shared.value.features(words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(shared.value.score(f)), pa.array(words.lengths), pa.array(f[:, 0])],
                names=["doc_id", "score", "words", "mean_log_ratio"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
            .mapInArrow(run, "doc_id long, score double, words long, mean_log_ratio double"))


def filter_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The documents whose score is under ``threshold``, with all their columns."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index("text")

    def run(batches):
        for batch in batches:
            texts = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in batch.column(at).to_pylist()]
            keep = shared.value.score(shared.value.features(batch_words(texts))) < threshold
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
