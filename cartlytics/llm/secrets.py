"""Secret scan: rule spans plus character Markov models, in DataFrame functions only.

Three rules give the base spans (leftmost, not overlapping per kind, offsets
in code points, end exclusive).  On top, every run of 20 or more token
characters outside the base spans is compared under two first-order character
Markov models, one of random strings and one of ordinary identifiers, and
becomes a span of kind ``markov`` when the log-likelihood ratio is at least
``min_ratio``.  The models are trained from labelled samples (token, random);
``labelled_samples`` labels what the rules find in a bounded number of
documents (``max_documents``, first by a hash of the id) as random and the
other long tokens of those documents as ordinary.

The collected model has one row per label and character pair of a 68-letter
alphabet, so its size is bounded whatever the corpus.

Defined results: a null text counts as empty; an empty text has no spans.
Ties cannot occur within a kind; equal starts are ordered by kind as listed.
Repeated rows are scanned alike; a null doc_id stays null.  Without samples
of both labels the Markov ratio is 0 and only base spans are found.  All
other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
SAMPLE_TOKEN = r"[A-Za-z0-9+/_=-]{12,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
_SPAN = "struct<start:int,kind:int,end:int>"


BLOCK = 128


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _running(values: Column, start: int, step) -> Column:
    """Running folds of an array of ints, by blocks: every fold appends to a short
    array, so long arrays take time in proportion to their length."""
    def block(v, b):
        return F.slice(v, b * BLOCK + 1, F.lit(BLOCK))

    def along(x, first):
        begun = F.struct(first.alias("at"), F.array().cast("array<int>").alias("all"))

        def push(acc, v):
            at = step(acc["at"], v)
            return F.struct(at.alias("at"), F.array_append(acc["all"], at).alias("all"))

        return F.aggregate(x, begun, push, lambda acc: acc["all"])

    def whole(v):
        blocks = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int"))
        folded = F.transform(blocks, lambda b: F.aggregate(block(v, b), F.lit(start), step))
        return _let(F.concat(F.array(F.lit(start)), along(folded, F.lit(start))), lambda first: F.flatten(
            F.transform(blocks, lambda b: along(block(v, b), F.element_at(first, b + 1)))))

    return F.when(F.size(values) > 0, _let(values, whole)).otherwise(F.array().cast("array<int>"))


def _located(matches: Column, pieces: Column, kind: int, keep: Column) -> Column:
    """Spans of the matches flagged in ``keep``; the pieces between matches give the offsets."""
    sizes = F.transform(F.arrays_zip(matches.alias("m"), F.slice(pieces, 1, F.size(matches)).alias("p")),
                        lambda x: F.length(x["m"]) + F.length(x["p"]))
    ends = _running(sizes, 0, lambda a, b: a + b)
    rows = F.filter(F.arrays_zip(matches.alias("m"), ends.alias("end"), keep.alias("keep")), lambda x: x["keep"])
    spans = F.transform(rows, lambda x: F.struct((x["end"] - F.length(x["m"])).alias("start"), F.lit(kind).alias("kind"),
                                                 x["end"].alias("end")))
    return F.when(F.size(matches) > 0, spans).otherwise(F.array()).cast(f"array<{_SPAN}>")


def _matches(df: DataFrame, name: str, pattern: str) -> DataFrame:
    return (df.withColumn(f"m_{name}", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
            .withColumn(f"p_{name}", F.when(F.size(f"m_{name}") > 0, F.split("text", pattern, -1))))


def _assigned(match: Column) -> Column:
    return F.length(F.regexp_extract(match, ASSIGN, 1)) >= 6


def base_spans(df: DataFrame) -> DataFrame:
    """Adds ``assign``, ``access`` and ``hex`` span arrays to rows with ``text``."""
    for name, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX)):
        df = _matches(df, name, pattern)
    for kind, name in enumerate(KINDS[:3]):
        long_enough = F.transform(f"m_{name}", _assigned if name == "assign" else lambda m: F.lit(True))
        df = df.withColumn(name, _located(F.col(f"m_{name}"), F.col(f"p_{name}"), kind, long_enough))
    return df.drop(*[f"{x}_{n}" for n in KINDS[:3] for x in "mp"])


def labelled_samples(docs: DataFrame, max_documents: int = 8_000) -> DataFrame:
    """(token, random) from at most ``max_documents`` documents."""
    chosen = (docs.select("doc_id").where("doc_id is not null")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_documents).distinct())
    own = (docs.join(F.broadcast(chosen), "doc_id")  # at most max_documents ids
           .select(F.coalesce("text", F.lit("")).alias("text")))
    values = F.transform(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(1)), lambda t: F.struct(
        t.alias("token"), F.lit(True).alias("random")))
    keys = F.transform(F.concat(F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)),
                                F.regexp_extract_all("text", F.lit(HEX), F.lit(0))),
                       lambda t: F.struct(t.alias("token"), F.lit(True).alias("random")))
    rest = F.regexp_replace("text", f"{ASSIGN}|{ACCESS}|{HEX}", " ")
    plain = F.transform(F.regexp_extract_all(rest, F.lit(SAMPLE_TOKEN), F.lit(0)), lambda t: F.struct(
        t.alias("token"), F.lit(False).alias("random")))
    return (own.select(F.explode(F.concat(values, keys, plain)).alias("s"))
            .select("s.token", "s.random").where(F.length("token") >= 12))


def train(samples: DataFrame, smoothing: float = 0.5) -> list[float]:
    """Log ratio of each character pair: log P(b | a, random) - log P(b | a, ordinary)."""
    pairs = F.transform(F.sequence(F.lit(1), F.length("token") - 1), lambda i: F.substr("token", i, F.lit(2)))
    rows = (samples.where("token is not null and random is not null and length(token) > 1")
            .select("random", F.explode(pairs).alias("pair"))
            .where(F.col("pair").rlike(r"^[A-Za-z0-9+/_.=-]{2}$"))
            .groupBy("random", "pair").agg(F.count("*").alias("n")).collect())
    size = len(ALPHABET)
    counts = {True: {}, False: {}}
    for r in rows:
        counts[r["random"]][r["pair"]] = r["n"]
    if not counts[True] or not counts[False]:
        return [0.0] * (size * size)
    logs = {}
    for label, seen in counts.items():
        total = {a: sum(seen.get(a + b, 0) for b in ALPHABET) for a in ALPHABET}
        logs[label] = [math.log((seen.get(a + b, 0) + smoothing) / (total[a] + smoothing * size))
                       for a in ALPHABET for b in ALPHABET]
    return [x - y for x, y in zip(logs[True], logs[False], strict=True)]


def log_ratio(token: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a token over its character pairs."""
    size = len(ALPHABET)
    codes = [1] * 128
    for i, ch in enumerate(ALPHABET):
        codes[ord(ch)] = i + 1
    code = F.lit(codes)
    ratio = F.lit([float(x) for x in model])

    def step(acc, c):
        pair = F.when(acc["code"] > 0, F.element_at(ratio, (acc["code"] - 1) * size + c)).otherwise(0.0)
        return F.struct(c.alias("code"), (acc["sum"] + pair).alias("sum"))

    chars = F.filter(F.split(token, ""), lambda c: c != "")
    codes = F.transform(chars, lambda c: F.element_at(code, F.ascii(c) + 1))
    return F.aggregate(codes, F.struct(F.lit(0).alias("code"), F.lit(0.0).alias("sum")), step, lambda acc: acc["sum"])


def scan(docs: DataFrame, model: list[float], min_ratio: float = 10.0) -> DataFrame:
    """(doc_id, assign, access, hex, markov): span arrays of every whole text."""
    df = base_spans(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    df = df.withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))
    df = df.withColumn("rest", F.when(F.size("base") > 0, _blanked(F.col("text"), F.col("base"))).otherwise(F.col("text")))
    df = df.withColumn("m_markov", F.regexp_extract_all("rest", F.lit(CANDIDATE), F.lit(0)))
    df = df.withColumn("hits", F.transform("m_markov", lambda t: log_ratio(t, model) >= min_ratio))
    df = df.withColumn("p_markov", F.when(F.exists("hits", lambda h: h), F.split("rest", CANDIDATE, -1)))
    found = F.when(F.col("p_markov").isNotNull(), _located(F.col("m_markov"), F.col("p_markov"), KINDS.index("markov"), F.col("hits")))
    return df.select("doc_id", "assign", "access", "hex", "base",
                     F.coalesce(found, F.array().cast(f"array<{_SPAN}>")).alias("markov"))


def _blanked(text: Column, spans: Column) -> Column:
    """The text with the characters of sorted spans made spaces: offsets stay."""
    def parts(chars, spans, ends):  # ends: how far spans reach so far
        def part(i):
            start, end = F.element_at(spans, i)["start"], F.element_at(ends, i)
            done = F.when(i > 1, F.element_at(ends, F.greatest(i - 1, F.lit(1)))).otherwise(0)
            plain = F.array_join(F.slice(chars, done + 1, F.greatest(start - done, F.lit(0))), "")
            return F.concat(plain, F.repeat(F.lit(" "), end - F.greatest(start, done)))

        rest = F.slice(chars, F.element_at(ends, -1) + 1, F.size(chars))
        return F.concat(F.array_join(F.transform(F.sequence(F.lit(1), F.size(spans)), part), ""), F.array_join(rest, ""))

    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return _let(spans, lambda known: _let(_running(F.transform(known, lambda x: x["end"]), 0, lambda a, b: F.greatest(a, b)), lambda ends: _let(
        chars, lambda c: parts(c, known, ends))))


def joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
