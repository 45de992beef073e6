"""Language-model scoring: token counts plus context mixing over token bits.

A text is its lower-cased words and one end token.  A token's probability is
that of its code (a byte of its hash) after the words before it, times its own
among the tokens of that code.  The first is mixed bit by bit from the counts of
all occurrences in training texts (``mixing``), so the order of words tells; the
second is the token's share below over that of its code, where spelling's share
of a code is taken as 1/256, its mean over hashes.  Every text belongs to one
of ``GATES`` classes by its most frequent byte outside ASCII, which tells
scripts and languages apart without any fitting; the class itself is priced
first.  A token's probability in a class is its discounted share of the class's
training tokens, backed off to its share of all training tokens, backed off to
being spelled bit by bit by the context mixer (``mixing``), which is what
prices unknown words; its tables count the bits of every training token as
often as it occurs.  The weight of spelling is how often a training token is a first sight
(tokens counted once over all tokens).

How it runs: tasks reduce chunks of documents to their distinct tokens with
lists of (document, times), cut by token hash into one part for every
``PART_BYTES`` of text, whatever the session.  A part thus meets each of its tokens once per chunk,
not once per occurrence, so frequent words are no hot keys.  Parts sum the
counts; the tables are summed over parts; mixer weights are trained online
over all tokens of every part and averaged by tokens; then each part prices its tokens once, and sums per
document go back by chunk.  The words of a chunk are kept in their order as hashes
of 32 bits, over which the codes are counted, trained and priced chunk by chunk.
Only the two mixers (of a fixed size) are broadcast.

Defined results: null text counts as empty, which is the end token alone.  A
null doc_id is neither training nor held out.  Without training documents all
counts are 0 and the mixer is untrained.  Repeated rows are documents of their
own.  Tokens of any length are spelled in full.  An empty table gives no rows.
Other columns are ignored.  ``docs`` must come from a stored table: chunks follow
the order of its rows, which a task that is run again has to find unchanged.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import mixing
from .common import bounded_batches, save, text_bytes, word_hashes, words

CHUNK_BYTES = 6_000_000
CHUNK_DOCS = 4096
SEGMENTS = 64
GATES = 16
DISCOUNT = 0.75
SOME = 10_000           # tokens priced at once
PART_BYTES = 16 << 20   # text that makes a part
PIECE_BYTES = 4 << 20   # of a part's tokens with their references, one row
HELD_BYTES = 16 << 20   # sums per document that pricing holds
SLICE = 100_000         # tokens spelled at once
#: Rows of megabytes: a page ends with the row that fills it, not after a hundred,
#: and so does a row group, which readers take whole.
LARGE_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.block.size": str(8 << 20)}

END_HASH = int(word_hashes([mixing.END])[0]) >> 32

_INFO = "chunk long, doc_id array<long>, held array<boolean>, train array<boolean>, gate array<long>, n_tokens array<long>, n_bytes array<long>, words binary"
_BLOB = "chunk long, tokens binary, gates binary, train binary, degree binary, docs binary, times binary"


def gate(text: bytes) -> int:
    """Class of a text: 0 for ASCII, else by its most frequent other byte."""
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)[128:192]
    return 1 + int(seen.argmax()) % (GATES - 1) if seen.any() else 0


def _chunk_rows(chunk: int, docs: list[tuple], parts: int) -> list[dict]:
    """One chunk's documents (doc_id, text, train, held) as rows by part."""
    split = [words(d[1]) for d in docs]
    lengths = np.array([len(s) for s in split], np.int64)
    tokens = [t for s in split for t in s]
    hashes = word_hashes(tokens)
    ordered = np.insert((hashes >> np.uint64(32)).astype(np.uint32), np.cumsum(lengths), END_HASH)
    gates = np.array([gate(d[1]) for d in docs], np.int64)
    in_training = np.array([d[2] for d in docs], np.uint8)
    info = {"chunk": chunk, "doc_id": [d[0] for d in docs], "held": [d[3] for d in docs],
            "train": [d[2] for d in docs],
            "gate": gates.tolist(), "n_tokens": (lengths + 1).tolist(), "n_bytes": [len(d[1]) for d in docs],
            "words": ordered.tobytes()}
    rows = [{"part": chunk % parts, "info": info, "blob": None}]
    if not tokens:
        return rows
    doc = np.repeat(np.arange(len(docs)), lengths)
    known, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    part = (known % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    code, times = np.unique((place[inverse] << 16) | doc, return_counts=True)
    if times.max() > 255:  # longer repetitions become several entries
        copies = (times + 254) // 255
        code, rest = np.repeat(code, copies), times - 255 * (copies - 1)
        full = np.full(len(code), 255)
        full[np.cumsum(copies) - 1] = rest
        times = full
    token, doc = code >> 16, code & 0xFFFF
    degree = np.bincount(token, minlength=len(known)).astype(np.uint32)
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    pairs = np.concatenate([[0], np.cumsum(degree, dtype=np.int64)])
    texts = [tokens[i] for i in first[order]]
    for p in range(parts):
        a, b = cuts[p], cuts[p + 1]
        if a < b:
            i, j = pairs[a], pairs[b]
            rows.append({"part": p, "info": None, "blob": {
                "chunk": chunk, "tokens": b" ".join(texts[a:b]), "gates": gates.astype(np.uint8).tobytes(),
                "train": in_training.tobytes(), "degree": degree[a:b].tobytes(), "docs": doc[i:j].astype(np.uint16).tobytes(),
                "times": times[i:j].astype(np.uint8).tobytes()}})
    return rows


def _chunks(parts: int, schema: pa.Schema):
    def run(batches):
        base, number = TaskContext.get().partitionId() << 24, 0
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                held.append(row)
                size += len(row[1])
                if size >= CHUNK_BYTES or len(held) >= CHUNK_DOCS:
                    yield pa.RecordBatch.from_pylist(_chunk_rows(base + number, held, parts), schema)
                    held, size, number = [], 0, number + 1
        if held:
            yield pa.RecordBatch.from_pylist(_chunk_rows(base + number, held, parts), schema)
    return run


def _merge(schema: pa.Schema):
    """All chunks' rows of one part: distinct tokens, counts, references, as rows
    of some megabytes with a piece of the tokens each.  The first one also has
    what the online pass meets, the training tokens in order, and the sums.  What
    tells of a whole chunk passes through as rows of its own, batch by batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs, ends, part = [], np.zeros(GATES, np.int64), None
        for batch in batches:
            part = batch.column("part")[0].as_py()
            info, blob = batch.column("info"), batch.column("blob")
            infos = info.filter(info.is_valid())
            for i in infos:
                np.add.at(ends, np.array(i["gate"].as_py(), np.int64), np.array(i["train"].as_py(), np.int64))
            if len(infos):
                yield pa.RecordBatch.from_arrays([
                    infos.cast(f.type) if f.name == "info" else pa.nulls(len(infos), f.type) for f in schema], schema=schema)
            blobs.extend(blob.filter(blob.is_valid()).to_pylist())
            del batch, info, blob, infos
        hashes = [word_hashes(b["tokens"].split(b" ")) for b in blobs]
        starts = np.cumsum([0, *map(len, hashes)])
        known, first, inverse = np.unique(np.concatenate([np.empty(0, np.uint64), *hashes]), return_index=True, return_inverse=True)
        order = np.argsort(first)
        cuts = np.searchsorted(first[order], starts)
        tokens: list[bytes] = [b""] * len(known)
        counts = np.zeros((len(known), GATES), np.int64)
        weight = np.zeros(len(known), np.int64)
        for k, b in enumerate(blobs):
            own = b.pop("tokens").split(b" ")
            for i in order[cuts[k]:cuts[k + 1]].tolist():
                tokens[i] = own[first[i] - starts[k]]
            index = inverse[starts[k]:starts[k + 1]]
            docs, degree = np.frombuffer(b["docs"], np.uint16), np.frombuffer(b["degree"], np.uint32)
            token = np.repeat(index, degree)
            times = np.frombuffer(b["times"], np.uint8) * np.frombuffer(b.pop("train"), np.uint8)[docs].astype(np.int64)
            np.add.at(counts, (token, np.frombuffer(b["gates"], np.uint8)[docs]), times)
            weight[index] += 8 + 3 * degree.astype(np.int64)
        weight += [len(t) + 1 for t in tokens]
        weight += 16 * np.count_nonzero(counts, axis=1)
        piece = np.cumsum(weight) // PIECE_BYTES
        edges = np.concatenate([[0], np.flatnonzero(np.diff(piece)) + 1, [len(known)]])
        refs: list[list[dict]] = [[] for _ in edges[1:]]
        for k, b in enumerate(blobs):
            _into_pieces(b, inverse[starts[k]:starts[k + 1]], edges, refs)
        del blobs, hashes, inverse
        total = counts.sum(axis=1)
        seen = np.flatnonzero(total)
        by_code = np.zeros((2, 256, GATES), np.int64)
        code = (known >> np.uint64(56)).astype(np.int64)
        np.add.at(by_code[0], code, counts)
        np.add.at(by_code[1], code, counts > 0)
        sums = {"met": b" ".join([tokens[i] for i in seen.tolist()]), "met_times": total[seen].tobytes(),
                "n_distinct": int((total > 0).sum()), "n_single": int((total == 1).sum()),
                "by_gate": np.stack([counts.sum(axis=0), (counts > 0).sum(axis=0), ends]).ravel().tolist(),
                "by_code": by_code.ravel().tolist()}
        for k, (a, z) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            row = {"part": part, "tokens": b" ".join(tokens[a:z]), "counts": _packed(counts[a:z]), "refs": refs[k], "info": None}
            refs[k] = []
            yield pa.RecordBatch.from_pylist([row | (sums if not k else dict.fromkeys(sums))], schema)
    return run


def _into_pieces(blob: dict, index: np.ndarray, edges: np.ndarray, refs: list[list[dict]]) -> None:
    """A chunk's references of the tokens ``index``, for each piece of the part's
    tokens; a piece has the tokens from one of ``edges`` to the next."""
    degree = np.frombuffer(blob["degree"], np.uint32)
    docs, times = np.frombuffer(blob["docs"], np.uint16), np.frombuffer(blob["times"], np.uint8)
    piece = np.searchsorted(edges, index, "right") - 1
    of = np.repeat(piece, degree)
    for p in np.unique(piece).tolist():
        own, mine = piece == p, of == p
        refs[p].append({"chunk": blob["chunk"], "index": (index[own] - edges[p]).astype(np.uint32).tobytes(),
                        "gates": blob["gates"], "degree": degree[own].tobytes(),
                        "docs": docs[mine].tobytes(), "times": times[mine].tobytes()})


def _packed(counts: np.ndarray) -> bytes:
    """[token, gate] counts, most of them 0, as places and values."""
    token, of = np.nonzero(counts)
    return np.stack([token * GATES + of, counts[token, of]]).astype(np.int64).tobytes()


def _unpacked(data: bytes, tokens: int) -> np.ndarray:
    place, value = np.frombuffer(data, np.int64).reshape(2, -1)
    counts = np.zeros(tokens * GATES, np.int64)
    counts[place] = value
    return counts.reshape(tokens, GATES)


def _split(text: bytes) -> list[bytes]:
    return text.split(b" ") if text else []


def _known_tokens(batch, i) -> tuple[list[bytes], np.ndarray]:
    """Training tokens of a part, and how often they occur."""
    return _split(batch.column("met")[i].as_py()), np.frombuffer(batch.column("met_times")[i].as_py(), np.int64)


def _in_segments(table: np.ndarray):
    width = table.shape[1] // SEGMENTS
    cut = [table[:, s * width:(s + 1) * width].tobytes() for s in range(SEGMENTS)]
    if table.any():
        yield pa.RecordBatch.from_arrays([pa.array(range(SEGMENTS), pa.int32()), pa.array(cut, pa.binary())],
                                         names=["segment", "counts"])


def _count_tables(batches):
    """Bits of the spelled training tokens, each as often as it occurs."""
    table = np.zeros((2, mixing.ORDERS * mixing.SLOTS), np.int64)
    for batch in batches:
        for i in range(batch.num_rows):
            tokens, times = _known_tokens(batch, i)
            for a in range(0, len(tokens), SLICE):
                mixing.count(mixing.spell(tokens[a:a + SLICE]), table, times[a:a + SLICE])
    yield from _in_segments(table)


def _texts(batches, training: bool):
    """(chunk, hashes of words with ends, tokens a text, their classes) of chunks."""
    for batch in batches:
        for i in range(batch.num_rows):
            chunk, gates, train, sizes, told = (batch.column(k)[i].as_py() for k in range(5))
            seen = np.frombuffer(told, np.uint32)
            sizes, gates, train = np.array(sizes, np.int64), np.array(gates, np.int64), np.array(train, bool)
            if training:
                seen, sizes, gates = seen[np.repeat(train, sizes)], sizes[train], gates[train]
            if len(sizes):
                yield chunk, seen, sizes, gates


def _count_order(batches):
    """Bits of the words' codes after the words before, over all training texts."""
    table = np.zeros((2, mixing.WORD_ORDERS << mixing.WORD_SLOT_BITS), np.int64)
    for _, seen, sizes, gates in _texts(batches, True):
        mixing.count_bits(mixing.codes(seen), mixing.word_contexts(seen, sizes, gates), table, mixing.WORD_SLOT_BITS)
    yield from _in_segments(table)


def _joined(texts):
    """(words, sizes, classes) of chunks together, ordered by the hashes of
    their texts: neither small chunks nor their order tell in training."""
    held: list[tuple] = []

    def together():
        seen, sizes, gates = (np.concatenate(x) for x in zip(*held, strict=True))
        split = np.split(seen, np.cumsum(sizes)[:-1])
        order = np.argsort([zlib.crc32(t.tobytes()) for t in split], kind="stable")
        return np.concatenate([split[k] for k in order]), sizes[order], gates[order]

    for _, *text in texts:
        held.append(text)
        if sum(len(t[0]) for t in held) >= SLICE:
            yield together()
            held.clear()
    if held:
        yield together()


def _train_order(shared):
    def run(batches):
        mixer, table = shared.value
        n = 0
        for seen, sizes, gates in _joined(_texts(batches, True)):
            mixer = mixing.train_bytes(mixer, table, mixing.codes(seen), mixing.word_contexts(seen, sizes, gates))
            n += len(seen)
        if n:
            yield _learned(mixer, n)
    return run


def _price_order(shared):
    """Rows like those of ``_price``: the codes' part of the scores."""
    def run(batches):
        for chunk, seen, sizes, gates in _texts(batches, False):
            cost = shared.value.log10_bytes(mixing.codes(seen), mixing.word_contexts(seen, sizes, gates))
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64())] + [pa.array([x.tobytes()], pa.binary()) for x in (
                    np.arange(n, dtype=np.uint16), np.zeros(n, np.uint32), np.zeros(n),
                    np.add.reduceat(cost, np.cumsum(sizes) - sizes))], names=["chunk", "docs", "known", "base", "score"])
    return run


def _learned(mixer: mixing.Mixer, n: int) -> pa.RecordBatch:
    values = np.concatenate([mixer.weights.ravel(), mixer.refine.ravel()])
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(values)), pa.int32()), pa.array(values), pa.array(np.full(len(values), n))],
        names=["place", "value", "n"])


def _averaged(mixer: mixing.Mixer, learned: DataFrame) -> None:
    """Sets what the tasks learned, averaged by tokens."""
    rows = (learned.groupBy("place").agg((F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("value"))
            .orderBy("place").collect())
    if rows:
        values, n = np.array([r["value"] for r in rows]), mixer.weights.size
        mixer.weights, mixer.refine = values[:n].reshape(mixer.weights.shape), values[n:].reshape(256, -1)


def _summed(tables: DataFrame, slots: int) -> np.ndarray:
    table = np.zeros((2, slots), np.int64)
    width = slots // SEGMENTS
    for r in tables.groupBy("segment").applyInPandas(_sum_tables, "segment int, counts binary").collect():
        table[:, r["segment"] * width:(r["segment"] + 1) * width] = np.frombuffer(r["counts"], np.int64).reshape(2, -1)
    return table


def _trained(mixer: mixing.Mixer, table: np.ndarray, tokens: list[bytes], times: np.ndarray | None = None) -> mixing.Mixer:
    """One online pass over all ``tokens``, in bounded slices."""
    for a in range(0, len(tokens), SLICE):
        counted = {} if times is None else {"times": times[a:a + SLICE]}
        mixer = mixing.train_online(mixer, table, mixing.spell(tokens[a:a + SLICE]), **counted)
    return mixer


def _sum_tables(pdf: pd.DataFrame) -> pd.DataFrame:
    total = 0
    for data in pdf["counts"]:
        total = total + np.frombuffer(data, np.int64)
    return pd.DataFrame({"segment": [int(pdf["segment"].iloc[0])], "counts": [total.tobytes()]})


class Model:
    """The mixer with the totals that turn counts into probabilities."""

    def __init__(self, mixer: mixing.Mixer, distinct: int, single: int, by_gate: np.ndarray, by_code: np.ndarray):
        tokens, types, self.ends = by_gate
        self.mixer = mixer
        self.gate_total = np.maximum(tokens + self.ends, 1)
        self.gate_types = types + (self.ends > 0)
        self.total = int(tokens.sum() + self.ends.sum())
        self.distinct = distinct + int(self.ends.sum() > 0)
        self.novel = min(1.0, (single + 1) / (self.total + 1)) if self.total else 1.0
        self.gate_price = np.log10((self.ends + 1) / (self.ends.sum() + GATES))
        counts, types = by_code  # [code, gate]
        end = END_HASH >> 24
        counts[end] += self.ends
        types[end] += self.ends > 0
        everywhere = counts.sum(axis=1) / max(self.total, 1) * (1 - self.novel) + self.novel / 256
        self.code_price = np.log10((counts - DISCOUNT * types) / self.gate_total + self.left() * everywhere[:, None])

    def left(self) -> np.ndarray:
        return np.where(self.gate_types > 0, DISCOUNT * self.gate_types / self.gate_total, 1.0)

    def base(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the add-one share, from [token, gate] counts."""
        return np.log10(counts.sum(axis=1) + 1) - math.log10(self.total + self.distinct + 1)

    def token(self, spelled: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """[token, gate] log10 probabilities."""
        share = counts.sum(axis=1) / max(self.total, 1) * (1 - self.novel)
        everywhere = np.logaddexp(np.log(np.maximum(share, 1e-300)), math.log(self.novel) + spelled * math.log(10))
        own = np.maximum(counts - DISCOUNT, 0) / self.gate_total
        return np.logaddexp(np.log(np.maximum(own, 1e-300)), np.log(self.left()) + everywhere[:, None]) / math.log(10)


def _price(shared):
    def told(held: dict[int, np.ndarray]) -> pa.RecordBatch:
        out: dict[str, list] = {k: [] for k in ("chunk", "docs", "known", "base", "score")}
        for chunk, sums in held.items():
            docs = np.flatnonzero(sums[0])
            met, *rest = (x[docs] for x in sums[1:])
            for k, x in zip(out, (chunk, docs.astype(np.uint16), met.astype(np.uint32), *rest), strict=True):
                out[k].append(x if k == "chunk" else x.tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array(out["chunk"], pa.int64())] + [pa.array(out[k], pa.binary()) for k in list(out)[1:]], names=list(out))

    def run(batches):
        model = shared.value
        held: dict[int, np.ndarray] = {}  # [tokens, known, base, score] by document of a chunk
        part, size = None, 0
        for batch in batches:
            for i in range(batch.num_rows):
                tokens = _split(batch.column("tokens")[i].as_py())
                counts = _unpacked(batch.column("counts")[i].as_py(), len(tokens))
                base, known = model.base(counts), counts.any(axis=1)
                score = np.empty(counts.shape, np.float32)
                for a in range(0, len(tokens), SOME):
                    spelled = model.mixer.log10_tokens(mixing.spell(tokens[a:a + SOME]))
                    code = (word_hashes(tokens[a:a + SOME]) >> np.uint64(56)).astype(np.int64)
                    score[a:a + SOME] = model.token(spelled, counts[a:a + SOME]) - model.code_price[code]
                before, part = part, batch.column("part")[i].as_py()
                if held and before != part:
                    yield told(held)
                    held, size = {}, 0
                for ref in batch.column("refs")[i]:
                    ref = ref.as_py()
                    token = np.repeat(np.frombuffer(ref["index"], np.uint32), np.frombuffer(ref["degree"], np.uint32))
                    times = np.frombuffer(ref["times"], np.uint8).astype(np.float64)
                    docs, gates = np.frombuffer(ref["docs"], np.uint16), np.frombuffer(ref["gates"], np.uint8)
                    if ref["chunk"] not in held:
                        held[ref["chunk"]] = np.zeros((4, len(gates)))
                        size += 32 * len(gates)
                    for total, weight in zip(held[ref["chunk"]], (1, known[token], base[token], score[token, gates[docs]]), strict=True):
                        total += np.bincount(docs, weights=times * weight, minlength=len(gates))
                    if size >= HELD_BYTES:
                        yield told(held)
                        held, size = {}, 0
        if held:
            yield told(held)
    return run


def _finish(end_base: float, end_scores: np.ndarray, end_known: bool, total: int):

    def run(infos: pd.DataFrame, sums: pd.DataFrame) -> pd.DataFrame:
        if not len(infos):
            return pd.DataFrame()
        info = infos.iloc[0]
        n = len(info["doc_id"])
        out = {"known": np.full(n, float(end_known)), "base": np.full(n, end_base), "score": end_scores[np.array(info["gate"], np.int64)]}
        for docs, known, base, score in zip(sums["docs"], sums["known"], sums["base"], sums["score"], strict=True):
            at = np.frombuffer(docs, np.uint16)
            out["known"][at] += np.frombuffer(known, np.uint32)
            out["base"][at] += np.frombuffer(base)
            out["score"][at] += np.frombuffer(score)
        ids = pd.array([None if x is None or x != x else int(x) for x in info["doc_id"]], dtype="Int64")
        size = np.array(info["n_bytes"], float)
        return pd.DataFrame({
            "doc_id": ids, "held_out": np.array(info["held"], bool), "n_tokens": np.array(info["n_tokens"], np.int64),
            "n_known": out["known"].astype(np.int64), "train_tokens": np.full(n, total, np.int64),
            "base_score": out["base"], "score": out["score"],
            "bits_per_byte": -out["score"] / math.log10(2) / np.maximum(size, 1)})
    return run


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte) of every whole text; the others than ``held_out`` train."""
    spark = docs.sparkSession
    bounded_batches(spark)
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(1, math.ceil(size / PART_BYTES))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"),
                       F.coalesce(~held_out, F.lit(False)).alias("train"),
                       F.coalesce(held_out, F.lit(False)).alias("held"))
    schema = f"part int, info struct<{_struct(_INFO)}>, blob struct<{_struct(_BLOB)}>"
    arrow = _arrow_schema(spark, schema)
    of_part = ("part int, tokens binary, counts binary, met binary, met_times binary, "
               "refs array<struct<chunk:long,index:binary,gates:binary,degree:binary,docs:binary,times:binary>>, "
               f"info struct<{_struct(_INFO)}>, n_distinct long, n_single long, by_gate array<long>, by_code array<long>")
    merged = save(rows.mapInArrow(_chunks(parts, arrow), schema).groupBy("part").applyInArrow(
        _merge(_arrow_schema(spark, of_part)), of_part), "parts", **LARGE_ROWS)
    tables, infos = merged.where("tokens IS NOT NULL"), merged.where("info IS NOT NULL").select("info.*")
    distinct, single, *by_gate = merged.agg(
        *[F.coalesce(F.sum(c), F.lit(0)) for c in
          ("n_distinct", "n_single", *[F.get("by_gate", F.lit(k)) for k in range(3 * GATES)])]).first()

    by_code = np.zeros(2 * 256 * GATES, np.int64)
    for r in merged.select(F.posexplode("by_code").alias("place", "n")).groupBy("place").agg(F.sum("n").alias("n")).collect():
        by_code[r["place"]] = r["n"]

    tasks = max(12, parts // 8)
    spelled = merged.where("met IS NOT NULL").select("met", "met_times").coalesce(tasks)
    table = _summed(spelled.mapInArrow(_count_tables, "segment int, counts binary"), mixing.ORDERS * mixing.SLOTS)
    mixer = mixing.start(table)
    shared_table = spark.sparkContext.broadcast((mixer, np.minimum(table, 2 ** 31 - 1).astype(np.int32)))

    def online(batches):
        mixer, table = shared_table.value
        for batch in batches:
            for i in range(batch.num_rows):
                tokens, times = _known_tokens(batch, i)
                if tokens:
                    yield _learned(_trained(mixer, table, tokens, times), len(tokens))

    _averaged(mixer, spelled.mapInArrow(online, "place int, value double, n long"))

    texts = infos.select("chunk", "gate", "train", "n_tokens", "words")
    table = _summed(texts.coalesce(tasks).mapInArrow(_count_order, "segment int, counts binary"),
                    mixing.WORD_ORDERS << mixing.WORD_SLOT_BITS)
    order = mixing.start(table, mixing.WORD_ORDERS, mixing.WORD_SLOT_BITS, 1)
    shared_order = spark.sparkContext.broadcast((order, np.minimum(table, 2 ** 31 - 1).astype(np.int32)))
    _averaged(order, texts.mapInArrow(_train_order(shared_order), "place int, value double, n long"))

    model = Model(mixer, distinct, single, np.array(by_gate, np.int64).reshape(3, GATES), by_code.reshape(2, 256, GATES))
    ends = model.ends[None, :]
    end = (float(model.base(ends)[0]), model.token(mixer.log10_tokens(mixing.END), ends)[0] - model.code_price[END_HASH >> 24] + model.gate_price,
           bool(model.ends.sum() > 0))
    shared = spark.sparkContext.broadcast(model)
    priced = tables.select("part", "tokens", "counts", "refs").mapInArrow(
        _price(shared), "chunk long, docs binary, known binary, base binary, score binary")
    ordered = texts.mapInArrow(_price_order(spark.sparkContext.broadcast(order)), priced.schema)
    priced = priced.unionByName(ordered)
    return infos.drop("words").groupBy("chunk").cogroup(priced.withColumnRenamed("chunk", "of").groupBy("of")).applyInPandas(
        _finish(*end, model.total), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double, bits_per_byte double")


def _struct(fields: str) -> str:
    return ",".join(f"{name}:{kind}" for name, kind in (f.strip().split(" ", 1) for f in fields.split(", ")))


def _arrow_schema(spark, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)
