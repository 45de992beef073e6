"""Online logistic context mixing over the bits of a token.

A token is spelled as its bytes and a closing space; the end of a text is one
line feed.  Every bit is predicted from hashed contexts: the place in the
token and the 1 to 5 bytes before, together with the bits of the byte so far.
A slot counts zeros and ones; its stretched ratio is the predictor's vote.
Votes are combined by weights chosen by a gate (bit number and how often the
four-byte context was seen), trained online by gradient steps on the coding
cost, with a token's own counts left out.  The mixed probability is refined by
an adaptive map (interpolated buckets of the vote per bit node), trained in
the same pass.

The order of words is mixed in the same way: every word, the end of a text too,
stands for a byte of its hash, whose bits are predicted from the class of the
text and the one and two words before, counted wherever they occur.

All tables have a fixed size: ``ORDERS`` times ``2**SLOT_BITS`` slots, and
``WORD_ORDERS`` times ``2**WORD_SLOT_BITS``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .common import mix64

ORDERS = 6
SLOT_BITS = 18
SLOTS = 1 << SLOT_BITS
PRIOR = 0.4
GATES = 8 * 6
BUCKETS = 25            # of the adaptive map, from -12 to 12
SLICE = 1 << 14         # bytes handled at once
BATCH = 512             # bits of a gradient step
WORD_ORDERS = 3
WORD_SLOT_BITS = 19
END = b"\n"

_NODE = np.uint64(0xD6E8FEB86659FD93)
_LEVELS = np.arange(8)
_BITS = (np.arange(256)[:, None] >> (7 - _LEVELS)) & 1
_NODES = (256 | np.arange(256)[:, None]) >> (8 - _LEVELS)
_LOGS = np.log(np.arange(1 << 16) + PRIOR)
_STEPS = np.array([3, 15, 63, 255, 1023])


def spell(tokens: list[bytes]) -> bytes:
    return b" ".join(tokens) + b" " if tokens else b""


def _by_order(contexts: np.ndarray) -> np.ndarray:
    """Hashes [byte, order] that tell the orders apart, in place and one order at
    a time, so that no further copies of all are held."""
    orders = contexts.shape[1]
    for k in range(orders):
        with np.errstate(over="ignore"):
            contexts[:, k] = mix64(contexts[:, k] * np.uint64(orders) + np.uint64(k))
    return contexts


def byte_contexts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, [byte, order] context hashes) of spelled tokens."""
    x = np.frombuffer(data, np.uint8)
    n = len(x)
    opens = np.ones(n, bool)
    opens[1:] = x[:-1] == 0x20
    start = np.maximum.accumulate(np.where(opens, np.arange(n), 0))
    place = np.arange(n) - start
    before = np.zeros(n, np.uint64)
    out = np.empty((n, ORDERS), np.uint64)
    out[:, 0] = np.minimum(place, 5).astype(np.uint64)
    for k in range(1, ORDERS):
        previous = np.zeros(n, np.uint64)
        previous[k:] = x[:-k]
        before |= np.where(place >= k, previous, np.uint64(0)) << np.uint64(8 * (k - 1))
        out[:, k] = before
    return x, _by_order(out)


def word_contexts(tokens: np.ndarray, sizes: np.ndarray, gates: np.ndarray) -> np.ndarray:
    """[token, order] context hashes of texts of ``sizes`` tokens, given by the
    hashes of their words: the class of the text, one and two words before."""
    n = len(tokens)
    place = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    one[1:], two[2:] = tokens[:-1], tokens[:-2]
    one[place < 1] = 1 << 32  # no hash of 32 bits
    two[place < 2] = 1 << 32
    out = np.stack([np.repeat(gates, sizes).astype(np.uint64), one, mix64(one) ^ two], axis=1)
    for k in range(WORD_ORDERS):
        out[:, k] = mix64(out[:, k])
    return _by_order(out)


def codes(hashes: np.ndarray) -> np.ndarray:
    """The byte that stands for a word: the first of its hash (32 bits)."""
    return (hashes >> np.uint32(24)).astype(np.uint8)


def bits_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[byte, bit] bits and nodes."""
    return _BITS.take(x, axis=0), _NODES.take(x, axis=0)


def places(nodes: np.ndarray, contexts: np.ndarray, order: int, slot_bits: int = SLOT_BITS) -> np.ndarray:
    """[byte, bit] slots of one order among those of all."""
    with np.errstate(over="ignore"):
        at = nodes.view(np.uint64) * _NODE
        at += (contexts[:, order] * _NODE)[:, None]
    at >>= np.uint64(64 - slot_bits)
    at += np.uint64(order << slot_bits)
    return at.view(np.int64)


def slots(x: np.ndarray, contexts: np.ndarray, slot_bits: int = SLOT_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """([byte, bit, order] slots over all orders, [byte, bit] bits and nodes)."""
    bits, nodes = bits_of(x)
    return np.stack([places(nodes, contexts, k, slot_bits) for k in range(contexts.shape[1])], axis=2), bits, nodes


def count_bits(x: np.ndarray, contexts: np.ndarray, table: np.ndarray, slot_bits: int = SLOT_BITS,
               times: np.ndarray | None = None) -> None:
    """Adds every bit of the bytes to ``table`` [bit, slot], each ``times`` over."""
    flat, width = table.reshape(-1), table.shape[1]
    for a in range(0, len(x), SLICE):
        bits, nodes = bits_of(x[a:a + SLICE])
        ones = bits * width
        many = 1 if times is None else np.repeat(times[a:a + SLICE], bits.shape[1])
        for k in range(contexts.shape[1]):
            np.add.at(flat, (places(nodes, contexts[a:a + SLICE], k, slot_bits) + ones).reshape(-1), many)


def count(data: bytes, table: np.ndarray, times: np.ndarray | None = None) -> None:
    """Adds every bit of the spelled tokens to ``table`` [bit, slot], as often as
    a token occurs (once without ``times``)."""
    if data:
        x, contexts = byte_contexts(data)
        count_bits(x, contexts, table, times=None if times is None else by_byte(x, times))


def by_byte(x: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Values of spelled tokens, for each of their bytes."""
    return np.repeat(times, np.diff(np.flatnonzero(x == 0x20), prepend=-1))


@dataclass
class Mixer:
    votes: np.ndarray        # [slot] stretched ratio
    seen: np.ndarray         # [slot] gate step of how often the slot was seen
    weights: np.ndarray      # [gate, order]
    refine: np.ndarray       # [node, bucket] probabilities
    slot_bits: int = SLOT_BITS
    gate_order: int = 4      # the order whose slots choose the gate

    def _mix(self, votes, gates):
        return np.clip((self.weights[gates] * votes).sum(axis=-1), -11.99, 11.99)

    def _refined(self, mixed, nodes):
        place = mixed + (BUCKETS // 2)
        low = place.astype(np.int64)
        part = place - low
        low += nodes * BUCKETS
        mapped = self.refine.reshape(-1)
        mapped = mapped.take(low) * (1 - part) + mapped.take(low + 1) * part
        return np.clip(0.5 * (1 / (1 + np.exp(-mixed)) + mapped), 1e-6, 1 - 1e-6)

    def log10_bytes(self, x: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """log10 probability of every byte."""
        cost = np.empty(len(x))
        weights = np.ascontiguousarray(self.weights.T)
        for a in range(0, len(x), SLICE):
            own = contexts[a:a + SLICE]
            bits, nodes = bits_of(x[a:a + SLICE])
            gates = _LEVELS * 6 + self.seen.take(places(nodes, own, self.gate_order, self.slot_bits))
            mixed = np.zeros(bits.shape)
            for k in range(len(weights)):
                mixed += weights[k].take(gates) * self.votes.take(places(nodes, own, k, self.slot_bits))
            p = self._refined(np.clip(mixed, -11.99, 11.99), nodes)
            cost[a:a + SLICE] = np.log10(np.where(bits == 1, p, 1 - p).prod(axis=1))
        return cost

    def log10_tokens(self, data: bytes) -> np.ndarray:
        """log10 probability of every spelled token in ``data``."""
        if not data:
            return np.empty(0)
        x, contexts = byte_contexts(data)
        cost = self.log10_bytes(x, contexts)
        closing = np.flatnonzero((x == 0x20) | (x == 0x0A))
        opening = np.concatenate([[0], closing[:-1] + 1])
        return np.add.reduceat(cost, opening)


def gate_steps(total: np.ndarray) -> np.ndarray:
    return np.searchsorted(_STEPS, total, "right")


def _logs(counts: np.ndarray) -> np.ndarray:
    """log(count + PRIOR)."""
    out = _LOGS.take(counts, mode="clip")
    large = counts >= len(_LOGS)
    if large.any():
        out[large] = np.log(counts[large] + PRIOR)
    return out


def start(table: np.ndarray, orders: int = ORDERS, slot_bits: int = SLOT_BITS, gate_order: int = 4) -> Mixer:
    zeros, ones = table[0].astype(np.float64), table[1].astype(np.float64)
    votes = np.log((ones + PRIOR) / (zeros + PRIOR)).astype(np.float32)
    centers = 1 / (1 + np.exp(-(np.arange(BUCKETS) - BUCKETS // 2.0)))
    return Mixer(votes, gate_steps(zeros + ones).astype(np.int8),
                 np.full((GATES, orders), 0.3), np.tile(centers, (256, 1)), slot_bits, gate_order)


def train_online(mixer: Mixer, table: np.ndarray, data: bytes, rate: float = 0.02, batch: int = BATCH,
                 times: np.ndarray | None = None) -> Mixer:
    """One online pass over spelled tokens, each of which the table has counted
    ``times`` over (once without): its own counts are left out of its votes, so
    that it is met as a new word."""
    if not data:
        return train_bytes(mixer, table, np.empty(0, np.uint8), np.empty((0, ORDERS), np.uint64))
    x, contexts = byte_contexts(data)
    return train_bytes(mixer, table, x, contexts, rate, batch, None if times is None else by_byte(x, times))


def train_bytes(mixer: Mixer, table: np.ndarray, x: np.ndarray, contexts: np.ndarray, rate: float = 0.02,
                batch: int = BATCH, own: np.ndarray | None = None) -> Mixer:
    """One online pass over bytes that the table has counted ``own`` times."""
    weights, refine = mixer.weights.copy(), mixer.refine.copy()
    out = Mixer(mixer.votes, mixer.seen, weights, refine, mixer.slot_bits, mixer.gate_order)
    orders, flat, near_map = weights.shape[1], weights.reshape(-1), refine.reshape(-1)
    for a in range(0, len(x), SLICE):
        bits, nodes = bits_of(x[a:a + SLICE])
        left = 1 if own is None else own[a:a + SLICE, None]
        off = bits * left, (1 - bits) * left
        votes = np.empty((bits.size, orders))
        for k in range(orders):
            at = places(nodes, contexts[a:a + SLICE], k, mixer.slot_bits)
            ones, zeros = np.maximum(table[1].take(at) - off[0], 0), np.maximum(table[0].take(at) - off[1], 0)
            votes[:, k] = (_logs(ones) - _logs(zeros)).reshape(-1)
            if k == mixer.gate_order:
                gates = (_LEVELS * 6 + gate_steps(ones + zeros)).reshape(-1)
        bits, nodes = bits.reshape(-1), nodes.reshape(-1) * BUCKETS + BUCKETS // 2
        cells = gates[:, None] * orders + np.arange(orders)
        used = np.bincount(np.arange(len(bits)) // batch * GATES + gates, minlength=-(-len(bits) // batch) * GATES)
        rates = np.repeat(rate / np.sqrt(np.maximum(used, 1)), orders).reshape(-1, GATES * orders)
        for n, b in enumerate(range(0, len(bits), batch)):
            cell, v, y, node = cells[b:b + batch], votes[b:b + batch], bits[b:b + batch], nodes[b:b + batch]
            mixed = np.minimum(np.maximum(np.einsum("ij,ij->i", flat.take(cell), v), -11.99), 11.99)
            error = y - 1 / (1 + np.exp(-mixed))
            flat += rates[n] * np.bincount(cell.reshape(-1), (error[:, None] * v).reshape(-1), GATES * orders)
            near = node + np.rint(mixed).astype(np.int64)
            np.add.at(near_map, near, 0.02 * (y - near_map.take(near)))
        np.clip(refine, 1e-4, 1 - 1e-4, out=refine)
    return out
