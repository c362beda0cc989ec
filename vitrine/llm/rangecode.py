"""Adaptive context-mixing range coder for blocks of token ids.

A block holds the ids of whole documents and is decoded without any other block: all
model state starts afresh with it, and its bytes end with a checksum. Inside a block the
ids are cut into lanes of equal length that are coded in step, so every operation is
one NumPy operation over all lanes; lanes share the model, which therefore learns from all of them.

The model predicts an id in three ways: order 2 and order 1 by the id that last followed
the last two ids or the last one, each with a confidence; order 0 by the counts of all
ids so far. Integer weights, counted per pair of confidences, mix the three: an id is coded as
"the order-2 prediction", "the order-1 prediction" or an order-0 id. Arithmetic is in integers only, so
every machine decodes alike.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"LNC1"
HEADER = "<4sIIII"  # magic, vocabulary, ids, lanes, crc32 of the ids
HEADER_SIZE = struct.calcsize(HEADER)
TAIL = "<I"  # crc32 of all bytes before
MAX_LANES, LEAST_STEPS = 8192, 256
MIX_BITS, ZERO_BITS = 16, 18
CONTEXT_BITS = 20
CHECK_STEPS = 64
_U = np.uint64
_FULL, _TOP, _LEAST = _U(2**64 - 1), _U(2**56), _U(2**48)
_S8, _S56 = _U(8), _U(56)
_ZERO, _ALL, _LAST = _U(ZERO_BITS), _U(MIX_BITS + ZERO_BITS), _U((1 << ZERO_BITS) - 1)


class CorruptBlock(ValueError):
    pass


class Model:
    """Predictions shared by all lanes; ``learn`` is called alike by encoder and decoder."""

    def __init__(self, vocabulary: int):
        if vocabulary > 1 << (ZERO_BITS - 1):
            raise ValueError(f"at most {1 << (ZERO_BITS - 1)} different ids")
        self.v = vocabulary
        # Entries are 4 * predicted id + confidence (0 to 3).
        self.one, self.two = np.zeros(vocabulary, np.int64), np.zeros(1 << CONTEXT_BITS, np.int64)
        self.counts = np.zeros(vocabulary, np.int64)
        self.seen, self.due, self.waiting = 0, 1024, []
        self.chosen = np.ones((32, 3), np.int64)
        self._mix()
        self._zero()

    def _mix(self) -> None:
        total = self.chosen.sum(1, keepdims=True)
        weights = 1 + self.chosen * ((1 << MIX_BITS) - 3) // total
        weights[:, 2] += (1 << MIX_BITS) - weights.sum(1)
        # Flat, by 3 * context + choice.
        self.mix = weights.astype(_U).reshape(-1)
        self.mix_start = (np.cumsum(weights, 1) - weights).astype(_U).reshape(-1)
        self.mix_one, self.mix_two = self.mix_start[1::3].copy(), self.mix_start[2::3].copy()

    def _zero(self) -> None:
        free = (1 << ZERO_BITS) - self.v
        freq = 1 + self.counts * free // max(1, int(self.counts.sum()))
        freq[int(np.argmax(freq))] += (1 << ZERO_BITS) - int(freq.sum())
        self.zero = freq.astype(_U)
        self.zero_start = (np.cumsum(freq) - freq).astype(_U)
        self.zero_id = np.repeat(np.arange(self.v), freq)

    def look(self, last: np.ndarray, before: np.ndarray) -> None:
        """Predictions for lanes whose last two ids are given."""
        self.last = last
        self.slot = (before * 40503 + last * 24593) & ((1 << CONTEXT_BITS) - 1)
        self.e1, self.e2 = self.one.take(last), self.two.take(self.slot)
        self.c1, self.c2 = self.e1 >> 2, self.e2 >> 2
        self.f1, self.f2 = self.e1 & 3, self.e2 & 3
        self.context = self.f2 * 8 + self.f1 * 2 + (self.c1 == self.c2)

    def learn(self, ids: np.ndarray, event: np.ndarray) -> None:
        """``event`` is 3 * context + choice."""
        first = ids * 4 + 1
        for table, at, e, c, f in ((self.one, self.last, self.e1, self.c1, self.f1), (self.two, self.slot, self.e2, self.c2, self.f2)):
            moved = e + np.where(c == ids, f < 3, -1)
            table[at] = np.where(f == 0, first, moved)
        self.chosen += np.bincount(event, minlength=96).reshape(32, 3)
        self.waiting.append(ids)
        self.seen += len(ids)
        if self.seen >= self.due:
            self.counts += np.bincount(np.concatenate(self.waiting), minlength=self.v)
            self.waiting = []
            self.due = self.seen + max(1024, min(self.seen // 2, 1 << 18))
            self._zero()
            self._mix()


def _shape(n: int) -> tuple[int, int]:
    lanes = max(1, min(MAX_LANES, n // LEAST_STEPS))
    return lanes, -(-n // lanes)


def _narrow(low: np.ndarray, width: np.ndarray, spill) -> None:
    """Shift out the leading bytes that are settled, in place; ``spill(lanes)`` is told of each byte before it goes.

    A byte is settled where both ends of the interval have it; an interval that straddles a
    boundary and is too thin is cut at the boundary, so no carry ever runs back.
    """
    lanes, lo, w = None, low, width
    while True:
        same = (lo ^ (lo + w)) < _TOP
        thin = (w < _LEAST) & ~same
        some = np.flatnonzero(same | thin)
        if not len(some):
            return
        cut = thin.take(some)
        lanes = some if lanes is None else lanes.take(some)
        lo, w = lo.take(some), w.take(some)
        if cut.any():
            w = np.where(cut, (_U(0) - lo) & (_LEAST - _U(1)), w)
        spill(lanes, lo)
        lo <<= _S8
        w <<= _S8
        low[lanes], width[lanes] = lo, w


def encode(ids: np.ndarray, vocabulary: int) -> bytes:
    """One block of ids below ``vocabulary``."""
    ids = np.ascontiguousarray(ids, "<u4")
    n = len(ids)
    lanes, steps = _shape(n)
    if n and int(ids.max()) >= vocabulary:
        raise ValueError("an id is outside the vocabulary")
    grid = np.zeros(lanes * steps, np.int64)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    model = Model(vocabulary)
    low, width = np.zeros(lanes, _U), np.full(lanes, _FULL)
    room = 3 * steps + 16 * CHECK_STEPS  # bytes per lane; grows where a lane comes near its end
    out, at = np.zeros(lanes * room, np.uint8), np.zeros(lanes, np.int64)

    def put(who: np.ndarray, lo: np.ndarray) -> None:
        place = at.take(who)
        out[who * room + place] = lo >> _S56
        at[who] = place + 1

    last, before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    for t in range(steps):
        active = max(0, -(-(n - t) // steps))
        if t % CHECK_STEPS == 0 and int(at.max()) + 16 * CHECK_STEPS > room:
            out = np.concatenate([out.reshape(lanes, room), np.zeros((lanes, room), np.uint8)], 1).reshape(-1)
            room *= 2
        now = grid[t, :active]
        model.look(last[:active], before[:active])
        choice = np.where((now == model.c2) & (model.f2 > 0), 0, np.where((now == model.c1) & (model.f1 > 0), 1, 2))
        event = model.context * 3 + choice
        start, freq = model.mix_start.take(event) << _ZERO, model.mix.take(event)
        rest = np.flatnonzero(choice == 2)
        coded, share = now.take(rest), freq.take(rest)
        freq <<= _ZERO
        start[rest] += share * model.zero_start.take(coded)
        freq[rest] = share * model.zero.take(coded)
        unit = width[:active] >> _ALL
        low[:active] += start * unit
        width[:active] = freq * unit
        _narrow(low[:active], width[:active], put)
        model.learn(now, event)
        before[:active], last[:active] = last[:active], now
    for _ in range(8):  # the rest of every lane's interval
        put(np.arange(lanes), low)
        low <<= _S8
    data = out.reshape(lanes, room)[np.arange(room)[None, :] < at[:, None]]
    head = struct.pack(HEADER, MAGIC, vocabulary, n, lanes, zlib.crc32(ids.tobytes()))
    body = head + at.astype("<u4").tobytes() + data.tobytes()
    return body + struct.pack(TAIL, zlib.crc32(body))


def decode(block: bytes) -> np.ndarray:
    """The ids of a block, or CorruptBlock."""
    body = block[:-4]
    if len(block) < HEADER_SIZE + 4 or zlib.crc32(body) != struct.unpack(TAIL, block[-4:])[0]:
        raise CorruptBlock("the checksum of the block does not hold")
    magic, vocabulary, n, lanes, crc = struct.unpack_from(HEADER, body)
    if magic != MAGIC:
        raise CorruptBlock("not a block of this format")
    steps = -(-n // lanes)
    sizes = np.frombuffer(body, "<u4", lanes, HEADER_SIZE).astype(np.int64)
    data = np.frombuffer(body + bytes(8), np.uint8, offset=HEADER_SIZE + 4 * lanes)
    at = np.cumsum(sizes) - sizes
    low, width, code = np.zeros(lanes, _U), np.full(lanes, _FULL), np.zeros(lanes, _U)
    for _ in range(8):
        code = (code << _S8) | data.take(at)
        at += 1

    def get(who: np.ndarray, lo: np.ndarray) -> None:
        place = at.take(who)
        code[who] = (code.take(who) << _S8) | data.take(place)
        at[who] = place + 1

    model = Model(vocabulary)
    grid = np.zeros((steps, lanes), np.int64)
    last, before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    for t in range(steps):
        active = max(0, -(-(n - t) // steps))
        model.look(last[:active], before[:active])
        unit = width[:active] >> _ALL
        value = (code[:active] - low[:active]) // unit
        coarse = value >> _ZERO
        choice = (coarse >= model.mix_one.take(model.context)).astype(np.int64) + (coarse >= model.mix_two.take(model.context))
        event = model.context * 3 + choice
        start, freq = model.mix_start.take(event) << _ZERO, model.mix.take(event)
        now = np.where(choice == 0, model.c2, model.c1)
        rest = np.flatnonzero(choice == 2)
        share = freq.take(rest)
        fine = np.minimum((value.take(rest) - start.take(rest)) // share, _LAST)
        found = model.zero_id.take(fine.astype(np.int64))
        now[rest] = found
        freq <<= _ZERO
        start[rest] += share * model.zero_start.take(found)
        freq[rest] = share * model.zero.take(found)
        low[:active] += start * unit
        width[:active] = freq * unit
        _narrow(low[:active], width[:active], get)
        grid[t, :active] = now
        model.learn(now, event)
        before[:active], last[:active] = last[:active], now
    ids = np.ascontiguousarray(grid.T).reshape(-1)[:n].astype("<u4")
    if zlib.crc32(ids.tobytes()) != crc:
        raise CorruptBlock("the ids of the block do not have their checksum")
    return ids
