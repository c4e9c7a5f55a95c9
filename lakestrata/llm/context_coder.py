"""Adaptive context-mixing range coder of id blocks.

Each block starts from an empty model and is coded on its own. Its model has three
predictions of the next id:

* order 2: the id that followed the last two ids before, with its hit probability;
* order 1: the same after the last id;
* order 0: given frequencies of all ids, which the blocks of a segment share.

The probability that the order-2 id comes, and then that the order-1 id does, is
mixed from what both orders give their ids: each pair of chances has a cell that
begins at their logistic mix and learns from what comes. What remains is coded by
order 0. The resulting interval narrows
a 62-bit range, which sends 32 bits as soon as it has become small.

All results are those of integers, so any machine decodes what another has coded. Many
blocks go through the coder abreast: a step codes one id of each. A step's numbers are of
one width where they can be, as numpy takes several times as long to convert and to choose.
"""

from __future__ import annotations

from decimal import Decimal
from functools import cache
from itertools import pairwise

import numpy as np

#: Ids of a block.
BLOCK = 4096
#: Blocks that are coded abreast.
LANES = 2048
#: Entries of the order-1 and order-2 tables, as powers of two.
BITS_1, BITS_2 = 10, 12
#: The frequencies of order 0 add up to 2 to at most this.
TOTAL_BITS = 18
_U, _N, _I = np.uint64, np.uint32, np.int32


@cache
def _u(value: int) -> np.ndarray:
    """A 64-bit constant; arrays take much less time to combine with than scalars."""
    return np.array(value, _U)


@cache
def _n(value: int) -> np.ndarray:
    """A 32-bit constant."""
    return np.array(value, _N)


#: Hit probabilities of 16 bits: of a new entry, and below which an entry is given up.
_NEW, _GIVE_UP = 16_384, 6_000
#: A range below this sends a word of 32 bits; the 30 bits below the word stay.
_REST = 30
_SMALL, _REST_BITS = _u(1 << _REST), _u((1 << _REST) - 1)
_HASH, _HASH_2 = _n(0x9E3779B1), _n(0x2545F)


#: Mixed chances stay within these; order 1 and order 0 have at least 64 of 65536, so that the range has room for each frequency.
_LEAST, _MOST = 512, 65_024
_FOR_BOTH = _n(65536 - 64)
_SPREAD, _FLOOR, _RATE = (np.array(x, _I) for x in (_MOST - _LEAST, _LEAST, 5))


def _mixed() -> np.ndarray:
    """Where the cells begin, in 65536ths. First, for two ids (0) or one (1) of both orders,
    and 8 levels of the chances of order 2 and order 1: that the order-2 id comes. Then, for both
    chances: that the order-1 id comes after all. In decimals, so that all machines agree."""
    logit = [((Decimal(q) + Decimal("0.5")) / (Decimal("7.5") - q)).ln() for q in range(8)]
    votes = [logit[a] - max(logit[b], Decimal(0)) / 2 for a in range(8) for b in range(8)]
    votes += [logit[a] + (logit[b] + 1) / 2 for a in range(8) for b in range(8)]
    votes += [logit[b] - max(logit[a], Decimal(0)) / 2 for a in range(8) for b in range(8)]
    return np.array([min(max(int(65536 / (1 + (-v).exp())), _LEAST), _MOST) for v in votes], np.int32)


MIXED = _mixed()


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Order-0 frequencies of ids that occur ``counts`` times: at least 1 each, together a power of two."""
    total = 1 << min(len(counts).bit_length() + 3, TOTAL_BITS)
    counts = counts.astype(np.int64)
    often = counts * (total - len(counts)) // max(int(counts.sum()), 1) + 1
    often[counts.argmax()] += total - often.sum()
    return often.astype("<u4")


class _Model:
    """The models of ``lanes`` blocks over ids of order-0 frequencies ``often``. Arrays of two
    rows have order 2 in the first and order 1 in the second."""

    def __init__(self, lanes: int, often: np.ndarray):
        self.lanes = lanes
        lane = np.arange(lanes, dtype=np.int64)
        self.at = np.stack((lane << BITS_2, (lanes << BITS_2) + (lane << BITS_1)))
        self.table = np.zeros(lanes * ((1 << BITS_2) + (1 << BITS_1)), _N)
        # a cell of all lanes lies side by side, as most lanes use the same few cells
        self.mix, self.at_mix = np.repeat(MIXED, lanes), np.stack((lane, lane + 128 * lanes)).astype(_N)
        self.last, self.before = np.zeros(lanes, _N), np.zeros(lanes, _N)
        # order 0: where an id begins (upper half) and its frequency; 0 stands for all ids, where another order has coded
        self.bits = _u(int(often.sum()).bit_length() - 1)
        cum = np.cumsum(often, dtype=_U)
        self.zero = np.append(_u(1) << self.bits, (cum - often) << _u(32) | often)

    def predict(self, k: int) -> None:
        """Of the first k lanes: the candidates ``ids`` and their shares of 65536."""
        context = np.empty((2, k), _N)
        np.multiply(self.before[:k], _HASH_2, out=context[0])
        context[0] += self.last[:k]
        context[0] >>= _n(32 - BITS_2)
        np.right_shift(self.last[:k], _n(32 - BITS_1), out=context[1])
        where = context.astype(np.int64)
        where += self.at[:, :k]
        entry = self.table.take(where)
        ids, chance = entry >> _n(16), entry & _n(0xFFFF)
        same = (ids[0] == ids[1]).astype(_N)
        cell = chance >> _n(13)
        cell[0] <<= _n(3)
        cell[1] += cell[0]
        np.left_shift(same, _n(6), out=cell[0])
        cell[0] += cell[1]
        cell *= _n(self.lanes)
        cell += self.at_mix[:, :k]
        cell = cell.astype(np.int64)
        mixed = self.mix.take(cell)
        same -= _n(1)  # all ones where the candidates differ
        self.share_2, one = mixed.view(_N)
        one = (_FOR_BOTH - self.share_2) * one
        one >>= _n(16)
        np.maximum(one, _n(64), out=one)
        one &= same
        self.share_1 = one
        self.ids, self.where, self.entry, self.chance, self.differ, self.cell, self.mixed = ids, where, entry, chance, same, cell, mixed

    def interval(self, other: np.ndarray, neither: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where it begins, its share) in 65536ths; ``other`` is 1 where the order-2 id does not come."""
        begin = other * self.share_2
        rest = _n(65536) - self.share_2
        rest -= self.share_1
        part = self.share_2 - begin
        begin += neither * self.share_1
        rest *= neither
        part += rest
        part += (other - neither) * self.share_1
        return begin.astype(_U), part.astype(_U)

    def learn(self, k: int, ids: np.ndarray, hit: np.ndarray) -> None:
        """``hit``: 1 where a candidate came."""
        mixed = self.mixed
        step = hit.view(_I) * _SPREAD
        step += _FLOOR
        step -= mixed
        step >>= _RATE
        step[1] *= ((hit[0] ^ _n(1)) & self.differ).view(_I)
        step += mixed
        self.mix[self.cell] = step
        chance = self.chance
        change = _n(65535) - chance
        change >>= _n(3)
        fall = chance >> _n(2)
        change += fall
        change *= hit
        change -= fall  # modulo 2 to 32
        chance += change
        kept = self.entry
        kept += change
        new = ids << _n(16)
        new |= _n(_NEW)
        new = new - kept
        chance -= _n(_GIVE_UP)
        chance >>= _n(31)  # 1 where it is given up
        new *= chance
        kept += new
        self.table[self.where] = kept
        self.before[:k] = self.last[:k]
        np.multiply(ids, _HASH, out=self.last[:k])


def _steps(lengths: np.ndarray):
    """(step, lanes that still have an id); lanes are in falling order of length."""
    most = int(lengths[0]) if len(lengths) else 0
    active = len(lengths) - np.searchsorted(lengths[::-1], np.arange(most), side="right")
    return zip(range(most), active.tolist(), strict=True)


def encode(ids: np.ndarray, lengths: np.ndarray, size: int, often: np.ndarray | None = None) -> list[bytes]:
    """The payload of each block: ``ids`` is a row a step and a column a block, blocks
    in falling order of length; all ids are below ``size``. ``often`` are the
    ``frequencies`` of order 0, of all ids alike unless given."""
    lanes = len(lengths)
    model = _Model(lanes, frequencies(np.ones(size)) if often is None else often)
    low, span = np.zeros(lanes, _U), np.full(lanes, 1 << 62, _U)
    words, of = [], []  # what is sent in a step, and the lanes
    for step, k in _steps(lengths):
        x = ids[step, :k].astype(_N)
        model.predict(k)
        hit = (model.ids == x).astype(_N)
        other = hit[0] ^ _n(1)
        neither = other - (other & hit[1])
        begin, part = model.interval(other, neither)
        l, s = low[:k], span[:k]
        s >>= _u(16)
        begin *= s
        l += begin
        s *= part
        s >>= model.bits
        own = x + _n(1)
        own *= neither
        own = model.zero.take(own.astype(np.int64))
        l += s * (own >> _u(32))
        own &= _u(0xFFFFFFFF)
        s *= own
        small = np.flatnonzero(s < _SMALL)
        sent = l.take(small)
        words.append(sent >> _u(_REST))
        of.append(small.astype(np.uint16))
        sent &= _REST_BITS
        l[small] = sent << _u(32)
        s[small] = s.take(small) << _u(32)
        model.learn(k, x, hit)
    for _ in range(2):
        words.append(low >> _u(_REST))
        of.append(np.arange(lanes, dtype=np.uint16))
        low = (low & _REST_BITS) << _u(32)
    lane = np.concatenate(of)
    ends = np.cumsum(np.bincount(lane, minlength=lanes))
    sent = np.concatenate(words)[np.argsort(lane, kind="stable")]
    while True:  # what a range passed on to bits that had been sent
        carry = np.flatnonzero(sent >> _u(32))
        if not len(carry):
            break
        sent[carry] &= _u(0xFFFFFFFF)
        sent[carry - 1] += _u(1)
    sent = sent.astype(">u4").tobytes()
    return [sent[4 * a : 4 * b] for a, b in pairwise([0, *ends.tolist()])]


def _quotient(code: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """``code // unit`` of at most 2 to 20 or so; a quotient of doubles, put right by its remainder, is faster."""
    got = (code.view(np.int64) / unit.view(np.int64)).astype(np.int64)
    rest = code.view(np.int64) - got * unit.view(np.int64)
    got += rest >> 63
    got += rest >= unit.view(np.int64)
    return got


def decode(payloads: list[bytes], lengths: np.ndarray, size: int, often: np.ndarray | None = None) -> np.ndarray:
    """The ids of blocks in falling order of length, a row a step and a column a block."""
    lanes = len(lengths)
    often = frequencies(np.ones(size)) if often is None else often
    model = _Model(lanes, often)
    # the id after each place of order 0, counted from 1; the first is for lanes that another order has coded
    slots = np.append(np.uint16(0), np.repeat(np.arange(1, len(often) + 1, dtype=np.uint16), often))
    words = np.frombuffer(b"".join(payloads) + bytes(8), ">u4").astype(_N)
    pos = np.cumsum([0, *(len(p) // 4 for p in payloads)])[:-1]
    code = words[pos].astype(_U) << _u(30) | words[pos + 1] >> _n(2)
    pos += 2
    # 62 bits are in use, so two bits of each word come with the next
    words[1:] = words[:-1] << _n(30) | words[1:] >> _n(2)
    span = np.full(lanes, 1 << 62, _U)
    ids = np.zeros((int(lengths[0]) if lanes else 0, lanes), np.uint16)
    for step, k in _steps(lengths):
        model.predict(k)
        c, s = code[:k], span[:k]
        s >>= _u(16)
        edge = s * model.share_2
        other = (c >= edge).astype(_N)
        edge += s * model.share_1
        neither = (c >= edge).astype(_N)
        begin, part = model.interval(other, neither)
        begin *= s
        c -= begin
        s *= part
        s >>= model.bits
        place = _quotient(c, s)
        place += 1
        place *= neither
        own = slots.take(place, mode="clip")
        x = own.astype(_N)
        own = model.zero.take(x)
        c -= s * (own >> _u(32))
        own &= _u(0xFFFFFFFF)
        s *= own
        # one of the candidates, unless neither came
        first, second = model.ids
        x -= _n(1)
        x -= second
        x *= neither
        x += first
        x += other * (second - first)
        small = np.flatnonzero(s < _SMALL)
        at = pos.take(small)
        c[small] = c.take(small) << _u(32) | words.take(at, mode="clip")
        s[small] = s.take(small) << _u(32)
        at += 1
        pos[small] = at
        ids[step, :k] = x
        model.learn(k, x, (model.ids == x).astype(_N))
    return ids
