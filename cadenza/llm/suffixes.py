"""External induced sorting of suffixes with common-prefix values, for one shard in one task.

Suffixes are of type S (smaller than the one behind) or L. The leftmost S suffixes (LMS: S behind
an L) are sorted first: the stretches between them get names in sorted order, and where names
repeat, the string of names is sorted by the same procedure, recursively, until it is short. Two scans then induce
the rest: popping a suffix tuple (position, common prefix with the tuple popped before) pushes the
suffix in front of it, with its own common prefix: one more than the least value popped since the
last push to the same symbol.

The priority queues are monotone: what is pushed is never popped before what stands already, and
tuples of one symbol leave in the order in which they came. So a queue is a file of tuples with one
region per symbol. Tuples are popped in blocks: all regions that can get no more tuples, up to
``BLOCK`` of them at a time, so that numpy moves whole blocks. Queues beyond ``MEMORY`` bytes are
files in the executor's own spill folders, unlinked when they are made; nothing else of the
task's state grows with the shard but a type bit and the text, which is such a file as well.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

#: Tuples popped at a time, and bytes up to which an array stays in memory.
BLOCK, MEMORY = 1 << 18, 48 << 20
#: Strings of names up to this length end the recursion: they are sorted in memory.
BASE = 300_000


def stored(n: int, dtype, memory: int | None = None) -> np.ndarray:
    """An array of zeros; a large one is an unlinked file where Spark itself spills."""
    dtype = np.dtype(dtype)
    if n * dtype.itemsize <= (MEMORY if memory is None else memory):
        return np.zeros(n, dtype)
    folder = os.environ.get("SPARK_LOCAL_DIRS", tempfile.gettempdir()).split(",")[0]
    with tempfile.TemporaryFile(dir=folder) as f:
        f.truncate(n * dtype.itemsize)
        return np.memmap(f, dtype, "r+", shape=(n,))


def _pairs_equal(text: np.ndarray, a: np.ndarray, b: np.ndarray, known: np.ndarray, cap: int) -> np.ndarray:
    """Common-prefix lengths (``cap`` at most) of the suffixes ``a[i]`` and ``b[i]``, of which
    ``known[i]`` symbols are known to be equal."""
    n, per = len(text), max(1, 8 // text.itemsize)
    out = np.minimum(known, cap).astype(np.int64)
    most = np.minimum(n - np.maximum(a, b), cap)
    open_ = np.flatnonzero(out < most)
    while len(open_):
        x, y, k = a[open_], b[open_], out[open_]
        # eight bytes at a time where they lie in the text, else symbol by symbol
        room = n - np.maximum(x, y) - k
        same = np.zeros(len(open_), np.int64)
        wide = room >= per
        if wide.any() and per > 1:
            words = np.ndarray((n - per + 1,), "<u8", _raw(text), strides=(text.itemsize,))
            diff = words[(x + k)[wide]] ^ words[(y + k)[wide]]
            zeros = np.bitwise_count((diff & (~diff + np.uint64(1))) - np.uint64(1)).astype(np.int64)
            same[wide] = np.where(diff == 0, per, zeros // (8 * text.itemsize))
        one = ~wide if per > 1 else np.ones(len(open_), bool)
        if one.any():
            same[one] = text[(x + k)[one]] == text[(y + k)[one]]
        got = np.minimum(k + same, most[open_])
        out[open_] = got
        full = same == np.where(wide & (per > 1), per, 1)
        open_ = open_[full & (got < most[open_])]
    return out


def _raw(text: np.ndarray):
    return text.data if not isinstance(text, np.memmap) else memoryview(text)


def _least(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The minima of ``values[lo..hi]`` inclusive, by minima of doubling lengths."""
    level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
    top = int(level.max())
    if top == 0:
        return values[lo]
    order = np.argsort(level.astype(np.int8), kind="stable")
    edges = np.searchsorted(level[order], np.arange(top + 2))
    out, table = np.empty(len(lo), values.dtype), values
    for k in range(top + 1):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[:-half], table[half:])
        mine = order[edges[k]:edges[k + 1]]
        if len(mine):
            out[mine] = np.minimum(table[lo[mine]], table[hi[mine] - (1 << k) + 1])
    return out


class _Queue:
    """Tuples (position, common prefix with the tuple pushed before to the same symbol), one
    region per symbol, filled and read front to back."""

    def __init__(self, counts: np.ndarray, cap: int, kind):
        self.first = np.concatenate(([0], np.cumsum(counts)))
        self.head = self.first[:-1].copy()
        self.position = stored(int(self.first[-1]), kind)
        self.prefix = stored(int(self.first[-1]), np.uint8 if cap < 256 else np.int32)
        # per symbol: its last push's block, and the least value popped behind it in that block;
        # per value: the newest block that popped that value or less
        self.block, self.after = np.full(len(counts), -1, np.int64), np.full(len(counts), cap, self.prefix.dtype)
        self.newest, self.blocks = np.full(cap + 1, -1, np.int64), 0
        self.cap = cap

    def push(self, symbol: np.ndarray, position: np.ndarray, at: np.ndarray, popped: np.ndarray) -> None:
        """Push ``position[i]`` to ``symbol[i]``, induced by the ``at[i]``-th tuple popped in this
        block; ``popped``: the block's common-prefix values."""
        if len(symbol):
            # numpy sorts short integers by radix
            order = np.argsort(symbol.astype(np.uint8 if len(self.head) <= 256 else np.int32), kind="stable")
            symbol, position, at = symbol[order], position[order], at[order]
            new = np.empty(len(symbol), bool)
            new[0] = True
            np.not_equal(symbol[1:], symbol[:-1], out=new[1:])
            firsts = np.flatnonzero(new)
            mine = symbol[firsts]
            lasts = np.empty_like(firsts)
            lasts[:-1], lasts[-1] = firsts[1:] - 1, len(symbol) - 1
            lo = np.empty_like(at)
            lo[1:] = at[:-1] + 1
            lo[firsts] = 0
            # one query for the values before every push, and those behind each symbol's last
            end = len(popped) - 1
            behind = np.minimum(at[lasts] + 1, end)
            value = _least(popped, np.concatenate((lo, behind)), np.concatenate((at, np.full(len(mine), end)))).astype(np.int64)
            value, rest = value[:len(symbol)], value[len(symbol):]
            rest[at[lasts] == end] = self.cap
            since = np.minimum(np.searchsorted(self.newest, self.block[mine], "right"), self.after[mine])
            value[firsts] = np.minimum(value[firsts], since)
            size = lasts - firsts + 1
            place = np.repeat(self.head[mine] - firsts, size) + np.arange(len(symbol))
            value = np.minimum(value + 1, self.cap)
            fresh = self.head[mine] == self.first[mine]
            value[firsts[fresh]] = 0
            self.position[place], self.prefix[place] = position, value
            self.head[mine] += size
            self.block[mine], self.after[mine] = self.blocks, rest
        self.newest[int(popped.min()):] = self.blocks
        self.blocks += 1

    def closed(self, symbol: int) -> int:
        """The first symbol from ``symbol`` on whose region still waits for tuples."""
        n, step = len(self.head), 64
        while symbol < n:
            hi = min(symbol + step, n)
            waits = self.head[symbol:hi] < self.first[symbol + 1:hi + 1]
            if waits.any():
                return symbol + int(waits.argmax())
            symbol, step = hi, step * 4
        return n


def _types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is of type S; a run of one symbol has the type of its last."""
    n = len(text)
    ends = np.flatnonzero(text[1:] != text[:-1])
    kind = np.append(text[ends] < text[ends + 1], False)
    return np.repeat(kind, np.diff(np.concatenate(([-1], ends, [n - 1]))))


def _names(text: np.ndarray, small: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the stretches from each LMS position to the next, and their names (equal
    stretches share one). Symbols carry their type, so no stretch is the beginning of another."""
    n, m = len(text), len(lms)
    size = np.append(lms[1:], n - 1) - lms + 1
    bits = int(2 * int(text.max()) + 2).bit_length()
    per = max(1, 63 // bits)

    def word(j: np.ndarray, r: int) -> np.ndarray:
        key = np.zeros(len(j), np.int64)
        for t in range(r * per, (r + 1) * per):
            inside = t < size[j]
            at = np.where(inside, lms[j] + t, 0)
            key = (key << bits) | np.where(inside, 2 * text[at].astype(np.int64) + small[at] + 1, 0)
        return key

    key = word(np.arange(m), 0)
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.append(True, key[1:] != key[:-1])
    del key
    r, open_ = 1, np.arange(m)
    while True:
        # positions in groups of several, of which one at least goes on
        group = np.cumsum(new[open_]) - 1
        count, longest = np.bincount(group), np.zeros(int(group[-1]) + 1 if len(group) else 0, np.int64)
        np.maximum.at(longest, group, size[order[open_]])
        open_ = open_[((count > 1) & (longest > r * per))[group]]
        if not len(open_):
            break
        key, group = word(order[open_], r), np.cumsum(new[open_])
        again = np.lexsort((key, group))
        order[open_] = order[open_][again]
        key, group = key[again], group[again]
        new[open_] = np.append(True, (key[1:] != key[:-1]) | (group[1:] != group[:-1]))
        r += 1
    names = np.empty(m, np.int32 if m < 1 << 31 else np.int64)
    names[order] = np.cumsum(new) - 1
    return order, names


def _doubled(text: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for a short string, by ranks of doubling lengths."""
    n, ranks, h = len(text), [text.astype(np.int64)], 1
    while True:
        key = ranks[-1] * (int(ranks[-1].max()) + 2)
        key[:n - h] += ranks[-1][h:] + 1
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.append(True, key[1:] != key[:-1])
        if new.all():
            break
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        ranks.append(rank)
        h *= 2
    a, b, k = order[:-1], order[1:], np.zeros(n - 1, np.int64)
    for rank in reversed(ranks):
        inside = np.flatnonzero(np.maximum(a, b) + k < n)
        k[inside[rank[(a + k)[inside]] == rank[(b + k)[inside]]]] += h
        h //= 2
    return order, np.minimum(np.append(0, k), cap)


def suffixes(text: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """The positions of all suffixes in sorted order, and each one's common prefix with the one
    before (``cap`` at most). ``text``: unsigned bytes, or names from 0 on."""
    n = len(text)
    kind = np.int32 if n < 1 << 31 else np.int64
    if n < 2:
        return np.arange(n, dtype=kind), np.zeros(n, np.int64)
    small = _types(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms):
        order, names = _names(text, small, lms)
        if len(lms) > 1 and int(names.max()) + 1 < len(lms):
            order, shared = (_doubled if len(names) <= BASE else suffixes)(names, cap)
            order, shared = np.asarray(order, np.int64), np.asarray(shared, np.int64)
            # equal names are equal stretches: so many symbols are known to be the same
            ends = np.append(lms, n)
            known = ends[np.minimum(order + shared, len(lms))] - lms[order]
            known[shared == 0] = 0
        else:
            known = np.zeros(len(lms), np.int64)
        first = lms[order]
        prefix = np.zeros(len(lms), np.int64)
        prefix[1:] = _pairs_equal(text, first[:-1], first[1:], np.maximum(known[1:] - 1, 0), cap)
    else:
        first, prefix = np.zeros(0, np.int64), np.zeros(0, np.int64)
    sigma = int(text.max()) + 1
    sizes_s = np.bincount(text[small], minlength=sigma)
    sizes_l = np.bincount(text[~small], minlength=sigma)
    values = np.uint8 if cap < 256 else np.int32
    larger = _induced(text, small, False, sizes_l, sigma, cap, kind, first, prefix.astype(values),
                      np.concatenate(([0], np.cumsum(np.bincount(text[first], minlength=sigma)))))
    turned = _Reversed(larger, sigma)
    smaller = _induced(text, small, True, sizes_s, sigma, cap, kind, turned.position, turned.prefix, turned.first)
    # both queues symbol by symbol: L suffixes, then S suffixes (which were pushed from the largest on)
    out, shared = stored(n, kind), stored(n, values)
    begin = np.concatenate(([0], np.cumsum(sizes_l + sizes_s)))
    for lo in range(0, len(larger.position), BLOCK):
        at = np.arange(lo, min(lo + BLOCK, len(larger.position)))
        symbol = np.searchsorted(larger.first, at, "right") - 1
        place = begin[symbol] + at - larger.first[symbol]
        out[place], shared[place] = larger.position[at], larger.prefix[at]
    # a pushed S tuple holds the common prefix with the next larger one of its symbol
    for lo in range(0, len(smaller.position), BLOCK):
        at = np.arange(lo, min(lo + BLOCK, len(smaller.position)))
        symbol = sigma - 1 - (np.searchsorted(smaller.first, at, "right") - 1)
        rank = at - smaller.first[sigma - 1 - symbol]
        place = begin[symbol + 1] - 1 - rank
        out[place] = smaller.position[at]
        behind = rank > 0
        shared[place[behind] + 1] = smaller.prefix[at[behind]]
    seam = np.flatnonzero((sizes_l > 0) & (sizes_s > 0))
    if len(seam):
        place = begin[seam] + sizes_l[seam]
        shared[place] = _pairs_equal(text, np.asarray(out[place - 1], np.int64), np.asarray(out[place], np.int64),
                                     np.zeros(len(seam), np.int64), cap)
    return out, shared


class _Reversed:
    """The L suffixes as the second scan pops them: from the largest symbol, from the largest on."""

    def __init__(self, queue: _Queue, sigma: int):
        self.first = queue.first[-1] - queue.first[::-1]
        self.position = queue.position[::-1]
        prefix = queue.prefix[::-1]                       # with the next smaller one: shifted by one
        self.prefix = _Shifted(prefix)


class _Shifted:
    """``values[i - 1]`` at ``i``; 0 at the start."""

    def __init__(self, values: np.ndarray):
        self.values = values

    def __getitem__(self, part: slice) -> np.ndarray:
        out = np.zeros(part.stop - part.start, self.values.dtype)
        out[max(0, 1 - part.start):] = self.values[max(part.start - 1, 0):part.stop - 1]
        return out


def _induced(text, small, second: bool, counts, sigma: int, cap: int, kind, given, given_prefix, given_first) -> _Queue:
    """One scan. First: L suffixes from the sorted LMS suffixes, by ascending symbol, the queue's own
    tuples of a symbol before the given ones. Second: S suffixes from the L suffixes, with symbols and
    order reversed. A block is popped when all its symbols' regions are full; a region that waits
    for its own tuples (a run of one symbol) is popped in rounds."""
    turn = (lambda c: sigma - 1 - c) if second else (lambda c: c)
    queue = _Queue(counts[::-1] if second else counts, cap, kind)
    values = queue.prefix.dtype
    n = len(text)

    def pop(position: np.ndarray, popped: np.ndarray) -> None:
        for lo in range(0, len(position), BLOCK):
            p, s = np.asarray(position[lo:lo + BLOCK], np.int64), popped[lo:lo + BLOCK]
            at = np.flatnonzero(p > 0)
            before = p[at] - 1
            mine = small[before] == second
            at, before = at[mine], before[mine]
            queue.push(turn(text[before].astype(np.int64)), before, at, s)

    if not second:
        # the end of the text is the smallest suffix of all
        queue.push(np.array([int(text[n - 1])]), np.array([n - 1]), np.array([0]), np.zeros(1, values))
    symbol, done = 0, 0                # tuples of the queue before ``done`` are popped
    while symbol < sigma:
        end = queue.closed(symbol)
        if end == symbol:              # its own tuples push into it: pop what stands there
            hi = int(queue.head[symbol])
            s = queue.prefix[done:hi].copy()
            pop(queue.position[done:hi].copy(), s)
            done = hi
            continue
        # as many full symbols as make one block, at least one
        total = queue.first[symbol + 1:end + 1] + given_first[symbol + 1:end + 1]
        room = int(np.searchsorted(total, done + given_first[symbol] + BLOCK, "right"))
        end = symbol + max(1, room)
        own_lo, own_hi = done, int(queue.first[end])
        got_lo, got_hi = int(given_first[symbol]), int(given_first[end])
        own, got = np.asarray(queue.position[own_lo:own_hi], np.int64), np.asarray(given[got_lo:got_hi], np.int64)
        s_own, s_got = queue.prefix[own_lo:own_hi].copy(), np.array(given_prefix[got_lo:got_hi], values)
        # the first given tuple of a symbol meets the last of the queue's own
        starts = given_first[symbol:end]
        has = np.flatnonzero((given_first[symbol + 1:end + 1] > starts))
        heads = given_first[symbol + has] - got_lo
        s_got[heads] = 0
        both = has[queue.first[symbol + has + 1] > queue.first[symbol + has]]
        if len(both):
            last = np.asarray(queue.position[queue.first[symbol + both + 1] - 1], np.int64)
            head = np.asarray(given_first[symbol + both] - got_lo)
            s_got[head] = _pairs_equal(text, last, got[head], np.zeros(len(both), np.int64), cap)
        if end == symbol + 1:
            pop(own, s_own)
            pop(got, s_got)
        else:
            rank = np.concatenate((2 * turn(text[own].astype(np.int64)), 2 * turn(text[got].astype(np.int64)) + 1))
            order = np.argsort(rank, kind="stable")
            pop(np.concatenate((own, got))[order], np.concatenate((s_own, s_got))[order])
        symbol, done = end, own_hi
    return queue
