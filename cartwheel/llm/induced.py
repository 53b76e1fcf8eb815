"""External induced suffix sorting with common-prefix lengths.

Suffixes are sorted by recursive induction. The substrings between leftmost-S
places (an S place with an L place before it) are named in sorted order; the
string of names is sorted by the same procedure; and the order and the common
prefixes of the leftmost-S suffixes induce those of all L suffixes, then of
all S suffixes. The queues of the two induction passes are priority queues
whose priority is the first symbol: a tuple (place, common prefix with the
tuple before it) that is pushed goes behind the others of its priority,
because sources come in sorted order. Queues, text, types and results are
files; a pass holds one block of tuples at a time.

The common prefix of two tuples next to each other in a queue is one more
than the smallest common prefix between their sources, so each queue keeps
the smallest value passed since its last push.

Recursion ends where the names outnumber the queues that pay; the remaining
(at most a third as long) string is ranked by doubling.
"""

from __future__ import annotations

import os
import uuid

import numpy as np

#: Tuples handled at a time.
BLOCK = 1 << 18
#: Longest common prefix that is told apart.
CAP = 65535
#: Names up to which a reduced string is induced in turn.
MOST_QUEUES = 4096


class Files:
    """Arrays in unnamed files of one folder; those of less than ``buffer`` bytes stay in memory."""

    def __init__(self, folder: str, buffer: int = 32 << 20):
        self.folder, self.buffer = folder, buffer

    def array(self, n: int, kind) -> np.ndarray:
        if n * np.dtype(kind).itemsize <= self.buffer:
            return np.zeros(n, kind)
        path = os.path.join(self.folder, uuid.uuid4().hex)
        out = np.memmap(path, kind, "w+", shape=(n,))
        os.unlink(path)  # the mapping keeps the data; nothing is left behind if the task dies
        return out


class Queue:
    """Disk-backed priority queue of (place, common prefix): one first-in-first-out
    region for each symbol, in symbol order."""

    def __init__(self, files: Files, sizes: np.ndarray):
        self.start = np.concatenate(([0], np.cumsum(sizes)))
        n = int(self.start[-1])
        self.place, self.prefix = files.array(n, np.int64 if n >= 1 << 31 else np.int32), files.array(n, np.uint16)
        self.filled = self.start[:-1].copy()
        self.since = np.zeros(len(sizes), np.uint16)  # smallest prefix passed since the last push

    def push(self, symbol: np.ndarray, place: np.ndarray, at: np.ndarray, prefix: np.ndarray) -> None:
        """Pushes ``place`` under ``symbol``; ``at`` says from which of the sources
        with common prefixes ``prefix`` each came. All sources count for ``since``."""
        passed = prefix.min()
        if not len(symbol):
            np.minimum(self.since, passed, out=self.since)
            return
        order = np.argsort(symbol, kind="stable")
        sym, pl, src = symbol[order], place[order], at[order]
        new = np.ones(len(sym), bool)
        new[1:] = sym[1:] != sym[:-1]
        first = np.flatnonzero(new)
        lo = np.zeros(len(src), np.int64)
        lo[1:] = src[:-1] + 1
        lo[first] = 0
        least = _range_min(prefix, lo, src)
        own = sym[first]
        least[first] = np.minimum(least[first], self.since[own])
        sym = sym.astype(np.int64)
        ends = np.append(first[1:], len(sym))
        dest = self.filled[sym] + np.arange(len(sym)) - np.repeat(first, ends - first)
        self.place[dest] = pl
        self.prefix[dest] = np.minimum(least.astype(np.int64) + 1, CAP)
        self.filled[own] += ends - first
        np.minimum(self.since, passed, out=self.since)
        last = src[ends - 1]
        behind = np.full(len(own), CAP, np.uint16)
        some = last + 1 < len(prefix)
        if some.any():
            behind[some] = np.minimum.accumulate(prefix[::-1])[::-1][last[some] + 1]
        self.since[own] = behind

    def read(self, symbol: int, done: int) -> tuple[np.ndarray, np.ndarray]:
        """Up to a block of the tuples of ``symbol`` from ``done`` on."""
        hi = min(int(self.filled[symbol]), done + BLOCK)
        return np.array(self.place[done:hi], np.int64), np.array(self.prefix[done:hi])


def _range_min(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of a[lo..hi] (inclusive) for each pair, by doubling tables."""
    out = np.empty(len(lo), a.dtype)
    level = np.floor(np.log2(hi - lo + 1)).astype(np.int64)
    table = a
    for k in range(int(level.max(initial=0)) + 1):
        here = np.flatnonzero(level == k)
        if len(here):
            out[here] = np.minimum(table[lo[here]], table[hi[here] - (1 << k) + 1])
        if len(table) > 1 << k:
            table = np.minimum(table[: -(1 << k)], table[1 << k :])
    return out


def _types(s: np.ndarray, files: Files) -> tuple[np.ndarray, np.ndarray]:
    """Whether each place is S, and the length of the run of equal symbols that starts there."""
    n = len(s)
    is_s, run = files.array(n, bool), files.array(n, np.uint16)
    next_type, next_symbol, next_run = False, -1, 0  # the end is smaller than any symbol
    for lo in range((n - 1) // BLOCK * BLOCK, -1, -BLOCK):
        part = np.array(s[lo : lo + BLOCK], np.int64)
        size = len(part)
        after = np.append(part[1:], next_symbol)
        change = np.flatnonzero(part != after)
        nearest = np.searchsorted(change, np.arange(size))
        inside = nearest < len(change)
        up = part < after
        kind = np.full(size, next_type)
        kind[inside] = up[change[nearest[inside]]]
        length = np.full(size, 0, np.int64)
        place = np.arange(size)
        length[inside] = change[nearest[inside]] - place[inside] + 1
        length[~inside] = size - place[~inside] + next_run
        is_s[lo : lo + size] = kind
        run[lo : lo + size] = np.minimum(length, CAP)
        next_type, next_symbol, next_run = bool(kind[0]), int(part[0]), int(length[0])
    return is_s, run


def _symbols(s, is_s, place, width, bits, stop):
    """Keys of ``width`` symbols from each place on, up to ``stop`` (exclusive), padded with 0."""
    n = len(s)
    key = np.zeros(len(place), np.uint64)
    for k in range(width):
        p = place + k
        ok = p < stop
        q = np.minimum(p, n - 1)
        x = np.where(ok & (p < n), 2 * np.asarray(s[q], np.int64) + is_s[q] + 1, 0).astype(np.uint64)
        key = (key << np.uint64(bits)) | x
    return key


def _name(s, is_s, lms, k_symbols, files):
    """Names of the substrings from each leftmost-S place to the next one (inclusive),
    and for each name how many (symbol, type) pairs it shares with the name before it."""
    m, n = len(lms), len(s)
    bits = int(2 * k_symbols + 1).bit_length()
    width = 64 // bits
    names, prefixes, total = files.array(m, np.int32), [], 0
    first = np.array(s[lms], np.int64)
    by_first = np.argsort(first.astype(np.uint16) if k_symbols <= 65536 else first, kind="stable")
    cuts = np.flatnonzero(np.diff(first[by_first])) + 1
    for members in np.split(by_first, cuts):
        place = lms[members].astype(np.int64)
        after = members + 1
        stop = np.where(after < m, lms[np.minimum(after, m - 1)].astype(np.int64) + 1, n + 1)
        size = len(place)
        order = np.arange(size)
        diff = np.full(size, -1, np.int64)  # symbols shared with the one before, -1 while the same
        diff[0] = 0
        todo = np.arange(size)  # slots of `order` in groups not yet told apart
        group = np.zeros(size, np.int64)
        depth = 0
        while len(todo):
            who = order[todo]
            key = _symbols(s, is_s, place[who] + depth, width, bits, stop[who])
            resort = np.lexsort((key, group))
            order[todo], key, group = who[resort], key[resort], group[resort]
            who = order[todo]
            fresh = np.ones(len(todo), bool)
            fresh[1:] = group[1:] != group[:-1]
            changed = ~fresh
            changed[1:] &= key[1:] != key[:-1]
            at = np.flatnonzero(changed)
            if len(at):
                same = (width - 1) - (_top_bit(key[at] ^ key[at - 1]) // bits)
                diff[todo[at]] = depth + same
            starts = fresh | changed
            group = np.cumsum(starts)
            counts = np.bincount(group)
            depth += width
            more = (counts[group] > 1) & (place[who] + depth < stop[who])
            todo, group = todo[more], group[more]
        is_new = diff >= 0
        is_new[0] = True
        names[members[order]] = total + np.cumsum(is_new) - 1
        new = np.flatnonzero(is_new)
        own = np.where(np.arange(len(new)) > 0, diff[new], 0)
        prefixes.append(np.minimum(own, CAP).astype(np.uint16))
        total += len(new)
    return names, total, np.concatenate(prefixes)


def _top_bit(x: np.ndarray) -> np.ndarray:
    """Place of the highest set bit of each non-zero number."""
    high = (x >> np.uint64(32)).astype(np.float64)
    low = (x & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return np.where(high > 0, 32 + np.log2(np.maximum(high, 1)).astype(np.int64), np.log2(np.maximum(low, 1)).astype(np.int64))


def _doubling(s: np.ndarray, files: Files) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and common prefixes of a string by prefix doubling.

    The first ranks tell several symbols apart at once; later rounds sort only
    suffixes that still share their rank. Each round's ranks stay in a file
    and give the common prefixes of neighbours at the end.
    """
    n = len(s)
    symbols = np.asarray(s, np.int64) + 1
    bits = int(symbols.max(initial=1)).bit_length()
    width = max(1, 63 // bits)
    packed = np.zeros(n, np.int64)
    for k in range(width):
        packed <<= bits
        packed[: max(n - k, 0)] |= symbols[k:]
    order = np.argsort(packed, kind="stable")
    rank = files.array(n, np.int32)
    start = np.ones(n, bool)
    start[1:] = np.diff(packed[order]) != 0
    del packed
    head = np.maximum.accumulate(np.where(start, np.arange(n), 0))  # rank = first slot of the group
    rank[order] = head
    levels, widths = [rank], [width]
    shared = ~start
    shared[:-1] |= shared[1:]
    slots, heads = np.flatnonzero(shared), head[shared]
    del head, shared
    while len(slots) and width < n:
        who = order[slots]
        ahead = np.where(who + width < n, np.asarray(rank[np.minimum(who + width, n - 1)], np.int64) + 1, 0)
        resort = np.lexsort((ahead, heads))
        who, ahead = who[resort], ahead[resort]
        order[slots] = who
        fresh = np.ones(len(slots), bool)
        fresh[1:] = (np.diff(heads) != 0) | (np.diff(ahead) != 0)
        heads = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(slots)), 0))]
        nxt = files.array(n, np.int32)
        nxt[:] = rank
        nxt[who] = heads
        rank, width = nxt, 2 * width
        levels.append(rank)
        widths.append(width)
        more = ~fresh
        more[:-1] |= more[1:]
        slots, heads = slots[more], heads[more]
    a, b = order[:-1], order[1:]
    size = np.zeros(max(n - 1, 0), np.int64)
    todo = np.arange(len(size))
    for k in range(len(levels) - 1, -1, -1):
        p, q = a[todo] + size[todo], b[todo] + size[todo]
        ok = (p < n) & (q < n)
        same = ok & (levels[k][np.minimum(p, n - 1)] == levels[k][np.minimum(q, n - 1)])
        size[todo[same]] += widths[k]
    for _ in range(widths[0] - 1):  # what is left is within one packed key
        p, q = a[todo] + size[todo], b[todo] + size[todo]
        ok = (p < n) & (q < n)
        todo = todo[ok & (symbols[np.minimum(p, n - 1)] == symbols[np.minimum(q, n - 1)])]
        size[todo] += 1
    return order, np.minimum(np.concatenate(([0], size)), CAP).astype(np.uint16)


def suffix_array(s: np.ndarray, k_symbols: int, files: Files) -> tuple[np.ndarray, np.ndarray]:
    """Places of the suffixes of ``s`` (symbols 0 .. k_symbols - 1) in order, and the
    common prefix of each with the one before it (up to CAP), as file-backed arrays."""
    n = len(s)
    if n < 3:
        order, prefix = _doubling(s, files) if n else (np.zeros(0, np.int64), np.zeros(0, np.uint16))
        return order, prefix
    is_s, run = _types(s, files)
    found = [
        np.flatnonzero(np.asarray(is_s[max(lo, 1) : lo + BLOCK]) & ~np.asarray(is_s[max(lo, 1) - 1 : min(lo + BLOCK, n) - 1]))
        + max(lo, 1)
        for lo in range(0, n, BLOCK)
    ]
    lms = files.array(sum(map(len, found)), np.int64)
    at = 0
    for part in found:
        lms[at : at + len(part)] = part
        at += len(part)
    del found
    seeds, shared = _sorted_seeds(s, is_s, run, lms, k_symbols, files)
    return _induce(s, is_s, run, seeds, shared, k_symbols, files)


def _sorted_seeds(s, is_s, run, lms, k_symbols, files):
    """The leftmost-S places in suffix order and the common prefixes of neighbours."""
    m = len(lms)
    if m == 0:
        return lms, np.zeros(0, np.uint16)
    names, total, name_prefix = _name(s, is_s, lms, k_symbols, files)
    if total == m:
        order, same = files.array(m, np.int64), np.broadcast_to(np.uint16(0), m)
        order[names] = np.arange(m)
    else:
        order, same = suffix_array(names, total, files) if total <= MOST_QUEUES else _doubling(names, files)
    seeds, shared = files.array(m, np.int64), files.array(m, np.uint16)
    for lo in range(0, m, BLOCK):
        here = np.asarray(order[max(lo - 1, 0) : lo + BLOCK], np.int64)
        if lo == 0:
            here = np.concatenate((here[:1], here))
        a, b, k = here[:-1], here[1:], np.asarray(same[lo : lo + BLOCK], np.int64)
        seeds[lo : lo + len(b)] = lms[b]
        ea, eb = np.minimum(a + k, m - 1), np.minimum(b + k, m - 1)
        x, y = np.asarray(names[ea], np.int64), np.asarray(names[eb], np.int64)
        least = _range_min(name_prefix, np.minimum(x + 1, y), y)
        # names that differ by type only: the shorter run of the symbol ends the common prefix
        p, q = lms[ea] + least, lms[eb] + least
        inside = (p < len(s)) & (q < len(s))
        p, q = np.minimum(p, len(s) - 1), np.minimum(q, len(s) - 1)
        extra = np.where(inside & (np.asarray(s[p]) == np.asarray(s[q])), np.minimum(run[p], run[q]), 0)
        part = np.minimum(lms[ea] - lms[a] + least + extra, CAP)
        shared[lo : lo + len(b)] = np.where(k >= CAP, CAP, part)
    shared[0] = 0
    return seeds, shared


def _induce(s, is_s, run, seeds, shared, k_symbols, files):
    n = len(s)
    small = np.uint8 if k_symbols <= 256 else np.uint16 if k_symbols <= 65536 else np.int32  # sorted by radix
    l_sizes, s_sizes, seed_sizes = (np.zeros(k_symbols, np.int64) for _ in range(3))
    for lo in range(0, n, BLOCK):
        part, kind = np.asarray(s[lo : lo + BLOCK], np.int64), np.asarray(is_s[lo : lo + BLOCK])
        l_sizes += np.bincount(part[~kind], minlength=k_symbols)
        s_sizes += np.bincount(part[kind], minlength=k_symbols)
    for lo in range(0, len(seeds), BLOCK):
        seed_sizes += np.bincount(np.asarray(s[seeds[lo : lo + BLOCK]], np.int64), minlength=k_symbols)
    seed_start = np.concatenate(([0], np.cumsum(seed_sizes)))

    def feed(queue: Queue, place: np.ndarray, prefix: np.ndarray, wanted: bool) -> None:
        """Pushes the places before the sources ``place`` that have the wanted type."""
        at = np.flatnonzero(place > 0)
        prev = place[at] - 1
        right = np.asarray(is_s[prev]) == wanted
        at, prev = at[right], prev[right]
        sym = np.asarray(s[prev])
        queue.push(sym.astype(small), prev, at, prefix)

    left = Queue(files, l_sizes)
    end = np.array([n - 1])
    left.push(np.asarray(s[end]).astype(small), end, np.zeros(1, np.int64), np.zeros(1, np.uint16))
    for c in np.flatnonzero((l_sizes > 0) | (seed_sizes > 0)):
        done = int(left.start[c])
        last = -1
        while done < left.filled[c]:
            place, prefix = left.read(c, done)
            if last < 0:
                prefix[0] = 0  # its source has another first symbol than the one before
            done += len(place)
            last = int(place[-1])
            feed(left, place, prefix, False)
        for lo in range(int(seed_start[c]), int(seed_start[c + 1]), BLOCK):
            hi = min(int(seed_start[c + 1]), lo + BLOCK)
            place, prefix = np.array(seeds[lo:hi], np.int64), np.array(shared[lo:hi])
            if lo == seed_start[c]:
                prefix[0] = min(run[last], run[place[0]]) if last >= 0 else 0
            feed(left, place, prefix, False)
    right = Queue(files, s_sizes)  # filled from the largest suffix down
    for c in np.flatnonzero((l_sizes > 0) | (s_sizes > 0))[::-1]:
        done = int(right.start[c])
        last = -1
        while done < right.filled[c]:
            place, prefix = right.read(c, done)
            if last < 0:
                prefix[0] = 0
            done += len(place)
            last = int(place[-1])
            feed(right, place, prefix, True)
        top = int(left.filled[c])
        while top > left.start[c]:
            lo = max(int(left.start[c]), top - BLOCK)
            place = np.array(left.place[lo:top][::-1], np.int64)
            # going down, a suffix's prefix with the one before it is what that one has with it going up
            prefix = np.empty(top - lo, np.uint16)
            prefix[1:] = left.prefix[lo + 1 : top][::-1]
            if top == left.filled[c]:
                prefix[0] = min(run[last], run[place[0]]) if last >= 0 else 0
            else:
                prefix[0] = left.prefix[top]
            feed(right, place, prefix, True)
            top = lo
    order, prefix = files.array(n, left.place.dtype), files.array(n, np.uint16)
    at = 0
    for c in np.flatnonzero((l_sizes > 0) | (s_sizes > 0)):
        a, b = int(left.start[c]), int(left.start[c + 1])
        k = b - a
        order[at : at + k] = left.place[a:b]
        prefix[at : at + k] = left.prefix[a:b]
        if k:
            prefix[at] = 0
        a, b = int(right.start[c]), int(right.start[c + 1])
        j = b - a
        if j:
            order[at + k : at + k + j] = right.place[a:b][::-1]
            prefix[at + k + 1 : at + k + j] = right.prefix[a + 1 : b][::-1]
            prefix[at + k] = min(run[order[at + k - 1]], run[order[at + k]]) if k else 0
        at += k + j
    return order, prefix
