"""External induced sorting of one shard's suffixes, with common-prefix values.

Suffix tuples (position, common prefix with the suffix before) wait in priority queues whose priority is the first
character; the queue of a character is a log on disk that is read in blocks while it still grows. Suffixes of type L
are induced from the sorted S* suffixes in rising order, those of type S from the L ones in falling order; the common
prefix of two induced neighbours is one more than the smallest value between the suffixes that induced them. The S*
suffixes come from the reduced string of their substrings' names. Order and common prefixes are exact up to ``depth``
characters, which is all that matches of that length need.
"""
from __future__ import annotations

import os

import numpy as np

SEPARATOR, END, PAD = 1, 0, 255
SPARE = 8
BLOCK = 1 << 18


class Queue:
    """Append-only (position, common prefix) log of one character; what exceeds the buffer goes to its file."""

    def __init__(self, path: str):
        self.path, self.buffer, self.held, self.stored, self.read = path, [], 0, 0, 0

    def __len__(self) -> int:
        return self.stored + self.held

    def append(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        rows = np.empty(len(pos), _TUPLE)
        rows["pos"], rows["lcp"] = pos, lcp
        self.buffer.append(rows)
        self.held += len(rows)
        if self.held > BLOCK:
            self.flush()

    def flush(self) -> None:
        if self.held:
            with open(self.path, "ab") as f:
                for rows in self.buffer:
                    rows.tofile(f)
            self.stored, self.held, self.buffer = self.stored + self.held, 0, []

    def slice(self, lo: int, hi: int) -> np.ndarray:
        """Rows lo..hi of the log."""
        if lo >= self.stored and self.buffer:
            rows = self.buffer[0] if len(self.buffer) == 1 else np.concatenate(self.buffer)
            self.buffer = [rows]
            return rows[lo - self.stored:hi - self.stored]
        self.flush()
        if hi <= lo:
            return np.empty(0, _TUPLE)
        return np.fromfile(self.path, _TUPLE, hi - lo, offset=lo * _TUPLE.itemsize)

    def next(self) -> np.ndarray:
        """The next unread block; empty when all that was appended so far has been read."""
        limit = self.stored if self.read < self.stored else len(self)
        rows = self.slice(self.read, min(limit, self.read + BLOCK))
        self.read += len(rows)
        return rows


#: Common prefixes have 16 bits: ``depth`` and the eight characters compared behind it fit.
_LCP, _MOST, MAX_DEPTH = np.uint16, 65_535, 65_000
_TUPLE = np.dtype([("pos", "<u4"), ("lcp", "<u2")])


class Induction:
    """One phase: block after block of suffixes in order, their predecessors into the queues."""

    def __init__(self, text: np.ndarray, queues: list[Queue], depth: int):
        self.text, self.queues, self.depth = text, queues, depth
        self.least = np.full(256, _MOST, _LCP)

    def block(self, pos: np.ndarray, lcp: np.ndarray, wanted) -> None:
        """``wanted`` maps the preceding characters to whether their suffixes belong to this phase."""
        before = np.where(pos > 0, self.text[np.maximum(pos, 1) - 1], PAD)
        target = np.where((pos > 0) & wanted(before), before, PAD)
        last_min = int(lcp.min())
        begun = np.array([len(q) > 0 for q in self.queues])
        present = np.flatnonzero(np.bincount(target, minlength=256)[:255])
        self.least = np.minimum(self.least, last_min)
        order = np.argsort(target, kind="stable")
        bounds = np.searchsorted(target[order], np.arange(257))
        carried = self._carry
        for c in present:
            at = order[bounds[c]:bounds[c + 1]]
            starts = np.empty(len(at) + 1, np.int64)
            starts[0], starts[1:] = 0, at + 1
            tail = starts[-1] == len(lcp)
            lows = np.minimum.reduceat(lcp, starts[:-1] if tail else starts)
            value = np.minimum(lows[:len(at)].astype(np.int64) + 1, self.depth)
            value[0] = min(value[0], int(carried[c]) + 1) if begun[c] else 0
            self.queues[c].append(pos[at] - 1, value)
            self.least[c] = _MOST if tail else lows[-1]
        self._carry = self.least.copy()

    _carry = np.full(256, _MOST, _LCP)


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix lengths, ``depth`` at most, of the suffixes at a and b (the text ends in ``depth`` + SPARE PADs)."""
    out = np.zeros(len(a), _LCP)
    alive = np.arange(len(a))
    for done in range(0, depth, 8):
        if not len(alive):
            break
        for s in range(0, len(alive), BLOCK):
            part = alive[s:s + BLOCK]
            at = np.arange(done, done + 8)
            same = text[a[part][:, None] + at] == text[b[part][:, None] + at]
            run = np.where(same.all(1), 8, np.argmin(same, axis=1))
            out[part] += run.astype(_LCP)
            alive[s:s + BLOCK] = np.where(run == 8, part, -1)
        alive = alive[alive >= 0]
    return np.minimum(out, depth)


def _words(text: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Eight characters from ``at`` as one big-endian number, PAD from ``ends`` on."""
    out = np.zeros(len(at), np.uint64)
    for k in range(8):
        i = at + k
        out = out << np.uint64(8) | np.where(i < ends, text[np.minimum(i, len(text) - 1)], PAD).astype(np.uint64)
    return out


def _refine(order: np.ndarray, group: np.ndarray, key_of, active: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorts the ``active`` slots of ``order`` inside their groups by a key; a group's number is its first slot."""
    keys = key_of(order[active])
    by = np.lexsort((keys, group[active]))
    order[active] = order[active][by]
    keys, own = keys[by], group[active]
    new = np.ones(len(active), bool)
    new[1:] = (own[1:] != own[:-1]) | (keys[1:] != keys[:-1])
    group[active] = active[np.maximum.accumulate(np.where(new, np.arange(len(active)), 0))]
    own = group[active]
    tied = np.zeros(len(active), bool)
    tied[1:] |= own[1:] == own[:-1]
    tied[:-1] |= own[1:] == own[:-1]
    return order, group, active[tied]


def sort_reduced(text: np.ndarray, stars: np.ndarray, depth: int) -> np.ndarray:
    """The S* positions in the order of their suffixes.

    First the substrings up to the next S* position are named in order (a longer one precedes its own prefix), then
    the string of names is ranked by doubling until all differ or ``depth`` characters are covered.
    """
    n = len(stars)
    ends = np.append(stars[1:] + 1, stars[-1] + 1)
    order, group, active = np.arange(n), np.zeros(n, np.int64), np.arange(n)
    longest, done = int((ends - stars).max()), 0
    while len(active) and done < longest:
        order, group, active = _refine(order, group, lambda i, d=done: _words(text, stars[i] + d, ends[i]), active)
        done += 8
        active = active[(ends[order[active]] - stars[order[active]]) > done - 8] if len(active) else active
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    tied = np.zeros(n, bool)
    same = group[1:] == group[:-1]
    tied[1:] |= same
    tied[:-1] |= same
    active, step = np.flatnonzero(tied), 1
    rank[order] = group
    while len(active) and step <= depth:
        order, group, active = _refine(order, group, lambda i, s=step: rank[np.minimum(i + s, n)], active)
        rank[order] = group
        step *= 2
    return stars[order]


def repeated_starts(text: np.ndarray, folder: str, depth: int, valid: np.ndarray) -> np.ndarray:
    """Marks the ``valid`` positions whose ``depth`` characters also start at another valid position.

    ``text`` is a uint8 array of characters from 2 on with SEPARATORs, one END, and ``depth`` + SPARE PADs behind it.
    """
    if not 1 <= depth <= MAX_DEPTH:
        raise ValueError(f"a depth of {depth} characters; 1 to {MAX_DEPTH} are possible")
    n = len(text) - depth - SPARE
    if n > np.iinfo(_TUPLE["pos"]).max:
        raise ValueError(f"{n} characters; a position in a queue has 32 bits")
    body = text[:n].astype(np.int16)
    # type S: smaller than the next suffix; equal characters share the type of the end of their run
    differs = np.append(body[1:] != body[:-1], True)
    to = np.where(differs, np.arange(n), n)
    to = np.minimum.accumulate(to[::-1])[::-1]
    s_type = np.append(body[:-1] < body[1:], True)[to]
    stars = np.flatnonzero(s_type & ~np.append(True, s_type[:-1]))
    del differs, to, s_type, body
    ordered = sort_reduced(text, stars, depth)
    lcps = np.zeros(len(ordered), _LCP)
    lcps[1:] = common_prefix(text, ordered[:-1], ordered[1:], depth)
    heads = text[ordered]
    star_at = np.searchsorted(heads, np.arange(257))

    def pair(a: int, b: int) -> int:
        return int(common_prefix(text, np.array([a]), np.array([b]), depth)[0])

    larger = [Queue(os.path.join(folder, f"l{c}")) for c in range(255)]
    phase = Induction(text, larger, depth)
    for c in range(255):
        last = -1
        while len(rows := larger[c].next()):
            last = int(rows["pos"][-1])
            phase.block(rows["pos"].astype(np.int64), rows["lcp"], lambda b, c=c: b >= c)
        lo, hi = star_at[c], star_at[c + 1]
        if hi > lo:
            lcps[lo] = pair(last, int(ordered[lo])) if last >= 0 else 0
            for s in range(lo, hi, BLOCK):
                phase.block(ordered[s:min(hi, s + BLOCK)], lcps[s:min(hi, s + BLOCK)], lambda b, c=c: b > c)
    del ordered, lcps, heads

    smaller = [Queue(os.path.join(folder, f"s{c}")) for c in range(255)]
    phase = Induction(text, smaller, depth)
    joint = np.zeros(255, _LCP)  # common prefix of a character's last L and first S suffix
    for c in range(254, -1, -1):
        if c == END:
            break
        last = -1
        while len(rows := smaller[c].next()):
            last = int(rows["pos"][-1])
            phase.block(rows["pos"].astype(np.int64), rows["lcp"], lambda b, c=c: b <= c)
        size, follow = len(larger[c]), 0
        for hi in range(size, 0, -BLOCK):
            rows = larger[c].slice(max(0, hi - BLOCK), hi)[::-1]
            lcp = np.empty(len(rows), _LCP)
            lcp[1:] = rows["lcp"][:-1]
            if hi == size:
                follow = joint[c] = pair(last, int(rows["pos"][0])) if last >= 0 else 0
            lcp[0] = follow
            follow = rows["lcp"][-1]
            phase.block(rows["pos"].astype(np.int64), lcp, lambda b, c=c: b < c)

    marks = np.zeros(n, bool)
    for c in range(2, 255):
        up, down = larger[c].slice(0, len(larger[c])), smaller[c].slice(0, len(smaller[c]))[::-1]
        pos = np.concatenate([up["pos"], down["pos"]])
        if len(pos) < 2:
            continue
        lcp = np.zeros(len(pos), _LCP)
        lcp[:len(up)] = up["lcp"]
        if len(down):
            lcp[len(up)] = joint[c] if len(up) else 0
            lcp[len(up) + 1:] = down["lcp"][:-1]
        at = np.flatnonzero(valid[pos])
        if len(at) < 2:
            continue
        lows = np.minimum.reduceat(lcp, np.append(0, at[:-1] + 1))[1:len(at)] if at[-1] + 1 >= len(lcp) else np.minimum.reduceat(lcp, np.append(np.append(0, at[:-1] + 1), at[-1] + 1))[1:len(at)]
        hit = lows >= depth
        marks[pos[at[1:][hit]]] = True
        marks[pos[at[:-1][hit]]] = True
    return marks
