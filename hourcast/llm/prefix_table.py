"""The table of each prefix's last token, which BPE coders share, and a bounded memory for what a task has met.

Every prefix of a string has exactly one last token in its BPE encoding: the token ending there that is compatible
with the last token of the rest before it. An automaton gives the tokens that end at each place, longest first; the
table keeps the last token of each prefix, and the ids are recovered from the end backwards.
"""
from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa

#: Token pairs of which a task keeps whether they are compatible.
KEPT_PAIRS = 400_000


class PrefixTable:
    """Ids of strings of symbols (one character each) by the tokens' symbol strings and a test of token pairs.

    ``compatible(before, token)``: whether the two are encoded as themselves side by side; ``before`` -1: whether the
    token alone is. Every symbol of a string must be a token.
    """

    def __init__(self, tokens: dict[str, int], compatible: Callable[[int, int], bool]):
        self.compatible, self.pairs = compatible, {}
        self.shift = max(tokens.values(), default=0).bit_length()
        self.next: list[dict[str, int]] = [{}]
        self.ends: list[tuple[tuple[int, int], ...]] = [()]
        for symbols, token in tokens.items():
            at = 0
            for c in symbols:
                to = self.next[at].get(c)
                if to is None:
                    to = self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.ends.append(())
                at = to
            self.ends[at] = ((len(symbols), token),)
        self.fail = [0] * len(self.next)
        todo = deque(self.next[0].values())
        while todo:
            at = todo.popleft()
            for c, to in self.next[at].items():
                back = self.fail[at]
                while back and c not in self.next[back]:
                    back = self.fail[back]
                self.fail[to] = self.next[back].get(c, 0)
                todo.append(to)
            self.ends[at] += self.ends[self.fail[at]]

    def step(self, at: int, c: str) -> int:
        """The state after ``c`` where the trie has none below ``at``; it is entered there."""
        back = self.fail[at]
        while back and c not in self.next[back]:
            back = self.fail[back]
        to = self.next[at][c] = self.next[back].get(c, 0)
        return to

    def encode_all(self, strings: Iterable[str]) -> Iterator[list[int]]:
        """Ids of each string. What one shares with the string before it stays in the table, so sort them."""
        follow, ends, pairs, shift = self.next, self.ends, self.pairs, self.shift
        last, sizes, states, before_it = [-1], [0], [0], ""
        for symbols in strings:
            same = 0
            for a, b in zip(before_it, symbols):
                if a != b:
                    break
                same += 1
            before_it = symbols
            del last[same + 1:], sizes[same + 1:], states[same + 1:]
            at = states[-1]
            for c in symbols[same:]:
                to = follow[at].get(c)
                at = self.step(at, c) if to is None else to
                states.append(at)
                for size, token in ends[at]:
                    before = last[-size]
                    fits = pairs.get(before << shift | token)
                    if fits is None:
                        if len(pairs) >= KEPT_PAIRS:
                            pairs.clear()
                        fits = pairs[before << shift | token] = self.compatible(before, token)
                    if fits:
                        last.append(token)
                        sizes.append(size)
                        break
                else:
                    raise ValueError(f"no token ends with {c!r}")
            out, end = [], len(symbols)
            while end:
                out.append(last[end])
                end -= sizes[end]
            out.reverse()
            yield out

    def encode(self, symbols: str) -> list[int]:
        return next(self.encode_all([symbols]))


class Met:
    """What ``make`` gives for chunks (a dict of all those it is asked for), kept in two generations.

    A generation that is full becomes the older one; what is met again there moves to the younger one. ``size`` is
    about the bytes of a generation.
    """

    def __init__(self, make: Callable[[list[str]], dict], size: int = 48_000_000):
        self.make, self.size = make, size
        self.young, self.older, self.weight = {}, {}, 0

    def of(self, rows: list[list[str]]) -> dict:
        """A dict with all chunks of the rows."""
        found, older = self.young, self.older
        new = set().union(*rows).difference(found)
        again = new.intersection(older)
        found.update({c: older[c] for c in again})
        found.update(self.make(sorted(new - again)))
        self.weight += 300 * len(new) + 10 * sum(map(len, new))
        if self.weight > self.size:
            self.young, self.older, self.weight = {}, found, 0
        return found


def slices(batch: pa.RecordBatch, characters: int = 3_000_000) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch that hold about so many characters (one row at least), and their texts ("" for null)."""
    begin, texts, held = 0, [], 0
    for at, text in enumerate(batch.column("text")):
        texts.append(text.as_py() or "")
        held += len(texts[-1])
        if held >= characters:
            yield batch.slice(begin, at + 1 - begin), texts
            begin, texts, held = at + 1, [], 0
    if texts:
        yield batch.slice(begin), texts
