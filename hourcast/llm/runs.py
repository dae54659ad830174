"""Periodic runs of words, caught online by dyadic squares.

At every word, two catchers are open for each power of two L: the completed block of L words that began two or three
blocks ago. The last L words are compared with both (by hash). A block that returns after p words, 2L <= p < 4L, is
the kernel of a square of period p as soon as the words on both sides agree far enough; comparisons that hold for
block after block are one chain, which ends online when they break. Each chain is extended to both sides by less than
a block, halving the step. A stretch that equals itself p words on for p words or more is a run of period p; every run
holds a block, so none is missed. Stretches that several periods explain keep the smallest.

Hashes find candidates only: each is compared word by word before it is reported, and where that fails its stretch is
searched word by word. Work is O(n log n) for n words, memory O(n), whatever the words are.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm.hashing import mix, powers
from hourcast.llm.store import sha256, table
from hourcast.llm.token_counts import split_words

#: Shortest run, in words.
LEAST = 12
#: Symbols that are appended at a time: bounds what a step holds besides the sequence.
STEP = 1 << 17
#: Words of documents that share a sequence.
TOGETHER = 1 << 16


class SquareCatcher:
    """Runs of a growing sequence of symbols (uint64). ``longest``: periods above half of it are not watched."""

    def __init__(self, longest: int | None = None):
        self.longest, self.size = longest, 0
        self.symbols, self.sums = np.empty(0, np.uint64), np.zeros(1, np.uint64)
        self.open: dict[tuple[int, int], np.ndarray] = {}  # by block size and distance: which of the last comparisons hold
        self.done: dict[int, int] = {}
        self.begun: dict[tuple[int, int], list[np.ndarray]] = {}
        self.ended: dict[tuple[int, int], list[np.ndarray]] = {}

    def append(self, symbols: np.ndarray) -> None:
        """The next symbols; catchers see them all before the next call."""
        for at in range(0, len(symbols), STEP):
            self._append(symbols[at:at + STEP])

    def _append(self, new: np.ndarray) -> None:
        size = self.size + len(new)
        if size > len(self.symbols):
            room = max(size, 2 * len(self.symbols))
            self.symbols = np.concatenate([self.symbols[:self.size], np.empty(room - self.size, np.uint64)])
            self.sums = np.concatenate([self.sums[:self.size + 1], np.empty(room - self.size, np.uint64)])
        self.symbols[self.size:size] = new
        np.cumsum(mix(new + np.uint64(0x9E3779B97F4A7C15)) * powers("up", size)[self.size:], out=self.sums[self.size + 1:size + 1])
        self.sums[self.size + 1:size + 1] += self.sums[self.size]
        self.size = size
        block, longest = 1, self.longest or size
        while 4 * block <= max(longest, 4) and 2 * block < size:
            self._watch(block)
            block *= 2

    def hashes(self, begin: np.ndarray, size: int) -> np.ndarray:
        return (self.sums[begin + size] - self.sums[begin]) * powers("down", self.size)[begin]

    def _watch(self, block: int) -> None:
        """Compares the windows of ``block`` words that are complete now with the blocks at their distances."""
        begin, end = self.done.get(block, 0), self.size - block + 1
        if end <= begin:
            return
        self.done[block] = end
        windows = (self.sums[begin + block:end + block] - self.sums[begin:end]) * powers("down", self.size)[begin:end]
        row = np.arange(begin, end) // block
        low = max(0, int(row[0]) - 3)
        blocks = self.hashes(np.arange(low, int(row[-1]) + 1) * block, block) if block > 1 else None
        for distance in (1, 2, 3) if block == 1 else (2, 3):
            skip = min(max(0, distance * block - begin), end - begin)  # words before the first such block
            holds = np.zeros(end - begin, bool)
            if block == 1:
                at = np.arange(begin + skip, end)
                holds[skip:] = self.symbols[at] == self.symbols[at - distance]
            else:
                holds[skip:] = windows[skip:] == blocks[row[skip:] - distance - low]
            key = (block, distance)
            known = np.concatenate([self.open.get(key, np.zeros(block, bool)), holds])
            before = known[:-block]
            for found, place, shift in ((self.begun, holds & ~before, 0), (self.ended, before & ~holds, block)):
                at = np.flatnonzero(place)
                if len(at):
                    found.setdefault(key, []).append(at + begin - shift)
            self.open[key] = known[-block:]

    def _chains(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Block size; period, first and last window of every chain."""
        for key, begun in self.begun.items():
            block, distance = key
            still = np.flatnonzero(self.open[key]) + self.done[block] - block
            first, last = np.concatenate(begun), np.concatenate([*self.ended.get(key, []), still])
            first, last = (x[np.lexsort((x, x % block))] for x in (first, last))
            yield block, distance * block + first % block, first, last

    def runs(self, least: int = LEAST) -> np.ndarray:
        """Rows (start, length, period), sorted: the runs of at least ``least`` words and two periods so far."""
        found = []
        for block, period, first, last in self._chains():
            reach = last - first + 3 * block  # more than any extension gives
            keep = (reach > period) & (reach + period >= least)
            period, first, last = period[keep], first[keep], last[keep]
            low, high = first - period, last + block - period  # the words low..high equal those a period on
            step = block // 2
            while step and len(low):
                can = np.flatnonzero(low >= step)
                same = self.hashes(low[can] - step, step) == self.hashes(low[can] + period[can] - step, step)
                low[can[same]] -= step
                can = np.flatnonzero(high + period + step <= self.size)
                same = self.hashes(high[can], step) == self.hashes(high[can] + period[can], step)
                high[can[same]] += step
                step //= 2
            keep = (high - low >= period) & (high - low + period >= least)
            found.append(np.column_stack([low, high + period, period])[keep])
        if not found:
            return np.empty((0, 3), np.int64)
        rows = np.concatenate(found).astype(np.int64)
        checked, known = [], None
        for low, high, period in rows[np.lexsort(rows.T[::-1])]:
            if known == (low, high):
                continue  # a smaller period explains the stretch
            same = self.symbols[low:high - period] == self.symbols[low + period:high]
            if same.all():
                checked.append((low, high, period))
                known = (low, high)
                continue
            edges = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
            checked += [(low + a, low + b + period, period) for a, b in zip(edges[::2], edges[1::2]) if b - a >= period and b - a + period >= least]
        rows = np.array(sorted(set(checked)), np.int64).reshape(-1, 3)
        first = np.ones(len(rows), bool)
        first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)  # of equal stretches the smallest period comes first
        rows = rows[first]
        return np.column_stack([rows[:, 0], rows[:, 1] - rows[:, 0], rows[:, 2]])


def runs_of(texts: list[list[str]], least: int = LEAST) -> list[np.ndarray]:
    """Runs of each of several word lists, as rows (start, length, period) sorted by start, then period."""
    ids: dict[str, int] = {}
    sizes = [len(words) for words in texts]
    ends = np.cumsum([0, *sizes])
    codes = np.fromiter((ids.setdefault(w, len(ids)) for words in texts for w in words), np.uint64, int(ends[-1]))
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), sizes)
    catcher = SquareCatcher(max(sizes, default=0))
    catcher.append(owner << np.uint64(40) | codes)  # words of different texts are never equal
    rows = catcher.runs(least)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    of = np.searchsorted(ends, rows[:, 0], "right") - 1
    cut = np.searchsorted(of, np.arange(len(texts) + 1))
    out = [rows[a:b].copy() for a, b in zip(cut, cut[1:])]
    for begin, own in zip(ends, out):
        own[:, 0] -= begin
    return out


def collapsed(words: list[str], runs: np.ndarray) -> list[str]:
    """The words that no run holds behind its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0)]


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs array<struct<start, length, period>> by start, then period, and the collapsed text.

    Words are the runs of characters other than 0x20 and 0x09-0x0D, numbered from 0. A run is a stretch of at least
    ``least`` words and two of its smallest periods that no neighbour extends. The collapsed text has the words that no
    run holds behind its first period, joined by one space. Null, empty and blank texts have no words, no runs and an
    empty collapsed text. One row per row of ``docs``, repeated rows included; only doc_id and text are read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, texts, held = 0, [], 0
            for at, text in enumerate(batch.column("text")):
                texts.append(split_words(text.as_py() or ""))
                held += len(texts[-1])
                if held < TOGETHER and at + 1 < batch.num_rows:
                    continue
                found = runs_of(texts, least)
                rows = np.concatenate(found)
                ends = np.cumsum([0, *map(len, found)])
                runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(3)], fields=list(run_type)))
                texts_left = pa.array([" ".join(collapsed(w, r)) for w, r in zip(texts, found)], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(begin, len(texts)), pa.array([len(w) for w in texts], pa.int64()), runs, texts_left],
                                                 ["doc_id", "n_words", "runs", "collapsed"])
                begin, texts, held = at + 1, [], 0

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, runs array<struct<start long, length long, period long>>, collapsed string")


def planted(doc_id: Column, text: Column) -> Column:
    """The text, or for one document in ten (by checksum of its id) its words with a repeated tail, joined by spaces."""
    h = F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))

    def tail(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        turned = F.transform(F.sequence(a, n - 1), lambda i: F.element_at(words, (a + (i - a) % p + 1).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), turned), " ")

    # the words are bound once, as the element of an array, and not split anew for every word of the tail
    made = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, tail(w)).otherwise(""))[0]
    return F.when((h % 10 == 0) & text.isNotNull(), made).otherwise(text)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed").select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"), sha256(F.col("lines")).alias("runs_sha256"),
        sha256(F.col("collapsed")).alias("collapsed_sha256"))
