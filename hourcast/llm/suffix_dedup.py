"""Suffix-array dedup: bytes covered by a long string that also starts elsewhere, by external induced sorting.

A string of ``length`` bytes is dealt by the smallest hash among its k-mers, so equal strings meet wherever they stand.
Consecutive starts with the same smallest hash make a piece; pieces whose hash is nowhere else can be skipped, equal
pieces are one piece with a count. Each shard's pieces are sorted by external induced sorting (``induced``), and the
common-prefix values between neighbours in the suffix array tell which starts repeat. A shard is sorted in batches of
whole keys; a key with more pieces than a batch may hold is dealt anew by a hash of each of its strings, and the counts
of the strings tell which repeat. Spans go back to the documents.
"""
from __future__ import annotations

import hashlib
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourcast.llm.hashing import mix, prefix_hash, powers, span_hash
from hourcast.llm.induced import END, MAX_DEPTH, PAD, SEPARATOR, SPARE, repeated_starts
from hourcast.llm.store import shuffle_partitions, table, written

KMER = 32
#: Bytes of pieces that a shard is planned for, and the most of one key that is sorted; a batch holds less than twice that.
SHARD_BYTES = 8 << 20
_NO_ID = -(1 << 63)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def pieces_of(data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """key, h1, h2, start, count, times of the pieces of a text: runs of starts whose strings have the same smallest
    k-mer hash; times is 2 if that k-mer stands in the piece more than once, so that a string may repeat inside it."""
    k = min(KMER, length)
    first, second = prefix_hash(data), prefix_hash(data, 1)
    at = np.arange(len(data) - k + 1)
    kmers = mix((first[at + k] - first[at]) * powers("down", len(first))[at])
    least = window_minima(kmers, length - k + 1)
    start = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    end = np.append(start[1:], len(least))
    stop = end + length - 1
    width, times = length - k + 1, np.ones(len(start), np.int64)
    for s in range(0, len(start), 4096):
        a, b = start[s:s + 4096], end[s:s + 4096] - 1
        leftmost = a + np.argmin(kmers[a[:, None] + np.arange(width)], axis=1)
        rightmost = b + width - 1 - np.argmin(kmers[b[:, None] + np.arange(width - 1, -1, -1)], axis=1)
        times[s:s + 4096] += leftmost != rightmost
    return least[start].view(np.int64), span_hash(first, start, stop).view(np.int64), span_hash(second, start, stop).view(np.int64), start, end - start, times


def _identified(docs: DataFrame) -> DataFrame:
    """did, th: what names a row's text (rows that repeat both are equal)."""
    return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("did"), F.xxhash64("text").alias("th"), F.coalesce("text", F.lit("")).alias("text"))


def occurrences(docs: DataFrame, length: int) -> DataFrame:
    """(key, h1, h2, did, th, start, count, times) of every piece of every text."""
    names = ["key", "h1", "h2", "did", "th", "start", "count", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in names]
            for did, th, text in zip(batch.column("did"), batch.column("th"), batch.column("text")):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                if len(data) >= length:
                    key, h1, h2, start, count, times = pieces_of(data, length)
                    for c, v in zip(columns, (key, h1, h2, np.full(len(key), did.as_py()), np.full(len(key), th.as_py()), start, count, times)):
                        c.append(v)
            arrays = [np.concatenate(c) for c in columns]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32() if n in ("start", "count", "times") else pa.int64()) for a, n in zip(arrays, names)], names)

    return _identified(docs).mapInArrow(run, "key long, h1 long, h2 long, did long, th long, start int, count int, times int")


def _packed(docs: DataFrame) -> DataFrame:
    """The texts compressed for a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            blobs = pa.array([pack(t.as_buffer()) for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("did"), batch.column("th"), blobs], ["doc_id", "did", "th", "blob"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _identified(docs).mapInArrow(run, f"doc_id {kind}, did long, th long, blob binary")


def cut_pieces(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(key, h1, h2, n, data): the bytes of the wanted pieces (key, h1, h2, n, did, th, start, count)."""
    lists = wanted.groupBy("did", "th").agg(F.collect_list(F.struct("key", "h1", "h2", "n", "start", "count")).alias("own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out: list[tuple] = []
            for blob, own in zip(batch.column("blob"), batch.column("own")):
                data = unpack(blob.as_py())
                out += [(p["key"], p["h1"], p["h2"], p["n"], data[p["start"]:p["start"] + p["count"] + length - 1]) for p in own.as_py()]
            columns = list(zip(*out)) if out else [()] * 5
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "h1", "h2", "n", "data"])

    return _packed(docs).join(lists, ["did", "th"]).select("blob", "own").mapInArrow(run, "key long, h1 long, h2 long, n long, data binary")


def repeated_in_shards(pieces: DataFrame, length: int, shards: int, batch_bytes: int = SHARD_BYTES) -> DataFrame:
    """(h1, h2, low, high): ranges of starts in a piece whose strings also start elsewhere.

    Equal strings have one key, so a task sorts whole keys, ``batch_bytes`` and the rest of a key at a time.
    """
    shift = bytes((i + 2) & 255 for i in range(256))  # no UTF-8 byte exceeds 0xF4, so none meets the marks

    def ranges(h1: list[int], h2: list[int], n: list[int], data: list[bytes]) -> pa.RecordBatch:
        sizes = np.array([len(d) for d in data])
        text = np.frombuffer(bytes([SEPARATOR]).join(data) + bytes([SEPARATOR, END]) + bytes([PAD]) * (length + SPARE), np.uint8)
        data.clear()
        begin = np.append(0, np.cumsum(sizes + 1)[:-1])
        edge = np.zeros(len(text) - length - SPARE + 1, np.int8)
        edge[begin] += 1
        edge[begin + sizes - length + 1] -= 1
        valid = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
        folder = tempfile.mkdtemp(prefix="suffixes-")
        try:
            marks = repeated_starts(text, folder, length, valid)
        finally:
            shutil.rmtree(folder)
        many = np.flatnonzero(np.array(n) > 1)
        edge = np.zeros(len(marks) + 1, np.int8)
        edge[begin[many]] += 1
        edge[begin[many] + sizes[many] - length + 1] -= 1
        marks |= np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
        turn = np.diff(np.concatenate([[0], marks.astype(np.int8), [0]]))
        low, high = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
        owner = np.searchsorted(begin, low, side="right") - 1
        return pa.RecordBatch.from_arrays([pa.array(np.array(h1)[owner]), pa.array(np.array(h2)[owner]), pa.array((low - begin[owner]).astype(np.int32)), pa.array((high - begin[owner]).astype(np.int32))], ["h1", "h2", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h1, h2, n, data = [], [], [], []
        seen: set[tuple[int, int]] = set()
        held, last = 0, None
        for batch in batches:
            for key, a, b, many, blob in zip(*(batch.column(c) for c in ("key", "h1", "h2", "n", "data"))):
                key = key.as_py()
                if key != last:
                    if held >= batch_bytes:
                        yield ranges(h1, h2, n, data)
                        h1, h2, n, data, held = [], [], [], [], 0
                    seen.clear()
                    last = key
                name = (a.as_py(), b.as_py())
                if name not in seen:
                    seen.add(name)
                    h1.append(name[0])
                    h2.append(name[1])
                    n.append(many.as_py())
                    data.append(blob.as_py().translate(shift))
                    held += len(data[-1])
        if data:
            yield ranges(h1, h2, n, data)

    dealt = pieces.select("key", "h1", "h2", "n", "data").repartition(shards, "key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "h1 long, h2 long, low int, high int")


def repeated_by_string(pieces: DataFrame, length: int) -> DataFrame:
    """The same ranges by the counts of each string, so that the pieces of one key lie with many tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, many, blob in zip(*(batch.column(c) for c in ("h1", "h2", "n", "data"))):
                data = np.frombuffer(blob.as_buffer(), np.uint8)
                first, second = prefix_hash(data), prefix_hash(data, 1)
                for lo in range(0, len(data) - length + 1, 1 << 16):
                    at = np.arange(lo, min(lo + (1 << 16), len(data) - length + 1))
                    own = [np.full(len(at), v.as_py(), np.int64) for v in (a, b, many)]
                    columns = [span_hash(first, at, at + length).view(np.int64), span_hash(second, at, at + length).view(np.int64), *own, at.astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["s1", "s2", "h1", "h2", "n", "at"])

    strings = pieces.dropDuplicates(["h1", "h2"]).mapInArrow(run, "s1 long, s2 long, h1 long, h2 long, n long, at int")
    again = strings.groupBy("s1", "s2").agg(F.sum("n").alias("times")).where("times > 1").select("s1", "s2")
    found = strings.join(again, ["s1", "s2"]).select("h1", "h2", "at")
    found = found.withColumn("run", F.col("at") - F.row_number().over(Window.partitionBy("h1", "h2").orderBy("at")))
    return found.groupBy("h1", "h2", "run").agg(F.min("at").alias("low"), (F.max("at") + 1).alias("high")).drop("run")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, length: int = 200, digest: bool = False, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, and kept (binary: the bytes that stay) or with ``digest`` kept_sha256.

    Texts are UTF-8 bytes. Every byte goes that a ``length``-byte string covers which also starts anywhere else in the
    corpus, the same text included; matches stay inside a text and are judged on the input. Null is the empty text.
    Rows that repeat a text, with or without its doc_id, repeat its strings. Spans are maximal removed runs. ``length``
    is 1 to 65,000; other values raise ValueError.
    """
    if not 1 <= length <= MAX_DEPTH:
        raise ValueError(f"strings of {length} bytes; 1 to {MAX_DEPTH} are possible")
    occ = written(occurrences(docs, length), "suffix-occurrences")
    again = occ.groupBy("key").agg(F.sum("times").alias("times")).where("times > 1").select("key")
    open_ = written(occ.drop("times").join(again, "key"), "suffix-open")
    reps = open_.groupBy("key", "h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("did", "th", "start", "count")).alias("at"))
    reps = written(reps.select("key", "h1", "h2", "n", "at.*"), "suffix-pieces")
    size = reps.agg(F.sum(F.col("count") + length)).first()[0] or 0
    shards = max(shuffle_partitions(docs.sparkSession), -(-size // shard_bytes))
    large = reps.groupBy("key").agg(F.sum(F.col("count") + length).alias("size")).where(F.col("size") > shard_bytes).select("key")
    large = written(large, "suffix-large")
    pieces = cut_pieces(docs, reps, length)
    if large.head(1):
        pieces = written(pieces, "suffix-cut")
        ranges = repeated_in_shards(pieces.join(large, "key", "left_anti"), length, shards, shard_bytes)
        ranges = ranges.unionByName(repeated_by_string(pieces.join(large, "key", "left_semi"), length))
    else:
        ranges = repeated_in_shards(pieces, length, shards, shard_bytes)
    ranges = written(ranges, "suffix-ranges")
    spans = open_.join(ranges, ["h1", "h2"]).select("did", "th", (F.col("start") + F.col("low")).alias("lo"), (F.col("start") + F.col("high") + length - 1).alias("hi"))
    spans = spans.groupBy("did", "th").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            sizes, removed, counts, kept = [], [], [], []
            for blob, own in zip(batch.column("blob"), batch.column("spans")):
                data = unpack(blob.as_py())
                cuts = merged([(s["lo"], s["hi"]) for s in own.as_py() or []])
                parts, at = [], 0
                for lo, hi in cuts:
                    parts.append(data[at:lo])
                    at = hi
                rest = b"".join([*parts, data[at:]])
                sizes.append(len(data))
                removed.append(len(data) - len(rest))
                counts.append(len(cuts))
                kept.append(hashlib.sha256(rest).hexdigest() if digest else rest)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (sizes, removed, counts)), pa.array(kept, pa.string() if digest else pa.binary())], names)

    last = "kept_sha256" if digest else "kept"
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", last]
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = _packed(docs).join(spans, ["did", "th"], "left").select("doc_id", "blob", "spans")
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, {last} {'string' if digest else 'binary'}")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), digest=True)
