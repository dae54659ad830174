"""Line dedup: sharded cuckoo filters over exact reference tables, with insertions and document deletions.

``LineIndex`` is a folder of Parquet tables, all dealt by a shard of the line key's hash:

refs     (shard, key, doc_id)           every document that holds a line key, once
counts   (shard, key, n_docs, last_doc) the exact reference counts, and the largest doc_id
filters  (shard, seats, slots)          a cuckoo filter of the keys found in at least ``min_docs`` documents

Insertions append references, deletions take a document's references out; the touched keys' counts are taken anew and
keys that reach or leave ``min_docs`` enter or leave their shard's filter, so both are reversible. Rewriting probes the
filters first: a line whose fingerprint is absent certainly stays, and only the rest meets the exact tables.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourcast.llm.store import new_path, sha256, table

BLANK = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = str.maketrans(UPPER, LOWER)
#: Filters are sent to all tasks up to so many bytes; beyond it the exact tables are joined without a filter.
FILTER_BYTES = 64 << 20


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; supports insert, delete and membership of 16-byte keys."""

    def __init__(self, buckets: int = 64, slots: bytes | None = None):
        self.buckets = buckets
        self.slots = np.zeros((buckets, 4), np.uint16) if slots is None else np.frombuffer(slots, np.uint16).reshape(buckets, 4).copy()

    @staticmethod
    def _places(key: bytes, buckets: int) -> tuple[int, int, int]:
        print_ = int.from_bytes(key[8:10], "little") % 65535 + 1
        first = int.from_bytes(key[:8], "little") & (buckets - 1)
        return print_, first, (first ^ (print_ * 0x5BD1E995)) & (buckets - 1)

    def __contains__(self, key: bytes) -> bool:
        print_, a, b = self._places(key, self.buckets)
        return print_ in self.slots[a] or print_ in self.slots[b]

    def add(self, key: bytes) -> bool:
        """False if no seat was found (the caller doubles the filter and adds all keys anew)."""
        print_, a, b = self._places(key, self.buckets)
        for at in (a, b):
            free = np.flatnonzero(self.slots[at] == 0)
            if len(free):
                self.slots[at, free[0]] = print_
                return True
        at = b
        for turn in range(500):
            seat = turn & 3
            print_, self.slots[at, seat] = int(self.slots[at, seat]), print_
            at = (at ^ (print_ * 0x5BD1E995)) & (self.buckets - 1)
            free = np.flatnonzero(self.slots[at] == 0)
            if len(free):
                self.slots[at, free[0]] = print_
                return True
        return False

    def remove(self, key: bytes) -> bool:
        print_, a, b = self._places(key, self.buckets)
        for at in (a, b):
            held = np.flatnonzero(self.slots[at] == print_)
            if len(held):
                self.slots[at, held[0]] = 0
                return True
        return False

    @classmethod
    def of(cls, keys: list[bytes]) -> CuckooFilter:
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, len(keys)) / 3.2))))
        while True:
            made = cls(buckets)
            if all(made.add(k) for k in keys):
                return made
            buckets *= 2

    def contains(self, keys: np.ndarray) -> np.ndarray:
        """Membership of keys given as rows of 16 bytes."""
        low = keys[:, :8].copy().view("<u8")[:, 0]
        print_ = (keys[:, 8:10].copy().view("<u2")[:, 0].astype(np.uint64) % np.uint64(65535)) + np.uint64(1)
        mask = np.uint64(self.buckets - 1)
        a = low & mask
        b = (a ^ (print_ * np.uint64(0x5BD1E995))) & mask
        wanted = print_.astype(np.uint16)[:, None]
        return (self.slots[a.astype(np.int64)] == wanted).any(1) | (self.slots[b.astype(np.int64)] == wanted).any(1)


def line_key(line: str) -> bytes:
    return hashlib.md5(line.strip(BLANK).translate(_FOLD).encode("utf-8", "surrogatepass")).digest()


def line_refs(docs: DataFrame, min_chars: int, shards: int) -> DataFrame:
    """(shard, key, doc_id): the distinct keys of at least ``min_chars`` code points of each document."""
    lines = F.array_distinct(F.transform(F.split(F.translate("text", UPPER, LOWER), "\n"), lambda x: F.btrim(x, F.lit(BLANK))))
    lines = F.filter(lines, lambda x: F.char_length(x) >= min_chars)
    rows = docs.where("text is not null").select(F.col("doc_id"), F.explode(lines).alias("line"))
    key = F.unhex(F.md5(F.encode("line", "UTF-8")))
    return rows.select(key.alias("key"), "doc_id").select(_shard(shards), "key", "doc_id").distinct()


def _shard(shards: int) -> F.Column:
    return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard")


class LineIndex:
    """The state in a shared folder. Parameters: ``min_chars`` code points of a key, ``min_docs`` documents that must
    hold a key before its lines go, ``shards``."""

    def __init__(self, spark: SparkSession, min_chars: int = 20, min_docs: int = 3, shards: int = 64, path: str | None = None):
        self.spark, self.min_chars, self.min_docs, self.shards = spark, min_chars, min_docs, shards
        self.path, self.version = path or new_path(spark, "line-index"), 0

    def _at(self, name: str, version: int | None = None) -> str:
        return f"{self.path}/{name}-v{self.version if version is None else version}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._at(name))

    def insert(self, docs: DataFrame) -> None:
        """Adds the documents' lines. A document inserted twice, or rows that share a doc_id, count once."""
        new = line_refs(docs, self.min_chars, self.shards)
        self._replace(self.read("refs").unionByName(new).distinct() if self.version else new)

    def delete(self, docs: DataFrame) -> None:
        """Takes the documents named by ``doc_id`` out; lines that thereby fall under ``min_docs`` are kept again."""
        gone = docs.select("doc_id").distinct().withColumnRenamed("doc_id", "gone")
        refs = self.read("refs")
        self._replace(refs.join(gone, F.col("doc_id").eqNullSafe(F.col("gone")), "left_anti"))

    def _replace(self, refs: DataFrame) -> None:
        was = self.read("counts").where(F.col("n_docs") >= self.min_docs).select("shard", "key") if self.version else None
        filters = self.read("filters") if self.version else None
        version = self.version + 1
        refs.write.parquet(self._at("refs", version))
        counts = self.spark.read.parquet(self._at("refs", version)).groupBy("shard", "key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))
        counts.write.parquet(self._at("counts", version))
        now = self.spark.read.parquet(self._at("counts", version)).where(F.col("n_docs") >= self.min_docs).select("shard", "key")
        if filters is None:
            made = now.groupBy("shard").applyInPandas(_build, "shard int, seats long, slots binary")
        else:
            moves = now.join(was, ["shard", "key"], "left_anti").withColumn("enters", F.lit(True)).unionByName(was.join(now, ["shard", "key"], "left_anti").withColumn("enters", F.lit(False)))
            moved = filters.groupBy("shard").cogroup(moves.groupBy("shard")).applyInPandas(_move, "shard int, seats long, slots binary")
            full = now.groupBy("shard").cogroup(moved.where("seats < 0").groupBy("shard")).applyInPandas(_rebuild, "shard int, seats long, slots binary")
            made = moved.where("seats >= 0").unionByName(full)
        made.write.parquet(self._at("filters", version))
        self.version = version

    def drops(self) -> DataFrame:
        """(doc_id, key) whose lines go: keys of at least ``min_docs`` documents, in all but the largest doc_id.

        The filters are broadcast if their summed size is within FILTER_BYTES; the exact join follows either way.
        """
        refs, filters = self.read("refs"), self.read("filters")
        size = filters.agg(F.sum(F.length("slots"))).first()[0] or 0
        if size <= FILTER_BYTES:
            held = self.spark.sparkContext.broadcast({r.shard: (r.seats, bytes(r.slots)) for r in filters.collect()})
            refs = refs.mapInPandas(lambda frames: _probe(frames, held.value), refs.schema)
        counts = self.read("counts").where(F.col("n_docs") >= self.min_docs)
        hits = refs.join(counts, ["shard", "key"]).where(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
        return hits.select("doc_id", "key")

    def rewrite(self, docs: DataFrame) -> DataFrame:
        """``docs`` with added columns kept (the text that stays; null stays null), n_lines and n_dropped.

        Null or empty text has one empty line. Rows that share a doc_id lose the same keys.
        """
        lists = self.drops().groupBy("doc_id").agg(F.collect_list("key").alias("__keys")).withColumnRenamed("doc_id", "__id")
        rows = docs.join(lists, F.col("doc_id").eqNullSafe(F.col("__id")), "left").drop("__id")
        cut = rows.withColumn("__cut", _cut_lines(F.col("text"), F.col("__keys")))
        lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(1)).cast("long")
        touched = F.col("__keys").isNotNull()
        return (cut.withColumn("kept", F.when(touched, F.col("__cut.kept")).otherwise(F.col("text"))).withColumn("n_lines", lines)
                .withColumn("n_dropped", F.when(touched, F.col("__cut.n_dropped")).otherwise(F.lit(0)).cast("long")).drop("__cut", "__keys"))


def _build(frame: pd.DataFrame) -> pd.DataFrame:
    made = CuckooFilter.of(sorted(frame["key"]))
    return pd.DataFrame({"shard": frame["shard"].iloc[:1].tolist(), "seats": [made.buckets], "slots": [made.slots.tobytes()]})


def _move(filters: pd.DataFrame, moves: pd.DataFrame) -> pd.DataFrame:
    """A shard's filter after keys left and entered; seats -1 if it is full and must be built anew."""
    shard = int((filters if len(filters) else moves)["shard"].iloc[0])
    held = CuckooFilter(int(filters["seats"].iloc[0]), filters["slots"].iloc[0]) if len(filters) else None
    if held is None:
        held = CuckooFilter.of(sorted(moves["key"][moves["enters"]]))
    else:
        done = all([held.remove(k) for k in moves["key"][~moves["enters"].astype(bool)]]) and all(held.add(k) for k in sorted(moves["key"][moves["enters"].astype(bool)]))
        if not done:
            return pd.DataFrame({"shard": [shard], "seats": [-1], "slots": [b""]})
    return pd.DataFrame({"shard": [shard], "seats": [held.buckets], "slots": [held.slots.tobytes()]})


def _rebuild(keys: pd.DataFrame, full: pd.DataFrame) -> pd.DataFrame:
    if not len(full):
        return pd.DataFrame({"shard": pd.Series(dtype="int32"), "seats": pd.Series(dtype="int64"), "slots": pd.Series(dtype="object")})
    return _build(keys) if len(keys) else pd.DataFrame({"shard": full["shard"].iloc[:1].tolist(), "seats": [16], "slots": [CuckooFilter(16).slots.tobytes()]})


def _probe(frames: Iterator[pd.DataFrame], filters: dict[int, tuple[int, bytes]]) -> Iterator[pd.DataFrame]:
    ready = {k: CuckooFilter(*v) for k, v in filters.items()}
    for f in frames:
        keep = np.zeros(len(f), bool)
        keys = np.frombuffer(b"".join(f["key"]), np.uint8).reshape(-1, 16)
        shards = f["shard"].to_numpy()
        for shard in np.unique(shards):
            if shard in ready:
                at = np.flatnonzero(shards == shard)
                keep[at] = ready[shard].contains(keys[at])
        yield f[keep]


@F.pandas_udf(T.StructType([T.StructField("kept", T.StringType()), T.StructField("n_dropped", T.LongType())]))
def _cut_lines(text: pd.Series, keys: pd.Series) -> pd.DataFrame:
    kept: list[str | None] = []
    dropped: list[int] = []
    for t, k in zip(text, keys):
        if k is None or t is None:
            kept.append(None)
            dropped.append(0)
            continue
        gone, lines = {bytes(x) for x in k}, t.split("\n")
        stay = [x for x in lines if line_key(x) not in gone]
        kept.append("\n".join(stay))
        dropped.append(len(lines) - len(stay))
    return pd.DataFrame({"kept": kept, "n_dropped": dropped})


def dedup_lines(docs: DataFrame, **parameters) -> DataFrame:
    index = LineIndex(docs.sparkSession, **parameters)
    index.insert(docs)
    return index.rewrite(docs)


def without_repeated_lines(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with the lines that stay as text, and n_chars, where there is such a column, counted anew if lines went."""
    rows = dedup_lines(docs, **parameters)
    columns = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col("n_dropped") > 0, F.char_length("kept")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in docs.columns])


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", sha256(F.coalesce("kept", F.lit(""))).alias("kept_sha256"))


SQL2 = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
heavy AS (SELECT k, max(doc_id) AS last_doc FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT d.doc_id, d.pos, d.line, (h.k IS NOT NULL AND d.doc_id <> h.last_doc) AS gone
  FROM keyed d LEFT JOIN heavy h ON d.k = h.k)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN gone THEN NULL ELSE line END, chr(10) ORDER BY pos), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""
