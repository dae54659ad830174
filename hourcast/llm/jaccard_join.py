"""N-gram Jaccard join by grouped prefixes.

Documents with equal shingle sets are one class. The shingles of a class are ordered rarest first, by their document
frequency in the whole corpus, and the shingles that a partner may lack bound the prefix in which it must share one. A
shingle of a single document can be shared with none, so classes with too many of those are out at once. Classes with
the same size and prefix form a group; groups that share a prefix shingle are paired if sizes and positions allow the
similarity, and parity bitmaps, whose distance bounds the sets' difference from below; then members are verified on all
shingles that they share with anything. Members are not expanded into all pairs: each group is first held against one
pivot for each prefix shingle, the same one where shingles agree, and for the few frequent shingles against other pivots
in further rounds, while many of their pairs are open; then groups that are not in one component yet through one member
each, and only pairs of members that are still in different components follow. Prefix shingles that one group has alone
are dropped once; the others are written with all that pivots need, so a round costs its frequent shingles only.

Frequencies take two shuffles of packed arrays, six bytes a shingle: to the shingle's bucket, and from there back to
the batch of documents that it came from (shingles of one document stay behind).
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm.components import connected_components
from hourcast.llm.hashing import mix, set_key, shingle_set
from hourcast.llm.store import shuffle_partitions, table, written

#: Bits of a class's parity bitmap.
BITS = 512
#: From here on numbers stand for classes that hold no doc_id.
STAND_IN = 1 << 62
#: A prefix shingle of more groups than this is frequent.
OFTEN = 16
#: Most rounds in which groups that are apart meet a common pivot of a frequent shingle.
ROUNDS = 8
#: Shingles that a map task holds before it sends them to their buckets.
BATCH = 500_000
#: Parts of a bucket's shingles that are counted one after another.
SLICES = 8
_PACKED = [("bucket", pa.int32()), ("batch", pa.int64()), ("tokens", pa.binary()), ("counts", pa.binary()),
           ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("keys", pa.binary())]
_PACKED_DDL = "bucket int, batch long, tokens binary, counts binary, ids array<long>, sizes array<int>, keys binary"
_SHARED = [("batch", pa.int64()), ("tokens", pa.binary()), ("often", pa.binary()), *_PACKED[3:]]
_SHARED_DDL = "batch long, tokens binary, often binary, counts binary, ids array<long>, sizes array<int>, keys binary"


def _rows(columns: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows) if rows else [()] * len(columns), columns)], [n for n, _ in columns])


def _pack(sets: list[np.ndarray], ids: list[int | None], batch: int, buckets: int) -> list[tuple]:
    """One row per bucket that gets shingles; the first row also names the documents."""
    tokens = np.concatenate(sets)
    bucket = (tokens & np.uint64(0xFFFF)).astype(np.int32) % buckets
    order = np.argsort(bucket, kind="stable")
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[order]
    packed = np.ascontiguousarray(tokens[order]).view(np.uint8).reshape(-1, 8)[:, 2:]
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows = []
    for b in range(buckets):
        lo, hi = ends[b], ends[b + 1]
        if hi > lo or not b:
            counts = np.bincount(owner[lo:hi], minlength=len(sets)).astype(np.int32)
            named = (ids, [len(s) for s in sets], b"".join(map(set_key, sets))) if not b else (None, None, None)
            rows.append((b, batch, packed[lo:hi].tobytes(), counts.tobytes(), *named))
    return rows


def _unpack(blob: bytes, bucket: int) -> np.ndarray:
    out = np.zeros((len(blob) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return out.view(np.uint64)[:, 0] | np.uint64(bucket)


def _shared_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All shingles of some buckets: those of at least two documents go back to their batches, with their frequency."""
    held, parts = [], []
    for batch in batches:
        tokens, rest = batch.column("tokens"), batch.drop_columns(["tokens"]).to_pylist()
        for i, row in enumerate(rest):
            parts.append(_unpack(tokens[i].as_buffer(), row["bucket"]))
            held.append(row)
    if not held:
        return
    often, out = _frequencies(parts), []
    for i, r in enumerate(held):
        counts = np.frombuffer(r["counts"], np.int32)
        keep = often[i] > 1
        owner = np.repeat(np.arange(len(counts)), counts)[keep]
        shared = np.bincount(owner, minlength=len(counts)).astype(np.int32)
        out.append((r["batch"], parts[i][keep].tobytes(), often[i][keep].tobytes(), shared.tobytes(), r["ids"], r["sizes"], r["keys"]))
        parts[i] = often[i] = held[i] = None
        if len(out) == 16:
            yield _rows(_SHARED, out)
            out = []
    yield _rows(_SHARED, out)


def _frequencies(parts: list[np.ndarray]) -> list[np.ndarray]:
    """How often each shingle of some documents occurs among them all, counted slice by slice of the shingles' values."""
    often = [np.empty(len(p), np.uint32) for p in parts]
    for s in range(SLICES):
        at = [np.flatnonzero((p >> np.uint64(32)) % np.uint64(SLICES) == s) for p in parts]
        tokens = np.concatenate([p[w] for p, w in zip(parts, at)])
        if not len(tokens):
            continue
        order = np.argsort(tokens)
        tokens = tokens[order]
        first = np.append(0, np.flatnonzero(tokens[1:] != tokens[:-1]) + 1)
        runs = np.diff(np.append(first, len(tokens)))
        found = np.empty(len(tokens), np.uint32)
        found[order] = np.repeat(np.minimum(runs, 0xFFFFFFFF).astype(np.uint32), runs)
        begin = 0
        for o, w in zip(often, at):
            o[w] = found[begin:begin + len(w)]
            begin += len(w)
    return often


def parity_bits(tokens: np.ndarray) -> np.ndarray:
    """A bitmap whose bits are the parities of the tokens hashed to them: two bitmaps differ in at most as many bits as
    the sets do in tokens."""
    odd = np.bincount((mix(tokens.view(np.uint64)) & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _prefixes(percent: int):
    """Per document: size, set key, number of its own shingles; if a partner is possible, the shared shingles of its
    prefix, rarest first, all shared shingles, and their bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                held.setdefault(row["batch"], []).append(row)
        for key in sorted(held):
            rows = held.pop(key)
            named = next(r for r in rows if r["ids"] is not None)
            sizes = np.array(named["sizes"], np.int64)
            tokens = np.concatenate([np.frombuffer(r["tokens"], np.uint64) for r in rows])
            often = np.concatenate([np.frombuffer(r["often"], np.uint32) for r in rows])
            owner = np.concatenate([np.repeat(np.arange(len(sizes)), np.frombuffer(r["counts"], np.int32)) for r in rows])
            order = np.lexsort((tokens, often, owner))
            tokens, shared = tokens[order].view(np.int64), np.bincount(owner, minlength=len(sizes))
            begin = np.append(0, np.cumsum(shared))
            single = sizes - shared
            spare = sizes - -(-percent * sizes // 100)  # shingles that a partner may lack
            open_ = [bool(sizes[i]) and single[i] <= spare[i] for i in range(len(sizes))]
            wholes = [tokens[begin[i]:begin[i + 1]] if o else None for i, o in enumerate(open_)]
            prefixes = [w[:spare[i] + 1 - single[i]] if w is not None else None for i, w in enumerate(wholes)]
            bits = [parity_bits(w) if w is not None else None for w in wholes]
            keys = [named["keys"][16 * i:16 * i + 16] for i in range(len(sizes))]
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (prefixes, wholes, bits)]
            yield pa.RecordBatch.from_arrays([pa.array(named["ids"], pa.int64()), pa.array(sizes), pa.array(keys, pa.binary()), pa.array(single), *lists],
                                             ["doc_id", "n", "key", "single", "prefix", "shared", "bits"])

    return run


def prefix_table(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, n, key, single, prefix, shared, bits) of each row of ``docs``; the last three are null where no partner
    is possible."""
    buckets = min(shuffle_partitions(docs.sparkSession), 1 << 15)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n = TaskContext.get().partitionId() << 32, 0
        sets, ids, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                sets.append(shingle_set(text.as_py(), words))
                ids.append(doc_id.as_py())
                held += len(sets[-1])
                if held >= BATCH or len(sets) >= 50_000:
                    yield _rows(_PACKED, _pack(sets, ids, base + n, buckets))
                    sets, ids, held, n = [], [], 0, n + 1
        if sets:
            yield _rows(_PACKED, _pack(sets, ids, base + n, buckets))

    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pack, _PACKED_DDL)
    shared = packed.repartition(buckets, "bucket").mapInArrow(_shared_shingles, _SHARED_DDL)
    return shared.repartition(shuffle_partitions(docs.sparkSession), "batch").mapInArrow(_prefixes(percent), "doc_id long, n long, key binary, single long, prefix array<long>, shared array<long>, bits array<long>")


def _near_enough(a: str, b: str, percent: int) -> F.Column:
    """Whether the bitmaps of a and b (columns n, single, bits) leave the similarity possible; unknown bits do.

    The sets differ in each one's own shingles and in at least as many shared ones as the bitmaps differ in bits."""
    col = lambda t, c: F.col(f"{t}.{c}")
    apart = F.aggregate(F.zip_with(col(a, "bits"), col(b, "bits"), lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("long")), F.lit(0).cast("long"), lambda t, x: t + x)
    differ = F.coalesce(apart, F.lit(0)) + col(a, "single") + col(b, "single")
    return (100 + percent) * differ <= (100 - percent) * (col(a, "n") + col(b, "n"))


def posts_of(groups: DataFrame) -> DataFrame:
    """(token, gid, n, left, often): one row per group and prefix shingle that other groups have in their prefixes too,
    with the shingles that are left from there on and the number of its groups."""
    posts = groups.select("gid", "n", "single", F.posexplode("prefix").alias("at", "token")).select("token", "gid", "n", (F.col("n") - F.col("single") - F.col("at")).alias("left"))
    shared = groups.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count("*").alias("often")).where("often > 1")
    return posts.join(shared, "token")


def _in_place(a: str, b: str, percent: int) -> F.Column:
    """Whether sizes and the position of a shared shingle leave the similarity possible."""
    return (100 + percent) * F.least(f"{a}.left", f"{b}.left") >= percent * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def _apart() -> F.Column:
    """Whether groups a and b are not wholly in one component."""
    return (F.col("a.low") != F.col("b.low")) | (F.col("a.low") != F.col("a.high")) | (F.col("b.low") != F.col("b.high"))


def mixed_posts(posts: DataFrame, spread: DataFrame) -> DataFrame:
    """The posts of shingles that groups of more than one component have, with their group's smallest and largest
    component (``spread``: gid, low, high)."""
    posts = posts.join(spread.select("gid", "low", "high"), "gid")
    mixed = posts.groupBy("token").agg(F.min("low").alias("l"), F.max("high").alias("h")).where("l <> h").select("token")
    return posts.join(mixed, "token", "left_semi")


def open_pairs(posts: DataFrame) -> tuple[int, int]:
    """Pairs of groups in different components that share a prefix shingle, counted for each shingle, and the posts."""
    per = posts.groupBy("token", "low").agg(F.count("*").cast("double").alias("c"))
    per = per.groupBy("token").agg(F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("own"))
    found = per.agg(F.sum((F.col("c") * F.col("c") - F.col("own")) / 2).alias("pairs"), F.sum("c").alias("posts")).first()
    return int(found["pairs"] or 0), int(found["posts"] or 0)


def pivot_pairs(posts: DataFrame, groups: DataFrame, percent: int, turn: int) -> DataFrame:
    """(a, b): groups and, for each prefix shingle, the pivot of the groups with nearly their size, where the two are
    apart (posts without low and high: all are). The order of the pivots is the same for all shingles of a turn, so that
    the shingles of near copies agree on one; another turn has another order, and size bands shifted by a half. The
    pairs grow with the posts, however many groups share a shingle."""
    size = F.log(F.col("n").cast("double")) / math.log(100 / percent) if percent < 100 else F.col("n")
    posts = posts.select("*", F.floor(size + (turn % 2) / 2).cast("long").alias("band"))
    told = [c for c in ("gid", "n", "left", "low", "high") if c in posts.columns]
    best = posts.groupBy("token", "band").agg(F.min_by(F.struct(*told), F.xxhash64(F.lit(turn), "gid")).alias("p"))
    pivots = best.select(F.col("token").alias("t"), F.col("band").alias("w"), "p.*")
    a, b = posts.alias("a"), pivots.alias("b")
    apart = _apart() if "low" in told else F.lit(True)
    found = a.join(b, (F.col("a.token") == F.col("b.t")) & (F.col("a.band") == F.col("b.w")) & (F.col("a.gid") != F.col("b.gid")) & apart & _in_place("a", "b", percent))
    found = found.select(F.least("a.gid", "b.gid").alias("x"), F.greatest("a.gid", "b.gid").alias("y")).distinct()
    bits = groups.select("gid", "n", "single", "bits")
    l, r = bits.alias("l"), bits.alias("r")
    return found.join(l, F.col("x") == F.col("l.gid")).join(r, F.col("y") == F.col("r.gid")).where(_near_enough("l", "r", percent)).select(F.col("x").alias("a"), F.col("y").alias("b"))


def group_pairs(posts: DataFrame, percent: int) -> DataFrame:
    """(a, b) of groups that share a prefix shingle at positions which allow the similarity, and whose bitmaps (of groups
    of one class) allow it. ``posts`` also has single and bits of its groups.

    ``low`` and ``high`` are the smallest and largest component of a group's members so far: groups that are wholly in
    one component need no pair."""
    a, b = posts.alias("a"), posts.alias("b")
    return a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.gid") < F.col("b.gid")) & _apart() & _in_place("a", "b", percent) & _near_enough("a", "b", percent)).select(
        F.col("a.gid").alias("a"), F.col("b.gid").alias("b")).distinct()


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) of set keys whose whole sets reach the similarity, as (a, b) of representatives.

    What two sets have in common is among the shingles that each shares with anything."""
    pairs = written(pairs, "jaccard-candidates")
    keys = pairs.select(F.col("x").alias("key")).union(pairs.select("y")).distinct()
    sets = written(sets.select("key", "rep", "n", "shared").join(keys, "key", "left_semi"), "jaccard-members")
    x = sets.select(F.col("key").alias("x"), F.col("rep").alias("a"), F.col("n").alias("xn"), F.col("shared").alias("xs"))
    y = sets.select(F.col("key").alias("y"), F.col("rep").alias("b"), F.col("n").alias("yn"), F.col("shared").alias("ys"))
    both = F.size(F.array_intersect("xs", "ys"))
    return pairs.join(x, "x").join(y, "y").where(100 * both >= percent * (F.col("xn") + F.col("yn") - both)).select("a", "b")


def jaccard_join(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs`` (doc_id and text are read).

    Two documents link when 100 * intersection >= percent * union of their sets of distinct ``words``-word shingles
    (A-Z lower-cased; fewer words: the whole sequence is one). component_id is the smallest doc_id reachable by links.
    Null, empty or blank texts have an empty set and link with nothing. Rows that share a doc_id are one document with
    several sets. A row without doc_id takes part like any other, but names no component: one without any doc_id is
    null. doc_ids are below 2^62; above, classes without doc_id have stand-ins.
    """
    heads = written(prefix_table(docs, words, percent), "jaccard-prefixes")
    stand_in = F.lit(STAND_IN) + F.xxhash64("key").bitwiseAND(F.lit(STAND_IN - 1))
    classes = heads.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("rep")).select("key", F.coalesce("rep", stand_in).alias("rep"))
    known = classes.select(F.col("key").alias("k"), "rep")
    open_ = heads.where("prefix is not null").join(known, (F.col("key") == F.col("k")) & (F.coalesce("doc_id", "rep") == F.col("rep"))).dropDuplicates(["key"])
    open_ = written(open_.select("key", "rep", "n", "single", "prefix", "shared", "bits", F.xxhash64("n", "single", "prefix").alias("gid")), "jaccard-classes")
    groups = open_.groupBy("gid", "n", "single", "prefix").agg(F.count("*").alias("members"), F.min("key").alias("pivot"), F.min("bits").alias("bits"))
    groups = written(groups.withColumn("bits", F.when(F.col("members") == 1, F.col("bits"))), "jaccard-groups")
    pivots = groups.groupBy("gid").agg(F.min("pivot").alias("pivot"))
    members = open_.select("gid", "key", "rep", "n", "single", "bits")

    def across(pairs: DataFrame) -> DataFrame:
        return pairs.join(pivots.toDF("a", "x"), "a").join(pivots.toDF("b", "y"), "b").where("x <> y").select("x", "y")

    def place(edges: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """Members with their component so far, and of each group the smallest and the largest of them."""
        near = connected_components(edges, "a", "b")
        placed = members.join(near, F.col("rep") == F.col("node"), "left").select("gid", "key", "n", "single", "bits", F.coalesce("component", "rep").alias("part"))
        placed = written(placed, name)
        return placed, placed.groupBy("gid").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("members"))

    # every member with its group's first one, every group with a pivot for each prefix shingle: links that grow with the posts
    posts = written(posts_of(groups), "jaccard-posts")
    star = members.join(pivots, "gid").where("key <> pivot").select(F.col("pivot").alias("x"), F.col("key").alias("y"))
    first = star.union(across(pivot_pairs(posts, groups, percent, 0))).distinct()
    edges = written(verified(first, open_, percent), "jaccard-edges")
    _, spread = place(edges, "jaccard-placed")
    # while near copies are in several components: the groups of a frequent shingle with other pivots
    often = posts.where(F.col("often") > OFTEN)
    apart = written(mixed_posts(often, spread), "jaccard-apart")
    left, many = open_pairs(apart)
    for turn in range(1, ROUNDS + 1):
        if left <= many:
            break
        edges = edges.union(written(verified(across(pivot_pairs(apart, groups, percent, turn)).distinct(), open_, percent), "jaccard-round"))
        _, spread = place(edges, "jaccard-placed")
        apart = written(mixed_posts(often, spread), "jaccard-apart")
        before, (left, _) = left, open_pairs(apart)
        if turn % 2 == 0 and left > 0.9 * before:
            break
    # then one member of each of two groups that are not in one component yet
    apart = mixed_posts(posts, spread).join(groups.select("gid", "single", "bits"), "gid")
    pairs = written(group_pairs(apart, percent), "jaccard-group-pairs")
    edges = edges.union(written(verified(across(pairs).distinct(), open_, percent), "jaccard-across"))
    placed, spread = place(edges, "jaccard-placed")
    a, b = spread.toDF("a", "low_a", "high_a", "m_a"), spread.toDF("b", "low_b", "high_b", "m_b")
    # of two groups of one class each the only pair has been verified
    todo = pairs.join(a, "a").join(b, "b").where("m_a + m_b > 2 and (low_a <> low_b or low_a <> high_a or low_b <> high_b)").select("a", "b")
    todo = todo.union(spread.where("low <> high").select(F.col("gid").alias("a"), F.col("gid").alias("b")))
    left, right = placed.alias("l"), placed.alias("r")
    rest = todo.join(left, F.col("a") == F.col("l.gid")).join(right, (F.col("b") == F.col("r.gid")) & (F.col("l.part") != F.col("r.part"))
                                                               & ((F.col("a") != F.col("b")) | (F.col("l.key") < F.col("r.key"))) & _near_enough("l", "r", percent))
    rest = rest.select(F.col("l.key").alias("x"), F.col("r.key").alias("y")).distinct()
    more = written(verified(rest, open_, percent), "jaccard-more-edges")
    linked = connected_components(edges.union(more), "a", "b")

    reps = classes.join(linked, F.col("rep") == F.col("node"), "left").select("key", F.coalesce("component", "rep").alias("component"))
    reps = reps.select("key", F.when(F.col("component") < STAND_IN, F.col("component")).alias("component"))
    # rows that share a doc_id belong together even where their sets do not
    named = written(heads.select("doc_id", "n", "key").join(reps, "key", "left").select("doc_id", "n", F.coalesce("component", "doc_id").alias("component")), "jaccard-named")
    joint = named.where("doc_id is not null").groupBy("doc_id").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    merged = connected_components(joint, "low", "high").toDF("node", "smallest")
    out = named.join(merged, F.col("component") == F.col("node"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("smallest", "component").alias("component_id"))


def one_of_each_group(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose doc_id names its component; of rows that repeat doc_id and text one stays.

    Rows without doc_id cannot be told apart by it: all of them go if each links with a row that has one, else all stay.
    """
    kept = jaccard_join(docs, words, percent).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__kept")).distinct()
    rows = docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("__kept")), "left_semi")
    return rows.dropDuplicates(["doc_id", "text"])


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"), words=4, percent=85)
