"""SimHash near-duplicates through vantage-point trees (operator 9).

Fingerprints are the nodes: equal ones collapse first, so exact copies cost one
row however many they are.  A vantage-point tree over a bounded sample parts
the fingerprints into shards; a fingerprint near a boundary is also sent, as a
query, to the shards on the other side that the triangle inequality cannot
rule out.  Each shard joins its members and queries with a tree of its own and
returns the edges of a spanning forest, which loses no link between classes.

Nulls and empty texts have fingerprint zero and link like any other.  A null
id has a fingerprint and a component; the component is the smallest id that is
not null, or null where there is none.  Repeated rows and ids give a row each.
A bit that exactly half of the shingles set is 0.  Very long texts are read
whole, alone in their piece.  An empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import kernels as K
from corpusloom.operators import dedup
from corpusloom.operators.components import connected_components
from corpusloom.sources import scratch

SAMPLE = 8192  # fingerprints that shape the top of the tree, at least
SHARD_ROWS, PER_SHARD, SHARDS = 50_000, 16, 1 << 16  # so at most 2**20 fingerprints, 8 MB, reach the driver
HELD = 1 << 20
LEAF = 96
BITMAP = 512  # bits that stand for a set of shingles


def _lanes() -> np.ndarray:
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(bits).view(np.uint64).ravel()


_LANES = _lanes()


def _majorities(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """For each row the bits that are set in over half of its hashes; zero for none."""
    count = np.diff(row)
    out = np.zeros(len(count), np.uint64)
    some = np.flatnonzero(count)
    if not some.size:
        return out
    parts = -(-count[some] // 255)  # a lane counts to 255
    of = np.repeat(np.arange(len(some)), parts)
    first = np.repeat(np.cumsum(parts) - parts, parts)
    begin = row[some][of] + (np.arange(len(of)) - first) * 255
    planes = h.view(np.uint8).reshape(-1, 8)
    sums = np.stack([np.add.reduceat(_LANES[planes[:, j]], begin) for j in range(8)], axis=1)
    lanes = sums.view(np.uint8).reshape(len(of), 64).astype(np.int32)
    total = np.add.reduceat(lanes, np.cumsum(parts) - parts, axis=0)
    on = total * 2 > count[some][:, None]
    out[some] = np.packbits(on, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(data: np.ndarray, off: np.ndarray, width: int) -> np.ndarray:
    words = K.Words(data, off)
    joined, start, end = words.joined(fold=True)
    count = words.count
    spans = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    row = np.concatenate([[0], np.cumsum(spans)])
    at = np.arange(row[-1]) + np.repeat(words.row[:-1] - row[:-1], spans)
    last = at + np.repeat(np.minimum(count, width), spans) - 1
    return _majorities(K.xxh64(joined, start[at], end[last] - start[at]), row)


def fingerprint(text: Column, width: int = 3) -> Column:
    """64-bit SimHash of a text's word shingles, as a signed long."""

    @F.arrow_udf("long")
    def simhash(col: pa.Array) -> pa.Array:
        data, off = K.text_bytes(col)
        parts = [fingerprints(d, o, width) for _, _, d, o in K.pieces(data, off)]
        return pa.array(np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64))

    return simhash(text)


def _distance(a: np.ndarray, b: np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


def _vantage(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """The point, of a few, whose distances spread most, and the radius that halves the others."""
    some = points[:: max(1, len(points) // 256)]
    best = None
    for v in some[:: max(1, len(some) // 6)]:
        d = np.sort(_distance(some, v))
        if best is None or d.std() > best[0]:
            best = (d.std(), v)
    d = np.sort(_distance(points, best[1]))
    m = int(d[(len(d) - 1) // 2])
    if m == d[-1]:
        m -= 1
    return (best[1], m) if d[0] <= m < d[-1] else None


def top_tree(points: np.ndarray, shards: int) -> list:
    """Nodes (vantage, radius, inner, outer); a negative child -1-k is shard k."""
    nodes: list = []

    def grow(p: np.ndarray, want: int) -> int:
        cut = _vantage(p) if want > 1 and len(p) > 8 else None
        if cut is None:
            leaves.append(None)
            return -len(leaves)
        nodes.append(None)
        me = len(nodes) - 1
        near = _distance(p, cut[0]) <= cut[1]
        nodes[me] = (cut[0], cut[1], grow(p[near], want // 2), grow(p[~near], want - want // 2))
        return me

    leaves: list = []
    grow(points, shards)
    return nodes


def _sides(d: np.ndarray, member: np.ndarray, m: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Who goes inside and who goes outside a ball: a member to its own side, and as a query outwards near the boundary; a query to every side that can hold a link."""
    inner = np.where(member, d <= m, d <= m + radius)
    outer = np.where(member, d > m - radius, d > m - radius)
    return inner, outer


def route(nodes: list, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, fingerprint, is member) rows."""
    done: list = []
    todo = [(0 if nodes else -1, fp, np.ones(len(fp), bool))]
    while todo:
        at, x, member = todo.pop()
        if not len(x):
            continue
        if at < 0:
            done.append((np.full(len(x), -1 - at, np.int32), x, member))
            continue
        v, m, near, far = nodes[at]
        d = _distance(x, v)
        inner, outer = _sides(d, member, m, radius)
        todo += [(near, x[inner], member[inner]), (far, x[outer], member[outer] & (d[outer] > m))]
    if not done:
        return np.zeros(0, np.int32), fp[:0], np.zeros(0, bool)
    return tuple(np.concatenate(c) for c in zip(*done, strict=True))


def link_chunks(x: np.ndarray, member: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of a member and a member or query that differ in at most ``radius`` bits, each pair at least once, a leaf of the tree after the other."""
    todo = [(np.flatnonzero(member), np.flatnonzero(~member))]
    while todo:
        mi, qi = todo.pop()
        if not len(mi):
            continue
        cut = _vantage(x[mi]) if len(mi) > LEAF else None
        if cut is None:
            everyone = np.concatenate([mi, qi])
            for lo in range(0, len(mi), 256):
                for to in range(0, len(everyone), 8192):
                    a, b = mi[lo : lo + 256], everyone[to : to + 8192]
                    i, j = np.nonzero(np.bitwise_count(x[a][:, None] ^ x[b][None, :]) <= radius)
                    keep = a[i] != b[j]
                    yield a[i][keep], b[j][keep]
            continue
        v, m = cut
        d, e = _distance(x[mi], v), _distance(x[qi], v)
        near = d <= m
        todo.append((mi[near], qi[e <= m + radius]))
        todo.append((mi[~near], np.concatenate([mi[near & (d > m - radius)], qi[e > m - radius]])))


def reached(x: np.ndarray, member: np.ndarray, radius: int, most: int = HELD) -> np.ndarray:
    """The smallest index that each fingerprint reaches over links; about ``most`` links are held at a time."""
    label, held, n = np.arange(len(x)), [], 0

    def merge() -> np.ndarray:
        return forest(len(x), *(np.concatenate(c) for c in zip(*held, (np.arange(len(x)), label), strict=True)))

    for pair in link_chunks(x, member, radius):
        held.append(pair)
        n += len(pair[0])
        if n > most:
            label, n = merge(), 0
            held.clear()
    return merge()


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of n nodes reaches."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def link_edges(fps: DataFrame, radius: int) -> DataFrame:
    """Edges (src, dst) that connect the fingerprints of a one-column table (fp, distinct) as all links would.

    The tree has a shard for every SHARD_ROWS fingerprints, and is shaped by
    PER_SHARD fingerprints a shard; both end at SHARDS shards, beyond which a
    shard's own tree is deeper.
    """
    spark = fps.sparkSession
    n = fps.count()
    shards = min(SHARDS, max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), n // SHARD_ROWS))
    seen = fps.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(max(SAMPLE, PER_SHARD * shards))
    points = seen.toArrow()["fp"].to_numpy().astype(np.int64).view(np.uint64)
    nodes = top_tree(points, shards) if len(points) > 8 else []

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def out() -> pa.RecordBatch:
            shard, x, member = route(nodes, np.concatenate(held).view(np.uint64), radius)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(shard), pa.array(x.view(np.int64)), pa.array(member)], ["shard", "fp", "member"])

        for b in batches:
            held.append(b.column(0).to_numpy(zero_copy_only=False))
            if sum(map(len, held)) > 50_000:  # many at once, since each visits every node of the tree
                yield out()
        if held:
            yield out()

    def join(t: pa.Table) -> pa.Table:
        x = np.ascontiguousarray(t["fp"].to_numpy()).view(np.uint64)
        root = reached(x, t["member"].to_numpy(), radius)
        on = np.flatnonzero(root != np.arange(len(x)))
        return pa.table({"src": pa.array(x[on].view(np.int64)), "dst": pa.array(x[root[on]].view(np.int64))})

    dealt = fps.select("fp").mapInArrow(deal, "shard int, fp long, member boolean")
    return dealt.groupBy("shard").applyInArrow(join, "src long, dst long")


def classes_of(fp: DataFrame, radius: int) -> DataFrame:
    """(doc_id, fp, component_id) of a table (doc_id, fp)."""
    nodes = scratch.written(fp.groupBy("fp").agg(F.min("doc_id").alias("low")), "nodes")
    root = connected_components(link_edges(nodes, radius))
    named = nodes.join(root, nodes.fp == root.node, "left").select("fp", "low", F.coalesce("component", "fp").alias("root"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = named.join(lowest, "root").select("fp", "component_id")
    return fp.join(classes, "fp", "left").select("doc_id", "fp", "component_id")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 2) -> DataFrame:
    """(id, fp, component_id), one row per row of df; component_id is the smallest id reachable over links of at most ``radius`` bits.

    The fingerprint is written once and everything after it works on 16 bytes a document.
    """
    fp = scratch.written(df.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col), width).alias("fp")), "fingerprints")
    return classes_of(fp, radius).withColumnRenamed("doc_id", id_col)


def parity_bitmaps(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """(rows x BITMAP / 64) words: a bit for each of BITMAP classes of hashes, set where a row has an odd number in the class."""
    n = len(row) - 1
    out = np.empty((n, BITMAP // 64), np.uint64)
    cell = (K.mix(h ^ K.U(BITMAP)) & K.U(BITMAP - 1)).astype(np.int64)
    for lo in range(0, n, 4096):
        hi = min(lo + 4096, n)
        of = np.repeat(np.arange(hi - lo), np.diff(row[lo : hi + 1]))
        odd = np.bincount(of * BITMAP + cell[row[lo] : row[hi]], minlength=(hi - lo) * BITMAP) & 1
        out[lo:hi] = np.packbits(odd.astype(np.uint8).reshape(-1, BITMAP), axis=1).view(np.uint64)
    return out


def shingle_set(text: Column, width: int) -> Column:
    """Struct of the hashes of a text's distinct word shingles and their parity bitmap."""

    @F.arrow_udf("struct<s:array<bigint>,m:array<bigint>>")
    def shingles(col: pa.Array) -> pa.Array:
        data, off = K.text_bytes(col)
        values, counts, maps = [np.zeros(0, np.uint64)], [0], [np.zeros((0, BITMAP // 64), np.uint64)]
        for _, _, d, o in K.pieces(data, off):
            words = K.Words(d, o)
            h, at = K.windows(words.hashes(fold=True), words.row, width)
            row = np.searchsorted(at, words.row)
            own = [np.unique(h[lo:hi]) for lo, hi in zip(row[:-1].tolist(), row[1:].tolist(), strict=True)]
            size = [len(u) for u in own]
            values += own
            counts += size
            maps.append(parity_bitmaps(np.concatenate([np.zeros(0, np.uint64), *own]), np.concatenate([[0], np.cumsum(size)])))
        sets = pa.ListArray.from_arrays(pa.array(np.cumsum(counts).astype(np.int32)), pa.array(np.concatenate(values).view(np.int64)))
        m = np.concatenate(maps)
        bits = pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * (BITMAP // 64)), pa.array(m.view(np.int64).ravel()))
        return pa.StructArray.from_arrays([sets, bits], ["s", "m"])

    return shingles(text)


def may_reach(a: str, b: str, similarity: float) -> Column:
    """False only where the sets of which (n, m) are the size and the parity bitmap can't have the similarity.

    Each element that one set alone has turns one bit, so the bitmaps differ in
    at most as many bits as the sets differ in elements; and at a Jaccard
    similarity of t these are at most (1 - t) / (1 + t) of both sizes together.
    """
    bits = reduce(Column.__add__, [F.bit_count(F.col(f"{a}.m")[i].bitwiseXOR(F.col(f"{b}.m")[i])) for i in range(BITMAP // 64)])
    return F.greatest(bits, F.abs(F.col(f"{a}.n") - F.col(f"{b}.n"))) <= (1 - similarity) / (1 + similarity) * (F.col(f"{a}.n") + F.col(f"{b}.n")) + 1e-6


def looser_edges(signed: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """Edges (src, dst) between components that hold texts of at least a Jaccard similarity of their shingles, which 64 bits can't tell within a small radius.

    signed: (_k, _bands, _c, _id), a row for each distinct text: its hash, its
    component so far, and a row that has it.  texts: (_id, _k, _t).  MinHash
    bands propose, and the shingles themselves decide.

    In rounds, some texts of each bucket are centres and are compared with all
    others there that aren't in their component yet.  Then they leave the
    bucket, what they reach is joined, and a bucket is done when one component
    is left in it.  So every two texts that share a bucket are compared or are
    connected already.  A bucket's centres are its text with the most links so
    far and a share by hash, which grows fourfold each round.
    """
    keys = ["band", "h"]
    cells = signed.select("_k", "_c", F.lit(0).cast("long").alias("links"), F.posexplode("_bands").alias(*keys))
    sets, found, few = None, [], 0
    while True:
        top = F.max(F.struct("links", "_k")).alias("top")
        buckets = cells.groupBy(*keys).agg(F.min("_c").alias("lo"), F.max("_c").alias("hi"), F.count("*").alias("n"), top).filter("lo <> hi")
        centre = (F.col("top._k") == F.col("_k")) | (F.pmod(F.xxhash64("_k", F.lit(few)), F.col("n")) < few)
        here = scratch.written(cells.join(buckets, keys).select(*keys, "_k", "_c", "links", centre.alias("centre")), "cells")
        if not here.limit(1).count():
            break
        if sets is None:
            some = signed.join(here.select("_k").distinct(), "_k", "left_semi").select("_id", "_k")
            sets = texts.join(some, ["_id", "_k"], "left_semi").select("_k", shingle_set(F.col("_t"), width).alias("sm"))
            sets = scratch.written(sets.groupBy("_k").agg(F.min("sm").alias("sm")).select("_k", "sm.*"), "shingles")
        marked = here.join(sets.select("_k", F.struct(F.size("s").alias("n"), "m").alias("map")), "_k")
        a = marked.filter("centre").select(*keys, F.col("_k").alias("ka"), F.col("_c").alias("src"), F.col("map").alias("ma"))
        b = marked.select(*keys, F.col("_k").alias("kb"), F.col("_c").alias("dst"), F.col("centre").alias("both"), F.col("map").alias("mb"))
        apart = F.expr("src <> dst and (not both or ka < kb)")
        pairs = scratch.written(a.join(b, keys).filter(apart & may_reach("ma", "mb", similarity)).select("ka", "kb", "src", "dst").distinct(), "pairs")
        both = pairs.join(sets.select(F.col("_k").alias("ka"), F.col("s").alias("a")), "ka").join(sets.select(F.col("_k").alias("kb"), F.col("s").alias("b")), "kb")
        shared = F.size(F.array_intersect("a", "b"))
        near = scratch.written(both.filter(shared >= similarity * (F.size("a") + F.size("b") - shared)).select("ka", "kb", "src", "dst"), "near")
        scratch.drop(pairs)
        cells = here.filter("not centre").drop("centre")
        if near.limit(1).count():
            found.append(near.select("src", "dst"))
            more = near.select(F.col("ka").alias("_k")).union(near.select("kb")).groupBy("_k").agg(F.count("*").alias("more"))
            root = connected_components(near)
            cells = cells.join(more, "_k", "left").join(root, F.col("_c") == F.col("node"), "left")
            cells = cells.select("_k", F.coalesce("component", "_c").alias("_c"), (F.col("links") + F.coalesce("more", F.lit(0))).alias("links"), *keys)
        few = max(4 * few, 3)
    return reduce(DataFrame.union, found) if found else signed.select(F.col("_c").alias("src"), F.col("_c").alias("dst")).limit(0)


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, radius: int = 3, similarity: float | None = 0.8) -> DataFrame:
    """The rows of df, less all but the smallest id of each component.

    With ``similarity``, components that looser_edges connects are one, whichever
    of their texts are near.  Of rows that share the surviving id and are in its component, the one
    with the smallest text stays.  Rows without an id can't be named, and stay.
    """
    bands = dedup.band_hashes(F.col(text_col), width=width) if similarity else F.lit(None).cast("array<bigint>")
    base = scratch.written(df.select(F.col(id_col).alias("_id"), fingerprint(F.col(text_col), width).alias("_fp"), bands.alias("_bands"), F.xxhash64(F.col(text_col)).alias("_k")), "fingerprints")
    classes = classes_of(base.select(F.col("_id").alias("doc_id"), F.col("_fp").alias("fp")), radius)
    classes = scratch.written(classes.select(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp"), "component_id").filter("_id is not null"), "classes")
    kept = scratch.written(classes.filter("_id = component_id").select("_id", "_fp").distinct(), "kept")
    if similarity:
        distinct = base.filter("_bands is not null and _id is not null").groupBy("_k").agg(F.min("_bands").alias("_bands"), F.min("_fp").alias("_fp"), F.min("_id").alias("_id"))
        part = classes.groupBy("_fp").agg(F.min("component_id").alias("_c"))
        signed = scratch.written(distinct.join(part, "_fp").select("_k", "_bands", "_c", "_id"), "signed")
        edges = looser_edges(signed, df.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_k"), F.col(text_col).alias("_t")), width, similarity)
        away = connected_components(edges).filter("node <> component").select(F.col("node").alias("_id"))
        kept = kept.join(away, "_id", "left_anti")
    name = "_id"
    while name in df.columns:  # a name that df doesn't have
        name = f"_{name}"
    out = df.join(kept.select(F.col("_id").alias(name)), df[id_col] == F.col(name), "left_semi")
    many = classes.groupBy("_id").count().filter("count > 1").join(kept.select("_id"), "_id", "left_semi").select("_id")
    if many.limit(1).count():
        record = F.struct(*[df[c] for c in df.columns])
        again = many.select(F.col("_id").alias(name))
        twice = out.join(again, out[id_col] == F.col(name), "left_semi").select(record.alias("_r"), F.col(id_col).alias("_id"), F.col(text_col).alias("_t"), fingerprint(F.col(text_col), width).alias("_fp"))
        own = twice.join(kept, ["_id", "_fp"], "left_semi")
        one = own.groupBy("_id").agg(F.min_by("_r", F.struct(F.length("_t"), "_t", F.to_json("_r"))).alias("_r")).select("_r.*")
        out = out.join(again, out[id_col] == F.col(name), "left_anti").unionByName(one)
    return out.unionByName(df.filter(df[id_col].isNull()))
