"""Exact substring deduplication by Rabin-Karp window hashes (operator 2).

Documents are dealt into groups of consecutive ids and about equal bytes.  A
group hashes every window of ``width`` words and sends its distinct hashes,
sorted and stored as differences, to buckets of the hash space; so however
often a window repeats inside a group, it is sent once.  A bucket answers each
group with one bit per hash: whether a group of smaller ids holds it too.  The
group hashes its windows again, adds what repeats inside it, and merges covered
words into maximal removal intervals.

A window's hash has 64 + EXTRA = 96 bits, from two Rabin-Karp sums: among the
10^13 windows of 100 TB, two different ones agree with a chance of under one in
a thousand.

The texts are shuffled once, by group, for both passes.  Null and empty texts
have no words; very long texts are handled whole.  Rows without an id count as
larger than every id and never as smaller than one another; rows that share an
id are never smaller than one another.  So the rows of one id, or of none, are
spread over several groups where they hold more bytes than one group should.
An empty table gives no rows; other columns travel in one struct, so their
names can't clash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import kernels as K

GROUP_BYTES = 6 << 20
CUT_POINTS = 2000
EXTRA = np.uint32
LAST = np.iinfo(np.int64).max


class Groups:
    """Classes of consecutive ids, the last one for null, each of one group or, where it has one id only, of several."""

    def __init__(self, cuts: list[int], parts: list[int], buckets: int):
        self.cuts, self.parts, self.buckets = np.array(cuts, np.int64), np.array(parts, np.int64), buckets
        self.first = np.cumsum(self.parts) - self.parts

    def of(self, ids: pa.Array, salt: pa.Array) -> np.ndarray:
        kind = np.searchsorted(self.cuts, ids.fill_null(LAST).to_numpy(zero_copy_only=False), "right")
        kind[ids.is_null().to_numpy(zero_copy_only=False)] = len(self.parts) - 1
        return self.first[kind] + salt.to_numpy(zero_copy_only=False) % self.parts[kind]

    def kind(self, group: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, group, "right") - 1


def plan_groups(df: DataFrame, group_bytes: int) -> Groups:
    """Groups of about equal bytes from two scans: ids at quantiles, and the bytes between these."""
    slots = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16
    asked = F.array(*[F.lit(i / CUT_POINTS) for i in range(CUT_POINTS + 1)])
    known = sorted(df.agg(F.percentile_approx("doc_id", asked, 20 * CUT_POINTS)).first()[0] or [])
    # an id at two quantiles has many rows, and an interval of its own
    marks = np.unique(np.array([*known, *(k + 1 for k, more in zip(known, known[1:]) if k == more and k < LAST)], np.int64))

    @F.arrow_udf("int")
    def interval(ids: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(marks, ids.fill_null(LAST).to_numpy(zero_copy_only=False), "right").astype(np.int32))

    # as many rows at most as there are marks
    rows = df.groupBy(interval("doc_id").alias("i"), F.col("doc_id").isNull().alias("none")).agg(F.sum(size).alias("bytes"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).orderBy("none", "i").collect()
    total = sum(r.bytes for r in rows)
    # with the root of the total, groups and buckets grow alike, and a group keeps some hashes for each bucket
    goal = max(1, min(max(group_bytes, 8 * math.isqrt(total)), -(-total // slots)))
    cuts: list[int] = []
    parts: list[int] = [1]
    held = 0
    for r in rows:
        if r.none:
            continue
        many = -(-r.bytes // goal)
        if held and held + r.bytes > goal:
            cuts.append(r.low)
            parts.append(1)
            held = 0
        if many > 1 and r.low == r.high:
            parts[-1] = many
            held = goal
        elif many > 1:
            inner = np.unique(np.interp(np.arange(1, many) / many, [0, 1], [r.low, r.high + 1]).astype(np.int64))
            cuts += inner[inner > r.low].tolist()
            parts += [1] * int((inner > r.low).sum())
            held = goal
        else:
            held += r.bytes
    nulls = sum(r.bytes for r in rows if r.none)
    return Groups(cuts, [*parts, max(1, -(-nulls // goal))], max(slots, -(-total // goal)))


def _hash_rows(t: pa.Table, width: int):
    """Per piece: (first row, end row, words, window hashes, their further bits, their first words)."""
    data, off = K.text_bytes(t["text"])
    for lo, hi, d, o in K.pieces(data, off):
        words = K.Words(d, o)
        h = words.hashes()
        more, at = K.windows(K.mix(h ^ K.U(0x9E3779B97F4A7C15)), words.row, width)
        yield lo, hi, words, K.windows(h, words.row, width)[0], (more >> K.U(32)).astype(EXTRA), at


def _ordered(h: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of hashes, equal ones as they stand, and which, in order, are the first of their kind."""

    def news(by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = h[by], more[by]
        first, other = np.ones(len(by), bool), np.zeros(len(by), bool)
        first[1:], other[1:] = a[1:] != a[:-1], b[1:] != b[:-1]
        return first, other

    by = np.argsort(h, kind="stable")
    first, other = news(by)
    if (other & ~first).any():  # equal in 64 bits, but not in all
        by = np.lexsort((more, h))
        first, other = news(by)
    return by, first | other & ~first


def _pack(h: np.ndarray, more: np.ndarray) -> bytes:
    step = np.diff(h, prepend=K.U(0))
    return np.ascontiguousarray(step.view(np.uint8).reshape(-1, 8).T).tobytes() + more.tobytes()


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(blob) // (8 + EXTRA().nbytes)
    planes = np.frombuffer(blob, np.uint8, 8 * n).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64), np.frombuffer(blob, EXTRA, n, 8 * n)


def _ranges(h: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket of the hash space begins and ends in sorted hashes."""
    edges = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(h, edges), [len(h)]])


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50, group_bytes: int = GROUP_BYTES, keep_text: bool = False) -> DataFrame:
    """(doc_id, row, n_words, n_removed, spans, kept_text) per row of df; with keep_text also text.

    ``row`` is a struct of df's other columns; ``spans`` are the removed word
    intervals [start, end); ``kept_text`` joins the kept words by one space.
    """
    rest = [df[c] for c in df.columns if c not in (id_col, text_col)] or [F.lit(True).alias("none")]
    docs = df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].alias("text"), F.struct(*rest).alias("row"))
    groups = plan_groups(docs, group_bytes)
    buckets = groups.buckets

    @F.arrow_udf("long")
    def group_of(ids: pa.Array, salt: pa.Array) -> pa.Array:
        return pa.array(groups.of(ids, salt))

    dealt = docs.withColumn("g", group_of("doc_id", F.monotonically_increasing_id()))

    def send(t: pa.Table) -> pa.Table:
        parts = []
        for _, _, _, h, more, _ in _hash_rows(t, width):
            by, new = _ordered(h, more)
            parts.append((h[by[new]], more[by[new]]))
        h, more = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else (np.zeros(0, np.uint64), np.zeros(0, EXTRA))
        by, new = _ordered(h, more)
        h, more = h[by[new]], more[by[new]]
        cut = _ranges(h, buckets)
        on = np.flatnonzero(np.diff(cut))
        g = t["g"][0].as_py() if t.num_rows else 0
        return pa.table({"bucket": pa.array(on.astype(np.int32)), "g": pa.array(np.full(len(on), g, np.int64)), "hashes": pa.array([_pack(h[cut[i] : cut[i + 1]], more[cut[i] : cut[i + 1]]) for i in on], pa.binary())})

    def answer(t: pa.Table) -> pa.Table:
        order = np.argsort(t["g"].to_numpy(), kind="stable")
        g, blobs = t["g"].to_numpy()[order], t["hashes"].combine_chunks()
        lists = [_unpack(blobs[int(i)].as_buffer()) for i in order]
        size = np.array([len(x[0]) for x in lists])
        by, new = _ordered(*(np.concatenate(c) for c in zip(*lists, strict=True)))
        kind = np.repeat(groups.kind(g), size)[by]
        again = np.zeros(len(by), bool)
        again[by] = kind[new][np.cumsum(new) - 1] < kind  # a run opens with its smallest group
        ends = np.cumsum(size)
        flags = [again[e - n : e] for e, n in zip(ends, size, strict=True)]
        on = [i for i, f in enumerate(flags) if f.any()]
        return pa.table({"g": pa.array(g[on].astype(np.int64)), "bucket": pa.array(np.full(len(on), t["bucket"][0].as_py(), np.int32)), "flags": pa.array([np.packbits(flags[i]).tobytes() for i in on], pa.binary())})

    # all columns go along, so that both passes read one and the same exchange
    sent = dealt.groupBy("g").applyInArrow(send, "bucket int, g long, hashes binary")
    flags = sent.groupBy("bucket").applyInArrow(answer, "g long, bucket int, flags binary")
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    more = [("n_words", T.LongType()), ("n_removed", T.LongType()), ("spans", span), ("kept_text", T.StringType()), *([("text", T.StringType())] if keep_text else [])]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), docs.schema["row"], *(T.StructField(*m) for m in more)])

    def cut_out(t: pa.Table, marks: pa.Table) -> pa.Table:
        if not t.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "row": t["row"].combine_chunks(), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()), "spans": pa.array([], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), "kept_text": pa.array([], pa.string())} | ({"text": t["text"].combine_chunks()} if keep_text else {}))
        t = t.take(pa.compute.sort_indices(t, [("doc_id", "ascending")], null_placement="at_end"))
        ids = t["doc_id"].fill_null(LAST).to_numpy()
        done = list(_hash_rows(t, width))
        at_row = [lo + np.searchsorted(w.row, at, "right") - 1 for lo, _, w, _, _, at in done]
        h = np.concatenate([x[3] for x in done])
        owner = ids[np.concatenate(at_row)] if len(h) else np.zeros(0, np.int64)
        by, head = _ordered(h, np.concatenate([x[4] for x in done]))
        sh = h[by]
        del h
        run = np.cumsum(head) - 1
        # rows stand in order of id and hashes in order of rows, so a run opens with its smallest id
        gone = owner[by] > owner[by][head][run] if len(sh) else head
        elsewhere = np.zeros(int(head.sum()), bool)
        cut = _ranges(sh[head], buckets)
        blobs = marks["flags"].combine_chunks() if marks.num_rows else []
        for b, blob in zip(marks["bucket"].to_pylist(), blobs, strict=True):
            n = cut[b + 1] - cut[b]
            elsewhere[cut[b] : cut[b + 1]] = np.unpackbits(np.frombuffer(blob.as_buffer(), np.uint8))[:n].astype(bool)
        if len(sh):
            gone |= elsewhere[run]
        removed = np.zeros(len(sh), bool)
        removed[by] = gone
        n_words, n_removed, spans, kept, seen = [], [], [], [], 0
        for lo, hi, w, x, _, at in done:
            off = K.covered(at[removed[seen : seen + len(x)]], width, len(w)) if len(x) else np.zeros(len(w), bool)
            seen += len(x)
            of = w.of()
            n_words.append(w.count)
            n_removed.append(np.bincount(of[off], minlength=hi - lo))
            edge = np.concatenate([[False], off])
            new_row = np.zeros(len(w) + 1, bool)
            new_row[w.row[:-1]] = True
            new_row = new_row[: len(w)]
            begin = np.flatnonzero(off & (~edge[:-1] | new_row))
            stop_here = np.append(~off[1:] | new_row[1:], True) if len(w) else np.zeros(0, bool)
            stop = np.flatnonzero(off & stop_here) + 1
            r = of[begin]
            spans.append((np.bincount(r, minlength=hi - lo), begin - w.row[r], stop - w.row[r]))
            kept.append(_kept_bytes(w, ~off))
        lens = np.concatenate([s[0] for s in spans])
        starts, stops = (np.concatenate([s[i] for s in spans]).astype(np.int32) for i in (1, 2))
        items = pa.StructArray.from_arrays([pa.array(starts), pa.array(stops)], ["start", "end"])
        span_col = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)), items)
        return pa.table({"doc_id": t["doc_id"].combine_chunks(), "row": t["row"].combine_chunks(), "n_words": pa.array(np.concatenate(n_words).astype(np.int64)), "n_removed": pa.array(np.concatenate(n_removed).astype(np.int64)), "spans": span_col, "kept_text": pa.concat_arrays(kept)} | ({"text": t["text"].combine_chunks()} if keep_text else {}))

    return dealt.groupBy("g").cogroup(flags.groupBy("g")).applyInArrow(cut_out, schema)


def _kept_bytes(w: K.Words, keep: np.ndarray) -> pa.Array:
    """Per row the kept words joined by one space."""
    start, end, of = w.start[keep], w.end[keep], w.of()[keep]
    count = np.bincount(of, minlength=len(w.count))
    length = end - start + 1  # a place for the space
    total = int(length.sum())
    out = np.full(total, 0x20, np.uint8)
    first = np.cumsum(length) - length
    src = np.arange(total) + np.repeat(start - first, length)
    body = np.ones(total, bool)
    body[first + length - 1] = False
    out[body] = w.data[src[body]]
    row = np.concatenate([[0], np.cumsum(np.bincount(of, weights=length, minlength=len(w.count)).astype(np.int64))])
    last = np.zeros(total, bool)
    last[row[1:][count > 0] - 1] = True  # no space after a row's last word
    out = out[~last]
    off = row - np.concatenate([[0], np.cumsum(count > 0)])
    return pa.Array.from_buffers(pa.large_string(), len(count), [None, pa.py_buffer(off.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes())]).cast(pa.string())
