"""URL filtering by the ratio of two character Markov models (operator 1).

Rules on host and path settle the URLs they fit.  These URLs, all of them,
also train two smoothed variable-order Markov models, of accepted and of
rejected URLs; every other URL is judged by the difference of its two
log-likelihoods for each character, calibrated to a probability.

The models are a table that grows with the input: a row for each context of 0
to ORDER characters that a settled URL has, under its 64-bit hash, with the
counts of the characters that follow it in URLs of either kind.  Counts are
summed in each batch before the shuffle.  URLs are judged in blocks: a block
sends its distinct contexts, a join answers with their rows, and the block's
scores are computed there; no table is collected or broadcast.  Each order is
smoothed with the next shorter one, down to equal chances for all code points.
Every tenth settled URL (by hash) is left out of the counts and calibrates.

A null URL, or one without ``://``, has an empty host and path; no rule fits
it, and the models judge the text as it is, a null one as empty.  Very long
URLs are judged whole, repeated ones and repeated or null ids row by row.
Without URLs of both kinds in training every URL that no rule fits is allowed.
An empty table gives no rows, and columns other than the id and the URL are not
read, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import kernels as K
from corpusloom.llm import labelled as L
from corpusloom.sources import scratch

ORDER = 5
PRIOR = 2.0
CALIBRATION_ROWS = 4000
BLOCK_ROWS = 4096
PIECE = 200_000
CODE_POINTS = 0x110000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// to / ? # or the end, A-Z as a-z.  Path: then to ? # or the end."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule (its text) that fits host and path; null for none.

    A rule is (host/path, verdict), as ("example.net/en/", "allow"); it fits
    its host and all subdomains where the path begins with its path.
    """
    out: Column | None = None
    for text in sorted({r for r, _ in rules}, key=lambda r: (-len(r), r)):
        name, _, tail = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + tail)
        out = F.when(fits, F.lit(text)) if out is None else out.when(fits, F.lit(text))
    return out if out is not None else F.lit(None).cast("string")


def contexts(chars: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Hashes of the 0 to ORDER characters before each character: a row for each order."""
    into = np.arange(len(chars)) - np.repeat(off[:-1], np.diff(off))
    codes = chars.astype(np.uint64) + K.U(1)
    out = np.empty((ORDER + 1, len(chars)), np.uint64)
    for k in range(ORDER + 1):
        h = np.full(len(chars), k + 1, np.uint64)
        for j in range(k, 0, -1):
            back = np.zeros(len(chars), np.uint64)  # before the first character stands 0
            back[j:] = np.where(into[j:] >= j, codes[:-j], K.U(0))
            h = K.mix(h * K.U(0x100000001B3) + back)
        out[k] = h
    return out


class Nodes:
    """Some contexts of the models, and what follows them."""

    def __init__(self, context: np.ndarray, row: np.ndarray, char: np.ndarray, counts: np.ndarray):
        """context: their hashes; row: where each one's characters begin in char; counts (2 x len(char)): in rejected and accepted URLs."""
        order = np.argsort(context)
        self.context = context[order]
        of = np.repeat(np.argsort(order), np.diff(row))
        key = of << 21 | char.astype(np.int64)
        by = np.argsort(key)
        self.pair, self.counts = np.append(key[by], -1), np.append(counts[:, by], [[0], [0]], axis=1)
        self.total = np.zeros((2, len(context) + 1))
        for c in (0, 1):
            self.total[c, :-1] = np.bincount(of, weights=counts[c], minlength=len(context))

    def gap(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Log-likelihood of accepted less that of rejected, for each character."""
        chars, off = K.code_points(data, off)
        p = np.full((2, len(chars)), 1 / CODE_POINTS)
        for h in contexts(chars, off):
            at = np.minimum(np.searchsorted(self.context, h), max(len(self.context) - 1, 0))
            at = np.where(self.context[at] == h, at, len(self.context)) if len(self.context) else np.zeros(len(h), np.int64)
            key = at << 21 | chars.astype(np.int64)
            pair = np.searchsorted(self.pair[:-1], key)
            pair = np.where(self.pair[pair] == key, pair, len(self.pair) - 1)
            p = (self.counts[:, pair] + PRIOR * p) / (self.total[:, at] + PRIOR)
        return K.row_sums(np.log(p[1] / p[0]), off) / np.maximum(np.diff(off), 1)


def count_contexts(labelled: DataFrame) -> DataFrame:
    """(context, next array<struct<char,n0,n1>>) over all rows (url, label); each batch is summed before the shuffle."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            label = b.column("label").to_numpy(zero_copy_only=False)
            data, off = K.text_bytes(b.column("url"))
            for lo, hi, d, o in K.pieces(data, off, PIECE):
                chars, o = K.code_points(d, o)
                h = contexts(chars, o).ravel()
                follow, kind = np.tile(chars, ORDER + 1), np.tile(np.repeat(label[lo:hi], np.diff(o)), ORDER + 1)
                by = np.lexsort((follow, h))
                h, follow, kind = h[by], follow[by], kind[by]
                new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (follow[1:] != follow[:-1]))) if len(h) else np.zeros(0, np.int64)
                ones = np.add.reduceat(kind.astype(np.int64), new) if len(new) else new
                many = np.diff(np.append(new, len(h)))
                yield pa.RecordBatch.from_arrays([pa.array(h[new].view(np.int64)), pa.array(follow[new].astype(np.int32)), pa.array(many - ones), pa.array(ones)], ["context", "char", "n0", "n1"])

    grams = labelled.select("url", "label").mapInArrow(partial, "context long, char int, n0 long, n1 long")
    summed = grams.groupBy("context", "char").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    return summed.groupBy("context").agg(F.collect_list(F.struct("char", "n0", "n1")).alias("next"))


def gaps(rows: DataFrame, model: DataFrame) -> DataFrame:
    """rows (block, url, and others) with ``gap``; a block has BLOCK_ROWS rows at most."""

    def ask(t: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.uint64)]
        for _, _, d, o in K.pieces(*K.text_bytes(t["url"]), PIECE):
            found.append(np.unique(contexts(*K.code_points(d, o))))
        h = np.unique(np.concatenate(found))
        block = t["block"][0].as_py() if t.num_rows else 0
        return pa.table({"context": pa.array(h.view(np.int64)), "block": pa.array(np.full(len(h), block, np.int64))})

    def judge(t: pa.Table, known: pa.Table) -> pa.Table:
        follow = known["next"].combine_chunks()
        row = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(follow).to_numpy(zero_copy_only=False))]).astype(np.int64)
        flat = follow.flatten()
        char, *n = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
        nodes = Nodes(known["context"].to_numpy().view(np.uint64), row, char, np.array(n, np.int64).reshape(2, -1))
        out = [nodes.gap(d, o) for _, _, d, o in K.pieces(*K.text_bytes(t["url"]), PIECE)]
        return t.append_column("gap", pa.array(np.concatenate([np.zeros(0), *out])))

    asked = rows.groupBy("block").applyInArrow(ask, "context long, block long")
    told = asked.join(model, "context").select("block", "context", "next")
    schema = T.StructType([*rows.schema, T.StructField("gap", T.DoubleType())])
    return rows.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(judge, schema)


def train(labelled: DataFrame) -> tuple[DataFrame | None, float, float]:
    """(models, slope, bias) from rows (block, url, label): 1 accepted, 0 rejected; no models without both."""
    held = F.pmod(F.xxhash64(F.lit("held"), "url"), F.lit(10)) == 0
    kinds = {r.label for r in labelled.filter(~held).groupBy("label").count().collect()}
    if len(kinds) < 2:
        return None, 1.0, 0.0
    model = scratch.written(count_contexts(labelled.filter(~held)), "contexts")
    order = F.xxhash64(F.lit("calibrate"), "url")
    few = [labelled.filter(held & (F.col("label") == k)).orderBy(order, "url").limit(CALIBRATION_ROWS) for k in (0, 1)]
    seen = gaps(few[0].union(few[1]).select("block", "url", "label"), model).select("gap", "label").toArrow()
    return model, *L.calibrate(seen["gap"].to_numpy(), seen["label"].to_numpy().astype(float))


def filter_urls(df: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", least: float = 0.5) -> DataFrame:
    """(id, host, path, rule, verdict, p_accept) per row; p_accept is null where a rule settles.

    The table is read once; all else works on the URLs, written with their
    blocks, which are runs of rows of one input partition.
    """
    verdicts = dict(rules)
    host, path = host_and_path(F.col("url"))
    seen = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.floor(F.monotonically_increasing_id() / BLOCK_ROWS).alias("block"))
    seen = seen.select("id", "url", "block", host.alias("host"), path.alias("path"))
    seen = seen.withColumn("rule", matched_rule(F.col("host"), F.col("path"), rules))
    by_rule = reduce(lambda c, r: c.when(F.col("rule") == r[0], F.lit(r[1])), verdicts.items(), F.when(F.lit(False), F.lit("")))
    seen = scratch.written(seen.withColumn("ruled", by_rule), "urls")
    model, slope, bias = train(seen.filter("ruled is not null").select("block", "url", (F.col("ruled") == "allow").cast("int").alias("label")))
    open_rows = seen.filter("ruled is null").drop("ruled")
    scored = gaps(open_rows, model) if model else open_rows.withColumn("gap", F.lit(0.0))
    p = 1 / (1 + F.exp(-(F.lit(slope) * F.col("gap") + F.lit(bias)))) if model else F.lit(1.0)
    scored = scored.withColumn("p_accept", p).withColumn("verdict", F.when(F.col("p_accept") >= least, F.lit("allow")).otherwise(F.lit("block")))
    settled = seen.filter("ruled is not null").withColumn("p_accept", F.lit(None).cast("double")).withColumn("verdict", F.col("ruled"))
    out = [t.select(F.col("id").alias(id_col), "host", "path", "rule", "verdict", "p_accept") for t in (settled, scored)]
    return out[0].unionByName(out[1])
