"""Texts that come with parallel arrays of chunk scores."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = 10_000
GAP = "\n\n[...]\n\n"


def repair_overlaps(chunks: Column) -> Column:
    """Each [start, end) starts no earlier than the one before it ends."""
    before = lambda i: F.get(chunks, i - F.lit(1))["end"]
    return F.transform(chunks, lambda c, i: F.struct(F.greatest(c["start"], before(i)).alias("start"), c["end"].alias("end")))


def _press(text: str, good: list[int]) -> str:
    """Chunks of a text by number, widened to line breaks, with a mark wherever something is left out before one."""
    out, at = [], 0
    for i in good:
        start = max(text.rfind("\n", 0, i * CHUNK), 0, at)
        end = text.find("\n", (i + 1) * CHUNK)
        end = len(text) if end < 0 else end
        out += [GAP if start > at else "", text[start:end]]
        at = end
    whole = "".join(out)
    return "" if whole == GAP else whole


def press_text(perplexity: str = "perplexity", language: str = "language", score: str = "score", text: str = "text", want: str = "fr") -> Column:
    """The good chunks of a text, a mark where something is left out before or between them; empty if nothing is good.  Takes column names.

    Which chunks are good is a native expression; looking for line breaks from
    a place onwards is not, without a copy of the text for each chunk.
    """
    fair = f"r.{perplexity} BETWEEN 10 AND 1000 AND r.{language} = '{want}' AND r.{score} >= 0.65"
    good = F.expr(f"filter(transform(arrays_zip({perplexity}, {language}, {score}), (r, i) -> CASE WHEN {fair} THEN i END), i -> i IS NOT NULL)")

    @F.arrow_udf("string")
    def joined(texts: pa.Array, chunks: pa.Array) -> pa.Array:
        return pa.array([None if t is None else _press(t, c or []) for t, c in zip(texts.to_pylist(), chunks.to_pylist(), strict=True)], pa.string())

    return joined(F.col(text), good)


def thesis_text(text: Column, starts: Column, ends: Column, log_prob: Column, language: Column, most: float = 2000) -> Column:
    """The first two chunks, and later ones of fair perplexity in a wanted language."""
    rows = F.arrays_zip(starts.alias("a"), ends.alias("b"), log_prob.alias("p"), language.alias("l"))
    kept = F.filter(rows, lambda r, i: (i <= 1) | ((F.pow(F.lit(10.0), r["p"]) <= most) & r["l"].isin("fr", "en", "it", "es", "de")))
    return F.array_join(F.transform(kept, lambda r: F.substring(text, r["a"] + 1, r["b"] - r["a"])), "")
