"""Quality signals of a text, all in one pass by array kernels.

The reference data carries such signals ready-made; here they are computed, by
the published descriptions (C4, Gopher, RedPajama-V2) with these definitions:
words are separated by white space (of ASCII where repetition is counted, of
Unicode elsewhere), lines are cut at \\n, characters are code points of words.
A null text counts as empty.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import kernels as K

TOP = (2, 3, 4)
DUPE = (5, 6, 7, 8, 9, 10)
SHAPE = {
    "word_count": "bigint", "mean_word_length": "double", "symbol_to_word_ratio": "double", "bullet_line_ratio": "double", "ellipsis_line_ratio": "double",
    "no_alpha_word_ratio": "double", "curly_count": "int", "lorem_count": "bigint", "sentence_count": "bigint",
}
REPETITION = [f"top_{n}gram" for n in TOP] + [f"dupe_{n}grams" for n in DUPE]


#: Unicode's white space, the marks that open a list's line, and the characters before which a line may end.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
BULLETS = [ord(c) for c in "-*•▪‣"]
LINE_ENDS = [0x0D, 0x85, 0x2028, 0x2029]
_SPACE = np.zeros(0x3001, bool)
_SPACE[WHITE] = True


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)


def _runs(on: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of marked places, cut at the rows' offsets."""
    cut = np.zeros(len(on) + 1, bool)
    cut[row] = True
    edge = np.concatenate([[False], on, [False]])
    start = np.flatnonzero(edge[1:-1] & (~edge[:-2] | cut[:-1]))
    stop = np.flatnonzero(edge[1:-1] & (~edge[2:] | cut[1:])) + 1
    return start, stop


def shape_rows(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The SHAPE signals, a row for each text."""
    c, row = K.code_points(data, off)
    n, rows = len(c), len(off) - 1
    total = lambda on: np.concatenate([[0], np.cumsum(on)])
    per_row = lambda at: np.diff(np.searchsorted(at, row))  # noqa: E731  of places in order
    solid = ~_SPACE[np.minimum(c, 0x3000)] | (c > 0x3000)
    start, end = _runs(solid, row)
    words = per_row(start)
    letters = total(_letters()[c]) if (c > 127).any() else total(((c | 32) >= 97) & ((c | 32) <= 122))
    no_letter = per_row(start[letters[end] == letters[start]])
    dots, dots_end = _runs(c == 46, row)
    triples = np.concatenate([[0], np.cumsum((dots_end - dots) // 3)])[np.searchsorted(dots, row)]
    symbols = per_row(np.flatnonzero((c == 35) | (c == 0x2026))) + np.diff(triples)

    # lines: a row's first place, and the place after each line break
    breaks = np.flatnonzero(c == 10)
    of = np.searchsorted(row, breaks, "right") - 1
    begin = np.concatenate([row[:-1], breaks + 1])
    stop = np.concatenate([row[1:], row[of + 1]])
    owner = np.concatenate([np.arange(rows), of])
    by = np.argsort(owner * np.int64(n + 1) + begin, kind="stable")
    begin, stop, owner = begin[by], stop[by], owner[by]
    same = np.append(owner[1:] == owner[:-1], False) if len(owner) else np.zeros(0, bool)
    stop = np.where(same, np.append(begin[1:], 0) - 1, stop)
    lines = np.bincount(owner, minlength=rows)
    place, other = np.arange(n), c != 32
    after = np.append(np.minimum.accumulate(np.where(other, place, n)[::-1])[::-1], n)
    before = np.append(np.maximum.accumulate(np.where(other, place, -1)), n - 1) if n else np.zeros(1, np.int64)
    padded = np.append(c, 0)
    at = after[np.minimum(begin, n)]
    bullet = (at < stop) & np.isin(padded[np.minimum(at, n)], BULLETS)
    last = stop - ((stop > begin) & np.isin(padded[np.maximum(stop - 1, 0)], LINE_ENDS))
    at = before[np.maximum(last - 1, 0)] if n else begin
    dot = padded == 46
    three = (at - 2 >= begin) & dot[np.maximum(at, 0)] & dot[np.maximum(at - 1, 0)] & dot[np.maximum(at - 2, 0)]
    ellipsis = (last > begin) & (at >= begin) & (three | (padded[np.maximum(at, 0)] == 0x2026))

    low = np.where((c >= 65) & (c <= 90), c + 32, c)
    lorem = np.flatnonzero(low[: max(n - 10, 0)] == ord("l"))
    for k, x in enumerate("lorem ipsum"):
        lorem = lorem[low[lorem + k] == ord(x)]
    lorem = lorem[np.searchsorted(row, lorem, "right") == np.searchsorted(row, lorem + 10, "right")]
    some = np.maximum(words, 1)
    return np.column_stack([
        words, np.bincount(np.searchsorted(row, start, "right") - 1, weights=end - start, minlength=rows)[:rows] / some, symbols / some,
        np.bincount(owner[bullet], minlength=rows) / lines, np.bincount(owner[ellipsis], minlength=rows) / lines, no_letter / some,
        per_row(np.flatnonzero((c == 123) | (c == 125))), per_row(lorem), per_row(_runs((c == 46) | (c == 33) | (c == 63), row)[0]),
    ])


def repetition_rows(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """For each text the share of word characters in the most frequent n-gram (n in TOP), and in repeated n-grams (n in DUPE).

    The most frequent n-gram is the one of most occurrences, of those the one
    of most characters; a single occurrence counts nothing.  Occurrences may
    overlap, so a top share is capped at 1; repeated n-grams cover each
    character once.
    """
    n = len(off) - 1
    w = K.Words(data, off)
    out = np.zeros((n, len(REPETITION)))
    if not len(w):
        return out
    of = w.of()
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    chars = lead[w.end] - lead[w.start]
    total = np.concatenate([[0], np.cumsum(chars)])
    size = np.maximum(total[w.row[1:]] - total[w.row[:-1]], 1)
    h = w.hashes()
    salt = K.mix(np.arange(1, n + 1, dtype=np.uint64))
    for k, gram in enumerate((*TOP, *DUPE)):
        x, at = K.windows(h, w.row, gram)
        if not len(x):
            continue
        key = x ^ salt[of[at]]
        by = np.argsort(key)
        head = np.flatnonzero(np.concatenate([[True], key[by][1:] != key[by][:-1]]))
        count = np.diff(np.append(head, len(key)))
        if gram in TOP:
            first = at[by[head]]
            mass = total[first + gram] - total[first]
            best = np.lexsort((mass, count, of[first]))
            last = best[np.append(of[first][best][1:] != of[first][best][:-1], True)]
            row = of[first][last]
            out[row, k] = np.where(count[last] > 1, np.minimum(count[last] * mass[last] / size[row], 1), 0)
        else:
            many = np.repeat(count > 1, count)
            cover = K.covered(at[by[many]], gram, len(w))
            out[:, k] = np.bincount(of[cover], weights=chars[cover], minlength=n) / size
    return out


def signals(text: Column) -> Column:
    """Struct of all signals."""
    names = [*SHAPE, *REPETITION]

    @F.arrow_udf("struct<" + ",".join(f"{c}:{SHAPE.get(c, 'double')}" for c in names) + ">")
    def quality_signals(col: pa.Array) -> pa.Array:
        data, off = K.text_bytes(col)
        rows = [np.column_stack([shape_rows(d, o), repetition_rows(d, o)]) for _, _, d, o in K.pieces(data, off)]
        each = np.concatenate([np.zeros((0, len(names))), *rows]).T
        kinds = {"double": pa.float64(), "bigint": pa.int64(), "int": pa.int32()}
        return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(v)).cast(kinds[SHAPE.get(c, "double")]) for c, v in zip(names, each, strict=True)], names)

    return quality_signals(text)


def with_signals(df: DataFrame, text: str = "text") -> DataFrame:
    """Add all signals of a text."""
    return df.withColumn("_r", signals(F.col(text))).select("*", "_r.*").drop("_r")
