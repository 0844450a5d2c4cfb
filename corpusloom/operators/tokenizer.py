"""What a tokenizer does to a text before and after its merges: normalise, mark spaces, cut into pieces, fall back to bytes, decode.

Unicode's NFC and cutting work on columns in the JVM; symbols, and bytes put
together, are Arrow functions.  Every step takes whole texts, null gives null, and an empty text
has no pieces.

A space is shown as the mark U+2581, and a piece begins with at most one.  Runs
of other marks, single line breaks and tabs, and digits are pieces of their
own; what lies between them up to the next space is one.  A mark U+2581 that a
text already holds counts as a space and is decoded as one, or, after an
opening mark, as the space that encoding puts there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import kernels, udfs

SPACE = "▁"
#: Characters after which a space is put before a word or a space.
SPACE_AFTER = "\n\t([{/<'’\"«“‘‚‹—–―"
#: The longest runs of spaces, tabs and line breaks that are one token.
LONGEST_RUNS = {SPACE: 8, "\t": 4, "\n": 2}
#: The tokens that come first in a vocabulary.
SPECIAL = ["<unk>", "<s>", "</s>", "<pad>"]

PIECE = 1 << 18  # bytes of text whose symbols are made, and tokens that are put together, at once, whatever the batch holds
BYTES = pa.array([f"<0x{i:02X}>" for i in range(256)])
ONE_BYTE = pa.array([bytes([i]) for i in range(256)], pa.binary())
_AFTER = "[" + SPACE_AFTER.replace("[", r"\[") + "]"
# plain letters stand first, since Java tests a class from the left
_LETTERS = r"a-zA-Z\p{IsAlphabetic}\p{M}\p{Pc}"
_BLANKS = r"\p{Z}\x09-\x0D\x{85}"
_MARKS = rf"[^{_LETTERS}{_BLANKS}\p{{N}}{SPACE}]+"
_REST = rf"[{_LETTERS}{_BLANKS}&&[^\p{{N}}\n\t]]+"


def normalised(text: Column, spaces: str = "prefix_all") -> Column:
    """NFC without carriage returns and NULs, and, as ``spaces`` says, with a space after opening marks (``prefix_all``), as it is (``prefix_sos``), or with every space as a mark (``split``)."""
    text = udfs.normalise_unicode(text)
    if spaces == "prefix_all":
        return F.regexp_replace(text, rf"({_AFTER})(?=[ {_LETTERS}\p{{Nd}}])", "$1 ")
    if spaces == "prefix_sos":
        return text
    if spaces == "split":
        return F.regexp_replace(text, "[  ]", SPACE)
    raise ValueError(f"no way of spaces {spaces}")


def marked(text: Column) -> Column:
    """Spaces as marks, and one before the first character; none where one is there, or the text is empty."""
    return F.regexp_replace(F.replace(text, F.lit(" "), F.lit(SPACE)), f"^(?=[^{SPACE}])", SPACE)


def pieces(text: Column, spaces: str = "prefix_all", single_digits: bool = True, own_marks: bool = True) -> Column:
    """The pieces of a text, in order, within which merges work; they join to the normalised text with its spaces marked."""
    # no two ways begin with the same character after the mark, so the frequent ones stand first
    digits = r"\p{N}" if single_digits else r"[\p{Nd}\p{Nl}]+|\p{No}+"
    if spaces == "split":
        whole = normalised(text, spaces)
        rest = [_REST, _MARKS] if own_marks else [rf"[^\n\t\p{{N}}{SPACE}]+"]
        ways = [*rest, rf"[{SPACE}\n\t]", digits]
    else:
        whole = marked(normalised(text, spaces))
        rest = [rf"{SPACE}?{_REST}", rf"{SPACE}?{_MARKS}", r"[\n\t]"] if own_marks else [rf"{SPACE}?[^\p{{N}}{SPACE}]+"]
        ways = [*rest, digits, SPACE]
    return F.regexp_extract_all(whole, F.lit("|".join(ways)), F.lit(0))


def alphabet(counts: DataFrame, size: int) -> list[str]:
    """The ``size`` most frequent characters of (token, n), ties by code point."""
    chars = counts.select(F.explode(F.regexp_extract_all("token", F.lit("(?s)."), F.lit(0))).alias("c"), "n")
    best = chars.groupBy("c").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.hex(F.encode("c", "utf-8"))).limit(size)
    return [r.c for r in best.collect()]


def character_counts(df: DataFrame, text: str = "text", spaces: str = "prefix_all") -> DataFrame:
    """(token, n) of the characters of all pieces, as ``alphabet`` takes them; pieces lose no character, so nothing is cut here.  Counted in batches before the shuffle."""
    whole = normalised(F.col(text), spaces)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, off in kernels.pieces(*kernels.text_bytes(batch.column(0))):
                found, n = np.unique(kernels.code_points(data, off)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(map(chr, found.tolist()), pa.string()), pa.array(n, pa.int64())], ["token", "n"])

    parts = df.select((whole if spaces == "split" else marked(whole)).alias("whole")).mapInArrow(count, "token string, n long")
    return parts.groupBy("token").agg(F.sum("n").alias("n"))


def symbol_lists(known: Sequence[str]) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    """``symbols`` of texts in Arrow batches; what comes out and is held at once are the symbols of a PIECE, or of one longer text."""
    chars = sorted(set(known))
    points = np.array([ord(c) for c in chars], np.uint32)
    names = pa.array([*BYTES.to_pylist(), *chars])

    def numbers(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each symbol its place in ``names``, and for each row the number of symbols."""
        head = (data & 0xC0) != 0x80
        point = kernels.code_points(data, off)[0]
        of = np.cumsum(head) - 1
        inside = np.isin(point, points)[of]
        at = np.flatnonzero(head | ~inside)
        number = np.where(inside[at], 256 + np.searchsorted(points, point[of[at]]), data[at])
        return number.astype(np.int32), np.diff(np.searchsorted(at, off))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for a in batches:
            for lo, hi, data, off in kernels.pieces(*kernels.text_bytes(a), PIECE):
                number, count = numbers(data, off)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32()), names.take(pa.array(number)))
                valid = a.slice(lo, hi - lo).is_valid()
                yield pc.if_else(valid, lists, None) if valid.false_count else lists

    return run


def symbols(found: Column, known: Sequence[str]) -> Column:
    """The symbols of pieces, in order, with which merging begins: characters of the alphabet, and the bytes of all others, as ``<0xC3>``."""
    run = symbol_lists(known)

    @F.arrow_udf("array<string>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return run(batches)

    return cut.asNondeterministic()(F.array_join(found, ""))  # so that it is computed once for all its uses


def _joined(a: pa.Array) -> pa.Array:
    at = pc.index_in(a.flatten(), BYTES)
    values = pc.if_else(pc.is_valid(at), ONE_BYTE.take(at), a.flatten().cast(pa.binary()))
    offsets = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(a), 0).to_numpy(zero_copy_only=False))])
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
    whole = pc.binary_join(lists, b"")
    try:
        text = whole.cast(pa.string())
    except pa.ArrowInvalid:
        text = pa.array([b.decode("utf-8", "replace") for b in whole.to_pylist()])
    return pc.if_else(a.is_valid(), text, None)


def joined_lists(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """``joined`` of lists in Arrow batches, with the texts of some PIECE tokens, or of one longer list, at once."""
    for a in batches:
        off = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(a), 0).to_numpy(zero_copy_only=False))])
        for lo, hi, _, _ in kernels.pieces(np.zeros(0, np.uint8), off, PIECE):
            yield _joined(a.slice(lo, hi - lo))


def joined(tokens: Column) -> Column:
    """The bytes of tokens put together, as text; U+FFFD stands where they are no UTF-8."""

    @F.arrow_udf("string")
    def put(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return joined_lists(batches)

    return put(tokens)


def decoded(tokens: Column, spaces: str = "prefix_all", fallback: bool = True) -> Column:
    """The text of tokens: bytes put together, marks as spaces, without the one at the start and those after opening marks that encoding put there.  Without ``fallback`` no token is a byte, as among pieces, which always cut its digit 0 off, and nothing leaves the JVM."""
    text = F.replace(joined(tokens) if fallback else F.array_join(tokens, ""), F.lit(SPACE), F.lit(" "))
    if spaces == "split":
        return text
    text = F.regexp_replace(text, "^ ", "")
    return F.regexp_replace(text, f"({_AFTER}) ", "$1") if spaces == "prefix_all" else text


def run_merges() -> list[tuple[str, str]]:
    """The merges by which runs of spaces, tabs or line breaks become one token, longer ones first."""
    out = []
    for char, most in LONGEST_RUNS.items():
        out += [(char * a, char * b) for a in range(most - 1, 0, -1) for b in range(most - a, 0, -1)]
    return out


def with_run_merges(merges: Iterable[tuple[str, str]]) -> list[tuple[str, str]]:
    """Merges with those of runs at their end, each once."""
    own = run_merges()
    return [m for m in merges if m not in set(own)] + own


def runs(text: Column) -> Column:
    """What the merges of runs make of the spaces, tabs and line breaks of a text with marked spaces."""
    return F.regexp_extract_all(text, F.lit("|".join(f"{c}{{1,{n}}}" for c, n in LONGEST_RUNS.items())), F.lit(0))


def vocabulary(merges: Iterable[tuple[str, str]], known: Iterable[str], unused: int = 40) -> list[str]:
    """All tokens in the order of their ids, each once: special, bytes, unused, runs, digits, the alphabet, and what merges make."""
    first = [*SPECIAL, *BYTES.to_pylist(), *[f"<unused{i}>" for i in range(unused)]]
    first += [c * i for c, n in LONGEST_RUNS.items() for i in range(1, n + 1)] + [str(i) for i in range(10)]
    return list(dict.fromkeys([*first, *sorted(known), *(a + b for a, b in merges)]))

