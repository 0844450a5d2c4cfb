"""Tokens: pre-token counts, a BPE trainer on them, padding, long texts in parts.

The trainer stands for the reference's own vocabulary training.  Every
pre-token of the corpus counts.  Where the distinct ones are few, the driver
learns the merges; beyond that Spark keeps their symbols in blocks, and sums up
what a batch of guessed merges changes in them.  Both ways give the same merges.
"""

from __future__ import annotations

import bisect
import heapq
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import kernels
from corpusloom.sources import scratch

#: Letters, single digits, single line breaks and tabs, runs of marks; a space goes with the word after it.
PRE_TOKEN = r"(?U) ?\p{L}+| ?\p{N}|[\n\t]| ?[^\s\p{L}\p{N}]+| +"


#: Of the trainer in Spark: tokens that guess the next merges, and pairs that may come to the driver in a round.
SAMPLE, MOST_RIVALS = 100_000, 200_000
#: Symbols of a block; the number of the first symbol that a merge makes, and the bits of such a number; a block's arrays as they are stored.
BLOCK, MADE, BITS, KINDS = 1 << 18, 0x110000, 21, (np.int32, np.int32, np.int64)


def pre_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PRE_TOKEN), F.lit(0))


def pre_token_counts(df: DataFrame, text: str = "text", cut: Callable[[Column], Column] = pre_tokens) -> DataFrame:
    """(token, n) over the corpus, cut into pre-tokens or, say, a tokenizer's pieces; counts are combined before the shuffle."""
    return df.select(F.explode(cut(F.col(text))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


def _joined(symbols: list[str], pairs: set[tuple[str, str]]) -> list[str]:
    """Symbols with each of these pairs made one symbol, from the left."""
    new, k = [], 0
    while k < len(symbols):
        if k + 1 < len(symbols) and (symbols[k], symbols[k + 1]) in pairs:
            new.append(symbols[k] + symbols[k + 1])
            k += 2
        else:
            new.append(symbols[k])
            k += 1
    return new


class Learner:
    """BPE merges over (token, count) held in memory; steps can be taken back."""

    def __init__(self, counts: list[tuple[str, int]]):
        self.words = [list(t) for t, _ in counts]
        self.weight = [n for _, n in counts]
        self.pairs: Counter = Counter()
        self.where: dict[tuple[str, str], set[int]] = defaultdict(set)
        for i, w in enumerate(self.words):
            self._count(i, 1)
            for p in zip(w, w[1:]):
                self.where[p].add(i)
        self.heap = [(-n, p) for p, n in self.pairs.items()]
        heapq.heapify(self.heap)
        self.steps: list[list[tuple[int, list[str]]]] = []

    def _count(self, i: int, sign: int) -> set[tuple[str, str]]:
        w = self.words[i]
        found = [*zip(w, w[1:])]
        for q in found:
            self.pairs[q] += sign * self.weight[i]
        return set(found)

    def _replace(self, changes: Iterable[tuple[int, list[str]]]) -> None:
        touched: set[tuple[str, str]] = set()
        for i, new in changes:
            touched |= self._count(i, -1)
            self.words[i] = new
            for q in (now := self._count(i, 1)):
                self.where[q].add(i)
            touched |= now
        for q in touched:
            if self.pairs[q] > 0:
                heapq.heappush(self.heap, (-self.pairs[q], q))

    def best(self, least: int = 1) -> tuple[str, str] | None:
        """The most frequent pair, ties by the pair; none below ``least``."""
        while self.heap and self.pairs[self.heap[0][1]] != -self.heap[0][0]:
            _, p = heapq.heappop(self.heap)
            if self.pairs[p] > 0:
                heapq.heappush(self.heap, (-self.pairs[p], p))
        return self.heap[0][1] if self.heap and -self.heap[0][0] >= least else None

    def merge(self, pair: tuple[str, str]) -> None:
        old = [(i, self.words[i]) for i in self.where[pair]]
        self.steps.append(old)
        self._replace([(i, _joined(w, {pair})) for i, w in old])

    def take_back(self, n: int) -> None:
        for _ in range(n):
            self._replace(self.steps.pop())


def learn_merges(counts: list[tuple[str, int]], merges: int, least: int = 2) -> list[tuple[str, str]]:
    """BPE merges by falling pair frequency, ties by the pair; a pair seen less than ``least`` times is not merged."""
    learner, out = Learner(counts), []
    while len(out) < merges and (pair := learner.best(least)):
        learner.merge(pair)
        learner.steps.clear()
        out.append(pair)
    return out


def symbols_of(token: str, ranks: dict[tuple[str, str], list[int]]) -> list[str]:
    """A token's symbols after the merges, each applied once, in order; ``ranks`` has the places of a pair, which may have been learnt more than once."""
    symbols, now = list(token), 0
    while len(symbols) > 1:
        ahead = [(r[k], p) for p in zip(symbols, symbols[1:]) if (r := ranks.get(p)) and (k := bisect.bisect_left(r, now)) < len(r)]
        if not ahead:
            break
        at, pair = min(ahead)
        symbols, now = _joined(symbols, {pair}), at + 1
    return symbols


class Block:
    """The symbols of many tokens as numbers in arrays; a merge is one look at all pairs, and work at the places where it is found.

    Characters are their code points; what merges make is numbered from MADE on.
    """

    def __init__(self, symbols: np.ndarray, sizes: np.ndarray, n: np.ndarray):
        end = len(symbols)
        self.sizes, self.n, self.end = sizes.astype(np.int64), n.astype(np.int64), end
        stop = np.cumsum(self.sizes)
        self.symbols = np.append(symbols, -1).astype(np.int64)
        self.weight = np.repeat(self.n, self.sizes)
        self.after, self.before = np.arange(1, end + 2, dtype=np.int32), np.arange(-1, end, dtype=np.int32)
        self.after[stop - 1] = self.before[stop - self.sizes] = self.after[end] = self.before[end] = end
        self.pairs = self._pairs(np.arange(end))

    def _pairs(self, at: np.ndarray) -> np.ndarray:
        """The pairs that begin at these places as numbers, -1 at a token's end."""
        after = self.after[at]
        return np.where(after < self.end, self.symbols[at] << BITS | self.symbols[after], -1)

    def copy(self) -> Block:
        return Block(*self.rest())

    def rest(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols, sizes and counts of the tokens that still have a pair."""
        alive = self.symbols[:-1] >= 0
        sizes = np.diff(np.concatenate([[0], np.cumsum(alive)])[np.concatenate([[0], np.cumsum(self.sizes)])])
        some = sizes > 1
        return self.symbols[:-1][alive & np.repeat(some, self.sizes)], sizes[some], self.n[some]

    def merge(self, left: int, right: int, made: int) -> tuple[np.ndarray, np.ndarray]:
        """Make the pair one symbol, from the left; by how much that changes which pairs, in many parts."""
        at = np.flatnonzero(self.pairs == (left << BITS | right))
        if left == right and len(at):  # in a run of the symbol every second pair
            k = np.arange(len(at))
            run = np.maximum.accumulate(np.where(np.append(False, self.after[at[:-1]] == at[1:]), 0, k))
            at = at[(k - run) % 2 == 0]
        gone = self.after[at]
        touched = np.unique(np.concatenate([self.before[at], at, gone]))
        touched = touched[touched < self.end]
        old = self.pairs[touched]
        rest = self.after[gone]
        self.symbols[at], self.symbols[gone], self.pairs[gone] = made, -1, -1
        self.after[at], self.before[rest] = rest, at
        self.before[self.end] = self.end
        now = touched[self.symbols[touched] >= 0]
        self.pairs[now] = new = self._pairs(now)
        pairs, change = np.concatenate([old, new]), np.concatenate([-self.weight[touched], self.weight[now]])
        return pairs[pairs >= 0], change[pairs >= 0]


def _numbered(merges: list[tuple[str, str]]) -> list[tuple[int, int, int]]:
    """Merges between numbers of symbols, and what each makes; a symbol made in two ways has one number."""
    number: dict[str, int] = {}
    of = lambda x: ord(x) if len(x) == 1 else number[x]
    return [(of(a), of(b), number.setdefault(a + b, MADE + i)) for i, (a, b) in enumerate(merges)]


def _symbols(numbers: np.ndarray, merges: list[tuple[str, str]]) -> pa.Array:
    found, at = np.unique(numbers, return_inverse=True)
    return pa.array([chr(i) if i < MADE else "".join(merges[i - MADE]) for i in found.tolist()], pa.string()).take(pa.array(at))


def _sums(columns: dict[str, np.ndarray]) -> pa.Table:
    by = [k for k in columns if k != "n"]
    return pa.table(columns).group_by(by, use_threads=False).aggregate([("n", "sum")]).rename_columns([*by, "n"])


def _block(tokens: pa.Array, n: np.ndarray) -> Block:
    points, off = kernels.code_points(*kernels.text_bytes(tokens))
    return Block(points, np.diff(off), n)


def _row(symbols: np.ndarray, sizes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x.astype(k).tobytes()], pa.binary()) for x, k in zip((symbols, sizes, n), KINDS, strict=True)], ["symbols", "sizes", "n"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for row in zip(*batch.columns, strict=True):
            yield Block(*(np.frombuffer(x.as_buffer(), k) for x, k in zip(row, KINDS, strict=True)))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, n) as rows of about BLOCK symbols."""
    held: list[tuple] = []
    for batch in batches:
        held.append(_block(batch.column("token"), batch.column("n").to_numpy()).rest())
        if sum(len(x[0]) for x in held) >= BLOCK:
            yield _row(*map(np.concatenate, zip(*held, strict=True)))
            held = []
    if held:
        yield _row(*map(np.concatenate, zip(*held, strict=True)))


def _merged(merges: list[tuple[int, int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            for m in merges:
                block.merge(*m)
            yield _row(*block.rest())

    return run


def _changes(merges: list[tuple[int, int, int]]):
    """How often each pair occurs, as step -1, and by how much each of the merges in turn changes that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            some = block.pairs >= 0
            parts = [(block.pairs[some], block.weight[some]), *(block.merge(*m) for m in merges)]
            step = np.repeat(np.arange(-1, len(merges), dtype=np.int32), [len(p) for p, _ in parts])
            yield from _sums({"step": step, "pair": np.concatenate([p for p, _ in parts]), "n": np.concatenate([n for _, n in parts])}).to_batches()

    return run


def _named(merges: list[tuple[str, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = batch.column("pair").to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column("step"), _symbols(pair >> BITS, merges), _symbols(pair & ((1 << BITS) - 1), merges), batch.column("n")], ["step", "l", "r", "n"])

    return run


class Ranked:
    """Pairs by falling count, ties by the pair."""

    def __init__(self, n: dict[tuple[str, str], float]):
        self.n = dict(n)
        self.heap = [(-c, p) for p, c in self.n.items() if c > 0]
        heapq.heapify(self.heap)

    def add(self, change: dict[tuple[str, str], float], sign: int = 1) -> None:
        for p, c in change.items():
            self.n[p] = now = self.n.get(p, 0) + sign * c
            if now > 0:
                heapq.heappush(self.heap, (-now, p))

    def best(self, least: float) -> tuple[str, str] | None:
        while self.heap and self.n[self.heap[0][1]] != -self.heap[0][0]:
            heapq.heappop(self.heap)
        return self.heap[0][1] if self.heap and -self.heap[0][0] >= least else None


def _guessed(sample: Block, counts: dict[tuple[str, str], float], out: list[tuple[str, str]], most: int, least: int) -> list[tuple[str, str]]:
    """The next merges, by all tokens' counts and by what each merge changes in the sample, in proportion."""
    ranked, block, guess = Ranked(counts), sample.copy(), []
    while len(guess) < most and (p := ranked.best(least)):
        guess.append(p)
        merge = _numbered([*out, *guess])[-1]
        pairs, n = block.merge(*merge)
        seen = -n[pairs == (merge[0] << BITS | merge[1])].sum()
        if seen > 0:
            t = _sums({"pair": pairs, "n": n})
            pair = t["pair"].to_numpy()
            of = zip(_symbols(pair >> BITS, [*out, *guess]).to_pylist(), _symbols(pair & ((1 << BITS) - 1), [*out, *guess]).to_pylist(), strict=True)
            ranked.add({k: c * ranked.n[p] / seen for k, c in zip(of, t["n"].to_pylist(), strict=True)})
        ranked.n[p] = 0
    return guess


def _without(change: dict[tuple[str, str], int], skipped: list[tuple[str, str]]) -> dict[tuple[str, str], int]:
    """A merge's change where these merges before it, which don't touch its symbols, were not made: what they join is still two symbols, of which the nearer one is its neighbour."""
    out: Counter = Counter()
    for (left, right), n in change.items():
        for a, b in reversed(skipped):
            left, right = b if left == a + b else left, a if right == a + b else right
        out[left, right] += n
    return out


def _accepted(base: dict[tuple[str, str], int], last: tuple | None, changes: list[dict] | None, guess: list[tuple[str, str]], out: list[tuple[str, str]], least: int) -> tuple[list[tuple[str, str]], dict, bool]:
    """The merges that counts over all tokens give, in their order, as far as those guessed tell; the counts after them; and whether none is left.

    base: pairs' counts, all up to ``last``, (-count, pair), or all there are if
    that is None.  changes: what each guessed merge changes after those guessed
    before it; None: unknown.  A guessed merge may come before others of the
    guess if it shares no symbol with them: tokens become the same either way.
    """
    made = Counter(a + b for a, b in [*out, *guess])
    new = {a + b for a, b in guess if made[a + b] == 1}
    counts, beyond = dict(base), set()
    if last:
        for p in {p for c in changes or [] for p in c} - counts.keys():
            if not new & {*p}:
                beyond.add(p)
                counts[p] = -last[0] - (p < last[1])  # at most
    ranked, order, done = Ranked(counts), [], set()
    left_out = lambda j: [t for t in range(j) if t not in done]
    merges = lambda steps: [guess[t] for t in steps]
    while True:
        best = ranked.best(least)
        if best is None:
            return order, ranked.n, last is None or -last[0] < least
        if best in beyond or last and (-ranked.n[best], best) > last:
            break
        j = next((j for j, p in enumerate(guess) if p == best and j not in done), None)
        if j is None or changes is None and j:
            break
        own = {*best, best[0] + best[1]}
        if any(guess[t][0] + guess[t][1] not in new or own & {*guess[t], guess[t][0] + guess[t][1]} for t in left_out(j)):
            break
        order.append(best)
        if changes is None:
            ranked.n[best] = 0
            break
        later = [u for u in done if u > j]
        for u in later:
            ranked.add(_without(changes[u], merges(left_out(u))), -1)
        done.add(j)
        for u in [j, *later]:
            ranked.add(_without(changes[u], merges(left_out(u))))
    return order, ranked.n, False


def _learn_in_table(counts: DataFrame, merges: int, least: int = 2, ahead: int = 64) -> list[tuple[str, str]]:
    """learn_merges over a table of any size, many merges in a round.

    All tokens are kept as rows of BLOCK symbols, written anew with each round's
    merges.  In a round the driver guesses the next ``ahead`` merges; Spark
    counts all pairs and sums up by how much each guessed merge changes each.
    From that the driver tells which of the guessed merges are right, and in
    what order.  So the merges are exact, and a round with a wrong guess only
    ends sooner.  The driver gets MOST_RIVALS pairs and as many changes at most:
    pairs beyond count as unknown, and with more changes fewer merges are
    guessed.
    """
    state = scratch.written(counts.mapInArrow(_packed, "symbols binary, sizes binary, n binary"), "symbols")
    top = counts.orderBy(F.desc("n"), "token").limit(SAMPLE).toArrow()
    sample = _block(top["token"], top["n"].to_numpy())
    out: list[tuple[str, str]] = []
    guess: list[tuple[str, str]] = []
    reach, ended = ahead, False
    while len(out) < merges and not ended:
        steps = state.mapInArrow(_changes(_numbered([*out, *guess])[len(out) :]), "step int, pair long, n long").groupBy("step", "pair").agg(F.sum("n").alias("n")).filter("n <> 0")
        sums = scratch.written(steps.mapInArrow(_named([*out, *guess]), "step int, l string, r string, n long"), "sums")
        base = {(r["l"], r["r"]): r["n"] for r in sums.filter("step < 0").orderBy(F.desc("n"), "l", "r").limit(MOST_RIVALS).toArrow().to_pylist()}
        last = max((-n, p) for p, n in base.items()) if len(base) == MOST_RIVALS else None
        found = sums.filter("step >= 0").limit(MOST_RIVALS + 1).toArrow().to_pylist()
        changes: list[dict] | None = [{} for _ in guess]
        for r in found:
            changes[r["step"]][r["l"], r["r"]] = r["n"]
        if len(found) > MOST_RIVALS:
            changes = None
        scratch.drop(sums)
        right, known, ended = _accepted(base, last, changes, guess, out, least)
        reach = max(1, reach // 4) if changes is None else min(ahead, 2 * reach)
        if right:
            out += right
            latest = _numbered(out)[-len(right) :]
            for m in latest:
                sample.merge(*m)
            sample = sample.copy()
            if len(out) < merges and not ended:
                old, state = state, scratch.written(state.mapInArrow(_merged(latest), state.schema), "symbols")
                scratch.drop(old)
        guess = _guessed(sample, known, out, min(reach, merges - len(out)), least)
    scratch.drop(state)
    return out


def within_alphabet(counts: DataFrame, size: int) -> DataFrame:
    """(token, n) without the characters beyond the ``size`` most frequent ones, ties by the character; tokens that become equal are one."""
    letters = counts.select(F.explode(F.split("token", "")).alias("c"), "n").groupBy("c").agg(F.sum("n").alias("n"))
    kept = [r.c for r in letters.orderBy(F.desc("n"), "c").limit(size).collect()]
    text = F.array_join(F.filter(F.split("token", ""), lambda c: c.isin(kept)), "")
    return counts.select(text.alias("token"), "n").filter("token <> ''").groupBy("token").agg(F.sum("n").alias("n"))


def train(df: DataFrame, merges: int = 1000, at_driver: int = 200_000, text: str = "text", alphabet: int | None = None, least: int = 2, cut: Callable[[Column], Column] = pre_tokens) -> list[tuple[str, str]]:
    """Merges learnt from all pre-tokens of the corpus: on the driver while the distinct ones have up to ``at_driver`` characters, beyond that in Spark; the same either way.

    ``alphabet``: how many characters take part, the most frequent; ``least``: how often a pair must occur to be merged; ``cut``: what makes pre-tokens of a text.
    """
    counts = pre_token_counts(df, text, cut)
    counts = scratch.written((within_alphabet(scratch.written(counts, "pre-tokens"), alphabet) if alphabet else counts).filter(F.length("token") > 1), "pre-tokens")
    size = counts.agg(F.coalesce(F.sum(F.length("token")), F.lit(0)).alias("chars")).first().chars
    out = learn_merges([(r.token, r.n) for r in counts.collect()], merges, least) if size <= at_driver else _learn_in_table(counts, merges, least)
    scratch.drop(counts)
    return out


def padded(tokens: Column, size: int, pad: int, end: int | None = None) -> Column:
    """Tokens clipped or padded to a size; an end token after them where asked for."""
    out = F.concat(F.slice(tokens, 1, size), F.array_repeat(F.lit(pad), F.greatest(F.lit(size) - F.size(tokens), F.lit(0)).cast("int")))
    return F.concat(out, F.array(F.lit(end))) if end is not None else out


def cut_before_digits(text: str, most: int) -> list[str]:
    """Parts of a text over ``most`` characters, cut before the first digit after half of it, or after a shorter way where none follows."""
    import re

    text = text.rstrip()
    if len(text) <= most:
        return [text]
    parts = []
    digit = re.compile(r"\d")
    while text:
        at = max(1, most // 2)
        found = digit.search(text, at)
        while found is None and at > 100:
            at //= 2
            found = digit.search(text, at)
        end = found.start() if found else len(text)
        parts.append(text[:end])
        text = text[end:]
    return parts


def parts_before_digits(text: Column, most: int) -> Column:
    @F.arrow_udf("array<string>")
    def cut(a: pa.Array) -> pa.Array:
        return pa.array([None if x is None else cut_before_digits(x, most) for x in a.to_pylist()], pa.list_(pa.string()))

    return cut(text)

