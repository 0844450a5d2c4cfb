"""The trainer in Spark: merges that are guessed, and told apart by counts over all tokens."""

from __future__ import annotations

import random
from collections import Counter
from itertools import pairwise

import numpy as np
import pyarrow as pa

from corpusloom.operators import tokens as K


def counted(words, counts):
    return +Counter(p for w, n in zip(words, counts, strict=True) for p in zip(w, w[1:]) for _ in range(n))


def test_guessed_merges_are_put_in_order():
    """Blocks change pairs' counts as symbol lists do; of merges guessed in any order those accepted are the next ones, in their order, with exact counts after them."""
    rng, swapped = random.Random(3), 0
    for case in range(500):
        letters = "abcdefgh"[: rng.randint(1, 8)]
        tokens = Counter("".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(rng.randint(1, 40)))
        n = [tokens[t] for t in tokens]
        want = K.learn_merges([*tokens.items()], 12)
        out = want[: rng.randint(0, 3)]
        guess, made = [], {a + b for a, b in out}
        for a, b in sorted(want[len(out) : len(out) + 8], key=lambda _: rng.random() < 0.2):
            if all(len(x) == 1 or x in made for x in (a, b)):
                guess.append((a, b))
                made.add(a + b)
        block, words = K._block(pa.array([*tokens]), np.array(n)), [[*t] for t in tokens]
        states = []
        for p, m in zip([*out, *guess], K._numbered([*out, *guess]), strict=True):
            states.append(counted(words, n))
            words = [K._joined(w, {p}) for w in words]
            pairs, change = block.merge(*m)
            of = list(zip(*(K._symbols(x, [*out, *guess]).to_pylist() for x in (pairs >> K.BITS, pairs & ((1 << K.BITS) - 1))), strict=True))
            now = Counter(states[-1])
            for q, c in zip(of, change.tolist(), strict=True):
                now[q] += c
            assert +now == counted(words, n), (case, p)
        states.append(counted(words, n))
        changes = [{q: b[q] - a[q] for q in a.keys() | b.keys()} for a, b in pairwise(states[len(out) :])]
        for most in (10**9, 6, 3):
            known = sorted((-c, p) for p, c in states[len(out)].items())[:most]
            order, left, _ = K._accepted({p: -c for c, p in known}, known[-1] if len(known) == most else None, changes, guess, out, 2)
            assert order == want[len(out) : len(out) + len(order)], case
            if most > 6:
                words = [[*t] for t in tokens]
                for p in [*out, *order]:
                    words = [K._joined(w, {p}) for w in words]
                assert +Counter(left) == counted(words, n), case
                swapped += order != guess[: len(order)]
    assert swapped > 20


def test_a_table_is_learnt_in_few_rounds(spark, monkeypatch):
    """Merges of many different tokens, of which the sample has few, come some dozens a round."""
    rng, rounds, accepted = random.Random(4), [], K._accepted
    monkeypatch.setattr(K, "_accepted", lambda *a: rounds.append(len(a[3])) or accepted(*a))
    monkeypatch.setattr(K, "SAMPLE", 3000)
    parts = ["th", "er", "on", "an", "re", "ti", "in", "s", "e", "ou"]
    df = spark.createDataFrame([(" ".join("".join(rng.choices(parts, range(10, 0, -1), k=rng.randint(1, 6))) for _ in range(200)),) for _ in range(60)], "text string")
    assert K.train(df, 60, at_driver=0) == K.train(df, 60, at_driver=10**9)
    assert len(rounds) < 10
