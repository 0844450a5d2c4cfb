"""Corpus statistics, totals and derived figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as T

COUNTS = ["docs", "words", "chars"]


def counted(df: DataFrame, text: str = "text") -> DataFrame:
    """Add each text's words and characters, and 1 as its documents."""
    return df.withColumns({"docs": F.lit(1).cast("long"), "words": T.word_count(F.col(text)), "chars": F.length(text).cast("long")})


def totals(df: DataFrame, *keys: str) -> DataFrame:
    """Sums of the counts by key; sums of sums are sums, so partial tables fold the same way."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in COUNTS])


def rolled_up(df: DataFrame, *keys: str) -> DataFrame:
    """Totals at every level of a hierarchy; --- stands for all."""
    out = df.rollup(*keys).agg(*[F.sum(c).alias(c) for c in COUNTS], F.grouping_id().alias("_g"))
    n = len(keys)
    shown = [F.when(F.col("_g").bitwiseAND(1 << (n - 1 - i)) != 0, F.lit("---")).otherwise(F.col(k)).alias(k) for i, k in enumerate(keys)]
    return out.select(*shown, *COUNTS)


def ratio(a: Column, b: Column) -> Column:
    """a / b; a zero denominator counts as one."""
    return a / F.when(b == 0, F.lit(1)).otherwise(b)


def derived(df: DataFrame) -> DataFrame:
    """Figures in millions and billions, and ratios; token ratios only where the documents of both tables agree within 0.01 M."""
    agree = F.abs(F.col("docs") - F.col("sequences")) / 1e6 <= 0.01
    return df.withColumns(
        {
            "m_docs": F.col("docs") / 1e6,
            "b_words": F.col("words") / 1e9,
            "b_chars": F.col("chars") / 1e9,
            "words_per_doc": ratio(F.col("words"), F.col("docs")),
            "chars_per_word": ratio(F.col("chars"), F.col("words")),
            "b_tokens": F.col("tokens") / 1e9,
            "tokens_per_word": F.when(agree, F.col("tokens") / F.col("words")),
            "chars_per_token": F.when(agree, F.col("chars") / F.col("tokens")),
        }
    )


def at_least_digits(x: Column, digits: int = 3, width: int = 8, most: int = 12) -> Column:
    """A number with ``digits`` decimals, or as many more as show at least two significant places."""
    out = F.format_string(f"%.{most}f", x)
    for p in range(most - 1, digits - 1, -1):
        shown = F.format_string(f"%{width}.{p}f" if p == digits else f"%8.{p}f", x)
        out = F.when(F.round(x, p) >= 100 * 10.0**-p, shown).otherwise(out)
    return F.when(x == 0, F.format_string(f"%{width}.{digits}f", x)).otherwise(out)


def token_stats(df: DataFrame, *keys: str, length: str = "n_tokens") -> DataFrame:
    """Sum, number, least and most tokens of the documents of each key."""
    n = F.col(length)
    return df.groupBy(*keys).agg(F.sum(n).alias("total_tokens"), F.count("*").alias("total_sequences"), F.min(n).alias("min_tokens"), F.max(n).alias("max_tokens"))


def merge_token_stats(df: DataFrame, *keys: str) -> DataFrame:
    """Token statistics of parts as those of the whole: totals add up, the least and the most stay."""
    how = {"total": F.sum, "min": F.min, "max": F.max}
    names = ["total_tokens", "total_sequences", "min_tokens", "max_tokens"]
    return df.groupBy(*keys).agg(*[how[c.split("_")[0]](c).alias(c) for c in names])


def text_counters(text: Column) -> dict[str, Column]:
    """Counters of a text for tokenizer reports."""
    without = lambda p: (F.length(text) - F.length(F.regexp_replace(text, p, ""))).cast("long")
    return {
        "pages": F.lit(1).cast("long"),
        "paragraphs": F.size(F.split(text, "\n\n")).cast("long"),
        "lines": F.size(F.split(text, "\n")).cast("long"),
        "words": T.word_count(text),
        "chars": F.length(text).cast("long"),
        "bytes": F.octet_length(text).cast("long"),
        "spaces": without(" "),
        "linebreaks": without("\n"),
        "tabs": without("\t"),
        "digits": without("[0-9]"),
    }


def token_counters(tokens: Column) -> dict[str, Column]:
    """Counters of a text's tokens, an array of strings."""
    some = lambda p: F.size(F.filter(tokens, lambda t: t.rlike(p))).cast("long")
    return {
        "tokens": F.size(tokens).cast("long"),
        "space_tokens": some("^ +$"),
        "linebreak_tokens": some("^\n+$"),
        "tab_tokens": some("^\t+$"),
        "digit_tokens": some("^ ?[0-9]+$"),
        "single_byte_tokens": F.size(F.filter(tokens, lambda t: F.octet_length(t) == 1)).cast("long"),
    }


def matched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Each row of left with its row of right; reading the key of a row without one is an error."""
    out = left.join(right.withColumn("_found", F.lit(True)), key, "left")
    found = F.when(F.col("_found"), F.col(key)).otherwise(F.raise_error(F.concat(F.lit("no match for "), F.coalesce(F.col(key).cast("string"), F.lit("null")))))
    return out.withColumn(key, found).drop("_found")


def looked_up(df: DataFrame, totals: DataFrame, keys: list[str], total: str = "---") -> DataFrame:
    """df with the columns of ``totals``, a roll-up whose upper levels have ``total`` in the keys they sum over, and ``level``.

    A row takes the most specific entry there is: that of all its keys (level
    0), of all but the last (1), and so on.  Distinct keys are resolved once, in
    one join with the levels, and joined back null-safely.
    """
    asked = df.select(*keys).distinct()
    forms = F.array(*[F.struct(F.lit(n).alias("level"), *[(F.col(k) if i < len(keys) - n else F.lit(total)).alias(f"_{k}") for i, k in enumerate(keys)]) for n in range(len(keys) + 1)])
    each = asked.select(*keys, F.explode(forms).alias("f")).select(*keys, "f.*")
    values = [c for c in totals.columns if c not in keys]
    known = totals.select(*[F.col(k).alias(f"_t_{k}") for k in keys], F.struct(*values).alias("_v"))
    same = [F.col(f"_{k}").eqNullSafe(F.col(f"_t_{k}")) for k in keys]
    best = each.join(known, reduce(lambda a, b: a & b, same)).groupBy(*keys).agg(F.min_by("_v", "level").alias("_v"), F.min("level").alias("level"))
    best = best.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_v", "level")
    joined = df.join(best, reduce(lambda a, b: a & b, [df[k].eqNullSafe(best[f"_k_{k}"]) for k in keys]), "left")
    return joined.select(*[df[c] for c in df.columns], *[F.col(f"_v.{v}").alias(v) for v in values], "level")
