"""Labels, orders and previews of report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types

#: Shown names of categories and languages.
CATEGORIES = {"legi_written": "Legislative Texts", "legi_spoken": "Legislative Transcripts", "legi_dialogue": "Legislative Transcripts", "aligned": "Multilingual Parallel"}
LANGUAGES = {"fr": "French", "en": "English", "de": "German", "es": "Spanish", "it": "Italian", "parallel": "Multilingual Parallel"}


def _lookup(names: dict[str, str], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), key)


def category_label(category: Column) -> Column:
    return F.initcap(F.replace(F.coalesce(_lookup(CATEGORIES, F.lower(category)), category), F.lit("_"), F.lit(" ")))


def language_label(code: Column) -> Column:
    name = _lookup(LANGUAGES, code)
    return F.when(name.isNotNull(), F.concat(name, F.lit(" ("), code, F.lit(")"))).otherwise(code)


def short_count(n: Column) -> Column:
    """A whole number with K, M, B or T where it is a multiple of it."""
    out = n.cast("string")
    for unit, size in (("K", 10**3), ("M", 10**6), ("B", 10**9), ("T", 10**12)):
        out = F.when((n >= size) & (n % size == 0), F.concat((n / size).cast("long").cast("string"), F.lit(unit))).otherwise(out)
    return out


def per_document(df: DataFrame) -> DataFrame:
    """Rounded ratios of a report row, from totals in millions and billions."""
    docs, words, chars, tokens = (F.col(c) * k for c, k in (("m_docs", 1e6), ("b_words", 1e9), ("b_chars", 1e9), ("b_tokens", 1e9)))
    return df.withColumns({"words_per_doc": F.bround(words / docs, 0).cast("long"), "chars_per_doc": F.bround(chars / docs, 0).cast("long"), "tokens_per_doc": F.bround(tokens / docs, 0).cast("long"), "chars_per_word": F.bround(chars / words, 1), "tokens_per_word": F.bround(tokens / words, 2)})


def category_order(df: DataFrame, category: str = "category", size: str = "b_tokens") -> DataFrame:
    """(category, total, place): programming last, multilingual before it, legislative categories weighed together, larger ones first."""
    c = F.col(category)
    family = F.when(c.startswith("Legislative"), "Legislative").otherwise(c)
    sums = df.groupBy(c.alias("category"), family.alias("_f")).agg(F.sum(size).alias("total"))
    weight = F.sum("total").over(Window.partitionBy("_f"))
    last = F.when(F.lower("category").rlike("code|programming"), 2).when(F.lower("category").contains("multilingual"), 1).otherwise(0)
    ranked = sums.withColumn("_w", weight)
    return ranked.withColumn("place", F.row_number().over(Window.orderBy(last, F.col("_w").desc(), "category")).cast("long")).select("category", "total", "place")  # a row a category


def config_place(name: Column) -> Column:
    """Sort key of a configuration: default, languages, several languages, code, programming languages, the rest."""
    languages = ["en", "fr", "de", "es", "it"]
    out = F.when(name == "default", 0)
    for i, k in enumerate(languages, 1):
        out = out.when(name == k, i)
    n = len(languages)
    return out.when(name.rlike(f"^({'|'.join(languages)}),"), n + 1).when(name == "code", n + 2).when(name.startswith("code-"), n + 3).otherwise(n + 4)


def last_by_name(df: DataFrame, name: str, order: str) -> DataFrame:
    """One row for each name: the last in order."""
    return df.groupBy(name).agg(F.max_by(F.struct(*[c for c in df.columns if c != name]), order).alias("_r")).select(name, "_r.*")


def dataset_label(name: Column) -> Column:
    """``Wikipedia:fr:3parquet`` as ``Wikipedia (fr)``."""
    parts = F.slice(F.filter(F.split(name, ":"), lambda p: ~p.contains("parquet")), 1, 2)
    parts = F.when(F.get(parts, F.lit(0)).contains("Stack"), F.slice(parts, 2, 2)).otherwise(parts)
    return F.regexp_replace(F.regexp_replace(F.array_join(parts, "."), r"[0-9.]+$", ""), r"(\w+)\.(\w+)", "$1 ($2)")


def evaluation_language(name: Column) -> Column:
    """English name of a dataset's language."""
    out = F.when(name.rlike(r"TheStack|c\+\+|javascript|python|tex"), "Code")
    for code, shown in (("en", "English"), ("de", "German"), ("es", "Spanish"), ("it", "Italian")):
        out = out.when(name.rlike(f"[:.]{code}"), shown)
    return out.otherwise("French")


def visible(text: Column) -> Column:
    """White space as marks, for display."""
    for raw, shown in (("\n", "\\n"), ("\t", "\\t"), ("\r", "\\r"), (" ", "▁")):
        text = F.replace(text, F.lit(raw), F.lit(shown))
    return text


def preview(value: Column, kind: types.DataType, most: int = 100) -> Column:
    """A value's text, lists over three items as the first, ..., and the last."""
    if isinstance(kind, types.ArrayType):
        n = F.size(value)
        value = value.cast("array<string>")
        value = F.when(n > 3, F.array(F.element_at(value, 1), F.lit("..."), F.element_at(value, -1))).otherwise(value)
        return F.concat(F.lit("["), F.array_join(value, ", "), F.lit("]"))
    text = F.to_json(value) if isinstance(kind, (types.StructType, types.MapType)) else value.cast("string")
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("..."))).otherwise(text)
