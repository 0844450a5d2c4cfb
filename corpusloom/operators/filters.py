"""Row predicates, and rule chains in which the first rule that fails names the reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import urls

#: A rule: (reason, signal, least allowed or None, most allowed or None); bounds themselves pass.
Rule = tuple[str, str, float | None, float | None]

_GOPHER: list[Rule] = [
    ("Gopher:word_count", "word_count", 50, 100_000),
    ("Gopher:mean_word_length", "mean_word_length", 3, 10),
    ("Gopher:symbol_word_ratio", "symbol_to_word_ratio", None, 0.1),
    ("Gopher:bulletpoint_start", "bullet_line_ratio", None, 0.9),
    ("Gopher:lines_end_with_ellipsis_ratio", "ellipsis_line_ratio", None, 0.3),
    ("Gopher:no_alpha_words", "no_alpha_word_ratio", None, 0.3),
]
_TOP = [(f"Gopher:top_{n}gram", f"top_{n}gram", None, most) for n, most in ((2, 0.2), (3, 0.18), (4, 0.16))]
_DUPE = [(f"Gopher:dupe_{n}grams", f"dupe_{n}grams", None, (20 - n) / 100) for n in range(5, 11)]

#: The web rules in their order.
WEB_RULES: list[Rule] = [
    ("ccnet:perplexity", "perplexity", 10, 1000),
    ("ccnet:language_score", "language_score", 0.65, None),
    ("C4:num_sentences", "sentence_count", 3, None),
    ("C4:curly_bracket", "curly_count", None, 0),
    ("C4:lorem_ipsum", "lorem_count", None, 0),
    ("C4:toxic_words", "bad_word_count", None, 0),
    *_GOPHER,
    *_TOP,
    *_DUPE,
]

#: The looser variant: no curly rule, more bad words, a Wikipedia score.
VARIANT_RULES: list[Rule] = [
    ("ccnet:perplexity", "perplexity", 10, 1000),
    ("ccnet:language_score", "language_score", 0.7, None),
    ("wikipedia_score", "wikipedia_score", 0.2, None),
    ("C4:num_sentences", "sentence_count", 3, None),
    ("C4:toxic_words", "bad_word_count", None, 3),
    ("C4:lorem_ipsum", "lorem_count", None, 0),
    *_GOPHER,
    *_TOP,
    *_DUPE,
]


def reason(rules: Sequence[Rule], columns: Sequence[str]) -> Column:
    """The first failing rule's reason, null if all pass.  A rule on a signal that is null, or that the table lacks, passes."""
    out: Column | None = None
    for name, signal, least, most in rules:
        if signal not in columns:
            continue
        c, bad = F.col(signal), F.lit(False)
        if least is not None:
            bad = bad | (c < least)
        if most is not None:
            bad = bad | (c > most)
        out = F.when(bad, F.lit(name)) if out is None else out.when(bad, F.lit(name))
    return out if out is not None else F.lit(None).cast("string")


def with_reason(df: DataFrame, rules: Sequence[Rule] = WEB_RULES) -> DataFrame:
    return df.withColumn("reason", reason(rules, df.columns))


def split_by_reason(df: DataFrame, rules: Sequence[Rule] = WEB_RULES) -> tuple[DataFrame, DataFrame]:
    """(kept rows, rejected rows with their reason), for an exclusion writer."""
    judged = with_reason(df, rules)
    return judged.filter("reason is null").drop("reason"), judged.filter("reason is not null")


def signal(signals: Column, name: str) -> Column:
    """A document-level signal: the value of the first [start, end, value] span of a map entry."""
    return F.element_at(signals, F.lit(name))[0][2]


def span_sum(signals: Column, name: str) -> Column:
    """The sum of the values of a signal's spans."""
    return F.aggregate(F.element_at(signals, F.lit(name)), F.lit(0.0), lambda a, s: a + s[2])


def url_reason(url: Column, language: Column, blacklist: Column) -> Column:
    return F.when(urls.covered_elsewhere(url, language), F.lit("dedup_url")).when(blacklist.isNotNull(), F.lit("blacklist_url"))


def not_duplicate(flag: Column) -> Column:
    return ~F.coalesce(flag, F.lit(False))


def ocr_at_least(score: Column, least: int) -> Column:
    """A missing score counts as 100."""
    return F.coalesce(score.cast("int"), F.lit(100)) >= least


def array_mean(values: Column) -> Column:
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values))


def array_median(values: Column) -> Column:
    """The mean of the two middle values where there are two."""
    s, n = F.array_sort(values), F.size(values)
    at = lambda i: F.element_at(s, i.cast("int"))
    return F.when(n > 0, (at(F.floor((n + 1) / 2)) + at(F.floor(n / 2) + 1)) / 2)


def perplexity_at_most(values: Column, most: float, how: str = "mean") -> Column:
    """Null and empty arrays fail."""
    return F.coalesce((array_mean(values) if how == "mean" else array_median(values)) <= most, F.lit(False))


def is_obscene(text: Column, bad_words: Column) -> Column:
    """Three distinct bad words or more; everything but letters and spaces is deleted first, line breaks too, and case counts."""
    found = F.array_intersect(F.array_distinct(F.split(F.regexp_replace(text, r"[^\p{L} ]+", ""), " +")), bad_words)
    return F.size(found) >= 3


def is_long_thesis(text: Column) -> Column:
    from corpusloom.functions.text import word_count

    return (word_count(text) >= 1000) & (F.length(text) >= 10_000)


def legal_status(birth: Column, death: Column, rights: Column, language: Column, year: int = 2024) -> Column:
    """Whether a book is free: dead for 80 years (fr) or 70; without a death date, born 80 years before that; unknown is free; English goes by rights alone."""
    years = F.when(language == "fr", 80).otherwise(70)
    by_age = F.when(death.isNotNull(), death <= year - years).when(birth.isNotNull(), birth <= year - years - 80).otherwise(F.lit(True))
    free = F.coalesce(rights != "copyright", F.lit(True))
    return F.when(language == "en", free).otherwise(free & by_age)


#: Names that give away a model-written answer.
MODEL_NAMES = ["OpenAI", "Open AI", "ChatGPT", "Chat GPT", "GPT-3", "GPT3", "GPT 3", "GPT-4", "GPT4", "GPT 4", "GPT-3.5", "GPT3.5", "GPT 3.5", "BingChat", "Bing Chat", "LAION", "Open Assistant", "OpenAssistant", "BARD", "PaLM", "Gemini", "Gemma", "Google AI", "Anthropic", "Claude", "LLaMA", "Meta AI", "Mixtral", "Mistral"]


def names_a_model(text: Column, names: Sequence[str] = MODEL_NAMES) -> Column:
    """Any of the names, as whole words in any case; a dot stands for any character."""
    return F.lower(text).rlike("(?U)\\b(" + "|".join(n.lower() for n in names) + ")\\b")


def conversation_is_clean(messages: Column, names: Sequence[str] = MODEL_NAMES) -> Column:
    """No assistant message names a model."""
    return ~F.exists(messages, lambda m: (m["role"] == "assistant") & F.coalesce(names_a_model(m["content"], names), F.lit(False)))


def error_class(log: Column) -> Column:
    """Class of a fetch error; the first class that fits."""
    pool = F.nullif(F.regexp_extract(log, r"ConnectionPool.*Caused by [\w\.].*(\[Errno ?.*\] .+)'\)\)", 1), F.lit(""))
    return (
        F.when(pool.isNotNull(), pool)
        .when(log.rlike(r"ConnectionPool.*Read timed out"), F.lit("Read timed out"))
        .when(log.rlike(r"ConnectionPool.*connect timeout"), F.lit("connect timeout"))
        .when(F.regexp_extract(log, r"(4\d{2} Client Error)", 1) == "404 Client Error", F.lit("404 Client Error"))
        .when(log.rlike(r"4\d{2} Client Error"), F.lit("4xx Client Error"))
        .when(log.rlike(r"5\d{2} Server Error"), F.lit("5xx Server Error"))
        .otherwise(F.lit("Other error"))
    )
