"""Datasets as recipes: what a corpus needs between its files and clean text.

A recipe's steps run in a fixed order: prepare, filter, subsample, clean the
text, drop empty texts, budget.  The subsample hashes the text as it is before
cleaning, or another column.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import hashing, udfs, urls
from corpusloom.functions import text as T
from corpusloom.operators import chunks, conversations, filters, ordered, uniform
from corpusloom.sources.registry import Named, named

Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Recipe:
    """key: the text's column (``text`` where it is missing).  prepare: new or changed columns.  keep: a predicate.  clean: the text's cleaner.  sample_key: what is hashed; the text if None."""

    key: str = "text"
    prepare: Step | None = None
    keep: Callable[[], Column] | None = None
    clean: Callable[[Column], Column] | None = None
    sample_key: str | None = None
    extra: dict[str, str] = field(default_factory=dict)

    def with_options(self, **changes) -> Recipe:
        return replace(self, **changes)


def load(df: DataFrame, recipe: Recipe, *, rate: float = 1.0, invert: bool = False, order: str | None = None, max_docs: int | None = None, max_chars: int | None = None, max_words: int | None = None, metadata: bool = False, keep_empty: bool = False) -> DataFrame:
    """Clean texts of a dataset.  Budgets need an ``order`` column, and keep the row that crosses them; with metadata the other columns come in the published schema; with keep_empty empty and null texts stay."""
    if recipe.prepare:
        df = recipe.prepare(df)
    if recipe.keep:
        df = df.filter(recipe.keep())
    key = recipe.key if recipe.key in df.columns else "text"
    if rate < 1:
        r = hashing.random01(F.col(recipe.sample_key or key))
        df = df.filter(r > rate if invert else r <= rate)
    text = recipe.clean(F.col(key)) if recipe.clean else F.col(key)
    df = df.withColumn("text", text) if key == "text" else df.withColumn("text", text).drop(key)
    if not keep_empty:
        df = df.filter(F.length("text") > 0)
    if max_chars is not None:
        df = ordered.budget(df, order, F.coalesce(F.length("text"), F.lit(0)), max_chars)
    if max_words is not None:
        df = ordered.budget(df, order, F.coalesce(T.word_count(F.col("text")), F.lit(0)), max_words)
    if max_docs is not None:
        if not order:
            raise ValueError("max_docs needs an order, or else each run has other rows")
        df = df.orderBy(order).limit(max_docs)
    return uniform.uniformise(df, recipe.extra) if metadata else df


def _column(name: str, make: Callable[[], Column]) -> Step:
    return lambda df: df.withColumn(name, make())


def _press(df: DataFrame) -> DataFrame:
    names = {"ccnet_perplexity": "perplexity", "fasttext_language": "language", "ccnet_language_score": "score"}
    for old, new in names.items():
        df = df.withColumn(f"_{new}", F.col(old))
    return df.withColumn("complete_text", chunks.press_text("_perplexity", "_language", "_score", "complete_text")).drop(*[f"_{n}" for n in names.values()])


def _thesis(df: DataFrame) -> DataFrame:
    raw = chunks.thesis_text(F.col("complete_text"), F.col("chunk_start"), F.col("chunk_end"), F.col("ccnet_avg_log_prob"), F.col("fasttext_language"))
    df = df.withColumn("text", udfs.clean_thesis(raw)).drop("complete_text")
    return df.withColumn("word_count", T.word_count(F.col("text"))).withColumn("character_count", F.length("text"))


def _aligned(df: DataFrame) -> DataFrame:
    if "text_1" in df.columns:
        pair = conversations.parallel_text(F.trim("text_1"), F.trim("text_2"), F.col("lan_1"), F.col("lan_2"), F.col("id"))
    else:
        pair = conversations.parallel_text(F.col("text_en"), F.col("text_fr"), F.lit("en"), F.lit("fr"), F.col("id"))
    return df.withColumn("_p", pair).withColumn("text", F.col("_p.text")).withColumn("languages", F.array("_p.lang_1", "_p.lang_2")).drop("_p")


def _exchange(df: DataFrame) -> DataFrame:
    """A question, and its answers with an empty line between them."""
    return df.withColumn("text", F.concat("question.Body", F.array_join(F.transform("answers", lambda a: a["Body"]), "\n\n")))


def _subtitles(language: str) -> Step:
    return lambda df: df.withColumn("text", F.coalesce(F.array_join(F.col(f"{language}.subtitles"), "\n"), F.lit("")))


def _perplexity(most: float) -> Callable[[], Column]:
    p = lambda: F.col("ccnet_perplexity")
    return lambda: filters.perplexity_at_most(p(), most) | filters.perplexity_at_most(p(), most, "median")


def _ocr(least: int) -> Callable[[], Column]:
    return lambda: filters.ocr_at_least(F.col("ocr"), least)


def _new_url(language: str) -> Callable[[], Column]:
    return lambda: ~urls.covered_elsewhere(F.col("url"), F.lit(language))


#: Corpora by name; each only combines operators of the library.
RECIPES: dict[str, Recipe] = {
    "Wikipedia": Recipe(clean=udfs.clean_wiki, sample_key="id"),
    "Wiktionary": Recipe(prepare=_column("url", lambda: T.fix_wiki_url(F.col("url"), "fr.wiktionary.org")), clean=udfs.clean_wiki, sample_key="id"),
    "Wikisource": Recipe(prepare=_column("url", lambda: T.fix_wiki_url(F.col("url"), "fr.wikisource.org")), clean=udfs.clean_wiki, sample_key="id"),
    "Gutenberg": Recipe(keep=lambda: filters.legal_status(F.col("authoryearofbirth").cast("int"), F.col("authoryearofdeath").cast("int"), F.col("usagerights"), F.col("language")), clean=T.drop_licence_tail),
    "Europarl": Recipe(),
    "EuroparlAligned": Recipe(prepare=_aligned),
    "CroissantAligned": Recipe(prepare=_aligned),
    "Claire": Recipe(),
    "Stac": Recipe(),
    "Eurovoc": Recipe(keep=_perplexity(1500), clean=udfs.without_glyph_codes),
    "YouTube": Recipe(),
    "CulturaX.fr": Recipe(keep=_new_url("fr")),
    "CulturaX.en": Recipe(keep=_new_url("en")),
    "CulturaX.other": Recipe(keep=_new_url("other")),
    "FineWebEdu": Recipe(keep=_new_url("en")),
    "RedPajama": Recipe(key="raw_content"),
    "GallicaMonographies": Recipe(key="complete_text", prepare=_press, clean=udfs.unescape_html),
    "GallicaPress": Recipe(key="complete_text", prepare=_press, clean=udfs.unescape_html),
    "GallicaPressHighQuality": Recipe(key="complete_text", prepare=_press, keep=_ocr(90), clean=udfs.unescape_html),
    "HAL": Recipe(keep=_perplexity(930)),
    "Theses": Recipe(prepare=_thesis, keep=lambda: (F.col("word_count") >= 1000) & (F.col("character_count") >= 10_000)),
    "DiscoursPublics": Recipe(clean=T.clean_speech),
    "Persee": Recipe(key="complete_text", sample_key="file_id"),
    "OpenEdition": Recipe(),
    "LEGI": Recipe(clean=T.clean_legal),
    "OpenData": Recipe(clean=T.clean_legal),
    "Subscene": Recipe(prepare=_subtitles("fr")),
    "AmericanStories": Recipe(keep=_perplexity(2310)),
    "PeS2o.s2ag": Recipe(keep=lambda: F.col("source").startswith("s2ag")),
    "PeS2o.s2orc": Recipe(keep=lambda: F.col("source").startswith("s2orc")),
    "Pile.Ubuntu": Recipe(clean=T.clean_channel_log),
    "Pile": Recipe(),
    "OtherFr": Recipe(),
    "MathPile": Recipe(),
    "MathPile.StackExchange": Recipe(prepare=_exchange),
    "TheStack": Recipe(key="content"),
    "TheStack.tex": Recipe(key="content", keep=lambda: F.col("ext") == "tex"),
    "Arxiver": Recipe(key="markdown"),
    "StackMathQA": Recipe(prepare=_column("text", lambda: F.format_string("### Question\n%s\n### Answer\n%s", "Q", "A"))),
    "Aya": Recipe(prepare=_column("text", lambda: F.concat_ws(" ", "inputs", "targets"))),
}

#: Recipes of families under another name, or of several parts.
FAMILY_RECIPES = {"wikiother": ["Wiktionary", "Wikisource"], "gallica_mono": ["GallicaMonographies"], "validated_youtube": ["YouTube"], "open_data_fr": ["OpenData"], "other_fr": ["LEGI", "OtherFr"], "code": ["TheStack"], "pile": ["Pile", "Pile.Ubuntu"], "math_pile": ["MathPile", "MathPile.StackExchange"]}


def recipes_of(dataset: Named) -> list[str]:
    """The recipes of a dataset: its family's, or that of its language, or its parts'; a KeyError if there is none."""
    if dataset.family in FAMILY_RECIPES:
        return FAMILY_RECIPES[dataset.family]
    family = dataset.family.replace("_", "")
    keys = {k.lower(): k for k in RECIPES}
    if family in keys:
        return [keys[family]]
    for child in (dataset.language, "other"):
        if f"{family}.{child}" in keys:
            return [keys[f"{family}.{child}"]]
    parts = [k for low, k in keys.items() if low.startswith(family + ".")]
    if not parts:
        raise KeyError(f"no recipe for {dataset.family}")
    return parts


def load_named(name: str, locate: Callable[[Named, str], DataFrame], non_commercial: bool = True, **options) -> DataFrame:
    """(dataset, language, year, text) of all datasets of a name, by ``locate(dataset, recipe name)``, which gives the raw rows; ``options`` as of load()."""
    out: DataFrame | None = None
    for dataset in named(name, non_commercial):
        for recipe in recipes_of(dataset):
            rows = load(locate(dataset, recipe), RECIPES[recipe], **options)
            one = rows.select(F.lit(recipe).alias("dataset"), F.lit(dataset.language).cast("string").alias("language"), F.lit(dataset.year).cast("string").alias("year"), "text")
            out = one if out is None else out.unionByName(one)
    return out


Chat = Callable[[DataFrame], DataFrame]


def _instructions(instruction: str, answer: str, more: str | None = None, keep: Callable[[], Column] | None = None) -> Chat:
    def run(df: DataFrame) -> DataFrame:
        df = df.filter(keep()) if keep else df
        df = df.filter(~F.coalesce(filters.names_a_model(F.col(answer)), F.lit(False)))
        return df.withColumn("messages", conversations.as_chat(F.col(instruction), F.col(answer), F.col(more) if more else None))

    return run


def _messages(column: str = "messages", keep: Callable[[], Column] | None = None, foreign: bool = False) -> Chat:
    def run(df: DataFrame) -> DataFrame:
        df = df.filter(keep()) if keep else df
        m = conversations.from_foreign(F.col(column)) if foreign else F.col(column)
        df = df.withColumn("messages", m)
        return df.filter(filters.conversation_is_clean(F.col("messages")))

    return run


#: Chat corpora: each gives a table with ``messages``, to be rendered by conversations.rendered.
CHATS: dict[str, Chat] = {
    "Alpaca": _instructions("instruction", "output", "input"),
    "LongAlpaca": _instructions("instruction", "output"),
    "Dolly": _instructions("instruction", "response", "context"),
    "AyaDataset": _instructions("inputs", "targets", keep=lambda: F.col("language").isin("English", "French", "German", "Italian", "Spanish")),
    "Flan": _messages(),
    "Ens": _messages(),
    "Oasst": _messages(),
    "Piaf": _messages(),
    "WildChat": _messages("conversation", keep=lambda: F.col("language").isin("English", "French", "German", "Italian", "Spanish")),
    "Tulu": _messages(),
    "PersonasMath": _messages(),
    "OpenHermes": _messages("conversations", foreign=True),
    "Magpie": _messages("conversations", foreign=True),
}


def render_chat(df: DataFrame, name: str) -> DataFrame:
    return CHATS[name](df).withColumn("text", conversations.rendered(F.col("messages")))


def _labels(n: int) -> Column:
    return F.array(*[F.lit(c) for c in "ABCDE"[:n]])


#: Benchmarks: raw columns to (question, choices, labels, answer).
BENCHMARKS: dict[str, Callable[[], tuple[Column, Column, Column, Column]]] = {
    "ARC": lambda: (F.col("question"), F.col("choices.text"), F.col("choices.label"), F.col("answerKey")),
    "ARC-fr": lambda: (F.col("question"), F.col("choices"), F.slice(_labels(5), F.lit(1), F.size("choices")), F.col("answerKey")),
    "Hellaswag": lambda: (F.col("ctx"), F.col("endings"), F.transform(F.sequence(F.lit(0), F.size("endings") - 1), lambda i: i.cast("string")), F.col("label")),
    "MMLU": lambda: (F.col("question"), F.col("choices"), _labels(4), F.col("answer").cast("string")),
    "MMMLU": lambda: (F.col("instruction"), F.array("option_a", "option_b", "option_c", "option_d"), _labels(4), F.upper("answer")),
    "OpenbookQA": lambda: (F.concat_ws(" ", "fact1", "question_stem"), F.col("choices.text"), F.col("choices.label"), F.col("answerKey")),
}


def benchmark(df: DataFrame, name: str, key: str, show_choices: bool | None = None) -> DataFrame:
    """(key, prompt, positive, negative) of a benchmark's labelled items."""
    question, choices, labels, answer = BENCHMARKS[name]()
    shown = False if name == "MMMLU" else show_choices
    item = conversations.benchmark_item(question, choices, labels, answer, F.col(key), shown)
    return conversations.labelled(df.select(key, item.alias("_i")).select(key, "_i.*"))


def tokenizer_mix(parts: dict[str, tuple[DataFrame, Recipe, dict]], train: bool = True, rate: float = 0.5) -> DataFrame:
    """Texts to train a tokenizer on, or the other half to test it on: each dataset under its budgets, in order."""
    out: DataFrame | None = None
    for at, (name, (df, recipe, budgets)) in enumerate(parts.items()):
        one = load(df, recipe, rate=rate, invert=not train, **budgets).select(F.lit(at).alias("part"), F.lit(name).alias("dataset"), "text")
        out = one if out is None else out.unionByName(one)
    return out
