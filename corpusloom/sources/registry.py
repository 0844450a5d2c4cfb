"""Dataset names, their expansion, and file listings."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LANGUAGES = ["en", "fr", "es", "de", "it"]

#: Dataset families in several languages, and those named with a year.
FAMILY_LANGUAGES = {
    "wikipedia": ["fr", "en", "de", "es", "it"],
    "wikiother": ["fr"],
    "gutenberg": ["fr", "en", "de", "es", "it"],
    "europarl": ["fr", "en", "de", "es"],
    "claire": ["fr", "en"],
    "eurovoc": ["en", "de", "es", "it"],
    "validated_youtube": ["fr"],
    "red_pajama": ["fr", "de", "es", "it"],
    "cultura_x": ["fr", "en", "de", "es", "it"],
    "subscene": ["fr", "en", "de", "es", "it"],
    "youtube": ["fr", "en", "de", "es", "it"],
    "aya": ["fr", "en", "de", "es", "it"],
    "aya_chat": ["fr", "de", "es", "it"],
    "alpaca": ["en", "fr"],
    "dolly": ["en", "fr", "de", "es"],
    "aya_dataset_chat": ["fr", "en", "de", "es", "it"],
    "oasst1": ["fr", "en", "de", "es", "it"],
    "filtered_oasst": ["fr", "en", "de", "es", "it"],
    "hard_coded": ["en", "fr"],
}
YEARLY = ["fine_web_edu"]
#: What ``all`` stands for, in order, and the part of it that is not for commercial use.
TRAINING = ["wikipedia", "wikiother", "gutenberg", "europarl", "claire", "eurovoc", "validated_youtube", "red_pajama", "croissant_aligned", "europarl_aligned", "american_stories", "pes2o", "fine_web_edu", "pile", "stac", "gallica_press", "gallica_mono", "theses", "hal", "open_edition", "discours_publics", "other_fr", "open_data_fr", "persee", "math_pile", "code"]
NON_COMMERCIAL = ["persee"]


class Named(NamedTuple):
    """One dataset that a name stands for; ``part`` is ``train`` or ``test`` of the tokenizer's mix."""

    family: str
    language: str | None = None
    year: str | None = None
    part: str | None = None


def named(name: str, non_commercial: bool = True) -> list[Named]:
    """The datasets of a name in any case: ``all``, ``tok`` (both halves), ``tok_train``, ``tok_test``, a family, ``family_<language>``, ``family_<year>``."""
    name = name.lower()
    if name == "all":
        return [d for family in TRAINING if non_commercial or family not in NON_COMMERCIAL for d in named(family)]
    if name.startswith("tok"):
        return [Named("tokenizer", part=p) for p, other in (("train", "test"), ("test", "train")) if other not in name]
    if name in FAMILY_LANGUAGES:
        return [Named(name, language) for language in FAMILY_LANGUAGES[name]]
    family, _, last = name.rpartition("_")
    if family in YEARLY:
        return [Named(family, year=last)]
    if family in FAMILY_LANGUAGES and last != "aligned":
        return [Named(family, last)]
    return [Named(name)]


Loader = Callable[[SparkSession], DataFrame]


class Registry:
    """Named datasets; a group name stands for several."""

    def __init__(self):
        self.loaders: dict[str, Loader] = {}
        self.groups: dict[str, list[str]] = {}

    def add(self, name: str, loader: Loader) -> None:
        self.loaders[name] = loader

    def group(self, name: str, members: Iterable[str]) -> None:
        self.groups[name] = list(members)

    def expand(self, name: str) -> list[str]:
        """Dataset names that a name stands for: itself, a group's, ``all``, or every ``name.<language>``."""
        if name == "all":
            return sorted(self.loaders)
        if name in self.loaders:
            return [name]
        if name in self.groups:
            return [m for g in self.groups[name] for m in self.expand(g)]
        children = [n for n in sorted(self.loaders) if n.startswith(name + ".")]
        if not children:
            raise KeyError(f"no dataset {name}")
        return children

    def load(self, spark: SparkSession, name: str) -> DataFrame:
        """The union of the datasets of a name, in order, with their name and place as columns; missing columns are null."""
        out: DataFrame | None = None
        for i, n in enumerate(self.expand(name)):
            one = self.loaders[n](spark).withColumn("dataset", F.lit(n)).withColumn("dataset_at", F.lit(i))
            out = one if out is None else out.unionByName(one, allowMissingColumns=True)
        return out


def config_name(name: str) -> str:
    """``claire-fr`` as ``fr/Claire``, ``croissant-aligned`` as ``CroissantAligned``; a name in that form stays."""
    if name.lower() == "default":
        return "default"
    if name[0].isupper() and not re.search("[/_-]", name) or name[:3] in [f"{k}/" for k in LANGUAGES]:
        return name
    *head, last = name.replace("_", "-").split("-")
    if head and last in LANGUAGES:
        return f"{last}/{config_name('-'.join(head))}"
    return "".join(f.capitalize() for f in [*head, last])


def config_name_column(name: Column) -> Column:
    """config_name for names in lower case with dashes."""
    parts = F.split(F.replace(name, F.lit("_"), F.lit("-")), "-")
    last = F.element_at(parts, -1)
    camel = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, F.lit(2), F.length(x))))), "")
    tail = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.when((F.size(parts) > 1) & last.isin(LANGUAGES), F.concat(last, F.lit("/"), camel(tail))).otherwise(camel(parts))


def file_order(paths: Iterable[str]) -> list[str]:
    """Shard files by their number (``7.parquet``, ``x-00007-of-00010``) where all have one, else by name."""
    paths = list(paths)
    found = [re.search(r"(\d+)(?:-of-\d+)?\.[a-z.]+$", p) for p in paths]
    return [p for _, p in sorted(zip([int(m[1]) for m in found], paths, strict=True))] if all(found) else sorted(paths)


def pick_files(paths: Iterable[str], offset: int = 0, limit: int | None = None, pattern: str | None = None) -> list[str]:
    """A window of the ordered files whose name matches a pattern, in any case."""
    chosen = [p for p in file_order(paths) if pattern is None or re.search(pattern, p.rsplit("/", 1)[-1], re.I)]
    return chosen[offset : None if limit is None else offset + limit]


def shard_files(spark: SparkSession, snapshots: list[str], shards: int, languages: list[str], parts: list[str]) -> DataFrame:
    """(snapshot, shard, lang, part) of every file of a sharded crawl."""
    arrays = [F.explode(F.array(*map(F.lit, xs))).alias(n) for xs, n in ((snapshots, "snapshot"), (languages, "lang"), (parts, "part"))]
    out = spark.range(shards).select(F.col("id").alias("shard"))
    for a in arrays:
        out = out.select("*", a)
    return out.select("snapshot", "shard", "lang", "part")


def without_missing(listing: DataFrame, missing: DataFrame) -> DataFrame:
    return listing.join(missing.select(*listing.columns), listing.columns, "left_anti")
