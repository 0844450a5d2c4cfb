"""Metadata of many sources in one schema.

Which columns a source has is known when the plan is made, so renaming and
grouping are decided then, and rows only see casts and to_json.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Old name and new, applied in order where the new name is free (doc_id always wins as id).
RENAMES = [("file_id", "id"), ("article_id", "id"), ("doc_id", "id"), ("hexsha", "id"), ("idx", "id"), ("idx_row", "id"), ("ID", "id"), ("page_title", "title"), ("headline", "title"), ("releasedate", "date"), ("created", "date"), ("added", "date"), ("date_download", "date"), ("Date", "date"), ("lang", "language"), ("file_path", "path"), ("page_path", "path"), ("source", "subset")]

#: Fields by the group that takes them in; names first, then patterns matched from a name's start.
GROUP_NAMES = {
    "id": ["hexsha", "index"],
    "author": ["author", "authoryearofbirth", "authoryearofdeath"],
    "quality_signals": ["ocr", "contain_at_least_two_stop_words", "char_num_after_normalized"],
    "extra": ["version", "edition", "dump", "subset", "sujet", "sort", "expose", "loi", "texteloi_id", "intervenants", "intervenant", "signataires", "type", "mimetype", "ext", "partition", "source_domain", "headline", "size", "added", "dataset", "digest", "byline", "theme", "depute", "ministre", "reponse", "question", "answers", "field", "subfield", "model", "rag", "synthetic_textbooks", "topic", "text_fr", "text_en", "text_1", "text_2", "lan_1", "lan_2"],
}
GROUP_PATTERNS = [
    ("id", [".*id", "idx.*"]),
    ("quality_signals", ["ccnet_.*", "rps_.*", "fasttext_.*", "chunk.*", ".*count", ".*score", ".*ratio", ".*fraction", ".*length"]),
    ("extra", ["page.*", ".*name", ".*path", ".+date", ".*time", ".*rights"]),
]
DROPPED = ["complete_text", "is_duplicate", "__index_level_0__"]
DROPPED_PREFIXES = ("max_issues_repo_", "max_forks_repo_", "max_stars_repo_")
TYPES = {"id": "string", "date": "string", "page": "string", "author": "string", "authoryearofbirth": "int", "authoryearofdeath": "int"}


def group_of(name: str) -> str | None:
    for group, names in GROUP_NAMES.items():
        if name in names:
            return group
    return next((g for g, ps in GROUP_PATTERNS for p in ps if re.match(p, name)), None)


def renamed(df: DataFrame) -> DataFrame:
    for old, new in RENAMES:
        if old in df.columns and (new not in df.columns or (old, new) == ("doc_id", "id")):
            df = df.drop(new).withColumnRenamed(old, new) if new in df.columns else df.withColumnRenamed(old, new)
    return df


def typed(df: DataFrame) -> DataFrame:
    """Enforce the known types; the text None is null."""
    for name, kind in TYPES.items():
        if name in df.columns:
            c = F.col(name)
            nested = df.schema[name].dataType.typeName() in ("struct", "map", "array")
            c = F.to_json(c) if nested else c
            df = df.withColumn(name, F.nullif(c.cast("string"), F.lit("None")).cast(kind))
    return df


def uniformise(df: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    """Rename, type, group and clean the columns of a source; ``extra`` has constants of the dataset, which a column of that name overrides (a source moves below ``extra``)."""
    code = {"hexsha", "ext"} <= set(df.columns)
    df = typed(renamed(df))
    if "url" not in df.columns and "id" in df.columns:
        df = df.withColumn("url", F.when(F.col("id").startswith("http://"), F.col("id")))
    for name, value in (extra or {}).items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(value))
    groups: dict[str, list[str]] = {}
    for c in df.columns:
        if g := group_of(c):
            groups.setdefault(g, []).append(c)
    taken = {c for cs in groups.values() for c in cs}
    plain = [c for c in df.columns if c not in taken and c not in DROPPED and not c.startswith(DROPPED_PREFIXES)]
    out = [F.col(c) for c in plain]
    for g, cs in groups.items():
        cs = [c for c in cs if c not in DROPPED and not c.startswith(DROPPED_PREFIXES)]
        if cs:
            out.append(F.col(g).cast("string").alias(g) if cs == [g] else F.to_json(F.struct(*cs)).alias(g))
    df = df.select(*out)
    if "languages" in df.columns:
        df = df.withColumn("language", F.array_join("languages", ",")).drop("languages")
    if "language" in df.columns:
        df = df.withColumn("language", F.concat(F.lit("code:"), "language") if code else two_letters(F.col("language")))
    nested = [f.name for f in df.schema if f.dataType.typeName() in ("struct", "map")]
    return reduce(lambda d, c: d.withColumn(c, F.to_json(c)), nested, df)


def two_letters(language: Column) -> Column:
    """Three-letter codes as two letters."""
    return F.when(F.length(language) == 3, F.when(language == "spa", "es").otherwise(F.substring(language, 1, 2))).otherwise(language)


def category(name: Column) -> Column:
    return F.when(F.lower(name).contains("stack"), "code").otherwise("natural")


def url_of(meta: Column) -> Column:
    return F.get_json_object(meta, "$.url")


def flattened(df: DataFrame, column: str, schema: str) -> DataFrame:
    """A JSON column's fields as columns; single quotes are read as well, nothing is evaluated."""
    return df.withColumn("_m", F.from_json(column, schema, {"allowSingleQuotes": "true"})).select(*[c for c in df.columns if c != column], "_m.*")


def parsed_name(file: Column) -> dict[str, Column]:
    """(lang, dataset, subset) of a statistics file's name."""
    name = F.regexp_replace(F.regexp_replace(file, "^stats_|\\.json$", ""), "_text_document", "")
    parts = F.split(name, "--")
    head, second = F.get(parts, F.lit(0)), F.coalesce(F.get(parts, F.lit(1)), F.lit(""))
    own = second.rlike("^(fr|en|de|es|it)(-(fr|en|de|es|it))?$")
    lang = F.when(own, second).when(F.lower(head).contains("stack"), "code").when(F.lower(head).rlike("americanstories|pes2o|pile|fineweb"), "en").otherwise("fr")
    rest = F.when(own, F.coalesce(F.array_join(F.slice(parts, F.lit(3), F.size(parts)), "-"), F.lit(""))).otherwise(F.array_join(F.slice(parts, F.lit(2), F.size(parts)), "-"))
    return {"lang": lang, "dataset": F.when(own, F.concat(head, F.lit("."), second)).otherwise(head), "subset": rest}


def schema_union(tables: list[DataFrame]) -> DataFrame:
    """(name, types): the types of each column over several tables, sorted."""
    kinds: dict[str, set[str]] = {}
    for t in tables:
        for f in t.schema:
            kinds.setdefault(f.name, set()).add(f.dataType.simpleString())
    return tables[0].sparkSession.createDataFrame([(k, ",".join(sorted(v))) for k, v in sorted(kinds.items())], "name string, types string")
