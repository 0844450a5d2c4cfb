"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from corpusloom.functions import text as T

#: The published columns, in order; absent ones are written empty.
PUBLISHED = ["text", "source", "id", "language", "date", "author", "url", "title", "extra", "quality_signals"]


def published(df: DataFrame) -> DataFrame:
    """The published columns as strings, then any others, with "" for null."""
    out = [(F.col(c).cast("string") if c in df.columns else F.lit("")).alias(c) for c in PUBLISHED]
    more = [F.col(c).cast("string").alias(c) for c in df.columns if c not in PUBLISHED]
    return df.select(*out, *more).na.fill("")


def write_published(df: DataFrame, path: str, version: str) -> None:
    """Published Parquet below data/version, by category, language and source, as folders that readers can prune."""
    kind = F.when(F.col("language").startswith("code:"), "code").otherwise("natural")
    layout = published(df).withColumn("category", kind).withColumn("lang", F.col("language")).withColumn("src", F.col("source"))
    layout.write.mode("overwrite").partitionBy("category", "lang", "src").parquet(f"{path}/data/{version}")


def write_jsonl(df: DataFrame, path: str, key: str = "text") -> None:
    df.select(key).write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header, for report tables."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_counted(df: DataFrame, path: str, text: str = "text") -> dict[str, int]:
    """Write df as Parquet, and count its rows, words and characters in the same pass; they also go to ``path.json``, as one row.

    The figures are gathered by the tasks that write, each of which counts once, when it has succeeded.
    """
    seen = Observation()
    rows = df.observe(seen, F.count("*").alias("num pages"), F.coalesce(F.sum(T.word_count(F.col(text))), F.lit(0)).cast("long").alias("num words"), F.coalesce(F.sum(F.length(text)), F.lit(0)).cast("long").alias("num chars"))
    rows.write.parquet(path)
    counts = {k: int(v) for k, v in seen.get.items()}
    df.sparkSession.createDataFrame([tuple(counts.values())], ", ".join(f"`{c}` long" for c in counts)).coalesce(1).write.json(f"{path}.json")
    return counts


def write_split(kept: DataFrame, rejected: DataFrame, path: str) -> None:
    """Kept rows, and rejected ones by reason."""
    kept.write.mode("overwrite").parquet(f"{path}/kept")
    rejected.write.mode("overwrite").partitionBy("reason").parquet(f"{path}/rejected")


def weight_text(df: DataFrame, weight: str = "new_ratio", path: str = "prefix") -> DataFrame:
    """One row ``text``: "weight path " for each row by falling weight, nine decimals; an error if a weight rounds to zero."""
    shown = F.format_string("%11.9f", F.col(weight))
    checked = F.when(F.round(F.col(weight), 9) > 0, shown).otherwise(F.raise_error(F.concat(F.lit("weight is zero for "), F.col(path))))
    rows = F.array_sort(F.collect_list(F.struct((-F.col(weight)).alias("w"), F.col(path).alias("p"), F.concat(checked, F.lit(" "), F.col(path), F.lit(" ")).alias("t"))))
    return df.agg(F.array_join(F.transform(rows, lambda r: r["t"]), "").alias("text"))


def markdown_table(df: DataFrame) -> str:
    """A report table, already small, as Markdown."""
    rows = df.collect()
    cells = [df.columns, ["---"] * len(df.columns), *[["" if v is None else str(v) for v in r] for r in rows]]
    return "\n".join("| " + " | ".join(r) + " |" for r in cells)
