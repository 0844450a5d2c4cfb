"""Pipeline functions as table functions: the rows of a rank in, in order, any number of rows out."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@F.udtf(returnType="rank long, doc_id long, idx long, at long, line string")
class LongLines:
    """The lines of at least ``least`` characters of each row's text, with the row's place in its rank and their own; only two counters are held."""

    def __init__(self) -> None:
        self.idx = self.at = -1

    def eval(self, row, least: int) -> Iterator[tuple]:
        self.idx += 1
        for line in (row["text"] or "").split("\n"):
            if len(line) >= least:
                self.at += 1
                yield row["rank"], row["doc_id"], self.idx, self.at, line


def long_lines(df: DataFrame, least: int) -> DataFrame:
    """(rank, doc_id, idx, at, line) of df (rank, doc_id, text): each rank is one partition, whose rows come in order of doc_id.  Ranks should be many and of like size, as hashes of ids are."""
    return LongLines(df.asTable().partitionBy("rank").orderBy("doc_id"), F.lit(least))
