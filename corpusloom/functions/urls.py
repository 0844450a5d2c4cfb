"""URL expressions and the predicates on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Parts of URLs whose texts other corpora hold, by language.
COVERED = {
    "fr": ["fr.wikipedia", "wiktionary", "wikisource", "theses.fr"],
    "en": ["en.wikipedia", "arxiv.org", "www.ncbi.nlm.nih.gov/pmc", "philpapers.org", "exporter.nih.gov", "irclogs.ubuntu.com", "courtlistener.com", "uspto.gov"],
    "other": ["wikipedia", "europarl", "op.europa.eu"],
}


def host(url: Column, add_scheme: bool = False) -> Column:
    """Lower-case network location (with port and user).  Extra slashes after :// don't count; with add_scheme a URL without :// is taken as http."""
    if add_scheme:
        url = F.when(url.contains("://") | (F.trim(url) == ""), url).otherwise(F.concat(F.lit("http://"), url))
    url = F.regexp_replace(url, "://+", "://")
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))


def covered_elsewhere(url: Column, language: Column) -> Column:
    def any_of(parts: list[str]) -> Column:
        out = F.lit(False)
        for p in parts:
            out = out | url.contains(p)
        return out

    return F.when(language == "fr", any_of(COVERED["fr"])).when(language == "en", any_of(COVERED["en"])).otherwise(any_of(COVERED["other"]))
