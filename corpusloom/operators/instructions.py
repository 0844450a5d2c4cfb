"""Translation instructions from aligned texts: a table of templates, drawn by weight, filled, varied, and made a chat.

Every choice is drawn from the key's SHA-256 and a name, so it is the same in
every run and SQL can say it too.  A template is one row of a table; its weight
is one over the square of its length, within its language and kind.  The
weights, summed up, are ranges of [0, 1), and a draw is a join on the range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.conversations import LANGUAGE_NAMES, message

#: Templates (language, text) with the tags <from> and <to>; which of them a template has is its kind.
TEMPLATES = [
    ("en", "Translate from <from> to <to>."), ("en", "Could you put this <from> text into <to>?"), ("en", "Give the <to> version of this <from> passage."), ("en", "Translate into <to>."), ("en", "How would you say this in <to>?"), ("en", "I need it in <to>, please."), ("en", "Translate this, please."), ("en", "What does this mean?"),
    ("fr", "Traduis du <from> vers le <to>."), ("fr", "Peux-tu passer ce texte de <from> en <to> ?"), ("fr", "Donne la version <to> de ce passage en <from>."), ("fr", "Traduis en <to>."), ("fr", "Comment dit-on cela en <to> ?"), ("fr", "Je voudrais passer au <to>."), ("fr", "Traduis, s'il te plaît."), ("fr", "Que veut dire ceci ?"),
    ("de", "Übersetze vom <from> ins <to>."), ("de", "Übersetze ins <to>."), ("de", "Bitte übersetzen."),
    ("es", "Traduce del <from> al <to>."), ("es", "Traduce al <to>."), ("es", "Traduce esto, por favor."),
    ("it", "Traduci da <from> a <to>."), ("it", "Traduci in <to>."), ("it", "Traduci, per favore."),
]
QUOTES = [("", ""), ("«", "»"), ('"', '"'), ("'", "'"), ("``", "''"), ("“", "”"), ("‘", "’")]
MOST_TEMPLATES = 100_000
ALIGNED = "text_1 string, text_2 string, lang_1 string, lang_2 string, key string"


def draw(name: str, key: Column) -> Column:
    """A number in [0, 1) for each key and name: the first 32 bits of a SHA-256."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{name}:"), key.cast("string")), 256), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def one_of(name: str, key: Column, options: list, weights: list[float] | None = None) -> Column:
    """One of some values, by weight."""
    weights = weights or [1.0] * len(options)
    total, upto, out = sum(weights), 0.0, None
    u = draw(name, key)
    for value, w in zip(options[:-1], weights, strict=False):
        upto += w
        out = F.when(u < upto / total, F.lit(value)) if out is None else out.when(u < upto / total, F.lit(value))
    return F.lit(options[-1]) if out is None else out.otherwise(F.lit(options[-1]))


def with_ranges(templates: DataFrame) -> DataFrame:
    """templates (language, text) with kind (both, to, none), p, and the range [lo, hi) that their weights sum up to in each language and kind, in order of the text."""
    kind = F.when(F.col("text").contains("<from>"), "both").when(F.col("text").contains("<to>"), "to").otherwise("none")
    rows = templates.select("language", "text", kind.alias("kind"), (1 / F.pow(F.length("text"), F.lit(2.0))).alias("w")).distinct()
    group = Window.partitionBy("language", "kind")  # of a table of templates
    upto = F.sum("w").over(group.orderBy("text").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.select("*", F.sum("w").over(group).alias("total"), upto.alias("upto"), F.row_number().over(group.orderBy(F.desc("text"))).alias("left"))
    hi = F.when(F.col("left") == 1, F.lit(1.0)).otherwise(F.col("upto") / F.col("total"))
    rows = rows.select("language", "kind", "text", (F.col("w") / F.col("total")).alias("p"), hi.alias("hi"))
    lo = F.coalesce(F.lag("hi").over(group.orderBy("text")), F.lit(0.0))
    return rows.select("language", "kind", "text", "p", lo.alias("lo"), "hi")


def drawn(df: DataFrame, ranges: DataFrame, language: str, kind: str, key: str) -> DataFrame:
    """df with ``template``, drawn for each key among those of its language and kind; rows without any are left out."""
    few = ranges.limit(MOST_TEMPLATES + 1).count() <= MOST_TEMPLATES
    r = ranges.select(F.col("language").alias("_l"), F.col("kind").alias("_k"), F.col("text").alias("template"), "lo", "hi")
    u = draw("template", F.col(key))
    hit = (F.col(language) == F.col("_l")) & (F.col(kind) == F.col("_k")) & (u >= F.col("lo")) & (u < F.col("hi"))
    return df.join(F.broadcast(r) if few else r, hit).drop("_l", "_k", "lo", "hi")


def _elided(text: Column, tag: str, name: Column) -> Column:
    """French before a vowel: d' for de, de l' for du, à l' for au, l' for le; and version takes the feminine."""
    vowel = name.rlike("(?i)^[aeiouy]")
    out = F.regexp_replace(text, F.lit(rf"\bversion {tag}"), F.concat(F.lit("version "), name, F.lit("e")))
    for word, by in ((rf"\b([Dd])e {tag}", "$1'"), (rf"\b([Dd])u {tag}", "$1e l'"), (rf"\bau {tag}", "à l'"), (rf"\b([Ll])e {tag}", "$1'")):
        out = F.regexp_replace(out, F.when(vowel, word).otherwise(r"(?!)"), F.concat(F.lit(by), name))
    return out


def _capital(x: Column) -> Column:
    return F.concat(F.upper(F.substring(x, 1, 1)), F.substr(x, F.lit(2)))


def translation_chats(df: DataFrame, templates: DataFrame) -> DataFrame:
    """(key, messages) of aligned texts (text_1, text_2, lang_1, lang_2, key), for languages that have names and templates.

    The instruction is in the source's language or the target's, before or after
    the text; in the latter case the text may be an earlier turn of the
    assistant, which makes three turns.
    """
    k = F.col("key")
    names = F.create_map(*[F.lit(x) for i, row in LANGUAGE_NAMES.items() for j, n in row.items() for x in (f"{i}{j}", n)])
    turn, same = draw("direction", k) < 0.5, draw("speaks", k) < 0.5
    pick = lambda a, b: F.when(turn, F.col(b)).otherwise(F.col(a))
    rows = df.select("key", pick("text_1", "text_2").alias("source"), pick("text_2", "text_1").alias("target"), pick("lang_1", "lang_2").alias("src"), pick("lang_2", "lang_1").alias("tgt"))
    rows = rows.select("*", F.when(same, F.col("src")).otherwise(F.col("tgt")).alias("speaks"), one_of("kind", k, ["both", "to", "none"], [0.4, 0.5, 0.1]).alias("kind"))
    rows = drawn(rows, with_ranges(templates), "speaks", "kind", "key")

    wrong = draw("capital", k) < 0.1  # German names and English ones have capitals
    proper = F.col("speaks").isin("en", "de")
    cased = lambda x: F.when(proper != wrong, _capital(x)).otherwise(F.lower(x))
    named = {tag: cased(F.element_at(names, F.concat("speaks", code))) for tag, code in (("<from>", "src"), ("<to>", "tgt"))}
    rows = rows.select("*", *[name.alias(tag[1:-1]) for tag, name in named.items()])
    for tag in named:  # a column at a time, so that none is computed twice
        name, french = F.col(f"`{tag[1:-1]}`"), F.col("speaks") == "fr"
        rows = rows.withColumn("elided", _elided(F.col("template"), tag, name))
        rows = rows.withColumn("template", F.replace(F.when(french, F.col("elided")).otherwise(F.col("template")), F.lit(tag), name))
    bare = F.regexp_replace("template", r"\s*[.?]$", "")
    space = F.when((F.col("speaks") == "fr") & (draw("gap", k) < 0.8), " ").otherwise("")
    end = F.when(F.col("template").endswith("?"), F.when(draw("mark", k) < 0.7, F.concat(space, F.lit("?"))).otherwise("")).otherwise(one_of("end", k, [".", ""], [0.4, 0.6]))
    case = one_of("case", k, ["lower", "upper", "as is"], [0.18, 0.02, 0.8])
    quotes = F.get(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in QUOTES]), F.floor(draw("quotes", k) * len(QUOTES)).cast("int"))
    rows = rows.select("key", "source", "target", F.concat(bare, end).alias("said"), case.alias("case"), (draw("text case", k) < 0.2).alias("text_too"), quotes.alias("q"))
    in_case = lambda x, c: F.when(c == "lower", F.lower(x)).when(c == "upper", F.upper(x)).otherwise(x)
    quoted = lambda x: F.concat(F.col("q.a"), F.when(F.col("text_too"), in_case(F.col(x), F.col("case"))).otherwise(F.col(x)), F.col("q.b"))
    rows = rows.select("key", in_case(F.col("said"), F.col("case")).alias("said"), quoted("source").alias("one"), quoted("target").alias("two"))

    last, history = draw("after", k) < 0.3, draw("history", k) < 0.5
    between = one_of("between", k, ["\n", "\n\n", "\t", ":"], [0.4, 0.3, 0.1, 0.2])
    one, two = F.col("one"), F.col("two")
    after = F.concat(one, F.when(between == ":", F.lit("\n--\n")).otherwise(between), "said")
    before = F.concat("said", F.when(between == ":", F.lit(": ")).otherwise(between), one)
    answer = message("assistant", two)
    chat = F.when(last & history, F.array(message("assistant", one), message("user", F.col("said")), answer)).otherwise(F.array(message("user", F.when(last, after).otherwise(before)), answer))
    return rows.select("key", chat.alias("messages"))
