"""Arrow functions for transforms that are sequential or need a Python library, and NFC, which the JVM has."""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from urllib import robotparser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def _each(f: Callable, returns: str, *cols: Column) -> Column:
    """Apply f to each row's values, in Arrow batches; a null first value gives null."""
    if len(cols) == 1:

        @F.arrow_udf(returns)
        def apply_one(a: pa.Array) -> pa.Array:
            return pa.array([None if x is None else f(x) for x in a.to_pylist()])

        return apply_one(*cols)

    @F.arrow_udf(returns)
    def apply_two(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([None if x is None else f(x, y) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)])

    return apply_two(*cols)


def unescape_html(text: Column) -> Column:
    return _each(html.unescape, "string", text)


def normalise_unicode(text: Column) -> Column:
    """NFC, without carriage returns and NULs.

    Composed in the JVM by ICU, which comes with Spark, so no text goes to a
    Python worker.  Spark takes a method's result as not deterministic and
    computes what is made of it once, however often that is used.
    """
    composed = F.when(text.isNotNull(), F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(False)))
    return F.replace(F.replace(composed, F.lit("\r"), F.lit("")), F.lit("\0"), F.lit(""))


def may_fetch(robots: str, url: str, agent: str = "CCBot") -> bool:
    parser = robotparser.RobotFileParser()
    parser.parse(robots.splitlines())
    return parser.can_fetch(agent, url)


def can_fetch(robots: Column, url: Column) -> Column:
    """Whether the crawler may fetch a URL by a robots text already at hand."""

    @F.arrow_udf("boolean")
    def allowed(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([None if u is None else may_fetch(r or "", u) for r, u in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.bool_())

    return allowed(robots, url)


# --- page numbers -----------------------------------------------------------

_N = r"\d{1,5}(?:/\d{2,5})?"
#: The nine shapes of a page number, in order of preference.
PAGE_SHAPES = [
    rf"_\s*{_N}\s*_", rf"-\s*{_N}\s*-", rf"—\s*{_N}\s*—",
    rf"\(\s*{_N}\s*\)", rf"\[\s*{_N}\s*\]", rf"\{{\s*{_N}\s*\}}",
    rf"(?:\b{_N}\s*->?(?:$| ))|(?:<?(?:^| )-\s*\d{{1,5}}\b)", rf"(?:\b{_N}\s*,>?(?:$| ))|(?:<?(?:^| ),\s*\d{{1,5}}\b)", rf"(?:\b{_N}\s*\.>?(?:$| ))|(?:<?(?:^| )\.\s*\d{{1,5}}\b)",
]
HOLE, BEAM, PAGE_CHARS, LOOK_PAGES = 7, 5, 80_000, 100
_NUMBER = re.compile(r"(?<!\w)([\dlIij]{1,5})(?:/\d{2,5})?(?!\w)")
_LETTERS = str.maketrans("lIij", "1111")


def _page_of(read: str) -> int | None:
    """The number that was read, with letters that OCR takes for a 1; a number of ones only must be in digits."""
    digits = read.translate(_LETTERS)
    if read != digits and (not re.search(r"\d", read) or set(digits) == {"1"}):
        return None
    return int(digits) if digits[0] != "0" else None


def _numbered_lines(text: str) -> dict[int, list[tuple[int, int]]]:
    """For each number the spans, breaks included, of whole lines that it opens or closes, but for marks, in order."""
    found: dict[int, list[tuple[int, int]]] = {}
    first = text.find("\n")
    while first >= 0 and (last := text.find("\n", first + 1)) >= 0:
        line = text[first + 1 : last]
        numbers = list(_NUMBER.finditer(line)) if any(c.isdigit() for c in line) else []
        outer = {m.start(): m for m in numbers if not re.search(r"\w", line[: m.start()]) or not re.search(r"\w", line[m.end() :])}
        for page in sorted({p for m in outer.values() if (p := _page_of(m[1])) is not None}):
            found.setdefault(page, []).append((first, last + 1))
        first = last
    return found


def _run_of_pages(lines: dict[int, list[tuple[int, int]]], near: bool) -> list[tuple[int, list[tuple[int, int]]]]:
    """(page, its lines) from page 2 on, each after the page before; ends where HOLE pages in a row are missing."""
    out: list[tuple[int, list[tuple[int, int]]]] = []
    known, after = 0, 0
    top = min(max(lines, default=0), LOOK_PAGES) if near else max(lines, default=0)
    page = 2
    while page <= top and page - max(known, 1) <= HOLE:
        reach = after + PAGE_CHARS * (page - known) if near else float("inf")
        here = [s for s in lines.get(page, []) if after < s[0] < reach or not out and s[0] >= after][:BEAM]
        if here:
            out.append((page, here))
            known, after = page, here[0][0]
        page += 1
    return out


def drop_page_numbers(text: str) -> str:
    """Remove page numbers of the shape most candidates have; a text without candidates stays as it is."""
    lines = _numbered_lines(text)
    seen = [text[a:b] for _, spans in _run_of_pages(lines, True) for a, b in spans]
    votes = Counter(k for k, shape in enumerate(PAGE_SHAPES) for c in seen if re.search(shape, c))
    if not votes:
        return text
    shape = re.compile(PAGE_SHAPES[min(votes, key=lambda k: (-votes[k], k))].replace(r"\d{1,5}", r"[\dlIij]{1,5}"))
    shaped = {}
    for page, spans in lines.items():
        marks = [(a + m.start(), a + m.end()) for a, b in spans for m in shape.finditer(text[a:b]) if page in {_page_of(n[1]) for n in _NUMBER.finditer(m[0])}]
        if marks:
            shaped[page] = marks
    kept, at = [], 0
    for a, b in sorted(s for _, spans in _run_of_pages(shaped, False) for s in spans):
        if a >= at:
            kept.append(text[at:a].strip() if kept else text[at:a].rstrip())
            at = b
    kept.append(text[at:].lstrip() if kept else text)
    return "\n".join(kept)


def without_page_numbers(text: Column) -> Column:
    return _each(drop_page_numbers, "string", text)


def clean_pdf(text: Column, unescape: bool = False) -> Column:
    """Page numbers out, cut lines joined, no space before a line break, nothing at the ends."""
    from corpusloom.functions import text as T

    text = T.join_lines(without_page_numbers(text))
    text = unescape_html(text) if unescape else text
    return T.strip(F.replace(text, F.lit(" \n"), F.lit("\n")))


# --- lines and pages --------------------------------------------------------

_CONTROL = re.compile("[\x00-\x08\x0b\x0e-\x1f\x7f\ufffd]")


def drop_common_lines(text: str, times: int = 10, length: int = 10) -> str:
    """Drop every line (with its line or page break) of ``length`` characters or more that comes ``times`` times or more."""
    lines = re.split("(?<=[\n\x0c])", text)
    count = Counter(lines)
    return "".join(x for x in lines if len(x) < length or count[x] < times)


def drop_bad_pages(text: str, max_lines: int = 200, max_control: float = 0.2) -> str:
    """Drop pages (ended by form feeds) of too many lines or control characters."""
    pages = [p for p in re.split("(?<=\x0c)", text) if p]
    return "".join(p for p in pages if p.count("\n") < max_lines and len(_CONTROL.findall(p)) <= max_control * len(p))


def without_common_lines(text: Column) -> Column:
    return _each(drop_common_lines, "string", text)


def without_bad_pages(text: Column) -> Column:
    return _each(drop_bad_pages, "string", text)


def clean_thesis(text: Column) -> Column:
    """A deposit's cover page out, then common lines, then bad pages, then space at the ends."""
    from corpusloom.functions.text import drop_cover_page, strip

    return strip(_each(lambda t: drop_bad_pages(drop_common_lines(t)), "string", drop_cover_page(text)))


# --- glyph codes ------------------------------------------------------------

#: Glyph codes that stand for two letters, and for one character (None: a space).
GLYPH_PAIRS = {5: "ti", 133: "fi", 309: "tz", 415: "ti", 427: "tt"}
GLYPHS = {
    21: "ā", 23: "z", 25: "ţ", 106: None, 107: None, 108: "m", 109: None, 113: None, 116: "q", 121: None, 127: "è", 128: None, 129: "ü", 130: "é", 131: "â", 132: "ä", 133: None, 134: "å", 135: "ç", 136: "ê", 137: "e", 138: "è", 139: "ï",
    140: "î", 141: "-", 142: "Ä", 143: "Å", 144: "é", 145: "á", 146: "í", 147: "ô", 148: "ö", 149: None, 150: "-", 151: "-", 152: "~", 153: "Ö", 154: "Ü", 155: "ó", 156: "ú", 157: "ñ", 158: "Ñ", 159: None, 160: None, 173: None, 190: "ü",
    217: " ", 296: "ź", 298: "t", 321: "o", 367: "l", 371: "ł", 373: "m", 374: "n", 375: "n", 378: "o", 381: "o", 383: "o", 393: "p", 395: "q", 396: "r", 400: "s", 404: "s", 407: "a", 410: "t", 417: "i", 425: "t", 431: "i", 437: "u", 448: "v",
}
#: Where letters begin among plain codes; the code that stands for a letter of either case.
FIRST_LETTER, SMALL_OR_CAPITAL = 176, 144
_OWN = frozenset(g for g in GLYPHS.values() if g)
_CODE = re.compile(r"\(cid:(\d+)\)")


def _fits(char: str, before: str, after: str) -> bool:
    """Whether a letter may stand between two characters, each empty at the edge of a word.

    A word doesn't begin with a small letter and go on with a capital or a
    digit, nor with a capital before a small letter or a digit, as the coded
    texts have none such; and no letter differs in case from both of its neighbours
    where these agree.
    """
    if not (char.isupper() or char.islower()):
        return True
    if not before:
        return not (after.isdigit() or (after.isupper() if char.islower() else after.islower()))
    if char.islower():
        return not (before.isupper() and after.isupper())
    return not (before.islower() and after.islower())


def _glyph(code: int, before: str, after: str) -> str:
    """What a glyph code stands for between two characters, each empty at the edge of a word."""
    if code in GLYPH_PAIRS:
        return GLYPH_PAIRS[code] if before.islower() and after.islower() else " "
    char = GLYPHS.get(code) if code in GLYPHS else chr(code) if 100 < code <= 300 else None
    if char is None:
        return " "
    alone = not (before and after)
    if alone and ord(char) < FIRST_LETTER and char not in _OWN:
        return ""
    if _fits(char, before, after):
        return char
    return char.upper() if code == SMALL_OR_CAPITAL and before else " "


def fix_glyph_codes(text: str) -> str:
    pieces = _CODE.split(text.replace(" (cid:1)", ""))
    out = pieces[0]
    for code, after in zip(map(int, pieces[1::2]), pieces[2::2], strict=True):
        word = [c if re.match(r"\w", c) else "" for c in (out[-1:], after[:1])]
        if code == 152 and out[-1:] and out[-1:] in "anoANO":  # a tilde over the letter before it
            out = out[:-1] + unicodedata.normalize("NFC", out[-1] + "\u0303") + after
        else:
            out += _glyph(code, *word) + after
    return re.sub(" +", " ", out)


def without_glyph_codes(text: Column) -> Column:
    return _each(fix_glyph_codes, "string", text)


# --- markdown ---------------------------------------------------------------


def _bullet(line: str) -> str:
    """A line of a list with its depth, the number of stars, as indent."""
    rest = line.lstrip("*")
    depth = len(line) - len(rest)
    if depth and rest.startswith(" "):
        return "   " * (depth - 1) + "*" + rest
    return "   " * depth + rest if depth and re.match(">+ ", rest) else line


def _sections(lines: Iterator[str]) -> Iterator[tuple[str, str]]:
    """(kind, line) of the lines; a header that opens the section that is open already is left out."""
    path: list[str] = []
    for line in lines:
        if re.match(r"[*> ]+ ", line + "\n"):
            yield "list", line
        elif len(line) > 1 and line[0] == line[-1] == "|":
            yield "table", line
        elif not (head := re.match(r"(#+) (.*)", line)):
            yield "text", line
        elif (level := len(head[1])) > 3:
            yield "header", f"**{head[2].strip()}**"
        else:
            title = f"{head[1]} {head[2].strip()}"
            if path[level - 1 : level] != [title]:
                path = [*path, *[""] * level][: level - 1] + [title]
                yield "header", title


def to_markdown(text: str, breaks: int = 2) -> str:
    """Wiki plain text as Markdown: nested lists, table heads, headers once each, levels past three in bold; breaks (0 to 2) is how much space stands between blocks."""
    out: list[str] = []
    last, bullet = "header", False
    for kind, line in _sections(filter(None, text.split("\n"))):
        closes = last in ("list", "table") and kind != last
        inner = kind == "list" and bullet and line.startswith("  ") and breaks > 1  # an indented line under a bullet
        if closes and breaks > 0 or inner or kind == "header" and last != "header" and breaks == 1:
            out.append("")
        out.append(_bullet(line) if kind == "list" else line)
        if kind == "table" and last != "table":
            out.append("|" + " - |" * (line.count("|") - 1))
        if kind in ("header", "text") and breaks > 1:
            out.append("")
        last, bullet = kind, out[-1].lstrip().startswith("*")
    return "".join(f"{line}\n" for line in out)


_SCRIPTS = re.compile(r"(?:[^\s$]*\$[_|^](?:[^$]|\{[^$}]+\})\$)+[^\s$]*")


def merge_scripts(text: str) -> str:
    """Runs of $_x$ and $^x$ in a word become one formula; $M^{me}$ is a word."""
    whole = lambda m: "$" + m[0].replace("$", "") + "$"
    return _SCRIPTS.sub(lambda m: "Mme" if whole(m) == "$M^{me}$" else whole(m), text)


def clean_wiki(text: Column) -> Column:
    return _each(lambda t: merge_scripts(to_markdown(t)), "string", text)


# --- languages --------------------------------------------------------------

#: A small scorer in place of a trained model: frequent short words of each language.
COMMON = {
    "fr": "le la les de des du un une et est que qui dans pour pas sur au aux ce il elle nous vous ne avec par se sont plus".split(),
    "en": "the of and to in is that it for was on are as with be this by from or at an not have has they we you which".split(),
    "de": "der die das und ist nicht ein eine zu den von mit sich auf für dem des im es auch als an werden aus er hat".split(),
    "es": "el la los las de que y en un una es por con no para se del al lo como más su sus pero fue ha sobre este".split(),
    "it": "il lo la gli le di che e un una è per con non in si del della al come più ma sono dei nel alla ha questo".split(),
}
_SETS = {k: frozenset(v) for k, v in COMMON.items()}


def language_scores(text: str, among: tuple[str, ...] = ("fr", "en", "de", "es", "it")) -> dict[str, float]:
    """Shares of the candidates: exponentials of the share of their common words, which don't depend on the text's length."""
    import math

    words = re.findall(r"\w+", text.lower())
    raw = {k: math.exp(8 * sum(w in _SETS[k] for w in words) / max(len(words), 1)) for k in among}
    return {k: v / sum(raw.values()) for k, v in raw.items()}


def split_bilingual(text: str) -> dict[str, str]:
    """Parts of a French-English line: cut at wide spaces, at the cut that parts the languages best and most evenly."""
    text = text.strip()
    cuts = list(re.finditer(r" {2,}|\n{2,}|\t", text))
    if not cuts:
        return {"text_en": None, "text_fr": None}
    fields = [text[a:b] for a, b in zip([0, *(c.end() for c in cuts)], [*(c.start() for c in cuts), len(text)], strict=True)]
    scores = [language_scores(f, ("fr", "en")) for f in fields]

    def worth(i: int) -> float:
        n, m = i, len(fields) - i
        en = sum(s["en"] for s in scores[:i]) + sum(s["fr"] for s in scores[i:])
        return max(en, len(fields) - en) + 1 - abs(n - m) / max(n, m)

    best = max(range(1, len(fields)), key=worth)
    a, b = text[: cuts[best - 1].start()], text[cuts[best - 1].end() :]
    gap = [s["en"] - s["fr"] for s in (language_scores(a, ("fr", "en")), language_scores(b, ("fr", "en")))]
    en, fr = (a, b) if gap[0] > gap[1] else (b, a)
    return {"text_en": en.strip(), "text_fr": fr.strip()}


def bilingual_parts(text: Column) -> Column:
    @F.arrow_udf("struct<text_en:string,text_fr:string>")
    def parts(a: pa.Array) -> pa.Array:
        return pa.array([None if x is None else split_bilingual(x) for x in a.to_pylist()], pa.struct([("text_en", pa.string()), ("text_fr", pa.string())]))

    return parts(text)
