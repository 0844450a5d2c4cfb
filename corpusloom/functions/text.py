"""Text expressions, all native.

Words are runs of characters that are not Unicode white space; patterns use
Unicode classes and take only \\n as a line end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters whose UTF-8 bytes are often read as Latin-1; each is replaced in this order.
MOJIBAKE = sorted("¡¿ÀÂÃÄÆÇÈÉÊËÎÏÑÔÕÖØÙÛÜẞßàâãäçèéêëîïñôõöøûüÿŒŸ ")

#: Channel codes of languages that are left out.
EXCLUDED_CHANNELS = ["cn", "zh", "ko", "vn", "gr", "il", "ru", "cz", "dk", "ch", "si", "se", "sv", "tw", "ir", "ro", "pt", "br", "lt", "rs", "hr", "ps", "sa", "cy", "dz", "eg", "tr"]


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+\z", "")


def rstrip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\s+\z", "")


def squeeze_spaces(text: Column) -> Column:
    return F.regexp_replace(text, " {2,}", " ")


def join_hyphenated(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)(\w)-\n(\w)", "$1$2")


def join_lines(text: Column) -> Column:
    """Join words cut by a hyphen, lines after a comma or semicolon, and lines that open in lower case."""
    text = F.regexp_replace(join_hyphenated(text), r"(?U)([,;])\s*\n", "$1 ")
    return squeeze_spaces(F.regexp_replace(text, r"(?U)\n\s*([a-z»])", " $1"))


def join_single_breaks(text: Column) -> Column:
    """Join words cut by a hyphen; a line break that stands alone becomes a space."""
    return F.regexp_replace(join_hyphenated(text), r"(?<!\n)\n(?!\n)", " ")


def clean_legal(text: Column, drop_title: bool = False) -> Column:
    """A literal /n is a line break; no spaces at line ends; optionally no first line."""
    text = squeeze_spaces(F.regexp_replace(F.replace(text, F.lit("/n"), F.lit("\n")), " *\n *", "\n"))
    if not drop_title:
        return text
    at = F.instr(text, "\n")
    return F.when(at > 0, F.substring(text, at + F.lit(1), F.length(text))).otherwise(text)


def clean_speech(text: Column) -> Column:
    """Drop view counts and source mentions."""
    text = rstrip(F.regexp_replace(text, r"(?Ud)-? ?\d+ VUES?$", ""))
    text = rstrip(F.regexp_replace(text, r"(?Ud)[Ss]ource [^\n]$", ""))
    text = F.regexp_replace(text, r"[Ss]ource [:a-z0-9_\-, ]+", " ")
    return squeeze_spaces(F.regexp_replace(text, r"[Ss]ource http[:a-z0-9_\-]+", " "))


def drop_licence_tail(text: Column) -> Column:
    """Cut an e-book's end mark and what follows."""
    return F.regexp_replace(text, r"(?s)\n\n {12}\*\*\* END OF THE PROJECT GUTENBERG EBOOK.*", "")


def fix_mojibake(text: Column) -> Column:
    """Undo UTF-8 read as Latin-1, character by character in order; a guard spares clean texts the work."""
    pairs = [(c.encode().decode("latin-1"), c) for c in MOJIBAKE]
    fixed = text
    for wrong, right in pairs:
        fixed = F.replace(fixed, F.lit(wrong), F.lit(right))
    suspects = "".join(sorted({wrong[0] for wrong, _ in pairs}))
    return F.when(text.rlike(f"[{suspects}]"), fixed).otherwise(text)


def clean_channel_log(text: Column) -> Column:
    """Empty for chat logs of channels in excluded languages, else with mojibake undone."""
    code = F.trim(F.regexp_extract(text, r"(?s)^#k?ubuntu-(..(?: |. ))", 1))
    return F.when(code.isin(EXCLUDED_CHANNELS), F.lit("")).otherwise(fix_mojibake(text))


def drop_cover_page(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)^.*?HAL is a multi-disciplinary open access.*?\x0c", "")


def fix_apostrophe(text: Column) -> Column:
    return F.regexp_replace(text, " ?'s ?", "'s")


def drop_annotations(text: Column) -> Column:
    """[word] annotations, with the dot and space before them, become one dot; leading dots and spaces go."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)\.?\s*\[[a-zA-Z]*\]", "."), r"^[ .]+", "")


def fix_wiki_url(url: Column, host: str) -> Column:
    """Put a project's host into a mirror's URL, and -- back to /."""
    return F.replace(F.regexp_replace(url, r"^(https?://)[^/]*", f"$1{host}"), F.lit("--"), F.lit("/"))


def slug(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(name, "[ :/]", "--"), "^[_-]+|[_-]+$", "")


def mask_pii(text: Column) -> Column:
    """E-mail addresses become <email>, public-looking IPv4 addresses <ip>."""
    email = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
    octet = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    return F.regexp_replace(F.regexp_replace(text, email, "<email>"), rf"\b{octet}(?:\.{octet}){{3}}\b", "<ip>")


#: Stand-ins for masked addresses.
STAND_IN_IPS = ["22.214.171.124", "126.96.36.199", "188.8.131.52", "184.108.40.206", "220.127.116.11", "18.104.22.168"]
STAND_IN_EMAILS = ["email@example.com", "firstname.lastname@example.org"]


def replace_pii_marks(text: Column, key: Column) -> Column:
    """Replace <email> and <ip> by stand-ins, one choice of each kind per document, drawn from its key's hash."""

    def pick(choices: list[str], salt: str) -> Column:
        at = F.pmod(F.conv(F.substring(F.sha2(F.concat(F.lit(salt), key.cast("string")), 256), 1, 8), 16, 10).cast("long"), F.lit(len(choices)))
        return F.element_at(F.array(*map(F.lit, choices)), (at + 1).cast("int"))

    return F.replace(F.replace(text, F.lit("<email>"), pick(STAND_IN_EMAILS, "email")), F.lit("<ip>"), pick(STAND_IN_IPS, "ip"))
