"""Text expressions: HTML/text to plain text, labelled-field patterns, tokens.

Everything is a chain of built-in string/regex expressions evaluated inside the
JVM. The patterns avoid look-around and back-references so the same pattern
means the same thing in Java regex and in RE2 (the oracle's dialect).
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

RE_REFERENCE = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


# Tags that end a block in LAYOUT mode (turned into a line break).
BLOCK_TAGS = ["p", "div", "h[1-6]", "li", "ul", "ol", "tr", "table", "article", "section",
              "nav", "header", "footer", "br", "hr", "blockquote", "pre", "title"]

RE_COMMENT = r"(?s)<!--.*?-->"
RE_SCRIPT = r"(?is)<script\b[^>]*>.*?</script\s*>"
RE_STYLE = r"(?is)<style\b[^>]*>.*?</style\s*>"
RE_BLOCK = r"(?i)</?(" + "|".join(BLOCK_TAGS) + r")\b[^>]*>"
RE_CELL = r"(?i)</t[dh]\s*>"
RE_TAG = r"<[^>]*>"
RE_HSPACE = r"[ \t\r\f]+"
RE_ANYSPACE = r"[ \t\n\r\f]+"
RE_EDGE = r"^[ \n]+|[ \n]+$"


def _named() -> dict[str, str]:
    """Every named reference of HTML that ends in a semicolon, from the standard
    library's table; those that stand for white space become a space."""
    return {k[:-1]: " " if v.isspace() else v for k, v in html5.items() if k.endswith(";")}


def decode_reference(ref: Column) -> Column:
    """The text of one reference such as 'amp', '#8217' or '#x2014'; NULL if there
    is no such name."""
    number = F.when(F.lower(F.substring(ref, 2, 1)) == "x", F.conv(F.substring(ref, 3, 6), 16, 10)) \
        .otherwise(F.substring(ref, 2, 7)).cast("int")
    valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    code = F.when(number == 160, 32).when(valid, number).otherwise(0xFFFD)
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    # a map is searched from its start: names by their first letters are two short
    # searches; as one constant, the table does not grow the plan by a node per name
    groups: dict[str, dict[str, str]] = {}
    for name, text in sorted(_named().items()):
        groups.setdefault(name[:2], {})[name] = text
    names = F.from_json(F.lit(json.dumps(groups)), "map<string, map<string, string>>")
    named = F.try_element_at(F.try_element_at(names, F.substring(ref, 1, 2)), ref)
    return F.when(F.startswith(ref, F.lit("#")), char).otherwise(named)


def decode_entities(c: Column) -> Column:
    """All numeric and named references decoded, each once and in its place, so the
    result of one is never read as part of another; unknown names stay."""
    refs = F.regexp_extract_all(c, F.lit(RE_REFERENCE), F.lit(1))
    decoded = F.zip_with(F.split(c, RE_REFERENCE, -1), refs, lambda piece, ref: F.when(ref.isNull(), piece).otherwise(
        F.concat(piece, F.coalesce(decode_reference(ref), F.concat(F.lit("&"), ref, F.lit(";"))))))
    return F.when(F.contains(c, F.lit("&")), F.array_join(decoded, "")).otherwise(c)


def without_tags(c: Column, mode: str = "LAYOUT") -> Column:
    """The first half of ``html_to_text``: no comments, scripts, styles and tags."""
    x = F.regexp_replace(c, RE_COMMENT, "")
    x = F.regexp_replace(x, RE_SCRIPT, "")
    x = F.regexp_replace(x, RE_STYLE, "")
    if mode == "LAYOUT":
        x = F.regexp_replace(x, RE_BLOCK, "\n")
        x = F.regexp_replace(x, RE_CELL, " ")
        return F.regexp_replace(x, RE_TAG, "")
    if mode == "OCR":
        return F.regexp_replace(x, RE_TAG, " ")
    raise ValueError(f"unknown mode {mode}")


def spaced_text(c: Column, mode: str = "LAYOUT") -> Column:
    """The second half: references decoded, white space as the mode has it. Reads ``c``
    several times, so give it a column, not an expression."""
    x = decode_entities(c)
    if mode == "LAYOUT":
        x = F.regexp_replace(x, RE_HSPACE, " ")
        x = F.regexp_replace(x, r" *\n[ \n]*", "\n")
    else:
        x = F.regexp_replace(x, RE_ANYSPACE, " ")
    return F.regexp_replace(x, RE_EDGE, "")


def html_to_text(c: Column, mode: str = "LAYOUT") -> Column:
    """LAYOUT keeps block structure as line breaks; OCR returns one flat line."""
    return spaced_text(without_tags(c, mode), mode)


def page_count(c: Column) -> Column:
    """Pages = 1 + form-feed page breaks."""
    return (F.lit(1) + F.length(c) - F.length(F.replace(c, F.lit("\f"), F.lit("")))).cast("int")


def label_pattern(label: str, value: str = r"(.*)") -> str:
    """Multi-line 'Label: value' pattern; group 1 is the value (portable form)."""
    return rf"(?m)^{label}: *{value}$"


def label_pattern_jvm(label: str, value: str = r"(.*)") -> str:
    """The same match for Java, to run on ``"\n" + text``: a line starting with
    the label is a newline followed by the label. UNIX_LINES (?d) makes '\n' the
    only line end, as in RE2. About 3x faster than the ^/$ multi-line form."""
    return rf"(?d)\n{label}: *{value}"


def extract_label(text: Column, pattern: str) -> Column:
    """First match of group 1, NULL when absent or empty."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


# Portable (RE2 / Java) spelling of "run of non-ASCII-alphanumerics", used by the oracle.
TOKEN_SPLIT = r"[^A-Za-z0-9]+"
# The same class for Java: \p{Alnum} is ASCII-only in Java regex, and the JVM
# matches this form ~15x faster than the range list above (same output).
TOKEN_SPLIT_JVM = r"[^\p{Alnum}]+"


def tokens(text: Column) -> Column:
    """ASCII word tokens, lower-cased; empty strings removed.

    Separators become single spaces first, so the string is pure ASCII before
    ``lower`` (no locale effects) and no higher-order function is needed: all
    four steps are native, code-generated expressions."""
    ascii_words = F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), TOKEN_SPLIT_JVM, " "))
    return F.array_remove(F.split(ascii_words, " "), "")


def sorted_words(words: Column, stemmed: bool = False) -> Column:
    """The words of an array in order, each as often as it occurs."""
    return F.sort_array(F.transform(words, lambda w: stem(w)) if stemmed else words)


def counted(ordered: Column) -> Column:
    """(term, tf) of each distinct word of an ordered array, as an array: a text is counted in
    its own row, without a shuffle."""
    def runs(words: Column) -> Column:
        starts = F.array_remove(F.transform(words, lambda w, i: F.when(w == F.get(words, i - 1), -1).otherwise(i)), -1)
        # an array of one value gives an expression a name, so that it is evaluated once a row
        return F.flatten(F.transform(F.array(starts), lambda at: F.transform(at, lambda i, j: F.struct(
            F.get(words, i).alias("term"), (F.coalesce(F.get(at, j + 1), F.size(words)) - i).cast("long").alias("tf")))))
    return F.flatten(F.transform(F.array(ordered), runs))


LETTERS = "abcdefghijklmnopqrstuvwxyz"


def stem(term: Column) -> Column:
    """A term of letters without its English ending, so that "damaged deliveries"
    finds "damage" and "delivery": -ies becomes -y; else -ed or -ing goes where three
    letters stay, then an -s that follows no s where three letters stay, then an -e
    where three stay. Used on both sides of a search. Plain string functions: a
    regular expression per rule costs several times as much."""
    n = F.char_length(term)
    ies = F.endswith(term, F.lit("ies")) & (n >= 5)
    m = n - F.when(F.endswith(term, F.lit("ed")) & (n >= 5), 2).when(F.endswith(term, F.lit("ing")) & (n >= 6), 3).otherwise(0)
    at = lambda place: F.substring(term, place, F.lit(1))
    m = m - ((m >= 4) & (at(m) == "s") & (at(m - 1) != "s")).cast("int")
    m = m - ((m >= 4) & (at(m) == "e")).cast("int")
    ending = F.substring(term, F.lit(-1), F.lit(1)).isin("s", "d", "g", "e")
    short = F.when(ies, F.concat(F.substring(term, F.lit(1), n - 3), F.lit("y"))).otherwise(F.substring(term, F.lit(1), m))
    return F.when(ending & (F.translate(term, LETTERS, "") == ""), short).otherwise(term)
