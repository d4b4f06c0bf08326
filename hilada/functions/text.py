"""Text expressions: cleaning, normalization, canonical form, words, lines and ratios. All but NFC run inside the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Code point ranges of white space, and what ends a line besides CR LF.
SPACES = ((0x9, 0xD), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
LINE_ENDS = ((0xA, 0xD), (0x1C, 0x1E), (0x85, 0x85), (0x2028, 0x2029))


def code_points(ranges: tuple[tuple[int, int], ...], without: tuple[int, ...] = (), braces: bool = False) -> str:
    """The inside of a character class, as Java writes code points or, with braces, as RE2 does."""
    out = []
    for a, b in ranges:
        for lo, hi in _cut(a, b, without):
            form = "\\x{{{:04x}}}" if braces else "\\u{:04x}"
            out.append(form.format(lo) if lo == hi else f"{form.format(lo)}-{form.format(hi)}")
    return "".join(out)


def _cut(a: int, b: int, without: tuple[int, ...]):
    for x in sorted(x for x in without if a <= x <= b):
        if a < x:
            yield a, x - 1
        a = x + 1
    if a <= b:
        yield a, b


WS = code_points(SPACES)
SL = "\\r\\n|[" + code_points(LINE_ENDS) + "]"
LEXICAL = "(?<![\\p{L}\\p{N}_])[a-záéíóúüñıſ]{2,}(?![\\p{L}\\p{N}_])"
WORD = "[\\p{L}\\p{Nl}\\p{No}]+(?:['\u2019\\-][\\p{L}\\p{Nl}\\p{No}]+)*"
SYMBOL = "[^\\p{L}\\p{N}_" + WS + ".,;:¿?¡!()«»“”\"'\u2019—–\\-]"
CONTROL = "[\\u0000-\\u0008\\u000b\\u000c\\u000e-\\u001f\\u007f]"
PAGE_MARK = f"(?iu)\\[\\[PÁGINA[{WS}]+\\p{{Nd}}+\\]\\]"


BLANKS = "".join(chr(i) for a, b in SPACES for i in range(a, b + 1))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def lines(c: Column) -> Column:
    """Lines without their ends; an end at the end of the text begins no line."""
    parts = F.split(c, SL, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def clean(c: Column) -> Column:
    """LF line ends, no page marks and control characters, single blanks, stripped lines, one empty line at most."""
    c = F.regexp_replace(c, "\r\n?", "\n")
    c = F.regexp_replace(F.regexp_replace(c, PAGE_MARK, "\n"), CONTROL, "")
    c = F.regexp_replace(c, "[ \\t]+", " ")
    c = F.array_join(F.transform(F.split(c, SL, -1), strip), "\n")
    return strip(F.regexp_replace(c, "\n{3,}", "\n\n"))


@F.pandas_udf(StringType())
def nfc(texts):
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


def normalize(c: Column) -> Column:
    """NFC, plain blanks, no blanks before line ends, one empty line at most, one line end at the end."""
    c = F.regexp_replace(nfc(c), "[\\u00a0\\u2007\\u202f]", " ")
    c = F.regexp_replace(c, "[ \\t]+\n", "\n")
    c = F.regexp_replace(c, f"[{code_points(SPACES, (0xA,))}]+", " ")
    return F.concat(strip(F.regexp_replace(c, "\n{3,}", "\n\n")), F.lit("\n"))


def canonical(c: Column) -> Column:
    """Words joined over line ends, lines of nothing but a number emptied, one empty line at most, one line end at the end."""
    c = F.regexp_replace(c, "([A-Za-zÁÉÍÓÚÜÑáéíóúüñ]+)-\n([a-záéíóúüñ]+)", "$1$2")
    c = F.regexp_replace(c, f"(?md)^[{WS}]*\\p{{Nd}}+[{WS}]*$", "")
    return F.concat(strip(F.regexp_replace(c, "\n{3,}", "\n\n")), F.lit("\n"))


def lexical_tokens(c: Column) -> Column:
    """Lower-case words of two or more letters, with no letter, number or underscore beside them."""
    return F.regexp_extract_all(F.lower(c), F.lit(LEXICAL), F.lit(0))


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(WORD)).cast("long")


def paragraph_count(c: Column) -> Column:
    return F.size(F.filter(F.split(c, f"\n[{WS}]*\n", -1), lambda p: strip(p) != "")).cast("long")


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def is_numeric_line(c: Column) -> Column:
    return F.regexp_replace(c, f"[{WS}.,:;()\\-–—]", "").rlike("^[\\p{Nd}\u00b2\u00b3\u00b9\u2070-\u2079\u2080-\u2089]+$")


def is_uppercase_line(c: Column) -> Column:
    letters = F.regexp_count(c, F.lit("\\p{L}"))
    return (letters >= 5) & (F.regexp_count(c, F.lit("\\p{Lu}")) >= 0.9 * letters)


def similarity_key(c: Column, size: int = 5000) -> Column:
    """What two extractions of one text share: lower case, single blanks, the first code points."""
    return F.substring(strip(F.regexp_replace(F.lower(c), f"[{WS}]+", " ")), 1, size)


def shortened(c: Column, size: int) -> Column:
    c = strip(F.regexp_replace(c, f"[{WS}]+", " "))
    return F.when(F.length(c) > size, F.concat(F.substring(c, 1, size), F.lit("..."))).otherwise(c)


def scalar(c: Column) -> Column:
    """A stripped value; null for nothing and for the word null."""
    c = strip(c)
    return F.when((c != "") & (F.lower(c) != "null"), c)


def names(c: Column, sign: str = ",") -> Column:
    """The parts of a list written in one string, stripped, without empty ones."""
    return F.filter(F.transform(F.split(c, sign), strip), lambda x: x != "")


def page_url(base: str, title: Column, quoted: bool = False) -> Column:
    """The address of a page: blanks become underscores and, if quoted, all but letters, digits and ()_-.~' their bytes."""
    plain = F.replace(title, F.lit(" "), F.lit("_"))
    if quoted:
        plain = F.url_encode(plain)
        for code, sign in (("*", "%2A"), ("%7E", "~"), ("%28", "("), ("%29", ")"), ("%27", "'")):
            plain = F.replace(plain, F.lit(code), F.lit(sign))
    return F.concat(F.lit(base), plain)


def uuid5(namespace_hex: str, name: Column) -> Column:
    """A UUID of version 5: the SHA-1 of the name space and the name, with its version and variant bits set."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace_hex.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab89ab89ab89ab"), F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") + 1, 1)
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4), F.lit("-5"), F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"), F.substring(digest, 21, 12),
    )


def human_bytes(c: Column) -> Column:
    """A size in the largest unit of 1024 below it, with two decimals."""
    units = ("B", "KiB", "MiB", "GiB", "TiB", "PiB")
    out = F.lit(None).cast("string")
    for k, unit in enumerate(units):
        fits = c < 1024.0 ** (k + 1) if k + 1 < len(units) else F.lit(True)
        out = F.coalesce(out, F.when(fits, F.format_string(f"%,.2f {unit}", half_even(c / 1024.0**k))))
    return out


def human_seconds(c: Column) -> Column:
    """Whole seconds as hours, minutes and seconds; a negative time is none."""
    s = F.greatest(F.lit(0), F.floor(c)).cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)


def half_even(c: Column, digits: int = 2) -> Column:
    """Rounded so that ties go to the even neighbour."""
    return F.bround(c, digits)
