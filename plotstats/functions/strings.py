"""Text functions on characters. NULL text gives NULL; a NULL count counts as 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters and their sound classes.
SOUND_LETTERS = "BFPVCGJKQSXZDTLMNR"
SOUND_DIGITS = "111122222222334556"
# A byte above 127 sounds like the letter it becomes without its highest bit.
SOUND_CHARACTERS = "".join(
    "".join(chr(ord(c) | high) for c in letters)
    for high in (0, 128)
    for letters in (SOUND_LETTERS, SOUND_LETTERS.lower())
)
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def _translate(s: Column, old: Column, new: Column) -> Column:
    return F.call_function("translate", s, old, new)


def _count(n: Column) -> Column:
    return F.coalesce(n, F.lit(0)).cast("int")


def replicate(s: Column, n: Column) -> Column:
    """`s` n times; NULL for a negative count."""
    return F.when(_count(n) >= 0, F.repeat(s, _count(n)))


def charindex(needle: Column, hay: Column, start: Column | None = None) -> Column:
    """1-based position of `needle` at or after `start`; 0 when absent or empty."""
    begin = F.greatest(_count(start), F.lit(1)) if start is not None else F.lit(1)
    found = F.call_function("locate", needle, hay, begin)
    return F.when(needle.isNull() | hay.isNull(), F.lit(None)).when(needle == "", 0).otherwise(found)


def leftstr(s: Column, n: Column) -> Column:
    return F.left(s, n)


def rightstr(s: Column, n: Column) -> Column:
    return F.right(s, n)


def reverse(s: Column) -> Column:
    return F.reverse(s)


def proper(s: Column) -> Column:
    """Capital after a blank or a tab, small letters elsewhere; only A to Z change."""
    def capital(word: Column) -> Column:
        first = _translate(F.left(word, F.lit(1)), F.lit(LOWER), F.lit(UPPER))
        return F.concat(first, F.substring(word, 2, 2**31 - 1))

    def words(part: Column) -> Column:
        return F.array_join(F.transform(F.split(part, " "), capital), " ")

    small = _translate(s, F.lit(UPPER), F.lit(LOWER))
    return F.array_join(F.transform(F.split(small, "\t"), words), "\t")


def padl(s: Column, n: Column) -> Column:
    """Blanks on the left up to n characters; longer text stays whole; NULL for negative n."""
    return F.when(_count(n) < 0, None).when(F.length(s) >= _count(n), s).otherwise(F.lpad(s, _count(n), F.lit(" ")))


def padr(s: Column, n: Column) -> Column:
    return F.when(_count(n) < 0, None).when(F.length(s) >= _count(n), s).otherwise(F.rpad(s, _count(n), F.lit(" ")))


def padc(s: Column, n: Column) -> Column:
    """Blanks on both sides, the odd one on the right."""
    missing = F.greatest(_count(n) - F.length(s), F.lit(0))
    before = F.floor(missing / 2).cast("int")
    padded = F.concat(F.repeat(F.lit(" "), before), s, F.repeat(F.lit(" "), missing - before))
    return F.when(_count(n) >= 0, padded)


def strfilter(s: Column, keep: Column) -> Column:
    """Only the characters of `s` that occur in `keep`."""
    return _translate(s, _translate(s, keep, F.lit("")), F.lit(""))


def sound_code(s: Column) -> Column:
    """First letter, then up to three sound classes counted from that same letter, filled with 0."""
    one_byte_each = F.decode(F.encode(s, "UTF-8"), "ISO-8859-1")
    rest = F.regexp_replace(one_byte_each, "^[^A-Za-z]+|[0-9]", "")
    classes = F.regexp_replace(_translate(rest, F.lit(SOUND_CHARACTERS), F.lit(SOUND_DIGITS * 4)), "[^1-6]", "")
    code = F.concat(F.upper(F.left(rest, F.lit(1))), F.rpad(F.left(classes, F.lit(3)), 3, "0"))
    return F.when(s.rlike("[A-Za-z]"), code).when(s.isNotNull(), "?000")


def difference(a: Column, b: Column) -> Column:
    """Number of equal positions (0 to 4) of the two sound codes."""
    x, y = sound_code(a), sound_code(b)
    same = F.zip_with(F.split(x, ""), F.split(y, ""), lambda p, q: p == q)
    return F.when(a.isNotNull() & b.isNotNull(), F.size(F.filter(same, lambda equal: equal)))


def ltrim(s: Column) -> Column:
    return F.ltrim(s)


def rtrim(s: Column) -> Column:
    return F.rtrim(s)


def trim(s: Column) -> Column:
    return F.trim(s)


def replace(s: Column, old: Column, new: Column) -> Column:
    return F.replace(s, old, new)


def abbreviation(s: Column) -> Column:
    """The capital letters of a name."""
    return F.regexp_replace(s, "[^A-Z]", "")
