"""Column functions for names, identifiers, phones, addresses and references."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and the plain letters they fold to, position by position.
ACCENTED = "áéíóúüñàèìòùâêîôûäëïöçãõ"
PLAIN = "aeiouunaeiouaeiouaeiocao"

# Words written for the gender classes of a product title.
GENDER_WORDS = {"MASCULINO": "Hombre", "FEMENINO": "Mujer"}


def fold(c: Column) -> Column:
    """Lower case without accents: the form in which place names are compared."""
    return F.translate(F.lower(c), ACCENTED, PLAIN)


def ci(c: Column) -> Column:
    """Compare key that ignores case and trailing blanks."""
    return F.lower(F.rtrim(c))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def clip(c: Column, width: int) -> Column:
    """Cut to the width of the receiving field."""
    return F.substring(c, 1, width)


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]+", "")


def digits_hyphen(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9-]+", "")


def letters_digits(c: Column) -> Column:
    """Folded letters and digits only, for matching labels typed by hand."""
    return F.regexp_replace(fold(c), "[^a-z0-9]+", "")


def strip_newlines(c: Column) -> Column:
    return F.regexp_replace(c, "[\r\n]+", "")


def log_text(c: Column) -> Column:
    """Replace characters that break a log line by blanks."""
    return F.regexp_replace(c, "[\"'.{}\\r\\n]", " ")


def join_text(*parts: Column) -> Column:
    """Concatenate with NULL read as empty text (plain concat gives NULL)."""
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def pad_left(c: Column, width: int, fill: str = "0") -> Column:
    """Pad on the left to at least ``width`` characters; a longer value stays whole, so keys never collide."""
    value = F.trim(c.cast("string"))
    return F.when(F.length(value) >= width, value).otherwise(F.lpad(value, width, fill))


def fixed_width(c: Column, width: int, fill: str = "0") -> Column:
    """The last ``width`` characters after padding on the left, for fields of fixed width; not for keys."""
    return F.right(F.concat(F.lit(fill * width), F.trim(c.cast("string"))), F.lit(width))


def slug(c: Column) -> Column:
    return F.lower(F.replace(F.trim(c), F.lit(" "), F.lit("-")))


def first_upper(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 20)))


def gender_word(c: Column) -> Column:
    for code, word in GENDER_WORDS.items():
        c = F.replace(c, F.lit(code), F.lit(word))
    return c


def first_surname(c: Column) -> Column:
    return F.substring_index(F.trim(c), " ", 1)


def other_surnames(c: Column) -> Column:
    whole = F.trim(c)
    at = F.locate(" ", whole)
    return F.when(at > 0, F.ltrim(F.substring(whole, at, F.length(whole)))).otherwise(
        F.when(whole.isNotNull(), F.lit(""))
    )


def clean_phone(c: Column, prefix: str = "+57", drop: str = "") -> Column:
    """Without country prefix and without the characters in ``drop``; NULL gives ''."""
    plain = F.replace(F.upper(F.coalesce(c, F.lit(""))), F.lit(prefix), F.lit(""))
    return F.translate(plain, drop, "") if drop else plain


def clean_email(c: Column, fallback: str | None = None, width: int = 255) -> Column:
    kept = F.coalesce(c, F.lit(""))
    if fallback is not None:
        kept = F.when(kept == "", F.lit(fallback)).otherwise(kept)
    return clip(kept, width)


def address_line_1(a1: Column, width: int = 39) -> Column:
    return clip(F.coalesce(a1, F.lit("")), width)


def address_line_2(a1: Column, a2: Column, width: int = 39) -> Column:
    """What did not fit in line 1; the second address only when line 1 was short."""
    first = F.coalesce(a1, F.lit(""))
    return F.when(
        F.length(F.rtrim(first)) > width, F.substring(first, width + 1, width)
    ).otherwise(clip(F.coalesce(a2, F.lit("")), width))


def last_chars(c: Column, width: int) -> Column:
    return F.when(F.length(c) > width, F.right(c, F.lit(width))).otherwise(c)


def external_reference(c: Column, origin: Column, width: int, origins: list[str]) -> Column:
    """Order number kept in the ERP: its last ``width`` characters.

    For the named origins the leading digit and what precedes the next 1-9 is dropped first.
    """
    at = F.regexp_instr(F.substring(c, 2, 1 << 20), F.lit("[1-9]"))
    bare = F.substring(c, at + 1, F.length(c))
    return last_chars(F.when(origin.isin(origins), bare).otherwise(c), width)


def drop_leading_zero(sku: Column) -> Column:
    return F.when(sku.startswith("0"), F.substring(sku, 2, 1 << 20)).otherwise(sku)


def brand_sku(sku: Column, product: Column, marks: dict[str, str]) -> Column:
    """Replace the hyphen by the mark a brand uses in its references."""
    out = sku
    for brand, mark in reversed(list(marks.items())):
        hit = sku.contains("-") & F.upper(product).contains(brand)
        out = F.when(hit, F.replace(sku, F.lit("-"), F.lit(mark))).otherwise(out)
    return out


def number_text(c: Column) -> Column:
    """Whole number as text, zero as ''."""
    whole = F.round(c).cast("bigint")
    return F.when(whole == 0, F.lit("")).otherwise(whole.cast("string"))


def like_any(c: Column, patterns: list[str]) -> Column:
    """OR of contains tests."""
    hit = F.lit(False)
    for p in patterns:
        hit = hit | c.contains(p)
    return hit


def day_text(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd")


def iso_instant(c: Column) -> Column:
    """Text with an offset to a timestamp; unreadable text gives NULL."""
    return F.try_to_timestamp(c)


def xml_text(c: Column) -> Column:
    """Value as XML character data: markup escaped, characters that XML cannot hold left out; NULL is empty."""
    clean = F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]", "")
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        clean = F.replace(clean, F.lit(mark), F.lit(entity))
    return clean
