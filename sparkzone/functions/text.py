"""String and array cleaning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Text that means "no value", and the marks that are repaired.
NULL_TOKENS = ("", "-", "--", "n/a", "na", "nan", "none", "null")
CELSIUS_WORDS = ("c", "celsius", "degree c", "degrees c")
DEGREE_C = "°C"
BROKEN_DASH = "â\u0080[\u0093\u0094]"
BROKEN_DEGREE_C = "(?i)[âÂ]\\s*[°º]\\s*c"
LOOSE_DEGREE_C = "(?i)°\\s*c"
CONTROL_CHARS = r"[\u0000-\u0008\u000B\u000C\u000E-\u001F\u007F-\u009F]"
UNCLEAN_CHARS = r"[\u0000-\u0008\u000B\u000C\u000E-\u001F\u007F-\u009F\r\n\t]"
ALLOWED_IMAGE_EXTENSIONS = r"\.(jpg|jpeg|png|webp)$"


# Every repair below needs one of these, so a text without them is only trimmed.
NEEDS_REPAIR = r"[\u0000-\u001F\u007F-\u009F°º]|  "


def tidy(c: Column) -> Column:
    """Whitespace squeezed, broken dashes and degree signs repaired, control marks gone."""
    fixed = F.regexp_replace(c, r"\s+", " ")
    fixed = F.regexp_replace(fixed, BROKEN_DASH, "-")
    fixed = F.regexp_replace(fixed, BROKEN_DEGREE_C, DEGREE_C)
    fixed = F.regexp_replace(fixed, LOOSE_DEGREE_C, DEGREE_C)
    fixed = F.regexp_replace(fixed, CONTROL_CHARS, "")
    return F.trim(F.when(c.rlike(NEEDS_REPAIR), fixed).otherwise(c))


def null_tokens(c: Column, keep: Column | None = None) -> Column:
    """Null for a null token, else ``keep`` (the lower-cased text unless given)."""
    low = F.lower(c)
    return F.when(~low.isin(*NULL_TOKENS), low if keep is None else keep)


def celsius_unit(c: Column) -> Column:
    """A unit column keeps its case; spelled-out Celsius becomes the degree sign."""
    return F.when(F.lower(c).isin(*CELSIUS_WORDS), F.lit(DEGREE_C)).otherwise(c)


def month_range(c: Column) -> Column:
    return F.regexp_replace(c, r"\s*-\s*", "-")


def period_label(c: Column) -> Column:
    """Lower-case period label whose foreign marks become single dashes."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"[^\w\s\-]", "-"), "-+", "-"))


def period_type(c: Column) -> Column:
    filled = F.coalesce(c, F.lit(""))
    return (
        F.when(F.contains(filled, F.lit("-")), "season")
        .when(F.contains(F.lower(filled), F.lit("year")), "annual")
        .otherwise("month")
    )


def bracketed_to_array(c: Column) -> Column:
    """``"['a', 'b']"`` to an array; quotes, brackets and blanks are dropped."""
    return F.split(F.regexp_replace(c, r"[\[\]'\"\s]", ""), ",")


def clean_array(c: Column) -> Column:
    return F.filter(F.transform(c, lambda x: F.lower(F.trim(x))), lambda x: x.isNotNull() & (x != ""))


def strip_hash(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, "^#", ""))


def has_unclean_chars(c: Column) -> Column:
    return F.coalesce(c.rlike(UNCLEAN_CHARS), F.lit(False))


def allowed_image(path: Column) -> Column:
    return F.lower(path).rlike(ALLOWED_IMAGE_EXTENSIONS)


def uri_bucket(c: Column) -> Column:
    return F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)


def uri_key(c: Column) -> Column:
    return F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/*([^?#]*)", 1)
