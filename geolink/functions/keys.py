"""Column expressions for coded text keys: normalising, validating, slicing and labelling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ASCII blanks that a full strip removes (a SQL TRIM removes spaces only).
BLANKS = " \t\n\r\x0b\x0c"

# Code widths.
POSTAL_WIDTH = 8
MUNICIPALITY_WIDTH = 6
STATE_WIDTH = 2

# Location levels, best first, and the label for "none".
LEVEL_POSTAL = "cep"
LEVEL_MUNICIPALITY = "municipio"
LEVEL_STATE = "uf"
LEVEL_NONE = "sem_localizacao"

# Patterns.
MUNICIPALITY7_PATTERN = "^[0-9]{7}$"
VARIABLE_NAME_PATTERN = "^[A-Z][A-Z0-9_]{2,15}$"
CODE_LABEL_PATTERN = r"(\d+)\s*[-–]\s*([^0-9\n]+)"
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: Column | str) -> Column:
    """The value as text without surrounding spaces; tabs stay, as with SQL ``TRIM``."""
    return F.trim(_col(c).cast("string"))


def stripped(c: Column | str) -> Column:
    """The value as text without surrounding spaces, tabs or line ends."""
    return F.btrim(_col(c).cast("string"), F.lit(BLANKS))


def is_filled(c: Column | str) -> Column:
    """True where the value is neither null nor blank; never null."""
    return F.coalesce(trimmed(c) != "", F.lit(False))


def or_empty(c: Column | str) -> Column:
    """Null becomes the empty text."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def only_digits(c: Column | str) -> Column:
    """ASCII digits of the value, in order; null becomes the empty text."""
    return F.regexp_replace(or_empty(c), "[^0-9]", "")


def is_code(c: Column | str, width: int) -> Column:
    """True where the digits are exactly ``width`` long and not all zero; never null."""
    digits = only_digits(c)
    return (F.length(digits) == width) & (digits != "0" * width)


def is_postal_code(c: Column | str) -> Column:
    return is_code(c, POSTAL_WIDTH)


def is_municipality6(c: Column | str) -> Column:
    return is_code(c, MUNICIPALITY_WIDTH)


def is_state2(c: Column | str) -> Column:
    return is_code(c, STATE_WIDTH)


def is_municipality7(c: Column | str) -> Column:
    return _col(c).cast("string").rlike(MUNICIPALITY7_PATTERN)


def prefix(c: Column | str, n: int) -> Column:
    return F.substring(_col(c), 1, n)


def without_last(c: Column | str) -> Column:
    col = _col(c)
    return F.left(col, F.length(col) - 1)


def zero_pad(c: Column | str, width: int) -> Column:
    """Left zeros up to ``width``; longer input is cut, as SQL ``LPAD`` does."""
    return F.lpad(_col(c).cast("string"), width, "0")


def zero_fill(c: Column | str, width: int) -> Column:
    """Left zeros up to ``width``; longer input is kept whole."""
    text = _col(c).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def to_number(c: Column | str) -> Column:
    """Parse as double; text that is no finite decimal number becomes null, and so does NaN."""
    text = stripped(c)
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def finite(c: Column | str) -> Column:
    """A double column with NaN turned into null, so that comparisons treat it as missing."""
    col = _col(c).cast("double")
    return F.when(~F.isnan(col), col)


def ladder(default: str | None, *steps: tuple[Column, str]) -> Column:
    """Ordered masks over a default, each later mask overriding the earlier ones."""
    return reduce(
        lambda below, step: F.when(step[0], F.lit(step[1])).otherwise(below),
        steps,
        F.lit(default).cast("string"),
    )


def level_available(postal_ok: Column, municipality_ok: Column, state_ok: Column) -> Column:
    """Best location level that the validity flags allow."""
    return ladder(
        LEVEL_NONE,
        (state_ok, LEVEL_STATE),
        (municipality_ok, LEVEL_MUNICIPALITY),
        (postal_ok, LEVEL_POSTAL),
    )


def flag_text(c: Column | str) -> Column:
    """A boolean as ``True`` / ``False`` text."""
    return F.initcap(_col(c).cast("string"))


def period_label(year: Column | int, month: Column | int) -> Column:
    """``2026-01`` from a year and a month."""
    year = year if isinstance(year, Column) else F.lit(year)
    month = month if isinstance(month, Column) else F.lit(month)
    return F.concat(year.cast("string"), F.lit("-"), zero_fill(month, 2))


def geocode_query(postal: Column | str, country: str = "Brazil") -> Column:
    """Text that a geocoder is asked for a postal code."""
    return F.concat(_col(postal), F.lit(f", {country}"))


def name_matches(name: Column | str, start: str, end: str) -> Column:
    """File-name test by prefix and suffix, whatever the case."""
    col = _col(name)
    return F.upper(col).startswith(start.upper()) & F.lower(col).endswith(end.lower())


def name_year(name: Column | str, suffix: str = ".dbc") -> Column:
    """Two-digit year of a name that ends in ``yymm`` and the suffix."""
    return F.substring(_col(name), -4 - len(suffix), 2)


def name_month(name: Column | str, suffix: str = ".dbc") -> Column:
    """Two-digit month of a name that ends in ``yymm`` and the suffix."""
    return F.substring(_col(name), -2 - len(suffix), 2)


def has_period(name: Column | str, suffix: str = ".dbc", digits: int = 4) -> Column:
    """True for names with digits where the year and month belong; templates have letters there.

    The length of the suffix counts, not its letters. Yearly files have two ``digits``.
    """
    return _col(name).rlike(f"[0-9]{{{digits}}}.{{{len(suffix)}}}$")


def is_variable_name(c: Column | str) -> Column:
    return stripped(c).rlike(VARIABLE_NAME_PATTERN)


def code_label_map(c: Column | str) -> Column:
    """Map of the "code - label" pairs in a text; the last label of a repeated code wins."""
    text = or_empty(c)
    codes = F.regexp_extract_all(text, F.lit(CODE_LABEL_PATTERN), 1)
    labels = F.regexp_extract_all(text, F.lit(CODE_LABEL_PATTERN), 2)
    backwards = F.reverse(codes)
    unique = F.array_distinct(codes)
    last_label = F.transform(
        unique,
        lambda code: F.element_at(
            labels, (F.size(codes) - F.array_position(backwards, code) + 1).cast("int")
        ),
    )
    return F.map_from_arrays(unique, last_label)
