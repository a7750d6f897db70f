"""String expressions shared by all operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a Unicode-aware strip() or split() treats as blank.
BLANK = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
BLANK_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(value: Column) -> Column:
    """Trim all Unicode blanks, not only the space character."""
    return F.btrim(value, F.lit(BLANK_CHARACTERS))


def squeeze(value: Column) -> Column:
    """Trim, then turn every run of blanks into one space.

    Single spaces are no matches, and visible ASCII is passed over before the class is tried.
    """
    return strip(F.regexp_replace(value, f"(?![!-~])(?:{BLANK}{{2,}}|(?! ){BLANK})", " "))


def word_count(value: Column) -> Column:
    """Number of blank-separated words; an empty text has none."""
    squeezed = squeeze(value)
    return F.when(squeezed == "", F.lit(0)).otherwise(F.size(F.split(squeezed, " ", -1)))


def blank_to_null(value: Column) -> Column:
    """Stripped text, NULL when nothing is left."""
    return F.nullif(strip(value), F.lit(""))


def capitalize(value: Column) -> Column:
    """First character upper case, the rest lower case."""
    return F.concat(F.upper(F.substring(value, 1, 1)), F.lower(F.substring(value, 2, 1 << 30)))


def round_half_up(value: Column, digits: int) -> Column:
    """Round by ``floor(x * 10**digits + 0.5)``; one rule for every engine."""
    factor = float(10**digits)
    return F.floor(value * F.lit(factor) + F.lit(0.5)) / F.lit(factor)


def slug(value: Column) -> Column:
    """Folder-safe name: blanks to ``_``, other marks dropped, empty -> ``unknown``."""
    name = F.regexp_replace(F.translate(strip(value), " ", "_"), "[^a-zA-Z0-9_-]+", "")
    return F.coalesce(F.nullif(name, F.lit("")), F.lit("unknown"))


def lookup(table: dict[str, object], key: Column, value_type: str | None = None) -> Column:
    """Value of a small fixed table, NULL on a miss."""
    cells: list[Column] = []
    for name, value in table.items():
        cells += [F.lit(name), F.lit(value)]
    found = F.try_element_at(F.create_map(*cells), key)
    return found.cast(value_type) if value_type else found


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def last_wins(entries: Column) -> Column:
    """A map from entries; of entries with equal keys the last one counts."""

    def build(backwards: Column) -> Column:
        keys = F.transform(backwards, lambda e: e["key"])
        return bind(
            keys, lambda k: F.map_from_entries(F.filter(backwards, lambda e, i: F.array_position(k, e["key"]) == i + 1))
        )

    return bind(F.reverse(entries), build)
