"""Date functions: dates mentioned in a text, publish date, quiet hours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import first_where
from ..vocab import ARTICLE_QUIET_WINDOWS, LINK_QUIET_WINDOWS, MONTH_NAMES

_NOT_IN_WORD, _WORD_ENDS = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
#: Month names and abbreviations, longest first, so that none hides a longer one.
_MONTH_NUMBER = {name: i + 1 for months in MONTH_NAMES.values() for i, names in enumerate(months) for name in names.split()}
_MONTH = _NOT_IN_WORD + "(?:" + "|".join(sorted(_MONTH_NUMBER, key=lambda n: (-len(n), n))) + ")" + _WORD_ENDS
_DAY = r"[0-9]{1,2}(?:st|nd|rd|th|er|\.|\u00ba)?"
_ISO = r"[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}"
_US = r"[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}"
_MONTH_FIRST = rf"{_MONTH}\.?\s+{_DAY},?\s+[0-9]{{4}}"
_DAY_FIRST = rf"{_DAY}\s+(?:(?:of|de|ng)\s+)?{_MONTH}\.?,?\s+(?:(?:de|del)\s+)?[0-9]{{4}}"

#: Date forms in running text: 2021-03-04, 2021/3/4, 3/4/2021 (month first), March 4th,
#: 2021, 4 Mar 2021, 4 de marzo de 2021, 1er mars 2021, 4. März 2021, ika-4 ng Marso, 2021.
DATE_PATTERN = rf"{_NOT_IN_WORD}(?:{_ISO}|{_US}|{_MONTH_FIRST}|{_DAY_FIRST}){_WORD_ENDS}"


def _iso(year: Column, month: Column, day: Column) -> Column:
    text = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return text.try_cast("timestamp_ntz")


def _parse(mention: Column) -> Column:
    """Timestamp (midnight) of one mention, null for an impossible date."""
    spelled = F.regexp_extract(mention, _MONTH, 0)
    numbers = F.create_map(*[F.lit(x) for name, number in sorted(_MONTH_NUMBER.items()) for x in (name, str(number))])
    month = F.try_element_at(numbers, spelled)
    day = F.regexp_extract(mention, r"(?:^|[^0-9])([0-9]{1,2})(?:[^0-9]|$)", 1)
    year = F.regexp_extract(mention, r"([0-9]{4})", 1)
    parts = F.split(mention, "[-/]")
    return (
        F.when(spelled != "", _iso(year, month, day))
        .when(mention.rlike(r"^[0-9]{4}"), _iso(F.get(parts, F.lit(0)), F.get(parts, F.lit(1)), F.get(parts, F.lit(2))))
        .otherwise(_iso(F.get(parts, F.lit(2)), F.get(parts, F.lit(0)), F.get(parts, F.lit(1))))
    )


def date_mentions(text: Column) -> Column:
    """All dates written in a text, in order of appearance."""
    found = F.regexp_extract_all(
        F.replace(F.lower(text), F.lit(":"), F.lit("")), F.lit(DATE_PATTERN), F.lit(0)
    )
    return F.filter(F.transform(found, _parse), lambda d: d.isNotNull())


def first_date_before(text: Column, as_of: Column) -> Column:
    """First date mentioned in a text that lies before ``as_of``."""
    return first_where(date_mentions(text), lambda d: d < as_of)


def publish_date(block_date: Column, meta_date: Column, as_of: Column) -> Column:
    """Earlier of the two dates known, else ``as_of``. Wall clocks, no zone."""
    return F.coalesce(F.least(block_date, meta_date), as_of)


def is_quiet(ts: Column, for_article: bool = False) -> Column:
    """Whether a time lies strictly inside a quiet window; windows may wrap past
    midnight."""
    seconds = (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("long")
    micros = seconds * 1_000_000 + (
        F.date_part(F.lit("SECOND"), ts) * 1_000_000
    ).cast("long")
    day = 86_400 * 1_000_000
    quiet = F.lit(False)
    for start, length in ARTICLE_QUIET_WINDOWS if for_article else LINK_QUIET_WINDOWS:
        begin, end = start * 60_000_000, (start + length) * 60_000_000
        quiet = quiet | ((micros > begin) & (micros < end))
        if end > day:
            quiet = quiet | (micros < end - day)
    return quiet
