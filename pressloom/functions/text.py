"""Text functions: transliteration, white space, word tokens."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import WHITESPACE, let, strip
from ..vocab import INVALID_TITLE_PHRASES, STOPWORDS, STOPWORDS_EN, stopwords_for

#: Word tokens and single other characters.
TOKEN_PATTERN = r"[\p{L}\p{N}_]+(?:[-'.][\p{L}\p{N}_]+)*|[^\p{L}\p{N}_\s]"
WORD_CHARACTER = r"[\p{L}\p{N}_]"
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

#: Letters without a decomposition, and common typographic signs.
_SINGLE = {
    "Ð": "D", "Ø": "O", "ð": "d", "ø": "o", "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h",
    "ı": "i", "ĸ": "k", "Ł": "L", "ł": "l", "Ŋ": "N", "ŋ": "n", "Ŧ": "T", "ŧ": "t",
    "ſ": "s", "‘": "'", "’": "'", "‚": ",", "“": '"', "”": '"', "‐": "-", "‑": "-",
    "‒": "-", "–": "-", "\xa0": " ",
}
_MULTIPLE = {
    "ß": "ss", "Æ": "AE", "æ": "ae", "Þ": "Th", "þ": "th", "Œ": "OE", "œ": "oe",
    "—": "--", "…": "...",
}


def _decomposed() -> dict[str, str]:
    """Base letters of the accented letters of Latin-1 and Latin Extended-A."""
    table = {}
    for code in range(0xC0, 0x180):
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and parts[0].isascii():
            table[chr(code)] = parts[0]
    return table


_TRANSLATION = {**_decomposed(), **_SINGLE}


def transliterate(text: Column) -> Column:
    """ASCII form of Latin text, stripped. Other scripts stay as they are."""
    out = F.translate(text, "".join(_TRANSLATION), "".join(_TRANSLATION.values()))
    for letter, replacement in _MULTIPLE.items():
        out = F.replace(out, F.lit(letter), F.lit(replacement))
    return strip(out)


def transliterate_literal(text: str) -> str:
    """The same mapping for a fixed phrase."""
    return "".join(_MULTIPLE.get(c, _TRANSLATION.get(c, c)) for c in text).strip()


def normalize(text: Column) -> Column:
    """Body text on one line: right quotes removed, white space collapsed."""
    blanks = F.translate(F.replace(text, F.lit("’"), F.lit("")), WHITESPACE, " " * len(WHITESPACE))
    return transliterate(F.trim(F.regexp_replace(blanks, " {2,}", " ")))


def raw_tokens(text: Column) -> Column:
    """Word and punctuation tokens of a text in order."""
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


def content_tokens(text: Column, stopwords: list[str]) -> Column:
    """Lower-case word tokens without stopwords and punctuation, in order."""
    return F.filter(
        raw_tokens(F.lower(text)), lambda t: ~t.isin(stopwords) & t.rlike(WORD_CHARACTER)
    )


def tokens_in(text: Column, lang: Column) -> Column:
    """Content tokens by the stopwords of the language of each row."""
    tokens = F.when(lang.isNull(), content_tokens(text, STOPWORDS_EN))
    for name in STOPWORDS:
        if name != "en":
            tokens = tokens.when(lang == name, content_tokens(text, stopwords_for(name)))
    return tokens.otherwise(content_tokens(text, STOPWORDS_EN))


def new_tokens(tokens: Column, known: Column) -> Column:
    """Tokens that are not in ``known``, order and repeats kept."""
    return let(known, lambda k: F.filter(tokens, lambda t: ~F.array_contains(k, t)))


def unescape(text: Column) -> Column:
    """The predefined character references replaced, also without semicolon. For
    titles read by pattern; parsed pages are unescaped in full."""
    for name, character in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "'"), ("amp", "&")):
        text = F.regexp_replace(text, f"&{name};?", character)
    return text


def author_text(text: Column) -> Column:
    """Byline text without English stopwords and punctuation, case kept."""
    kept = F.filter(
        raw_tokens(text),
        lambda t: ~F.lower(t).isin(STOPWORDS_EN)
        & (F.instr(F.lit(ASCII_PUNCTUATION), F.lower(t)) == 0),
    )
    return F.array_join(kept, " ")


def title_tokens(title: Column) -> Column:
    """Upper-case tokens of a title tag, marks before white space dropped."""
    return raw_tokens(F.upper(F.regexp_replace(title, r"[^\p{L}\p{N}]\s", " ")))


def heading_tokens(heading: Column) -> Column:
    return raw_tokens(F.upper(heading))


def valid_title(title: Column) -> Column:
    """``title``, or null where it is empty or an error page's title."""
    bad = title == ""
    for phrase in INVALID_TITLE_PHRASES:
        bad = bad | F.lower(title).contains(transliterate_literal(phrase).lower())
    return F.when(~bad, title)
