"""Text cleaning as Column expressions.

All patterns carry explicit Java flags so that white space, digits and case
folding are the Unicode ones: U (Unicode classes), iu (Unicode ignore case), d
(only \\n ends a line).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from nomina import fixed

# The separators U+001C..U+001F count as white space but are not in Java's \s.
_WS = r"[\s\x1c-\x1f]"
# Word characters include all numbers and no combining marks, unlike Java's \w.
_WORD = r"[\p{L}\p{N}_]"

# Code points that canonical composition never changes, moves or merges. A text
# made of these only is composed already and need not leave the JVM.
_STABLE = (
    r"\x{0}-\x{2ff}\x{400}-\x{482}\x{48a}-\x{52f}\x{2010}-\x{2027}\x{2030}-\x{205e}"
    r"\x{2070}-\x{209c}\x{20a0}-\x{20bf}\x{2100}-\x{2125}\x{2190}-\x{2328}\x{2500}-\x{27bf}"
)


def _composer():
    # A nested function travels to the executors by value, so that they need
    # no copy of this package.
    def compose_batch(text: pd.Series) -> pd.Series:
        return text.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")

    return F.pandas_udf(compose_batch, StringType())


def normalize_unicode(text: Column) -> Column:
    """Canonical composition (NFC). Spark has no built-in for it."""
    return _composer()(text)


def is_composed(text: Column) -> Column:
    """True when the text is certainly composed already (null counts as such).

    Anchored and possessive on purpose: the JVM is ten times slower at searching
    for a character outside of such a class.
    """
    return F.coalesce(is_ascii(text) | text.rlike(f"^[{_STABLE}]*+$"), F.lit(True))


def compose(text: Column) -> Column:
    """Canonical composition that hands only the rows in need of it to Python."""
    composed = normalize_unicode(F.when(~is_composed(text), text))
    return F.coalesce(composed, text)


def cast_text(value: Column) -> Column:
    """Any value as text; null becomes the empty text."""
    return F.coalesce(value.cast("string"), F.lit(""))


def bound(text: Column, step: Callable[[Column], Column]) -> Column:
    """``step`` of a text that is computed once, however often the step names it."""
    return F.get(F.transform(F.array(text), step), 0)


def is_ascii(text: Column) -> Column:
    """Tells by its length, many times faster than by a pattern."""
    return F.octet_length(text) == F.char_length(text)


def strip_space(text: Column) -> Column:
    # Few texts have outer white space, and looking for its end costs a text's length.
    def strip(t: Column) -> Column:
        outer = F.left(t, F.lit(1)).rlike(rf"(?U){_WS}") | F.right(t, F.lit(1)).rlike(rf"(?U){_WS}")
        return F.when(outer, F.regexp_replace(t, rf"(?U)^{_WS}+|(?<!{_WS}){_WS}+\z", "")).otherwise(t)

    return bound(text, strip)


def unify_dashes(text: Column) -> Column:
    dashes = fixed.DASH_CLASS + "+"
    return bound(text, lambda t: F.when(is_ascii(t), t).otherwise(F.regexp_replace(t, dashes, "-")))


def unify_slashes(text: Column) -> Column:
    # Two searches of bytes; translate() looks up every character.
    for slash in fixed.SLASHES:
        text = F.replace(text, F.lit(slash), F.lit("/"))
    return text


def clean_raw(text: Column) -> Column:
    """Unified dashes and slashes, no outer white space; null gives the empty
    text. The input is composed."""
    return strip_space(unify_slashes(unify_dashes(F.coalesce(text, F.lit("")))))


def strip_leading_code(text: Column) -> Column:
    """One leading article code becomes a space, with a sign that joins it to a
    further word. The code must end where its word ends."""
    end = f"(?:[-/](?={_WORD})|(?!{_WORD}))"
    return F.regexp_replace(text, f"(?U)^{_WS}*(?:{fixed.ARTICLE_CODE}){end}", " ")


def strip_date_tail(text: Column) -> Column:
    """Drop the text from a trailing date or period on."""
    tail = (
        rf"(?iuUd){_WS}+(?:{fixed.DATE_PREPOSITIONS}){_WS}+(?:{fixed.DATE_PERIOD_WORD}{_WS}+)?"
        rf"(?:{fixed.DATE_MONTHS}|{fixed.DATE_DIGITS}).*$"
    )
    # The prepositions have no ASCII letter.
    return bound(text, lambda t: F.when(is_ascii(t), t).otherwise(F.regexp_replace(t, tail, "")))


def filter_chars(text: Column, extra_letters: str = "") -> Column:
    """Everything outside the kept alphabet becomes a space."""
    kept = fixed.KEPT_CHARS + "".join(rf"\x{{{ord(c):x}}}" for c in extra_letters)
    return F.regexp_replace(text, rf"(?U)[^\s\x1c-\x1f{kept}]", " ")


def squeeze_space(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, rf"(?U){_WS}+", " ")))


def clean_composed(text: Column, keep_codes: bool = False, extra_letters: str = "") -> Column:
    """The cleaning chain for text that is composed already."""
    raw = clean_raw(text)
    body = raw if keep_codes else strip_leading_code(raw)
    return squeeze_space(filter_chars(strip_date_tail(body), extra_letters))


def clean(
    text: Column, passes: int = 1, keep_codes: bool = False, extra_letters: str = ""
) -> Column:
    """The whole cleaning chain; null gives the empty text.

    ``passes=2`` cleans the cleaned text once more (cleaning is not idempotent:
    each pass may remove one leading code).
    """
    column = compose(text)
    for _ in range(passes):
        column = clean_composed(column, keep_codes, extra_letters)
    return column
