"""Label predicates and label columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from nomina import fixed


def normalize_label(category: Column) -> Column:
    """Null, the empty label and the empty-name label become the fallback."""
    missing = category.isNull() | category.isin("", fixed.EMPTY_LABEL)
    return F.when(missing, F.lit(fixed.FALLBACK_LABEL)).otherwise(category)


def is_labeled(category: Column) -> Column:
    return category != fixed.FALLBACK_LABEL


def is_unmatched(category: Column) -> Column:
    return category.isNull() | category.isin("", fixed.FALLBACK_LABEL)


def is_junk(category: Column, prefix: str = fixed.JUNK_PREFIX) -> Column:
    return category.startswith(prefix)


def has_text(clean: Column) -> Column:
    return F.length(F.trim(clean)) > 0


def category_levels(category: Column) -> Column:
    """Levels of a label path."""
    return F.split(category, fixed.LEVEL_SEPARATOR)


def contains_all(text: Column, words: list[str]) -> Column:
    """Every word occurs as a plain substring; no words means true."""
    found = F.lit(True)
    for word in words:
        found = found & F.contains(text, F.lit(word))
    return found


def contains_none(text: Column, words: list[str]) -> Column:
    """No word occurs as a plain substring."""
    clear = F.lit(True)
    for word in words:
        clear = clear & ~F.contains(text, F.lit(word))
    return clear


def hash_order(*key: Column | str, seed: int) -> Column:
    """A repeatable random order: md5 of the key and the seed, as hex text."""
    columns = [F.col(k) if isinstance(k, str) else k for k in key]
    texts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws(":", *texts, F.lit(str(seed))))
