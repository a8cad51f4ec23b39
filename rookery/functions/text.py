"""Small text and arithmetic helpers with NULL-on-no-match semantics."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def first_group(text: Column, pattern: str) -> Column:
    """First capture group, or NULL when nothing matched or the group is empty."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def all_groups(text: Column, pattern: str, group: int = 1) -> Column:
    """Every match of one capture group, as an array."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def last_segment(url: Column) -> Column:
    """The last path segment of a URL, one trailing slash ignored."""
    bare = F.when(F.endswith(url, F.lit("/")), F.left(url, F.length(url) - 1)).otherwise(url)
    return blank_to_null(F.substring_index(bare, "/", -1))


def to_long(text: Column) -> Column:
    """Number in a text; text that is no 64-bit number gives NULL."""
    return text.try_cast("bigint")


def greatest_number(text: Column, pattern: str) -> Column:
    """Largest number captured by ``pattern``; NULL when there is none.

    The cast runs on the whole array, which keeps the expression inside
    generated code (a lambda would not).
    """
    return F.array_max(all_groups(text, pattern).try_cast("array<bigint>"))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def rate(part: Column, whole: Column) -> Column:
    """Share as a double; NULL instead of an error on an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def share(condition: Column) -> Column:
    """Aggregate: fraction of the group's rows that satisfy ``condition``."""
    return rate(F.count_if(condition), F.count(F.lit(1)))


def json_field(text: Column, path: str) -> Column:
    """One JSON field as text; NULL for missing fields and broken JSON."""
    return F.get_json_object(text, path)
