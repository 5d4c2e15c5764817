"""Ordered keyword rules compiled to one conditional expression."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from requestlens import fixed_values as V


def contains_any(texts: Sequence[Column], words: Iterable[str]) -> Column:
    return reduce(or_, [text.contains(word) for word in words for text in texts])


def first_label(texts: Sequence[Column], rules: Iterable[tuple[str, Sequence[str]]], otherwise: str) -> Column:
    """Label of the first rule one of whose words occurs in any of the texts."""
    branches = iter(rules)
    label, words = next(branches)
    result = F.when(contains_any(texts, words), label)
    for label, words in branches:
        result = result.when(contains_any(texts, words), label)
    return result.otherwise(otherwise)


def complaint_category(complaint_type: Column) -> Column:
    return first_label([F.lower(complaint_type)], V.CATEGORY_RULES, V.OTHER_CATEGORY)


def keyword_category(complaint_type: Column, descriptor: Column) -> Column:
    texts = [F.lower(F.coalesce(text, F.lit(""))) for text in (complaint_type, descriptor)]
    return first_label(texts, V.KEYWORD_RULES, V.OTHER_KEYWORD)


def is_emergency(complaint_type: Column) -> Column:
    return F.coalesce(contains_any([F.lower(complaint_type)], V.EMERGENCY_WORDS), F.lit(False))
