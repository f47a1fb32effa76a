"""Flags, weighted scores, score bands and one-hot columns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from payscope import fixed_values as V


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, 1).otherwise(0)


def points(condition: Column, weight: int | Column) -> Column:
    return F.when(condition, weight).otherwise(0)


def on(flag_column: Column) -> Column:
    return flag_column == 1


def weighted_score(terms: Iterable[tuple[Column, int | Column]]) -> Column:
    """Sum of the weights of the conditions that hold."""
    return reduce(add, [points(condition, weight) for condition, weight in terms])


def lighter_if(condition: Column, light: int, full: int) -> Column:
    """Weight that drops to ``light`` where a mitigating condition holds."""
    return F.when(condition, light).otherwise(full)


def risk_bucket(score: Column) -> Column:
    """Very Low up to 3, Low up to 7, Medium up to 15, High above."""
    return first_match([(score <= top, label) for top, label in V.RISK_BANDS], V.RISK_TOP)


def first_match(cases: Iterable[tuple[Column, object]], default: object) -> Column:
    """Value of the first condition that holds."""
    cases = list(cases)
    (condition, value), rest = cases[0], cases[1:]
    result = F.when(condition, value)
    for condition, value in rest:
        result = result.when(condition, value)
    return result.otherwise(default)


def one_hot(c: Column, values: dict[str, str]) -> dict[str, Column]:
    """One 0/1 column per value."""
    return {column: flag(c == value) for column, value in values.items()}
