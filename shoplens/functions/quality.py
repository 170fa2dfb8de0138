"""Validation rules with codes (V1)."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# rule codes (fixed values)
NULL_VALUE = 1001
EMPTY_LIST = 1002
EMPTY_STRING = 1003
NOT_POSITIVE = 1004


class Validated(NamedTuple):
    valid: DataFrame
    rejected: DataFrame


def rule_code(column: str, rule: str) -> Column:
    """The code of a broken rule, null when the value is fine."""
    value = F.col(column)
    if rule == "not_null":
        return F.when(value.isNull(), NULL_VALUE)
    if rule == "not_empty_list":
        return F.when(value.isNull() | (F.size(value) <= 0), EMPTY_LIST)
    if rule == "not_empty_str":
        return F.when(value.isNull() | (value == ""), EMPTY_STRING)
    if rule == "positive":
        return F.when(value.isNull(), NULL_VALUE).when(value <= 0, NOT_POSITIVE)
    raise ValueError(f"unknown rule {rule!r}")


def validate(df: DataFrame, rules: list[tuple[str, str]]) -> Validated:
    """Rows that keep all rules, and the others with the ``code`` of the first broken one."""
    code = F.coalesce(*(rule_code(column, rule) for column, rule in rules)).cast("int")
    return Validated(df.where(code.isNull()), df.withColumn("code", code).where("code IS NOT NULL"))
