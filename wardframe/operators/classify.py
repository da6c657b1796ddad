"""Diagnosis codes to group flags and severity bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardframe.fixed_values import RESPIRATORY_CODE_GROUPS
from wardframe.functions.measures import total

Rule = tuple[str, str] | frozenset[str]


def split_codes(diagnoses: DataFrame) -> DataFrame:
    """One column per code system; null in the other."""
    version, code = F.col("icd_version"), F.col("icd_code")
    return diagnoses.select(
        "hadm_id",
        F.when(version == 9, code).alias("icd9_code"),
        F.when(version == 10, code).alias("icd10_code"),
    )


def _matches(code: Column, rule: Rule) -> Column:
    prefix = F.substring(code, 1, 3)
    if isinstance(rule, frozenset):
        return prefix.isin(sorted(rule))
    return prefix.between(*rule)


def group_flags(
    split: DataFrame,
    key: str = "hadm_id",
    groups: Mapping[str, Sequence[Rule]] = RESPIRATORY_CODE_GROUPS,
) -> DataFrame:
    """0/1 per group and key: does any code of the key fall in the group?

    Every flag is a map-side-combined maximum, so a key with very many codes
    reaches the shuffle as one row per task.
    """
    systems = ("icd9_code", "icd10_code")
    flags = []
    for name, rules in groups.items():
        hit = reduce(Column.__or__, (_matches(F.col(c), r) for c, r in zip(systems, rules, strict=True)))
        flags.append(F.max(F.when(hit, 1).otherwise(0)).alias(name))
    return split.groupBy(key).agg(*flags)


def severity_bands(groups: Sequence[str] = tuple(RESPIRATORY_CODE_GROUPS)) -> list[Column]:
    """Moderate: one or two groups; severe: three or more; 0 when unknown."""
    found = total(F.col(name) for name in groups)
    return [
        F.when(found.isin(1, 2), 1).otherwise(0).alias("c_mod_resp_comorbidity"),
        F.when(found >= 3, 1).otherwise(0).alias("c_svr_resp_comorbidity"),
    ]
