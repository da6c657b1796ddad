"""Code groups from a table of rules, through an index of intervals that do not overlap."""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rules that a task holds as an index at most.
MOST_RULES = 100_000

#: Of each code system, where its intervals begin, in order, and the groups of each. A place
#: is a code and 0 before or 1 after it, so that both ends of a rule belong to it.
Index = dict[int, tuple[list[tuple[str, int]], list[list[str]]]]


def interval_index(rules: DataFrame) -> Index:
    """The rules (``code_group``, ``system``, ``low``, ``high``) cut at all their ends.

    A rule holds the code prefixes from ``low`` to ``high``, both included, in the order of
    strings; a set of codes is one rule a code. Groups may overlap in any way, and a group
    may have many rules. A rule with an end missing, or with ``low`` above ``high``, holds none.
    """
    rows = rules.select("code_group", "system", "low", "high").distinct().limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    ends: dict[int, dict[tuple[str, int], list[tuple[str, int]]]] = {}
    for r in rows:
        if None in (r["system"], r["low"], r["high"]) or r["low"] > r["high"]:
            continue
        own = ends.setdefault(r["system"], {})
        own.setdefault((r["low"], 0), []).append((r["code_group"], 1))
        own.setdefault((r["high"], 1), []).append((r["code_group"], -1))
    index: Index = {}
    for system, own in ends.items():
        open_rules, starts, groups = Counter(), [], []
        for place in sorted(own):
            for group, change in own[place]:
                open_rules[group] += change
            starts.append(place)
            groups.append(sorted(g for g, n in open_rules.items() if n > 0))
        index[system] = (starts, groups)
    return index


def groups_of_codes(codes: DataFrame, rules: DataFrame) -> DataFrame:
    """``system``, ``prefix`` and ``groups`` of the distinct prefixes of ``codes`` (``system``, ``prefix``).

    Each prefix is found by one binary search; there are no more of them than the code
    systems have, however many rows use them.
    """
    index = interval_index(rules)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for system, prefix in zip(batch.column("system").to_pylist(), batch.column("prefix").to_pylist(), strict=True):
                starts, groups = index.get(system, ([], []))
                at = bisect_right(starts, (prefix, 0.5)) - 1
                found.append(groups[at] if at >= 0 else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("system"), batch.column("prefix"), pa.array(found, pa.list_(pa.string()))],
                ["system", "prefix", "groups"],
            )

    distinct = codes.where("system IS NOT NULL AND prefix IS NOT NULL").select("system", "prefix").distinct()
    return distinct.mapInArrow(run, "system int, prefix string, groups array<string>")


def rule_flags(diagnoses: DataFrame, rules: DataFrame, key: str = "hadm_id", length: int = 3) -> DataFrame:
    """0/1 per group of the rules and key: does any code (``icd_version``, ``icd_code``) of the key fall in the group?

    The result has one column a group, in order of names. Facts meet the groups of their
    prefixes by equality, so there is no range join over them; each flag is a map-side
    combined maximum. A key without any code that has a group has zeros.
    """
    names = [r["code_group"] for r in rules.select("code_group").distinct().limit(MOST_RULES).collect()]
    codes = diagnoses.select(
        key, F.col("icd_version").cast("int").alias("system"), F.substring("icd_code", 1, length).alias("prefix")
    )
    found = codes.join(groups_of_codes(codes, rules), ["system", "prefix"], "left")
    flags = [F.max(F.when(F.array_contains("groups", n), 1).otherwise(0)).alias(n) for n in sorted(names)]
    return found.groupBy(key).agg(*flags)
