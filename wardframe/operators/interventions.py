"""What-if replacement of concepts on wrongly predicted rows.

A label model is linear before its sigmoid. Replacing concept ``i`` by a value
that differs by ``delta = old - new`` moves the logit by ``-w_i * delta``, and
letting every other concept ``v`` follow it by ``sign * r(i, v) * delta`` moves
it by ``sign * sum_v r(i, v) * w_v`` times ``delta``. Either way the effect of a
concept is one constant times its delta, so an intervention costs one
multiplication per changed concept and all of them are counted in one
aggregate, without multiplying rows by interventions.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardframe.fixed_values import (
    ALL_KINDS_SETS,
    BASE_BINARY_SETS,
    BASE_CONTINUOUS_SETS,
    C_BINARY,
    C_CONTINUOUS,
    C_TEXT,
    CONTEXT_BINARY_SETS,
    CONTEXT_CONTINUOUS_SETS,
    MULTI_LEADS,
    SINGLE_FLIP_CONCEPT,
    TEXT_SETS,
)
from wardframe.functions.measures import linear, safe_divide, sigmoid, total
from wardframe.operators.scoring import ALL_CONCEPTS, CONCEPTS, LabelModel

TRUTH, MEAN, MEDIAN, CONSTANT = "truth", "mean", "median", "const"
# A text concept has no truth to restore; it is set to what would correct the row.
WANTED = {"FN": 1.0, "FP": 0.0}


@dataclass(frozen=True)
class Intervention:
    """Replace ``concepts`` on the rows with ``outcome`` and count corrections.

    ``follow`` names the concepts that move along with the replaced ones and
    ``sign`` their direction. ``inclusive`` lets a probability of exactly one
    half correct a false positive.
    """

    name: str
    outcome: str
    concepts: tuple[str, ...]
    kind: str
    follow: tuple[str, ...] = ()
    sign: int = 1
    inclusive: bool = True


@dataclass(frozen=True)
class Setting:
    """Model under study, where its concepts come from, and replacement values."""

    label: LabelModel
    prefix: str  # predicted concepts are prefix + concept
    values: Mapping[str, float | None]  # mean or median per concept, for those kinds
    correlation: Mapping[tuple[str, str], float | None]

    def current(self, concept: str) -> Column:
        return F.col(concept if concept in C_TEXT else self.prefix + concept).cast("double")

    def replacement(self, concept: str, kind: str, outcome: str) -> Column:
        if kind == TRUTH and concept not in C_TEXT:
            return F.col(concept).cast("double")
        if kind in (TRUTH, CONSTANT):
            return F.lit(WANTED[outcome])
        return F.lit(self.values[concept]).cast("double")

    def effect(self, concept: str, item: Intervention) -> float:
        """What one unit of old minus new adds to the logit."""
        weights = self.label.weights
        moved = sum(
            (self.correlation.get((concept, other)) or 0.0) * weights.get(other, 0.0)
            for other in item.follow
            if other not in item.concepts
        )
        return item.sign * moved - weights.get(concept, 0.0)

    def logit(self) -> Column:
        return linear(self.label.weights, {c: self.current(c) for c in self.label.weights})


def new_probability(item: Intervention, setting: Setting, logit: Column) -> Column:
    shifts = [
        F.lit(setting.effect(c, item))
        * (setting.current(c) - setting.replacement(c, item.kind, item.outcome))
        for c in item.concepts
    ]
    return sigmoid(total([logit, *shifts]))


def _corrected(item: Intervention, probability: Column) -> Column:
    if item.outcome == "FN":
        return probability >= 0.5
    return probability <= 0.5 if item.inclusive else probability < 0.5


def correction_counts(
    df: DataFrame, items: Sequence[Intervention], setting: Setting, outcome: str = "outcome"
) -> DataFrame:
    """Rows (intervention, outcome, corrected, total, ratio), one per intervention.

    The ratio is null where no row has the outcome.
    """
    errors = df.where(F.col(outcome).isin("FN", "FP")).withColumn("start_logit", setting.logit())
    aggregates = [F.count_if(F.col(outcome) == o).alias(f"total_{o}") for o in ("FN", "FP")]
    for position, item in enumerate(items):
        flipped = _corrected(item, new_probability(item, setting, F.col("start_logit")))
        aggregates.append(F.count_if((F.col(outcome) == item.outcome) & flipped).alias(f"n{position}"))
    rows = [
        F.struct(
            F.lit(item.name).alias("intervention"),
            F.lit(item.outcome).alias("outcome"),
            F.col(f"n{position}").alias("corrected"),
            F.col(f"total_{item.outcome}").alias("total"),
            safe_divide(F.col(f"n{position}"), F.col(f"total_{item.outcome}")).alias("ratio"),
        )
        for position, item in enumerate(items)
    ]
    return errors.agg(*aggregates).select(F.inline(F.array(*rows)))


def flip_listing(
    df: DataFrame, key: str, items: Iterable[Intervention], setting: Setting, outcome: str = "outcome"
) -> DataFrame:
    """The corrected rows themselves, with their new probability."""
    entries = []
    for item in items:
        probability = new_probability(item, setting, F.col("start_logit"))
        entries.append(
            F.when(
                (F.col(outcome) == item.outcome) & _corrected(item, probability),
                F.struct(F.lit(item.name).alias("intervention"), probability.alias("new_prob")),
            )
        )
    errors = df.where(F.col(outcome).isin("FN", "FP")).withColumn("start_logit", setting.logit())
    listed = errors.select(key, outcome, F.explode(F.array(*entries)).alias("flip"))
    return listed.where(F.col("flip").isNotNull()).select(
        key, F.col(outcome).alias("outcome"), "flip.intervention", "flip.new_prob"
    )


def _by_number(numbers: Iterable[int], names: Sequence[str] = ALL_CONCEPTS) -> tuple[str, ...]:
    return tuple(names[n] for n in numbers)


def _each_and_set(concepts: Sequence[str], sets: tuple, names: Sequence[str], kind: str, inclusive: bool) -> list[Intervention]:
    items = []
    for outcome, chosen in zip(("FN", "FP"), sets, strict=True):
        items += [Intervention(c, outcome, (c,), kind, inclusive=inclusive) for c in concepts]
        items.append(Intervention("chosen set", outcome, _by_number(chosen, names), kind, inclusive=inclusive))
    return items


def base_binary(kind: str) -> list[Intervention]:
    return _each_and_set(C_BINARY, BASE_BINARY_SETS[kind], ALL_CONCEPTS, kind, inclusive=False)


def base_continuous(kind: str) -> list[Intervention]:
    return _each_and_set(C_CONTINUOUS, BASE_CONTINUOUS_SETS[kind], ALL_CONCEPTS, kind, inclusive=False)


def context_binary(kind: str) -> list[Intervention]:
    return _each_and_set(C_BINARY, CONTEXT_BINARY_SETS[kind], ALL_CONCEPTS, kind, inclusive=True)


def context_continuous(kind: str) -> list[Intervention]:
    return _each_and_set(C_CONTINUOUS, CONTEXT_CONTINUOUS_SETS[kind], ALL_CONCEPTS, kind, inclusive=True)


def text_concepts(kind: str) -> list[Intervention]:
    return _each_and_set(C_TEXT, TEXT_SETS[kind], C_TEXT, kind, inclusive=True)


def all_kinds(kind: str) -> list[Intervention]:
    items = []
    for outcome, (binary, continuous, text) in zip(("FN", "FP"), ALL_KINDS_SETS[kind], strict=True):
        concepts = _by_number((*binary, *continuous)) + _by_number(text, C_TEXT)
        items.append(Intervention("all kinds", outcome, concepts, kind))
    return items


def led_by_concept(kind: str) -> list[Intervention]:
    """One concept leads, all others and the text concepts follow."""
    return [
        Intervention(c, outcome, (c,), kind, ALL_CONCEPTS, sign)
        for outcome, sign in (("FN", 1), ("FP", -1))
        for c in CONCEPTS
    ]


def led_by_text(kind: str) -> list[Intervention]:
    return [Intervention(c, o, (c,), kind, ALL_CONCEPTS) for o in ("FN", "FP") for c in C_TEXT]


def led_by_several(kind: str) -> list[Intervention]:
    """Two concepts and a text concept lead at once."""
    return [
        Intervention("several leads", o, (*_by_number(leads), C_TEXT[text]), kind, ALL_CONCEPTS)
        for o, (leads, text) in zip(("FN", "FP"), MULTI_LEADS, strict=True)
    ]


def led_in_base(kind: str) -> list[Intervention]:
    """One continuous concept leads, the other continuous ones follow."""
    return [Intervention(c, o, (c,), kind, C_CONTINUOUS) for o in ("FN", "FP") for c in C_CONTINUOUS]


def single_flips() -> list[Intervention]:
    concept = ALL_CONCEPTS[SINGLE_FLIP_CONCEPT]
    return [Intervention(concept, o, (concept,), TRUTH) for o in ("FN", "FP")]
