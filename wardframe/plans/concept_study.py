"""A scored study: both concept models on one split, ready for what-if questions."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.fixed_values import LABEL
from wardframe.operators import fitting
from wardframe.operators.correlation import correlation_matrix
from wardframe.operators.interventions import MEAN, MEDIAN, Setting
from wardframe.operators.metrics import outcome
from wardframe.operators.prepare import SPLIT, prepared
from wardframe.operators.scoring import ALL_CONCEPTS, ConceptModel, score_model
from wardframe.operators.statistics import ColumnStats, column_stats
from wardframe.session import materialize

BASE, CONTEXT = "base_", "context_"


def score_both(rows: DataFrame, base: ConceptModel, context: ConceptModel) -> DataFrame:
    """Predicted concepts, probabilities and outcomes of both models."""
    scored = score_model(rows, base, BASE, "base_prob")
    scored = score_model(scored, context, CONTEXT, "context_prob")
    return scored.withColumns(
        {
            "base_outcome": outcome(F.col(LABEL), F.col("base_prob")),
            "context_outcome": outcome(F.col(LABEL), F.col("context_prob")),
        }
    )


@dataclass(frozen=True)
class ConceptStudy:
    """``frame`` is the prepared frame and ``scored`` the written scores of one split.

    The second model differs by the text concepts in its label layer. Statistics
    and fitted models, a few hundred numbers, are computed once and kept.
    """

    frame: DataFrame
    stats: Mapping[str, ColumnStats]
    base: ConceptModel
    context: ConceptModel
    split: str
    scored: DataFrame
    kept: dict[tuple, Any] = field(default_factory=dict, repr=False, compare=False)

    def _once(self, name: tuple, compute: Callable[[], Any]) -> Any:
        if name not in self.kept:
            self.kept[name] = compute()
        return self.kept[name]

    @classmethod
    def build(
        cls, frame: DataFrame, base: ConceptModel, context: ConceptModel, split: str = "test"
    ) -> ConceptStudy:
        """Prepare a modelling frame and score one split with both models.

        The scores are written before anything asks about them: a filter on an
        outcome would otherwise be pushed below the scoring with a copy of the
        whole model for every mention of a probability.
        """
        ready, stats = prepared(frame)
        rows = ready.where(F.col(SPLIT) == split)
        scored = materialize(score_both(rows, base, context), "scored")
        return cls(ready, stats, base, context, split, scored)

    def replacements(self, kind: str, stats_from: str | None = None) -> Mapping[str, float | None]:
        """Mean or median of the true concepts, by default of the studied split."""
        own = stats_from or self.split
        return self._once(("replacements", kind, own), lambda: self._replacements(kind, own))

    def _replacements(self, kind: str, stats_from: str) -> Mapping[str, float | None]:
        if stats_from == self.split:
            source = self.scored
        else:
            source = self.frame.where(F.col(SPLIT) == stats_from)
        stats = column_stats(source, ALL_CONCEPTS, (0.5,) if kind == MEDIAN else ())
        return {c: s.median if kind == MEDIAN else s.mean for c, s in stats.items()}

    def setting(
        self,
        enhanced: bool,
        kind: str,
        predicted_by: str | None = None,
        correlated: bool = False,
        stats_from: str | None = None,
    ) -> Setting:
        """What an intervention needs; only the statistics its kind uses are computed."""
        return Setting(
            label=(self.context if enhanced else self.base).label,
            prefix=predicted_by or (CONTEXT if enhanced else BASE),
            values=self.replacements(kind, stats_from) if kind in (MEAN, MEDIAN) else {},
            correlation=self._correlation() if correlated else {},
        )

    def _correlation(self) -> Any:
        return self._once(("correlation",), lambda: correlation_matrix(self.scored, ALL_CONCEPTS))

    def joint_model(self, with_text: bool = False) -> ConceptModel:
        """The model that the joint fit finds on the prepared frame."""
        return self._once(("joint", with_text), lambda: fitting.fit_joint(self.frame, with_text=with_text).model)
