"""Document quality by hierarchical empirical Bayes.

A classifier reads the text; the labelled documents of a host, and of a path
within it, say how good the site is. A site's posterior is a beta posterior
around the level above it (path around host, host around all), so a site with
few labels hardly departs from the prior. Evidence and site add up as log-odds.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardframe.llm.texts import byte_values, schema_with, slices, with_columns
from wardframe.session import materialize

#: Labelled documents that the text classifier is fitted on, about.
SAMPLE = 6_000
#: Documents whose probability of being good is below this are rejected.
REJECT_BELOW = 0.5
#: How much a step of log-odds between site and corpus may weigh against the text.
SITE_WEIGHT = 1.0
SLICE_BYTES = 4 << 20
_UPPER, _LETTERS = slice(65, 91), np.r_[65:91, 97:123, 128:256]
_ODD = np.frombuffer(b"!#$%&*+/<=>@\\^_`{|}~", dtype=np.uint8)


def features(data: bytes | None) -> np.ndarray:
    """Numbers on a whole text: shares of kinds of bytes, repetition of words and lines, length."""
    data = data or b""
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256).astype(np.float64)
    n = max(1.0, counts.sum())
    words = distinct = twice = 0
    last = None
    for at in range(0, len(data), 1 << 20):  # a word that is cut counts as two
        for word in (part := data[at : at + (1 << 20)].split()):
            twice += word == last
            last = word
        words += len(part)
        distinct += len(set(part))  # within a piece, so that memory stays bounded
    w = max(1, words)
    letters = counts[_LETTERS].sum()
    lone = counts[_ODD].sum()
    return np.array(
        [
            1.0,
            np.log1p(words) / 10,
            letters / n,
            counts[_UPPER].sum() / max(1.0, letters),
            np.sqrt(lone / n),
            np.sqrt(counts[ord("|")] / n),
            np.sqrt(counts[ord("!")] / n),
            counts[48:58].sum() / n,
            np.sqrt(twice / w),
            distinct / w,
            np.sqrt(distinct / w),
            (n - counts[32] - counts[10]) / (w * 10),
            counts[46] / w,
            counts[10] / w,
        ]
    )


@dataclass
class TextClassifier:
    """Logistic regression on standardised features and their squares."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    base: float  # log-odds of the sample, to be taken out of the evidence

    @classmethod
    def fit(cls, rows: np.ndarray, good: np.ndarray, ridge: float = 1.0) -> TextClassifier:
        mean, scale = rows.mean(0), rows.std(0) + 1e-6
        mean[0], scale[0] = 0.0, 1.0
        x = cls._expanded((rows - mean) / scale)
        penalty = np.full(x.shape[1], ridge)
        penalty[0] = 1e-6
        weights = np.zeros(x.shape[1])
        for _ in range(50):  # Newton steps; the ridge keeps them finite
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            slope = x.T @ (p - good) + penalty * weights
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), slope)
            size = np.abs(step).max()
            weights -= step * min(1.0, 5.0 / max(size, 1e-12))
            if size < 1e-6:
                break
        return cls(mean, scale, weights, _log_odds((good.sum() + 0.5) / (len(good) + 1)))

    @staticmethod
    def _expanded(z: np.ndarray) -> np.ndarray:
        z = np.clip(z, -6, 6)
        return np.concatenate([z, z[:, 1:] ** 2], axis=1)

    def evidence(self, rows: np.ndarray) -> np.ndarray:
        """Log of how much likelier the text is among good documents than among poor ones."""
        return self._expanded((rows - self.mean) / self.scale) @ self.weights - self.base


def _log_odds(p: float) -> float:
    return float(np.log(p / (1 - p)))


@dataclass
class Sites:
    """Columns that name a document's host and its path within the host."""

    host: Column
    path: Column


def document_sites() -> Sites:
    """In ``documents`` a source is a host, and the section of one language is a path."""
    return Sites(F.coalesce(F.col("source"), F.lit("")), F.coalesce(F.col("lang"), F.lit("")))


def _labelled(docs: DataFrame, labels: DataFrame, sites: Sites) -> DataFrame:
    """``doc_id``, text, host, path and ``good`` of labelled documents; an id labelled twice counts once."""
    once = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min(F.col("quality").cast("double")).alias("good"))
    )
    rows = docs.select(
        F.col("doc_id"), F.col("text").cast("string").alias("t"), sites.host.alias("host"), sites.path.alias("path")
    )
    return rows.join(once, "doc_id")


def fit_text_classifier(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> TextClassifier | None:
    """Fit on about ``sample`` labelled documents, chosen by a hash of their id; None without both classes.

    Features are made in the tasks; the driver gets a few numbers a document. Rows that
    share an id count once, so an id with a third of all rows does not enlarge the sample.
    """
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    n = marks.agg(F.count("*")).first()[0]
    scale = 1 << 20
    share = min(scale, -(-scale * sample // max(1, n)))
    chosen = (
        marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < share)
        .groupBy("doc_id")
        .agg(F.min(F.col("quality").cast("double")).alias("good"))
    )
    texts = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < share).select(
        "doc_id", F.col("text").cast("string").alias("t")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t", SLICE_BYTES):
            rows = [features(d).tolist() for d in byte_values(batch.column("t"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "x"]
            )

    kind = texts.schema["doc_id"].dataType.simpleString()
    made = texts.mapInArrow(run, f"doc_id {kind}, x array<double>")
    once = made.join(chosen, "doc_id").groupBy("doc_id").agg(F.min(F.struct("good", "x")).alias("row"))
    rows = sorted((r["doc_id"], r["row"]["good"], r["row"]["x"]) for r in once.collect())
    good = np.array([r[1] > 0.5 for r in rows], dtype=np.float64)
    if len(rows) == 0 or good.min() == good.max():
        return None
    return TextClassifier.fit(np.array([r[2] for r in rows]), good)


def _strength(counts: DataFrame) -> float:
    """How many labels the prior of a level is worth, by the method of moments.

    The spread of site means beyond what chance makes is the spread of the
    prior; the less there is, the more labels the prior is worth.
    """
    row = counts.where("n > 1").agg(
        F.sum("n").alias("n"),
        F.count("*").alias("sites"),
        F.sum("good").alias("good"),
        F.sum(F.col("good") * F.col("good") / F.col("n")).alias("squares"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
    ).first()
    n, sites = float(row["n"] or 0), float(row["sites"] or 0)
    if sites < 3 or n <= sites:
        return 50.0
    p = float(row["good"]) / n
    between = float(row["squares"]) - n * p * p  # weighted squares of site means around p
    chance = p * (1 - p)
    spread = max(0.0, (between - (sites - 1) * chance) / max(1e-9, n - float(row["nn"]) / n - (sites - 1)))
    return float(np.clip(chance / spread - 1 if spread > 0 else 1e4, 2.0, 1e4))


def site_posteriors(docs: DataFrame, labels: DataFrame, sites: Sites) -> DataFrame:
    """``host``, ``path``, ``host_rate``, ``path_rate`` of every site with labels, and the rate of all (``rate``).

    Counts cover all labelled documents and are summed before they are
    shuffled, so a host with a third of all documents is one row per task.
    """
    paths = materialize(
        _labelled(docs, labels, sites)
        .groupBy("host", "path")
        .agg(F.sum("good").alias("good"), F.count("*").cast("double").alias("n")),
        "site-labels",
    )
    hosts = materialize(paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n")), "host-labels")
    total = hosts.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    rate = ((total["good"] or 0.0) + 1) / ((total["n"] or 0.0) + 2)
    of_host, of_path = _strength(hosts), _strength(paths)
    rated = hosts.select(
        "host", ((F.col("good") + F.lit(of_host * rate)) / (F.col("n") + F.lit(of_host))).alias("host_rate")
    )
    return paths.join(rated, "host").select(
        "host",
        "path",
        "host_rate",
        ((F.col("good") + of_path * F.col("host_rate")) / (F.col("n") + of_path)).alias("path_rate"),
        F.lit(rate).alias("rate"),
    )


ADDED = "quality_evidence double, quality_host_rate double, quality_path_rate double, quality_score double"


def score(
    docs: DataFrame, labels: DataFrame, sites: Sites | None = None, sample: int = SAMPLE, site_weight: float = SITE_WEIGHT
) -> DataFrame:
    """``docs`` with evidence of the text, rates of its site and the probability that it is good.

    Columns added (in place of any of that name): ``quality_evidence`` (log of
    the likelihood ratio), ``quality_host_rate``, ``quality_path_rate`` (the
    rate of all where a site has no labels) and ``quality_score``. A null text
    counts as empty; null hosts and paths are the site "". Without labels of
    both classes the evidence is 0 and rates decide.
    """
    spark = docs.sparkSession
    sites = sites or document_sites()
    classifier = spark.sparkContext.broadcast(fit_text_classifier(docs, labels, sample))  # a few dozen numbers
    posteriors = materialize(site_posteriors(docs, labels, sites), "site-rates")
    overall = posteriors.agg(F.max("rate")).first()[0]
    overall = 0.5 if overall is None else overall

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = classifier.value
        for batch in slices(batches, "text", SLICE_BYTES):
            texts = byte_values(batch.column("text"))
            found = np.zeros(len(texts))
            if fitted is not None and texts:
                found = fitted.evidence(np.array([features(d) for d in texts]))
            yield with_columns(batch, {"quality_evidence": pa.array(found, pa.float64())})

    bare = docs.drop("quality_host_rate", "quality_path_rate", "quality_score")
    read = bare.mapInArrow(run, schema_with(bare, "quality_evidence double"))
    hosts = posteriors.groupBy("host").agg(F.max("host_rate").alias("__any_host_rate"))
    rates = posteriors.select(
        F.col("host").alias("__host"), F.col("path").alias("__path"), F.col("host_rate").alias("__host_rate"),
        F.col("path_rate").alias("__path_rate"),
    )
    keyed = read.withColumns({"__host": sites.host, "__path": sites.path})
    joined = keyed.join(rates, ["__host", "__path"], "left")
    joined = joined.join(hosts.withColumnRenamed("host", "__host"), "__host", "left")
    host_rate = F.coalesce("__host_rate", "__any_host_rate", F.lit(overall))
    path_rate = F.coalesce("__path_rate", host_rate)
    odds = F.log(path_rate / (1 - path_rate))
    prior = float(np.log(overall / (1 - overall)))
    logit = F.col("quality_evidence") + F.lit(prior) + F.lit(site_weight) * (odds - F.lit(prior))
    return joined.withColumns(
        {
            "quality_host_rate": host_rate,
            "quality_path_rate": path_rate,
            "quality_score": F.lit(1.0) / (1 + F.exp(-logit)),
        }
    ).drop("__host", "__path", "__host_rate", "__path_rate", "__any_host_rate")


def accepted(docs: DataFrame, labels: DataFrame, reject_below: float = REJECT_BELOW) -> DataFrame:
    """The documents whose probability of being good is not below ``reject_below``, with all their columns."""
    aside = {c: f"__kept_{c}" for c in docs.columns if c.startswith("quality_")}
    scored = score(docs.withColumnsRenamed(aside), labels)
    kept = scored.where(F.col("quality_score") >= reject_below)
    return kept.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])
