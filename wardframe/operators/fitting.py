"""Fitting label and concept models on the prepared frame.

Weights and gradients are a few hundred numbers and live on the driver; every
pass over rows is a Spark aggregate. No model has an intercept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.fixed_values import (
    C_BINARY,
    C_CONTINUOUS,
    C_TEXT,
    CONCEPT_LABEL_WEIGHT_DECAY,
    CONCEPT_LOSS_WEIGHT,
    JOINT_WEIGHT_DECAY,
    LABEL,
    LOGISTIC_WEIGHT_DECAY,
    SEQUENTIAL_WEIGHT_DECAY,
)
from wardframe.operators.correlation import product_sums
from wardframe.operators.prepare import SPLIT
from wardframe.operators.scoring import (
    CONCEPTS,
    FEATURES,
    ConceptModel,
    LabelModel,
    score_concepts,
)
from wardframe.operators.sums import as_blocks, block_totals

SEED = 25
NEWTON_STEPS = 50
NEWTON_TOLERANCE = 1e-9
#: Passes over the rows that a joint fit takes at most.
JOINT_PASSES = 40
#: Rows that a joint pass takes at a time, so that what is made of them stays in the processor's cache.
SLICE_ROWS = 4_000
#: Steps without a validation loss lower by JOINT_GAIN (a share of it) that end a joint fit.
JOINT_WAIT, JOINT_GAIN = 2, 1e-3


def _train(frame: DataFrame) -> DataFrame:
    return frame.where(F.col(SPLIT) == "train")


@contextmanager
def _kept(rows: DataFrame) -> Iterator[DataFrame]:
    """The rows as packed blocks, held while a fit passes over them."""
    doubles = rows.select(*(F.col(c).cast("double").alias(c) for c in rows.columns))
    blocks = as_blocks(doubles).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield blocks
    finally:
        blocks.unpersist()


def _logistic_sums(batch: np.ndarray, weights: np.ndarray, targets: int) -> np.ndarray:
    """Rows, then loss, gradient and curvature of every target, summed over a batch."""
    x, y = batch[:, :-targets], batch[:, -targets:]
    parts = [np.array([len(x)])]
    for k in range(targets):
        logit = x @ weights[k]
        p = 1.0 / (1.0 + np.exp(-logit))
        loss = np.logaddexp(0.0, logit) - y[:, k] * logit
        parts += [np.array([loss.sum()]), x.T @ (p - y[:, k]), ((x * (p * (1 - p))[:, None]).T @ x).ravel()]
    return np.concatenate(parts)


def fit_logistics(
    frame: DataFrame, columns: Sequence[str], targets: Sequence[str], weight_decay: float
) -> dict[str, dict[str, float]]:
    """Cross-entropy with an L2 penalty for several 0/1 targets at once.

    Newton steps: with a few dozen columns the curvature matrix is tiny, so a
    handful of passes over the rows reach the minimum that a gradient method
    needs dozens for, and all targets share every pass.
    """
    width, many = len(columns), len(targets)
    weights = np.zeros((many, width))
    previous, losses = weights.copy(), np.full(many, np.inf)
    with _kept(_train(frame).select(*columns, *targets)) as blocks:
        for _ in range(NEWTON_STEPS):
            now = weights.copy()
            size = 1 + many * (1 + width + width * width)
            sums = block_totals(blocks, width + many, size, lambda b, w=now: _logistic_sums(b, w, many))
            moved = 0.0
            for k, part in enumerate(sums[1:].reshape(many, -1) / max(sums[0], 1.0)):
                w = now[k]
                loss = part[0] + weight_decay / 2 * w @ w
                if loss > losses[k] + 1e-12:  # overshot: go half way back
                    weights[k] = (w + previous[k]) / 2
                else:
                    gradient = part[1 : 1 + width] + weight_decay * w
                    curvature = part[1 + width :].reshape(width, width) + weight_decay * np.eye(width)
                    weights[k] = w - np.linalg.solve(curvature, gradient)
                    previous[k], losses[k] = w, loss
                moved = max(moved, float(np.abs(weights[k] - w).max()))
            if moved < NEWTON_TOLERANCE:
                break
        else:
            raise RuntimeError(f"no convergence in {NEWTON_STEPS} steps; the last moved a weight by {moved:g}")
    return {t: dict(zip(columns, map(float, weights[k]), strict=True)) for k, t in enumerate(targets)}


def logistic_slopes(
    frame: DataFrame, model: LabelModel, label: str = LABEL, weight_decay: float = LOGISTIC_WEIGHT_DECAY
) -> tuple[float, dict[str, float]]:
    """Penalised mean loss over the training rows at given weights, and its slope in each of them."""
    columns, w = list(model.weights), np.array(list(model.weights.values()))
    width = len(columns)
    with _kept(_train(frame).select(*columns, label)) as blocks:
        size = 2 + width + width * width
        sums = block_totals(blocks, width + 1, size, lambda b: _logistic_sums(b, w[None, :], 1))
    mean = sums[1:] / max(sums[0], 1.0)
    slopes = mean[1 : 1 + width] + weight_decay * w
    return float(mean[0] + weight_decay / 2 * w @ w), dict(zip(columns, map(float, slopes), strict=True))


def fit_logistic(
    frame: DataFrame,
    columns: Sequence[str] = FEATURES,
    label: str = LABEL,
    weight_decay: float = LOGISTIC_WEIGHT_DECAY,
) -> LabelModel:
    """The label from columns, fitted on the training rows."""
    return LabelModel(fit_logistics(frame, columns, [label], weight_decay)[label])


def fit_linear_concepts(
    frame: DataFrame, concepts: Sequence[str], weight_decay: float
) -> dict[str, dict[str, float]]:
    """Ridge regression of all continuous concepts at once.

    They share one loss, the mean over rows and concepts of the squared error,
    whose minimum needs only sums of products: one pass over the rows and a
    solve as wide as there are features.
    """
    columns = [*FEATURES, *concepts, "one"]
    rows = _train(frame).withColumn("one", F.lit(1.0))
    sums = product_sums(rows, columns, dict.fromkeys(columns, 0.0))
    width, trained = len(FEATURES), sums[-1, -1]
    sums = sums[:-1, :-1]
    scale = 2.0 / (trained * len(concepts))
    left = sums[:width, :width] * scale + weight_decay * np.eye(width)
    solved = np.linalg.solve(left, sums[:width, width:] * scale)
    return {c: dict(zip(FEATURES, map(float, solved[:, j]), strict=True)) for j, c in enumerate(concepts)}


def fit_concepts(frame: DataFrame, weight_decay: float = SEQUENTIAL_WEIGHT_DECAY) -> dict[str, dict[str, float]]:
    """Features to concepts: the penalised losses separate by concept kind.

    The binary loss is a mean over concepts too, so the same penalty weighs
    once per binary concept on each of them.
    """
    weights = fit_linear_concepts(frame, C_CONTINUOUS, weight_decay)
    weights |= fit_logistics(frame, FEATURES, C_BINARY, weight_decay * len(C_BINARY))
    return {c: weights[c] for c in CONCEPTS}


def fit_label_from_concepts(
    frame: DataFrame,
    predicted_by: ConceptModel | None = None,
    with_text: bool = False,
    weight_decay: float | None = None,
) -> LabelModel:
    """The label from true concepts, or from those a fitted model predicts."""
    if weight_decay is None:
        weight_decay = CONCEPT_LABEL_WEIGHT_DECAY["with_text" if with_text else "plain"]
    prefix = ""
    if predicted_by is not None:
        prefix = "predicted_"
        frame = score_concepts(frame, predicted_by, prefix)
    text = C_TEXT if with_text else ()
    fitted = fit_logistic(frame, [*(prefix + c for c in CONCEPTS), *text], LABEL, weight_decay)
    return LabelModel({name.removeprefix(prefix): w for name, w in fitted.weights.items()})


def fit_sequential(
    frame: DataFrame, with_text: bool = False, weight_decay: float = SEQUENTIAL_WEIGHT_DECAY
) -> ConceptModel:
    """Concepts first, then the label from the frozen predicted concepts."""
    concepts = fit_concepts(frame, weight_decay)
    frozen = ConceptModel(concepts, LabelModel({}))
    label = fit_label_from_concepts(frame, frozen, with_text, weight_decay)
    return ConceptModel(concepts, label)


def sequential_slopes(
    frame: DataFrame, model: ConceptModel, weight_decay: float = SEQUENTIAL_WEIGHT_DECAY
) -> dict[tuple[str, str], float]:
    """Slopes (source, target) of the losses of a sequential fit at given weights: of the concepts, then of the label.

    The model scores the training rows as it does any others; what its concepts miss,
    times the features, gives the slopes of both kinds of concept in one pass.
    """
    scored = score_concepts(frame, model, "predicted_")
    missed = [(F.col("predicted_" + c) - F.col(c)).alias("missed_" + c) for c in CONCEPTS]
    names = [*FEATURES, *("missed_" + c for c in CONCEPTS), "one"]
    rows = _train(scored).select(*FEATURES, *missed, F.lit(1.0).alias("one"))
    sums = product_sums(rows, names, dict.fromkeys(names, 0.0))
    means = sums / max(sums[-1, -1], 1.0)
    slopes = {}
    for j, c in enumerate(CONCEPTS):
        pull, decay = (2.0 / len(C_CONTINUOUS), 1) if c in C_CONTINUOUS else (1.0, len(C_BINARY))
        for i, f in enumerate(FEATURES):
            slopes[f, c] = float(pull * means[i, len(FEATURES) + j] + decay * weight_decay * model.concepts[c][f])
    named = {("predicted_" + n if n in CONCEPTS else n): w for n, w in model.label.weights.items()}
    for n, v in logistic_slopes(scored, LabelModel(named), weight_decay=weight_decay)[1].items():
        slopes[n.removeprefix("predicted_"), LABEL] = v
    return slopes


# --- joint fit -----------------------------------------------------------------


@dataclass
class Weights:
    """Feature-to-concept matrix, concept-to-label and text-to-label vectors."""

    concept: np.ndarray
    label: np.ndarray
    text: np.ndarray

    def flat(self) -> np.ndarray:
        return np.concatenate([self.concept.ravel(), self.label, self.text])

    @classmethod
    def from_flat(cls, values: np.ndarray, text: int) -> Weights:
        features, concepts = len(FEATURES), len(CONCEPTS)
        edge = features * concepts
        return cls(
            values[:edge].reshape(features, concepts),
            values[edge : edge + concepts],
            values[edge + concepts : edge + concepts + text],
        )

    @classmethod
    def start(cls, text: int, seed: int = SEED) -> Weights:
        """Uniform within one over the root of the inputs of a layer."""
        rng = np.random.default_rng(seed)
        features, concepts = len(FEATURES), len(CONCEPTS)

        def draw(inputs: int, *shape: int) -> np.ndarray:
            bound = 1.0 / np.sqrt(max(inputs, 1))
            return rng.uniform(-bound, bound, shape)

        return cls(draw(features, features, concepts), draw(concepts, concepts), draw(text, text))


def _predicted(x: np.ndarray, w: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Concepts before and after their activation: only the binary ones, which come last, have one."""
    raw = x @ w.concept
    concepts = raw.copy()
    concepts[:, len(C_CONTINUOUS) :] = 1.0 / (1.0 + np.exp(-raw[:, len(C_CONTINUOUS) :]))
    return raw, concepts


def batch_sums(x: np.ndarray, c: np.ndarray, s: np.ndarray, y: np.ndarray, w: Weights) -> tuple[float, np.ndarray]:
    """Loss and gradient of the joint loss, summed over the rows of a batch."""
    first = len(C_CONTINUOUS)
    raw, concepts = _predicted(x, w)
    logit = concepts @ w.label + s @ w.text
    error = 1.0 / (1.0 + np.exp(-logit)) - y
    miss = concepts - c
    label_loss = np.logaddexp(0.0, logit) - y * logit
    binary_loss = (np.logaddexp(0.0, raw[:, first:]) - c[:, first:] * raw[:, first:]).mean(axis=1)
    continuous_loss = (miss[:, :first] ** 2).mean(axis=1)
    loss = label_loss.sum() + CONCEPT_LOSS_WEIGHT * (binary_loss.sum() + continuous_loss.sum())
    into_raw = np.outer(error, w.label)
    into_raw[:, first:] *= concepts[:, first:] * (1.0 - concepts[:, first:])
    miss[:, :first] *= CONCEPT_LOSS_WEIGHT * (2.0 / len(C_CONTINUOUS))
    miss[:, first:] *= CONCEPT_LOSS_WEIGHT * (1.0 / len(C_BINARY))
    into_raw += miss
    gradient = np.concatenate([(x.T @ into_raw).ravel(), concepts.T @ error, s.T @ error])
    return float(loss), gradient


def _upper(size: int) -> np.ndarray:
    return np.triu(np.ones((size, size), bool))


def _whole(half: np.ndarray, size: int) -> np.ndarray:
    """A symmetric matrix out of its upper half."""
    matrix = np.zeros((size, size))
    matrix[_upper(size)] = half
    return matrix + np.triu(matrix, 1).T


def _curvature_sizes(text: int) -> tuple[int, int]:
    """Columns that all lines of the curvature are made of, and the numbers that ``curvature_sums`` returns."""
    features, binary = len(FEATURES), len(C_BINARY)
    columns = features * (1 + binary) + binary + text
    return columns, columns * (columns + 1) // 2 + (1 + binary) * features * (features + 1) // 2


def curvature_sums(x: np.ndarray, s: np.ndarray, w: Weights) -> np.ndarray:
    """What ``gauss_newton`` needs of the rows of a batch: sums of products of few columns.

    A continuous concept is linear in the features, so what goes through it is a
    constant times products of features; only the binary ones bend row by row. Some
    70 columns (features, features times each binary slope, binary concepts, texts)
    carry the products of all some 300 weights.
    """
    _, concepts = _predicted(x, w)
    bent = concepts[:, len(C_CONTINUOUS) :]
    slope = bent * (1.0 - bent)
    p = 1.0 / (1.0 + np.exp(-(concepts @ w.label + s @ w.text)))
    weight = np.sqrt(p * (1.0 - p))[:, None]
    features, many = len(FEATURES), slope.shape[1]
    columns = np.empty((len(x), _curvature_sizes(s.shape[1])[0]))
    np.multiply(x, weight, out=columns[:, :features])
    for b in range(many):
        np.multiply(columns[:, :features], slope[:, [b]], out=columns[:, features * (1 + b) : features * (2 + b)])
    np.multiply(bent, weight, out=columns[:, features * (1 + many) : features * (1 + many) + many])
    np.multiply(s, weight, out=columns[:, features * (1 + many) + many :])
    # a product of a matrix with itself takes half the work of one of two
    parts = [(columns.T @ columns)[_upper(columns.shape[1])]]
    for part in (np.ascontiguousarray(x), *(x * np.sqrt(slope[:, [b]]) for b in range(many))):
        parts.append((part.T @ part)[_upper(features)])
    return np.concatenate(parts)


def gauss_newton(sums: np.ndarray, w: Weights) -> np.ndarray:
    """Gauss-Newton matrix of the joint loss from ``curvature_sums``.

    The outputs (label and concepts) are taken as linear in the weights, and the losses
    as they bend in the outputs, so the matrix has no negative direction.
    """
    features, many, first, text = len(FEATURES), len(CONCEPTS), len(C_CONTINUOUS), w.text.size
    columns, _ = _curvature_sizes(text)
    edge, products = features * many, columns * (columns + 1) // 2
    # how each weight's line is made of the columns
    made = np.zeros((columns, w.flat().size))
    for k in range(many):
        block = 0 if k < first else (1 + k - first) * features
        made[np.arange(block, block + features), np.arange(features) * many + k] = w.label[k]
        if k < first:
            made[:features, edge + k] = w.concept[:, k]
        else:
            made[features * (1 + many - first) + k - first, edge + k] = 1.0
    made[columns - text :, edge + many :] = np.eye(text)
    total = made.T @ _whole(sums[:products], columns) @ made
    own = [_whole(part, features) for part in sums[products:].reshape(1 + many - first, -1)]
    for k in range(many):
        share = 2.0 / first if k < first else 1.0 / (many - first)
        place = np.arange(features) * many + k
        total[np.ix_(place, place)] += CONCEPT_LOSS_WEIGHT * share * own[0 if k < first else 1 + k - first]
    return total


def batch_curvature(x: np.ndarray, s: np.ndarray, w: Weights) -> np.ndarray:
    """Gauss-Newton matrix of the joint loss, summed over the rows of a batch."""
    return gauss_newton(curvature_sums(x, s, w), w)


@dataclass
class JointStep:
    """Mean losses, mean training gradient and, if asked for, the mean Gauss-Newton matrix."""

    train_loss: float
    valid_loss: float
    gradient: np.ndarray
    curvature: np.ndarray | None = None


def joint_step(blocks: DataFrame, w: Weights, text: Sequence[str], curvature: bool = False) -> JointStep:
    """The joint losses at given weights: one job per call.

    Blocks hold features, concepts, text concepts, label and a mark for training
    rows. Of the curvature a task returns some 3,000 sums, not the matrix.
    """
    features, concepts, width = len(FEATURES), len(CONCEPTS), len(text)
    many = w.flat().size
    size = 4 + many + (_curvature_sizes(width)[1] if curvature else 0)

    def sums_of(batch: np.ndarray) -> np.ndarray:
        total = np.zeros(size)
        for start in range(0, len(batch), SLICE_ROWS):
            rows = batch[start : start + SLICE_ROWS]
            for train, place in ((True, 0), (False, 2)):
                part = rows[(rows[:, -1] == 1.0) == train]
                x, c = part[:, :features], part[:, features : features + concepts]
                s = part[:, features + concepts : features + concepts + width]
                loss, gradient = batch_sums(x, c, s, part[:, -2], w)
                total[place : place + 2] += len(part), loss
                if train:
                    total[4 : 4 + many] += gradient
                    if curvature:
                        total[4 + many :] += curvature_sums(x, s, w)
        return total

    sums = block_totals(blocks, features + concepts + width + 2, size, sums_of)
    train_rows, train_loss, valid_rows, valid_loss = sums[:4]
    step = JointStep(
        train_loss / max(train_rows, 1), valid_loss / max(valid_rows, 1), sums[4 : 4 + many] / max(train_rows, 1)
    )
    if curvature:
        step.curvature = gauss_newton(sums[4 + many :] / max(train_rows, 1), w)
    return step


def _joint_rows(frame: DataFrame, text: Sequence[str]) -> DataFrame:
    is_train = (F.col(SPLIT) == "train").cast("double")
    return frame.where(F.col(SPLIT).isin("train", "validation")).select(
        *FEATURES, *CONCEPTS, *text, LABEL, is_train.alias("is_train")
    )


def joint_slopes(frame: DataFrame, model: ConceptModel) -> tuple[float, float, Weights]:
    """Mean joint loss on training and validation rows at given weights, and the slope of the first."""
    text = [name for name in C_TEXT if name in model.label.weights]
    concept = np.array([[model.concepts[c][f] for c in CONCEPTS] for f in FEATURES])
    label = model.label.weights
    w = Weights(concept, np.array([label[c] for c in CONCEPTS]), np.array([label[c] for c in text]))
    with _kept(_joint_rows(frame, text)) as blocks:
        step = joint_step(blocks, w, text)
    return float(step.train_loss), float(step.valid_loss), Weights.from_flat(step.gradient, len(text))


@dataclass
class JointFit:
    model: ConceptModel
    train_losses: list[float] = field(default_factory=list)
    validation_losses: list[float] = field(default_factory=list)


def fit_joint(
    frame: DataFrame,
    with_text: bool = False,
    passes: int = JOINT_PASSES,
    weight_decay: float = JOINT_WEIGHT_DECAY,
    wait: int = JOINT_WAIT,
) -> JointFit:
    """Concepts and label together, by damped Gauss-Newton steps with early stopping.

    Every pass takes losses, gradient and curvature at one point. A step that lowers the
    penalised training loss is taken, and the damping follows how well the curvature foretold
    the fall; one that does not is tried again shorter. The weights with the lowest validation
    loss are kept; the fit stops after ``wait`` steps without one that is clearly lower.
    """
    text = C_TEXT if with_text else ()
    values = Weights.start(len(text)).flat()
    fit = JointFit(ConceptModel({}, LabelModel({})))

    with _kept(_joint_rows(frame, text)) as blocks:

        def at(point: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
            step = joint_step(blocks, Weights.from_flat(point, len(text)), text, curvature=True)
            fit.train_losses.append(step.train_loss)
            fit.validation_losses.append(step.valid_loss)
            loss = step.train_loss + weight_decay / 2 * point @ point
            ridge = weight_decay * np.eye(point.size)
            return loss, step.gradient + weight_decay * point, step.curvature + ridge

        loss, gradient, curvature = at(values)
        best, best_loss, waited = values, fit.validation_losses[0], 0
        damping, harder = 1e-2, 2.0
        while len(fit.train_losses) < passes and waited < wait:
            damped = curvature + damping * np.diag(np.diag(curvature))
            move = -np.linalg.solve(damped, gradient)
            foretold = -(gradient @ move + move @ curvature @ move / 2)
            if foretold < NEWTON_TOLERANCE:
                break
            there = at(values + move)
            gain = (loss - there[0]) / foretold
            if gain <= 0 or not np.isfinite(gain):
                damping, harder = damping * harder, harder * 2
                continue
            values = values + move
            loss, gradient, curvature = there
            damping, harder = max(1e-9, damping * max(1 / 5, 1 - (2 * gain - 1) ** 3)), 2.0
            valid = fit.validation_losses[-1]
            waited = 0 if valid < best_loss * (1 - JOINT_GAIN) else waited + 1
            if valid < best_loss:
                best, best_loss = values, valid
    w = Weights.from_flat(best, len(text))
    concepts = {c: dict(zip(FEATURES, map(float, w.concept[:, j]), strict=True)) for j, c in enumerate(CONCEPTS)}
    label = dict(zip((*CONCEPTS, *text), map(float, np.concatenate([w.label, w.text])), strict=True))
    fit.model = ConceptModel(concepts, LabelModel(label))
    return fit
