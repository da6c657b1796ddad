"""Language identification by a small convolutional network over bytes.

Filters of several widths slide over one-hot bytes, so a filter is a table of
(offset, byte) weights and a convolution adds up looked-up rows. The largest
response of each filter in a window goes through a softmax. Trained in numpy.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardframe.llm.texts import byte_values, slices

#: Bytes of a window, widths of filters, filters of each width.
WINDOW, WIDTHS, FILTERS = 256, (2, 3, 4), 8
#: Documents of each language that training looks at, at most about.
SAMPLE_PER_LANGUAGE = 400
#: Windows of each of these documents, spread over the whole text.
SAMPLE_WINDOWS = 3
SLICE_BYTES = 1 << 20
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Network:
    languages: list[str]
    tables: list[np.ndarray] = field(default_factory=list)  # per width: (width, 256, filters)
    biases: list[np.ndarray] = field(default_factory=list)  # per width: (filters,)
    weights: np.ndarray | None = None  # (filters of all widths, languages)
    offset: np.ndarray | None = None  # (languages,)

    def responses(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The largest response of each filter in each window, and where it is."""
        best, places = [], []
        for table, bias in zip(self.tables, self.biases, strict=True):
            width = len(table)
            span = windows.shape[1] - width + 1
            sums = table[0].take(windows[:, :span], axis=0)
            for k in range(1, width):
                sums += table[k].take(windows[:, k : k + span], axis=0)
            at = sums.argmax(axis=1)
            best.append(np.take_along_axis(sums, at[:, None], 1)[:, 0] + bias)
            places.append(at)
        return np.maximum(np.concatenate(best, axis=1), 0), places

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        best = []
        for table, bias in zip(self.tables, self.biases, strict=True):
            width = len(table)
            span = windows.shape[1] - width + 1
            sums = table[0].take(windows[:, :span], axis=0)
            for k in range(1, width):
                sums += table[k].take(windows[:, k : k + span], axis=0)
            best.append(sums.max(axis=1) + bias)
        return np.maximum(np.concatenate(best, axis=1), 0)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        return _softmax(self.pooled(windows) @ self.weights + self.offset)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def windows_of(data: bytes) -> np.ndarray:
    """The whole text in windows of fixed length, the last filled up with zero bytes."""
    n = max(1, -(-len(data) // WINDOW))
    return np.frombuffer(data.ljust(n * WINDOW, b"\0"), dtype=np.uint8).reshape(n, WINDOW)


def train(
    windows: np.ndarray, classes: np.ndarray, languages: list[str], epochs: int = 12, rate: float = 0.02, seed: int = 7
) -> Network:
    """Fit by Adam on mini-batches; only the winning place of a filter gets a gradient."""
    random = np.random.default_rng(seed)
    net = Network(
        languages,
        [random.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        random.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    parameters = [*net.tables, *net.biases, net.weights, net.offset]
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(windows))
        for begin in range(0, len(order), 64):
            x, y = windows[order[begin : begin + 64]], classes[order[begin : begin + 64]]
            hidden, places = net.responses(x)
            p = _softmax(hidden @ net.weights + net.offset)
            p[np.arange(len(y)), y] -= 1
            p /= len(y)
            back = (p @ net.weights.T) * (hidden > 0)
            slopes = []
            for i, (table, at) in enumerate(zip(net.tables, places, strict=True)):
                part = back[:, i * FILTERS : (i + 1) * FILTERS]
                slope = np.zeros_like(table)
                for k in range(len(table)):
                    seen = np.take_along_axis(x, at + k, axis=1)
                    np.add.at(slope[k], (seen, np.arange(FILTERS)[None, :]), part)
                slopes.append(slope)
            slopes += [back[:, i * FILTERS : (i + 1) * FILTERS].sum(0) for i in range(len(WIDTHS))]
            slopes += [hidden.T @ p, p.sum(0)]
            step += 1
            for value, slope, m, v in zip(parameters, slopes, first, second, strict=True):
                m += 0.1 * (slope - m)
                v += 0.001 * (slope * slope - v)
                value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def held_out(id_column: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_language_network(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
) -> Network | None:
    """Train on a sample of labelled documents that are not held out; None without any.

    All such documents are counted per language; a hash of id and text then picks
    about ``per_language`` of each, so the driver holds a bounded number of
    windows whatever the size of the corpus. Windows are drawn in the tasks,
    from all over the text; equal ones count once.
    """
    labelled = docs.select(
        F.col(id_column).alias("k"), F.col(text_column).cast("string").alias("t"), F.col(label_column).alias("l")
    ).where(F.col("k").isNotNull() & F.col("t").isNotNull() & F.col("l").isNotNull() & ~held_out(F.col("k")))
    counts = {r["l"]: r["n"] for r in labelled.groupBy("l").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    scale = 1 << 20
    chosen = F.create_map(
        *[F.lit(x) for l, n in counts.items() for x in (l, min(scale, -(-scale * per_language // n)))]
    )[F.col("l")]

    def draw(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, windows = [], []
            for data, label in zip(byte_values(batch.column("t")), batch.column("l").to_pylist(), strict=True):
                starts = np.unique(np.linspace(0, max(0, len(data) - WINDOW), SAMPLE_WINDOWS).astype(int))
                labels += [label] * len(starts)
                windows += [data[s : s + WINDOW].ljust(WINDOW, b"\0") for s in starts]
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(windows, pa.binary())], ["l", "w"])

    sample = labelled.where(F.pmod(F.xxhash64("k", "t"), F.lit(scale)) < chosen).select("t", "l")
    rows = sample.mapInArrow(draw, "l string, w binary").distinct().collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["l"], bytes(r["w"])))
    languages = sorted({r["l"] for r in rows})
    windows = np.frombuffer(b"".join(bytes(r["w"]) for r in rows), dtype=np.uint8).reshape(len(rows), WINDOW)
    return train(windows, np.array([languages.index(r["l"]) for r in rows]), languages)


def predict_language(
    docs: DataFrame, network: Network | None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id_column``, ``lang_pred`` and ``score`` of every document.

    All windows of the whole text are classified; the score of a language is
    its mean probability, weighted by the bytes of each window. A text that is
    null or has no letter is ``und`` with score 0, as is every text without a
    network. The network is of fixed size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in slices(batches, "t", SLICE_BYTES):
            langs, scores = [], []
            held = []
            for i, text in enumerate(batch.column("t").to_pylist()):
                langs.append("und")
                scores.append(0.0)
                if net is not None and text and _LETTER.search(text):
                    held.append((i, text.encode()))
            total = np.zeros((len(langs), len(net.languages) if net else 0))
            blocks = [(i, windows_of(data), len(data)) for i, data in held]
            if blocks:
                owner = np.concatenate([np.full(len(w), i) for i, w, _ in blocks])
                weight = np.concatenate(
                    [np.append(np.full(len(w) - 1, WINDOW), n - WINDOW * (len(w) - 1)) / n for _, w, n in blocks]
                )
                windows = np.concatenate([w for _, w, _ in blocks])
                for at in range(0, len(windows), 1024):
                    part = slice(at, at + 1024)
                    np.add.at(total, owner[part], net.probabilities(windows[part]) * weight[part, None])
            for i, _ in held:
                best = int(total[i].argmax())
                langs[i], scores[i] = net.languages[best], float(min(1.0, total[i, best]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["k", "l", "s"]
            )

    keyed = docs.select(F.col(id_column).alias("k"), F.col(text_column).cast("string").alias("t"))
    kind = keyed.schema["k"].dataType.simpleString()
    return keyed.mapInArrow(run, f"k {kind}, l string, s double").toDF(id_column, "lang_pred", "score")
