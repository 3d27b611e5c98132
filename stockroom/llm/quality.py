"""A quality classifier learnt from trusted positives and unlabelled text only.

The network minimises the non-negative unbiased risk of positive-unlabelled learning: the unlabelled risk for the negative
class, less what the positives in it contribute, is held at zero or above. The share of positives among unlabelled texts is
estimated first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.llm.registry import ROW, packed, unpacked
from stockroom.llm.shingles import text_bytes, word_hashes

#: Bytes are counted one by one up to here, those of other scripts by their upper bits.
_BYTE_CLASS = np.array([b if b < 128 else 128 + (b >> 4) - 8 for b in range(256)])
_CLASSES = 136
BYTES_AT_A_TIME = 1 << 19


def features(texts: pa.Array) -> np.ndarray:
    """One row per text: shares of byte classes and pairs of character kinds, and how words and lines repeat."""
    count = len(texts)
    data, starts = text_bytes(texts)
    sizes = np.diff(starts)
    scale = np.maximum(sizes, 1)[:, None]
    # Kinds: lower case, upper case, number, space, line break, mark, other script.
    kind = np.full(256, 6)
    kind[:128] = 5
    kind[ord("a") : ord("z") + 1], kind[ord("A") : ord("Z") + 1], kind[ord("0") : ord("9") + 1] = 0, 1, 2
    kind[[0x20, 0x09]], kind[[0x0A, 0x0D]] = 3, 4
    shares, pairs = np.zeros(count * _CLASSES), np.zeros(count * 49)
    # Some bytes at a time, as each needs several numbers.
    for low in range(0, len(data), BYTES_AT_A_TIME):
        high = min(low + BYTES_AT_A_TIME, len(data))
        # One byte more to the left, for the pair that crosses.
        left = max(low - 1, 0)
        text = np.repeat(np.arange(count), np.diff(np.clip(starts, left, high)))
        part, kinds = data[left:high], kind[data[left:high]]
        own = slice(low - left, None)
        shares += np.bincount(text[own] * _CLASSES + _BYTE_CLASS[part[own]], minlength=count * _CLASSES)
        within = text[1:] == text[:-1]
        pairs += np.bincount((text[1:] * 49 + kinds[:-1] * 7 + kinds[1:])[within], minlength=count * 49)
    shares, pairs = shares.reshape(count, _CLASSES) / scale, pairs.reshape(count, 49) / scale
    hashes, first = word_hashes(texts)
    words = np.diff(first)
    of_text = np.repeat(np.arange(count), words)
    next_to = of_text[1:] == of_text[:-1]

    def per_word(flags: np.ndarray, owners: np.ndarray) -> np.ndarray:
        return np.bincount(owners[flags], minlength=count) / np.maximum(words, 1)

    twice = per_word((hashes[1:] == hashes[:-1]) & next_to, of_text[1:]) if len(hashes) > 1 else np.zeros(count)
    order = np.lexsort((hashes, of_text))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | ~next_to
    distinct = per_word(fresh, of_text[order])
    extra = np.stack(
        [
            twice,
            distinct,
            np.log1p(words),
            np.log1p(sizes),
            sizes / np.maximum(words, 1),
            np.log1p(words) * (1 - distinct),
        ],
        axis=1,
    )
    return np.concatenate([np.sqrt(shares), np.sqrt(pairs), extra], axis=1).astype(np.float32)


@dataclass
class QualityModel:
    """A network of one hidden layer over standardised features."""

    mean: np.ndarray
    width: np.ndarray
    weights: list[np.ndarray]
    prior: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        values = np.clip((rows - self.mean) / self.width, -8, 8)
        a, b, c, d = self.weights
        return 1 / (1 + np.exp(-np.clip(np.tanh(values @ a + b) @ c + d, -30, 30)))


def _risk_gradients(
    weights: list[np.ndarray], positive: np.ndarray, unlabelled: np.ndarray, prior: float | None
) -> list[np.ndarray]:
    """Gradients of the non-negative risk with logistic loss; without a prior, of telling positive from unlabelled."""

    def forward(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh(rows @ weights[0] + weights[1])
        return hidden, 1 / (1 + np.exp(-np.clip(hidden @ weights[2] + weights[3], -30, 30)))

    hidden_p, score_p = forward(positive)
    hidden_u, score_u = forward(unlabelled)
    n_p, n_u = len(positive), len(unlabelled)
    if prior is None:
        out_p, out_u = (score_p - 1) / n_p / 2, score_u / n_u / 2
    else:
        # Losses: -log s for the positive class, -log(1 - s) for the negative one.
        as_negative_p, as_negative_u = -np.log(1 - score_p + 1e-9).mean(), -np.log(1 - score_u + 1e-9).mean()
        if as_negative_u - prior * as_negative_p >= 0:
            out_p = prior * ((score_p - 1) - score_p) / n_p
            out_u = score_u / n_u
        else:
            # Below zero the network has learnt single unlabelled texts by heart: go back.
            out_p, out_u = prior * score_p / n_p, -score_u / n_u
    gradients = [np.zeros_like(w) for w in weights]
    for rows, hidden, out in ((positive, hidden_p, out_p), (unlabelled, hidden_u, out_u)):
        inner = (out[:, None] * weights[2][None, :]) * (1 - hidden**2)
        gradients[0] += rows.T @ inner
        gradients[1] += inner.sum(axis=0)
        gradients[2] += hidden.T @ out
        gradients[3] += out.sum()
    return gradients


def _train(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, hidden: int, epochs: int, seed: int
) -> list[np.ndarray]:
    """Adam over shuffled batches, with weight decay."""
    draw = np.random.default_rng(seed)
    width = positive.shape[1]
    weights = [
        draw.normal(0, width**-0.5, (width, hidden)).astype(np.float32),
        np.zeros(hidden, np.float32),
        draw.normal(0, hidden**-0.5, hidden).astype(np.float32),
        np.zeros((), np.float32),
    ]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    batches, step = max(1, len(unlabelled) // 512), 0
    # Few rows make short epochs; train as many steps as with many.
    epochs = max(epochs, -(-800 // batches))
    for epoch in range(epochs):
        p, u = draw.permutation(len(positive)), draw.permutation(len(unlabelled))
        for i in range(batches):
            step += 1
            gradients = _risk_gradients(weights, positive[p[i::batches]], unlabelled[u[i::batches]], prior)
            rate = 0.003 * (1 - epoch / epochs) + 0.0002
            for k, gradient in enumerate(gradients):
                gradient = gradient + 1e-4 * weights[k]
                first[k] = 0.9 * first[k] + 0.1 * gradient
                second[k] = 0.999 * second[k] + 0.001 * gradient**2
                move = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                weights[k] = (weights[k] - rate * move).astype(np.float32)
    return weights


def estimate_prior(scores_positive: np.ndarray, scores_unlabelled: np.ndarray) -> float:
    """The share of positives among unlabelled texts, from a classifier that tells positive from unlabelled.

    Above any score there are at least as many unlabelled texts as the positives among them, so the share is at most the
    ratio of both tails; the smallest ratio, allowing for the sampling error of each tail, is the estimate.
    """
    n_p, n_u = len(scores_positive), len(scores_unlabelled)
    levels = np.quantile(scores_positive, np.linspace(0, 0.9, 91))
    tail_p = np.array([(scores_positive >= level).mean() for level in levels])
    tail_u = np.array([(scores_unlabelled >= level).mean() for level in levels])
    error = np.sqrt(np.log(20.0) / 2) * (n_p**-0.5 + n_u**-0.5)
    best = np.argmin((tail_u + error) / tail_p)
    return float(np.clip(tail_u[best] / tail_p[best], 0.01, 0.99))


def fit_quality(positive: np.ndarray, unlabelled: np.ndarray, hidden: int = 16, epochs: int = 40, seed: int = 1) -> QualityModel:
    """Estimate the prior on the half of the rows that its classifier has not seen, then minimise the risk on all."""
    mean, width = unlabelled.mean(axis=0), unlabelled.std(axis=0)
    width = np.where(width > 1e-6, width, 1).astype(np.float32)

    def standard(rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - mean) / width, -8, 8).astype(np.float32)

    p, u = standard(positive), standard(unlabelled)
    prior = 0.5
    if len(p) >= 4 and len(u) >= 4:
        sides = QualityModel(mean, width, _train(p[::2], u[::2], None, hidden, max(4, epochs // 4), seed), 0.5)
        prior = estimate_prior(sides.scores(positive[1::2]), sides.scores(unlabelled[1::2]))
    return QualityModel(mean, width, _train(p, u, prior, hidden, epochs, seed), prior)


def in_held_out(doc_id: Column) -> Column:
    """A third of the ids, by their checksum."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def _collected(rows: DataFrame, text: str) -> np.ndarray:
    """Features of a sample, whose size the caller bounds."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = features(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in found], pa.binary())], names=["row"])

    raw = rows.select(text).mapInArrow(extract, "row binary").collect()
    # Sorted, so that the fit does not depend on the order in which tasks end.
    return np.array([np.frombuffer(row["row"], np.float32) for row in sorted(raw)])


def scorer(model: QualityModel) -> Callable:
    """For mapInArrow: the packed columns and the scores of the texts."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.scores(features(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column(ROW), pa.array(found, pa.float64())], names=[ROW, "score"])

    return score


def fit_on_tables(
    documents: DataFrame,
    labels: DataFrame,
    most_positives: int = 8_000,
    most_unlabelled: int = 16_000,
    id_column: str = "doc_id",
) -> QualityModel | None:
    """Learn from documents labelled 1 outside the held-out third, and from documents without regard to labels.

    The fit uses samples of about these sizes, drawn by hashes of ids; with less data it uses all. Without positives or
    documents there is no model.
    """
    texts = documents.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    trusted = (
        labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull() & ~in_held_out(F.col("doc_id")))
        .select("doc_id")
        .distinct()
    )
    draw = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(-1)), F.lit(17)), F.lit(1_000_000))

    def drawn(rows: DataFrame, most: int) -> DataFrame:
        count = rows.count()
        return rows.where(draw < int(1_000_000 * min(1.0, most / max(count, 1))))

    # The ids of the sample, of which there are about ``most_positives``, go to all tasks.
    positive = _collected(texts.join(F.broadcast(drawn(trusted, most_positives)), "doc_id", "left_semi"), "text")
    unlabelled = _collected(drawn(texts, most_unlabelled), "text")
    if not len(positive) or not len(unlabelled):
        return None
    return fit_quality(positive, unlabelled)


def score_quality(
    documents: DataFrame,
    labels: DataFrame,
    most_positives: int = 8_000,
    most_unlabelled: int = 16_000,
    id_column: str = "doc_id",
) -> DataFrame:
    """The documents with ``score`` (0 to 1, higher: good text is likelier) and ``predicted`` (1 from 0.5 on).

    Scores see the whole text and nothing else. A NULL text is scored as an empty one, and those are scored like any text.
    If nothing can be learnt, all scores are 0.5. Labels that are NULL or name no document teach nothing; repeated rows and
    labels count once per row. An empty table gives no rows; other columns are kept, unless named like a result.
    """
    model = fit_on_tables(documents, labels, most_positives, most_unlabelled, id_column)
    rows = documents.select(packed(documents), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    if model is None:
        scored = rows.select(ROW, F.lit(0.5).alias("score"))
    else:
        schema = T.StructType([rows.schema[ROW], T.StructField("score", T.DoubleType())])
        scored = rows.mapInArrow(scorer(model), schema)
    predicted = (F.col("score") >= 0.5).cast("int")
    return scored.select(*unpacked(documents, {"score": F.col("score"), "predicted": predicted}))
