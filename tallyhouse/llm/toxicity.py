"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes ratios.

A feature is a character n-gram of a word with its borders, in lower case; a text has
it or not.  Its value is the log ratio of its smoothed shares in toxic and in other
training texts, and logistic regression weighs these values.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import ship, text_or_empty
from tallyhouse.llm.wordhash import counted, filled, slices, split_words, window_hashes

#: Lengths of the n-grams; a word's border counts as a character.
GRAMS = (3, 4, 5, 6)
#: Features are numbered by this many bits of their hash.
BITS = 20
#: Labelled rows the classifier is fitted on at most, drawn by a hash of the id.
TRAINING_ROWS = 12_000
#: Features kept for the regression, those with most evidence.
FEATURES = 4096
#: One row in so many is held out of training, by checksum of the id.
HOLD_OUT = 5

_BORDER = 10  # a line feed, which no word contains
_SLICE = 2_000_000


@dataclass(frozen=True)
class Model:
    """Weights of the kept features, numbered as hashed, and the intercept."""

    features: np.ndarray
    weights: np.ndarray
    intercept: float


def is_held_out(doc_id: Column, folds: int = HOLD_OUT) -> Column:
    """Rows that training must not see; without an id, the checksum of an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word number and feature of each n-gram of ``words``."""
    text = "\n" + "\n".join(words) + "\n"
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    border = points == _BORDER
    word = np.cumsum(border) - 1
    inside = np.cumsum(border)
    owners, features = [], []
    for n in GRAMS:
        if len(points) < n:
            continue
        at = np.arange(len(points) - n + 1)
        # No border between the first and the last character.
        whole = inside[at + n - 2] == inside[at]
        at = at[whole]
        owners.append(word[at])
        seeded = window_hashes(points + np.uint64(n << 32), n)[at]
        features.append((seeded >> np.uint64(64 - BITS)).astype(np.int64))
    if not owners:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(owners), np.concatenate(features)


def text_features(
    texts: pa.Array, kept: np.ndarray | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, text numbers, features), each pair once, for slices of ``texts``.

    ``kept`` maps a feature to its number, or to -1 when it is not wanted.
    """
    lowered = pc.utf8_lower(texts)
    for start, end in slices(lowered, _SLICE):
        words, starts = split_words(lowered.slice(start, end - start))
        coded = words.dictionary_encode()
        known = coded.dictionary.to_pylist()
        owner = np.repeat(np.arange(end - start), np.diff(starts))
        pairs = np.unique(owner * np.int64(len(known) + 1) + coded.indices.to_numpy())
        owner, word = pairs // (len(known) + 1), pairs % (len(known) + 1)
        of_word, feature = word_features(known) if known else (word, word)
        if kept is not None:
            feature = kept[feature]
            of_word, feature = of_word[feature >= 0], feature[feature >= 0]
        order = np.argsort(of_word, kind="stable")
        of_word, feature = of_word[order], feature[order]
        edges = np.searchsorted(of_word, np.arange(len(known) + 1))
        sizes = np.diff(edges)[word] if known else word
        spot = np.repeat(edges[:-1][word], sizes) + counted(sizes) if known else word
        both = np.unique((np.repeat(owner, sizes) << BITS) | feature[spot])
        yield start, both >> BITS, both & ((1 << BITS) - 1)


def _fit_logistic(
    rows: np.ndarray, columns: np.ndarray, values: np.ndarray, labels: np.ndarray, width: int,
    penalty: float = 2.0, steps: int = 300,
) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated gradient descent on the penalised log loss."""
    n = len(labels)
    x = values[columns]
    squares = np.bincount(rows, x * x, n)
    rate = 1.0 / (0.25 * (squares.max(initial=0) + 1) * n / 8 + penalty)
    weights, bias = np.zeros(width), 0.0
    ahead, ahead_bias, momentum = weights, bias, 1.0
    loss_before = np.inf
    for _ in range(steps):
        margin = np.bincount(rows, x * ahead[columns], n) + ahead_bias
        p = 1 / (1 + np.exp(-margin))
        error = p - labels
        slope = np.bincount(columns, x * error[rows], width) + penalty * ahead
        loss = np.sum(np.logaddexp(0, margin) - labels * margin) + penalty / 2 * ahead @ ahead
        if loss > loss_before:
            # Too long a step or too much momentum.
            rate, momentum = rate / 2 if loss > 1.05 * loss_before else rate, 1.0
        loss_before = loss
        new, new_bias = ahead - rate * slope, ahead_bias - rate * error.sum()
        grown = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        pull = (momentum - 1) / grown
        ahead, ahead_bias = new + pull * (new - weights), new_bias + pull * (new_bias - bias)
        weights, bias, momentum = new, new_bias, grown
    return weights, float(bias)


def fit(texts: pa.Array, labels: np.ndarray, features: int = FEATURES) -> Model:
    """A model from labelled texts.

    Without both labels a constant: the odds of label 1 among the rows and two more, one
    and a half of them of label 0, so that nothing is predicted 1 without any row.
    """
    size = 1 << BITS
    counts = np.zeros((2, size))
    for start, text, feature in text_features(texts):
        for label in (0, 1):
            mine = feature[labels[start + text] == label]
            counts[label] += np.bincount(mine, minlength=size)
    positive = int(labels.sum())
    if positive in (0, len(labels)):
        intercept = float(np.log((positive + 0.5) / (len(labels) - positive + 1.5)))
        return Model(np.empty(0, np.int64), np.empty(0), intercept)
    # Evidence: likelihood ratio of the feature's share in the two classes.
    totals = np.array([len(labels) - positive, positive], float)[:, None]
    share = counts.sum(axis=0) / totals.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        evidence = np.nansum(
            counts * np.log(counts / totals / share)
            + (totals - counts) * np.log((1 - counts / totals) / (1 - share)), axis=0,
        )
    chosen = np.sort(np.argsort(-evidence, kind="stable")[:features])
    chosen = chosen[counts[:, chosen].sum(axis=0) >= 2]
    smooth = counts + 1
    ratio = np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())
    kept = np.full(size, -1, np.int64)
    kept[chosen] = np.arange(len(chosen))
    rows, columns = [], []
    for start, text, feature in text_features(texts, kept):
        rows.append(start + text)
        columns.append(feature)
    values = ratio[chosen]
    weights, intercept = _fit_logistic(
        np.concatenate(rows), np.concatenate(columns), values, labels.astype(float), len(chosen)
    )
    return Model(chosen, weights * values, intercept)


def scores(texts: pa.Array, model: Model) -> np.ndarray:
    """Probability of label 1 of each text; one without words gets the intercept's."""
    kept = np.full(1 << BITS, -1, np.int64)
    kept[model.features] = np.arange(len(model.features))
    margin = np.full(len(texts), model.intercept)
    for start, text, feature in text_features(texts, kept):
        margin += np.bincount(start + text, model.weights[feature], len(texts))
    return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS) -> Model:
    """A model from the labelled rows that are not held out, ``limit`` of them at most.

    The rows with the least hash of their id are taken: a random sample that is the
    same in each run.  It is bounded, so it is broadcast, and its texts are brought to
    the driver, one for each id: rows that repeat an id count as the one with the
    greatest text.  Labels other than 0 and 1 and rows without an id are passed over.
    """
    known = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").filter(
        ~is_held_out(F.col("doc_id"))
    )
    order = F.xxhash64(F.col("doc_id"), F.lit(5))
    sample = known.select(F.col("doc_id").cast("long").alias("id"), "toxic").orderBy(
        order, "id", "toxic"
    ).limit(limit)
    texts = docs.select(F.col("doc_id").cast("long").alias("text_id"), text_or_empty().alias("text"))
    rows = (
        texts.join(F.broadcast(sample), F.col("text_id") == F.col("id"))
        .groupBy("id", "toxic")
        .agg(F.max("text").alias("text"))
    )
    table = rows.toArrow().sort_by([("id", "ascending"), ("text", "ascending")])
    return fit(filled(table["text"]), table["toxic"].to_numpy().astype(np.int64))


def _scoring(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = filled(batch["text"])
            for start, end in slices(texts):
                found = scores(texts.slice(start, end - start), model)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(start, end - start),
                        batch["held_out"].slice(start, end - start),
                        pa.array(found),
                        pa.array((found >= 0.5).astype(np.int32)),
                    ],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    return score


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text.

    * A NULL or empty text has no features: the share of label 1 in training.
    * Repeated rows are scored each, alike.
    * An empty table gives an empty result; only doc_id and text are looked at.
    """
    ship(docs.sparkSession)
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), is_held_out(doc_id).alias("held_out"), "text")
    schema = "doc_id long, held_out boolean, score double, predicted int"
    return rows.mapInArrow(_scoring(model), schema)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_documents(docs, train(docs, labels))
