"""Language-model scores: masked pseudo-likelihood of a bidirectional window network.

Every token is predicted from the two tokens before and the two after it; a
document's score is the sum of the log probabilities of its tokens, each with that
token left out of what the network sees.

The network's vocabulary is the corpus's most frequent words, counted over all
documents, and buckets for all other words; it grows with the corpus.  A token is
predicted in two steps, its class (tokens of like frequency) and then the token within
the class, so the cost of a token is not that of the whole vocabulary.  A word of a
bucket has the probability P(bucket | around it) * P(word | bucket), the second factor
from the counts of all words, so each word is scored as itself.  The network is trained by local gradient descent: each
task trains a copy on its share of the corpus, copies are averaged over a tree, and
the next round begins from the average.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import ship, stored
from tallyhouse.llm.wordhash import counted, filled, mixed, slices, split_words


@dataclass(frozen=True)
class Shape:
    """Sizes of the network and of its training.

    ``vocabulary`` includes the padding (0) and ``buckets`` for words that are not
    frequent.  It is the least one: :meth:`grown` has more words for more tokens.
    ``batch`` is the least one too: the tokens of one step.  ``width`` consecutive
    numbers of the vocabulary are a class of the softmax.
    Each round trains on one token in ``stride``, another part in each round,
    so ``stride`` rounds train on every token of every document once.
    """

    vocabulary: int = 512
    buckets: int = 64
    hidden: int = 32
    reach: int = 2
    rounds: int = 2
    stride: int = 2
    batch: int = 256
    rate: float = 0.1
    width: int = 64

    def __post_init__(self):
        if self.stride > self.rounds:
            raise ValueError(f"{self.rounds} rounds of one token in {self.stride} leave tokens out")

    @property
    def words(self) -> int:
        return self.vocabulary - self.buckets - 1

    @property
    def classes(self) -> int:
        return -(-self.vocabulary // self.width)

    def grown(self, tokens: int) -> Shape:
        """With words of their own growing as the fourth root of the corpus's tokens.

        Steps stay as many when they are of more tokens, up to ``_LARGEST_BATCH``.
        """
        words = max(self.words, round(_GROWTH * tokens**0.25))
        batch = max(self.batch, min(_LARGEST_BATCH, tokens // _STEPS))
        return replace(self, vocabulary=words + self.buckets + 1, batch=batch)


#: Frequent words per fourth root of the number of tokens: 447 for four million.
_GROWTH = 10

#: Steps that all tasks take together before a batch reaches its largest size.
_STEPS = 8192
_LARGEST_BATCH = 4096

#: Averages are taken over so many groups of copies before the last one.
_GROUPS = 16


# -- vocabulary and token numbers --------------------------------------------


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pc.utf8_lower(filled(batch["text"]))
        for start, end in slices(texts):
            words, _ = split_words(texts.slice(start, end - start))
            found = words.value_counts()
            yield pa.RecordBatch.from_arrays(
                [found.field("values").cast(pa.string()), found.field("counts")],
                names=["word", "n"],
            )


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all documents, in lower case."""
    ship(docs.sparkSession)
    return (
        docs.select("text").mapInArrow(_counting, "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n"))
    )


def frequent_words(counts: DataFrame, number: int) -> list[tuple[str, int]]:
    """The ``number`` most frequent words of ``counts`` (word, n), ties by the word."""
    top = counts.orderBy(F.col("n").desc(), "word").limit(number)
    return [(r.word, r.n) for r in top.collect()]


def word_key(word: str) -> int:
    """What Spark's xxhash64 gives for the word."""
    key = xxhash.xxh64_intdigest(word, seed=42)
    return key - (1 << 64) if key >> 63 else key


def word_keys(words: list[str]) -> np.ndarray:
    digests = map(partial(xxhash.xxh64_intdigest, seed=42), words)
    return np.fromiter(digests, np.uint64, len(words)).view(np.int64)


def bucket_shares(
    counts: DataFrame, frequent: list[tuple[str, int]], buckets: int
) -> DataFrame:
    """(word_key, log_share) of all words that are not ``frequent``: log P(word | bucket)."""
    rare = F.lit(False)
    if frequent:
        word, n = frequent[-1]
        rare = (F.col("n") < n) | ((F.col("n") == n) & (F.col("word") > word))
    keyed = counts.filter(rare).groupBy(F.xxhash64("word").alias("word_key")).agg(
        F.sum("n").alias("n")
    )
    bucketed = keyed.withColumn("bucket", F.pmod("word_key", F.lit(buckets)))
    totals = bucketed.groupBy("bucket").agg(F.sum("n").alias("of_bucket"))
    return bucketed.join(F.broadcast(totals), "bucket").select(
        "word_key", (F.log("n") - F.log("of_bucket")).alias("log_share")
    )


_TOKENS = "doc_id long, row long, tokens binary, rare array<long>"


def _numbering(words: list[str], shape: Shape):
    frequent = pa.array(words, pa.large_string())
    other = 1 + shape.words

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            texts = pc.utf8_lower(filled(batch["text"]))
            for start, end in slices(texts):
                flat, starts = split_words(texts.slice(start, end - start))
                coded = flat.dictionary_encode()
                place = pc.index_in(coded.dictionary, value_set=frequent)
                number = pc.fill_null(place, -1).to_numpy(zero_copy_only=False).astype(np.uint16) + np.uint16(1)
                is_rare = number == 0
                key = np.zeros(len(number), np.int64)
                key[is_rare] = word_keys(coded.dictionary.filter(pa.array(is_rare)).to_pylist())
                number[is_rare] = other + key[is_rare] % shape.buckets
                at = coded.indices.to_numpy() if len(flat) else np.empty(0, np.int64)
                ids, rare = number[at].astype("<u2"), is_rare[at]
                before = np.concatenate([[0], np.cumsum(rare)])[starts].astype(np.int32)
                packed = [ids[i:j].tobytes() for i, j in zip(starts[:-1], starts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(start, end - start),
                        pa.array(np.arange(row, row + end - start)),
                        pa.array(packed, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(before), pa.array(key[at[rare]])),
                    ],
                    names=["doc_id", "row", "tokens", "rare"],
                )
                row += end - start

    return tokens


# -- network -----------------------------------------------------------------


class WindowNetwork:
    """Hidden layer from the tokens around a place, softmax in two steps over the vocabulary.

    P(token) = P(class | around it) * P(token | class, around it): ``width`` consecutive
    tokens are a class, so a token costs the classes and one class of the softmax in place
    of all tokens.  Both factors are whole softmaxes, and the probabilities of all tokens
    have the sum 1.  With one class the second is the softmax over the vocabulary.
    """

    def __init__(self, shape: Shape, values: np.ndarray | None = None):
        self.shape = shape
        sizes = [
            (2 * shape.reach, shape.vocabulary, shape.hidden),
            (shape.hidden,),
            # The last rows are biases, of a hidden value that is always 1.
            (shape.hidden + 1, shape.vocabulary),
            (shape.hidden + 1, shape.classes),
        ]
        total = sum(int(np.prod(s)) for s in sizes)
        if values is None:
            values = np.random.default_rng(1).normal(0, 0.1, total)
        self.values = np.array(values, np.float32)
        at, parts = 0, []
        for size in sizes:
            parts.append(self.values[at : at + int(np.prod(size))].reshape(size))
            at += int(np.prod(size))
        self.inputs, self.bias, self.whole_output, self.whole_class = parts
        self.output, self.output_bias = self.whole_output[:-1], self.whole_output[-1]
        self.class_output, self.class_bias = self.whole_class[:-1], self.whole_class[-1]

    def hidden(self, around: np.ndarray) -> np.ndarray:
        """Hidden values of each row, and 1."""
        total = self.inputs[0].take(around[:, 0], axis=0)
        total += self.bias
        for k in range(1, around.shape[1]):
            total += self.inputs[k].take(around[:, k], axis=0)
        values = np.ones((len(total), self.shape.hidden + 1), np.float32)
        np.tanh(total, out=values[:, :-1])
        return values

    def _stretches(self, kinds: np.ndarray) -> list[tuple[slice, slice]]:
        """(rows, tokens) of each class in ``kinds``, the classes of rows in ascending order."""
        width, end = self.shape.width, self.shape.vocabulary
        edges = np.searchsorted(kinds, np.arange(self.shape.classes + 1)).tolist()
        return [
            (slice(i, j), slice(k * width, min((k + 1) * width, end)))
            for k, (i, j) in enumerate(zip(edges[:-1], edges[1:])) if i < j
        ]

    def _logits(
        self, hidden: np.ndarray, kinds: np.ndarray, stretches: list[tuple[slice, slice]]
    ) -> tuple[np.ndarray, np.ndarray]:
        """Of the classes, and of the tokens of each row's class; none may be too large for exp."""
        of_class = hidden @ self.whole_class
        width = min(self.shape.width, self.shape.vocabulary)
        within = np.empty((len(kinds), width), np.float32)
        for rows, tokens in stretches:
            n = tokens.stop - tokens.start
            np.matmul(hidden[rows], self.whole_output[:, tokens], out=within[rows, :n])
            if n < width:
                within[rows, n:] = -np.inf
        if self.largest_logit() > 80:
            # Only such could be too large.
            for logits in (of_class, within):
                logits -= logits.max(axis=1, keepdims=True)
        return of_class, within

    def log_probabilities(self, around: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Log probability of each token given the tokens around it."""
        order = np.argsort(token, kind="stable")
        around, token = around[order], token[order].astype(np.int64)
        kinds, rows = token // self.shape.width, np.arange(len(token))
        logs = np.zeros(len(token))
        both = self._logits(self.hidden(around), kinds, self._stretches(kinds))
        for logits, own in zip(both, (kinds, token - kinds * self.shape.width)):
            logs += logits[rows, own]
            np.exp(logits, out=logits)
            logs -= np.log(_row_sums(logits))
        result = np.empty(len(token))
        result[order] = logs
        return result

    def largest_logit(self) -> float:
        """A bound: hidden values lie between -1 and 1."""
        layers = (self.whole_output, self.whole_class)
        return max(float(np.abs(layer).sum(axis=0).max()) for layer in layers)

    def slopes(self, around: np.ndarray, token: np.ndarray) -> list[np.ndarray]:
        """Slopes of the mean negative log probability by the weights of both output layers.

        The last one is by the sum that each row's hidden values come from.  ``token``
        ascends.
        """
        n, width = len(token), self.shape.width
        token = token.astype(np.int64)
        kinds, rows = token // width, np.arange(n)
        stretches, hidden = self._stretches(kinds), self.hidden(around)
        of_class, within = self._logits(hidden, kinds, stretches)
        for error, own in ((of_class, kinds), (within, token - kinds * width)):
            np.exp(error, out=error)
            error *= (1 / (n * _row_sums(error)))[:, None]
            error[rows, own] -= np.float32(1 / n)
        by_hidden = of_class @ self.class_output.T
        by_output = np.zeros_like(self.whole_output)
        for some, tokens in stretches:
            error = within[some, : tokens.stop - tokens.start]
            by_hidden[some] += error @ self.output[:, tokens].T
            np.matmul(hidden[some].T, error, out=by_output[:, tokens])
        by_hidden *= 1 - hidden[:, :-1] ** 2
        return [by_output, hidden.T @ of_class, by_hidden]

    def learn(self, around: np.ndarray, token: np.ndarray, sums: list[np.ndarray]) -> None:
        """One step on a batch; ``sums`` holds the squares of past slopes, per weight."""
        order = np.argsort(token, kind="stable")
        around = around[order]
        *grads, slope = self.slopes(around, token[order])
        grads += [slope.sum(axis=0), self._by_inputs(around, slope)]
        for weights, grad, past in zip(self._layers(), grads, sums):
            slow = grad * grad
            past += slow
            np.add(past, np.float32(1e-8), out=slow)
            np.sqrt(slow, out=slow)
            grad /= slow
            grad *= np.float32(self.shape.rate)
            weights -= grad

    def _by_inputs(self, around: np.ndarray, slope: np.ndarray) -> np.ndarray:
        """Slopes by the input weights: sums of ``slope`` over the rows that have a token at a place."""
        total = np.empty_like(self.inputs)
        columns = np.arange(self.shape.hidden)
        weights = slope.astype(np.float64).ravel()
        for k in range(around.shape[1]):
            at = around[:, k].astype(np.int64)[:, None] * self.shape.hidden + columns
            total[k] = np.bincount(at.ravel(), weights, total[k].size).reshape(total[k].shape)
        return total

    def _layers(self) -> list[np.ndarray]:
        return [self.whole_output, self.whole_class, self.bias, self.inputs]

    def past(self) -> list[np.ndarray]:
        return [np.zeros_like(x) for x in self._layers()]


def _row_sums(x: np.ndarray) -> np.ndarray:
    return x @ np.ones(x.shape[1], x.dtype)


def windows(
    documents: list[np.ndarray], reach: int, choose=None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, the tokens around each (0 beyond the ends), and its document's number.

    ``choose`` gives the tokens that are wanted, and their order, from each one's
    document and its place there.
    """
    sizes = np.fromiter(map(len, documents), np.int64, len(documents))
    gap = np.zeros(reach, np.uint16)
    padded = np.concatenate([gap, *(x for d in documents for x in (d, gap))])
    before = np.arange(len(documents)) * reach + reach
    starts = before + np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(documents) else before
    place = counted(sizes)
    at = np.repeat(starts, sizes) + place
    owner = np.repeat(np.arange(len(sizes)), sizes)
    if choose is not None:
        wanted = choose(owner, place)
        at, owner = at[wanted], owner[wanted]
    shifts = [s for s in range(-reach, reach + 1) if s]
    around = np.stack([padded[at + s] for s in shifts], axis=1) if len(at) else None
    empty = np.empty((0, 2 * reach), np.uint16)
    return padded[at], empty if around is None else around, owner


def _document_groups(batch: pa.RecordBatch, limit: int = 200_000):
    """(first row, token arrays) of consecutive rows with about ``limit`` tokens."""
    held, first, size = [], 0, 0
    for i, packed in enumerate(batch["tokens"].to_pylist()):
        held.append(np.frombuffer(packed, "<u2"))
        size += len(held[-1])
        if size >= limit or len(held) >= 4096:
            yield first, held
            held, first, size = [], i + 1, 0
    if held:
        yield first, held


def _chosen(stride: int, turn: int, rows: np.ndarray, owner: np.ndarray, place: np.ndarray):
    """Tokens of the round ``turn``, in random order: each is of one round in ``stride``.

    That depends on the row and the place in its text alone, so rounds may deal rows otherwise.
    """
    chance = mixed(mixed(rows.astype(np.uint64))[owner] + place.astype(np.uint64))
    used = np.flatnonzero(chance % np.uint64(stride) == turn % stride)
    # By 16 bits, which are sorted by radix; of equal ones the first token comes first.
    order = mixed(chance[used] + np.uint64(turn)).astype(np.uint16)
    return used[np.argsort(order, kind="stable")]


def _training(shape: Shape, values: np.ndarray, turn: int):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = WindowNetwork(shape, values)
        past, seen = network.past(), 0
        for batch in batches:
            rows = batch["row"].to_numpy()
            for first, documents in _document_groups(batch):
                choose = partial(_chosen, shape.stride, turn, rows[first : first + len(documents)])
                token, around, _ = windows(documents, shape.reach, choose)
                for at in range(0, len(token), shape.batch):
                    part = slice(at, at + shape.batch)
                    network.learn(around[part], token[part], past)
                seen += len(token)
        if seen:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part % _GROUPS], pa.int64()),
                    pa.array([part], pa.int64()),
                    pa.array([float(seen)]),
                    pa.array([network.values.tobytes()], pa.binary()),
                ],
                names=["place", "part", "weight", "network"],
            )

    return train


def _averaged(table: pa.Table) -> pa.Table:
    """Weighted mean of the copies of a group, in the order of their parts."""
    total, weight = 0.0, 0.0
    for row in table.sort_by("part").to_pylist():
        total = total + row["weight"] * np.frombuffer(row["network"], np.float32).astype(np.float64)
        weight += row["weight"]
    mean = (total / weight).astype(np.float32)
    return pa.table(
        {
            "place": table["place"][:1],
            "part": table["place"][:1],
            "weight": pa.array([weight]),
            "network": pa.array([mean.tobytes()], pa.binary()),
        }
    )


_COPIES = "place long, part long, weight double, network binary"


def train_network(tokens: DataFrame, shape: Shape = Shape()) -> WindowNetwork:
    """A network trained on the stored ``tokens`` of all documents.

    Copies grow in number with the corpus; at most ``_GROUPS`` averages of them
    reach the driver.  A task that is run again reads the same rows and trains the
    same copy.
    """
    network = WindowNetwork(shape)
    for turn in range(shape.rounds):
        copies = tokens.select("row", "tokens").mapInArrow(_training(shape, network.values, turn), _COPIES)
        means = copies.groupBy("place").applyInArrow(_averaged, _COPIES)
        table = means.toArrow()
        if not table.num_rows:
            break
        whole = _averaged(table)
        network = WindowNetwork(shape, np.frombuffer(whole["network"][0].as_py(), np.float32))
    return network


def _scoring(shape: Shape, values: np.ndarray, rows_at_once: int = 4096):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = WindowNetwork(shape, values)
        for batch in batches:
            for first, documents in _document_groups(batch):
                token, around, owner = windows(documents, shape.reach)
                total = np.zeros(len(documents))
                for at in range(0, len(token), rows_at_once):
                    part = slice(at, at + rows_at_once)
                    logs = network.log_probabilities(around[part], token[part])
                    total += np.bincount(owner[part], logs, len(documents))
                sizes = np.fromiter(map(len, documents), np.int64, len(documents))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(first, len(documents)),
                     batch["row"].slice(first, len(documents)), pa.array(sizes), pa.array(total)],
                    names=["doc_id", "row", "n_tokens", "of_network"],
                )

    return score


def score_documents(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_likelihood) of every whole text.

    * A NULL text, or one without words, has no tokens, the sum 0 and no mean.
    * Repeated rows are scored each, and train the network each.
    * An empty table gives an empty result; only doc_id and text are looked at.
    """
    ship(docs.sparkSession)
    counts = stored(word_counts(docs), "word-counts")
    shape = shape.grown(counts.agg(F.sum("n")).first()[0] or 0)
    frequent = frequent_words(counts, shape.words)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    numbered = rows.mapInArrow(_numbering([word for word, _ in frequent], shape), _TOKENS)
    tokens = stored(numbered, "tokens")
    network = train_network(tokens, shape)
    shares = bucket_shares(counts, frequent, shape.buckets)
    # By shuffle at any size: the words of a corpus grow with it, and none here is frequent.
    rare = (
        tokens.select("row", F.explode("rare").alias("word_key"))
        .join(shares.hint("merge"), "word_key")
        .groupBy("row").agg(F.sum("log_share").alias("within_buckets"))
    )
    scored = tokens.select("doc_id", "row", "tokens").mapInArrow(
        _scoring(shape, network.values), "doc_id long, row long, n_tokens long, of_network double"
    )
    total = F.col("of_network") + F.coalesce("within_buckets", F.lit(0.0))
    return scored.join(rare, "row", "left").select(
        "doc_id", "n_tokens", total.alias("log_likelihood"),
        F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_log_likelihood"),
    )
