"""Language identification: a linear-chain conditional random field labels the words of possibly mixed texts."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from .rows import text_slices, whole_row

UNKNOWN = "und"
# Words of one chain; longer texts are read as several.
CHAIN = 64
# Hashed features.
BUCKETS = 1 << 16
# Words whose scores a worker remembers before it forgets all of them.
REMEMBERED = 1 << 18


class Training(NamedTuple):
    """What is learned from: about this many documents, spread evenly over the most frequent labels, and of each some
    spans of words from anywhere in it; spans of different documents are joined into mixed chains."""

    documents: int = 3000
    labels: int = 200
    spans: int = 3
    span_words: int = 24
    rounds: int = 40
    rate: float = 0.1
    decay: float = 1e-5
    seed: int = 7


class Model(NamedTuple):
    labels: list[str]
    weights: np.ndarray  # one row per feature bucket, one column per label
    transitions: np.ndarray  # from label (row) to label
    start: np.ndarray


def features(words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, feature bucket) of all features of lower-case words in UTF-8.

    A word between two marks has its strings of two, three and four bytes, those at a mark being its affixes, and
    the whole word, its place in the lexicon. Words without a letter have none.
    """
    texts = [b"\x02" + word + b"\x03" if any(map(str.isalpha, word.decode())) else b"" for word in words]
    sizes = np.array([len(text) for text in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    remaining = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))
    rows, buckets = [], []
    code = data
    for size in (2, 3, 4):
        code = code[: len(data) - size + 1] * np.uint64(257) + data[size - 1 :]
        inside = np.flatnonzero(remaining[: len(code)] >= size)
        mixed = (code[inside] + np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15)
        rows.append(owner[inside])
        buckets.append((mixed >> np.uint64(48)).astype(np.int64))
    known = np.flatnonzero(sizes)
    rows.append(known)
    buckets.append(np.array([zlib.crc32(texts[i]) & (BUCKETS - 1) for i in known.tolist()], dtype=np.int64))
    return np.concatenate(rows), np.concatenate(buckets)


def _word_scores(pairs: tuple[np.ndarray, np.ndarray], n_words: int, weights: np.ndarray) -> np.ndarray:
    rows, buckets = pairs
    columns = [np.bincount(rows, weights=weights[buckets, label], minlength=n_words) for label in range(weights.shape[1])]
    return np.stack(columns, axis=1) if columns else np.zeros((n_words, 0))


def forward_backward(scores: np.ndarray, mask: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginal probability of each label at each place of many chains, and the expected label pairs of all.

    ``scores`` is chains x places x labels, ``mask`` tells places that exist, the first ones of each chain.
    """
    n, length, labels = scores.shape
    local = np.exp(scores - scores.max(axis=2, keepdims=True)) + 1e-30
    local[~mask] = 1.0
    step = np.exp(transitions - transitions.max())
    ahead = np.empty_like(local)
    message = np.exp(start - start.max()) * local[:, 0]
    ahead[:, 0] = message / message.sum(axis=1, keepdims=True)
    for t in range(1, length):
        message = (ahead[:, t - 1] @ step) * local[:, t]
        message /= message.sum(axis=1, keepdims=True)
        ahead[:, t] = np.where(mask[:, t, None], message, ahead[:, t - 1])
    marginal = np.empty_like(local)
    pairs = np.zeros((labels, labels))
    back = np.full((n, labels), 1.0 / labels)
    for t in range(length - 1, -1, -1):
        both = ahead[:, t] * back
        marginal[:, t] = both / both.sum(axis=1, keepdims=True)
        if t:
            carried = local[:, t] * back
            joint = ahead[:, t - 1][:, :, None] * step * carried[:, None, :]
            there = mask[:, t]
            pairs += (joint[there] / joint[there].sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            message = carried @ step.T
            message /= message.sum(axis=1, keepdims=True)
            back = np.where(there[:, None], message, back)
    return marginal, pairs


def _marginals(scores: np.ndarray, mask: np.ndarray, model: Model) -> np.ndarray:
    """Marginals alone, without the expected pairs."""
    n, length, labels = scores.shape
    local = np.exp(scores - scores.max(axis=2, keepdims=True)) + 1e-30
    step = np.exp(model.transitions - model.transitions.max())
    ahead = np.empty_like(local)
    message = np.exp(model.start - model.start.max()) * local[:, 0]
    ahead[:, 0] = message / message.sum(axis=1, keepdims=True)
    for t in range(1, length):
        message = (ahead[:, t - 1] @ step) * local[:, t]
        ahead[:, t] = message / message.sum(axis=1, keepdims=True)
    back = np.full((n, labels), 1.0 / labels)
    for t in range(length - 1, -1, -1):
        both = ahead[:, t] * back
        ahead[:, t] = both / both.sum(axis=1, keepdims=True)
        message = (local[:, t] * back) @ step.T
        back = np.where(mask[:, t, None], message / message.sum(axis=1, keepdims=True), back)
    return ahead


def fit(spans: Sequence[tuple[str, Sequence[bytes]]], training: Training = Training()) -> Model:
    """Learn weights and transitions from labelled spans of words, by the gradient of the chains' likelihood.

    Spans are shuffled and joined into chains that switch from label to label, so that transitions are learned.
    """
    labels = sorted({label for label, words in spans if words})
    if not labels:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((0, 0)), np.zeros(0))
    number = {label: i for i, label in enumerate(labels)}
    order = np.random.default_rng(training.seed).permutation(len(spans))
    tokens = [(number[spans[i][0]], word) for i in order for word in spans[i][1]]
    words = sorted({word for _, word in tokens})
    index = {word: i for i, word in enumerate(words)}
    n_chains = -(-len(tokens) // CHAIN)
    ids, truth = np.zeros((2, n_chains * CHAIN), dtype=np.int64)
    ids[: len(tokens)] = [index[word] for _, word in tokens]
    truth[: len(tokens)] = [label for label, _ in tokens]
    mask = (np.arange(n_chains * CHAIN) < len(tokens)).reshape(n_chains, CHAIN)
    ids, truth = ids.reshape(n_chains, CHAIN), truth.reshape(n_chains, CHAIN)
    wanted = np.eye(len(labels))[truth] * mask[:, :, None]
    before, after = truth[:, :-1][mask[:, 1:]], truth[:, 1:][mask[:, 1:]]
    seen = np.zeros((len(labels), len(labels)))
    np.add.at(seen, (before, after), 1)

    rows, buckets = features(words)
    shapes = ((BUCKETS, len(labels)), (len(labels), len(labels)), (len(labels),))
    values = [np.zeros(shape) for shape in shapes]
    first = [np.zeros(shape) for shape in shapes]
    second = [np.zeros(shape) for shape in shapes]
    for turn in range(1, training.rounds + 1):
        weights, transitions, start = values
        scores = _word_scores((rows, buckets), len(words), weights)
        marginal, pairs = forward_backward(scores[ids], mask, transitions, start)
        error = (wanted - marginal * mask[:, :, None]).reshape(-1, len(labels))
        by_word = [np.bincount(ids.reshape(-1), weights=error[:, i], minlength=len(words)) for i in range(len(labels))]
        by_bucket = [np.bincount(buckets, weights=column[rows], minlength=BUCKETS) for column in by_word]
        gradients = (
            np.stack(by_bucket, axis=1) / len(tokens) - training.decay * weights,
            (seen - pairs) / len(tokens),
            (wanted[:, 0] - marginal[:, 0]).sum(axis=0) / len(tokens),
        )
        for value, gradient, mean, square in zip(values, gradients, first, second, strict=True):  # Adam
            mean += 0.1 * (gradient - mean)
            square += 0.001 * (gradient**2 - square)
            value += training.rate * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.999**turn)) + 1e-8)
    return Model(labels, values[0].astype(np.float32), values[1], values[2])


def learn(docs: DataFrame, training: Training = Training(), id_column: str = "doc_id", label_column: str = "lang", text_column: str = "text") -> Model:
    """Fit a model on a bounded sample of the documents with a label.

    Every label gives about as many documents, chosen by a hash of id and text as they are read, ``training.documents``
    in all; of copies one. Only spans of these come to the driver, ``training.spans`` of ``training.span_words``
    words from each. More than ``training.labels`` labels are an error.
    """
    labelled = docs.select(F.col(id_column).alias("id"), F.col(label_column).cast("string").alias("label"), F.col(text_column).alias("text"))
    labelled = labelled.where("label is not null and text is not null")
    counted = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    counts = counted.orderBy(F.desc("n"), "label").limit(training.labels + 1).collect()
    if len(counts) > training.labels:
        raise ValueError(f"More than {training.labels} labels in {label_column!r}")
    shares = [F.lit(value) for label, n in counts for value in (label, training.documents / len(counts) / n)]
    share = F.try_element_at(F.create_map(*shares), "label") if shares else F.lit(0.0)
    spread = F.pmod(F.xxhash64(F.lit(training.seed), F.col("id"), F.col("text")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = labelled.where(spread < F.coalesce(share, F.lit(0.0))).dropDuplicates(["id", "label", "text"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch):
                found = []
                for id_, label, text in zip(part.column("id").to_pylist(), part.column("label").to_pylist(), texts, strict=True):
                    words = text.lower().encode("utf-8", "replace").split()
                    rng = np.random.default_rng([training.seed, zlib.crc32(str(id_).encode())])
                    for start in rng.integers(0, max(1, len(words) - training.span_words + 1), training.spans).tolist():
                        found.append((label, b" ".join(words[start : start + training.span_words])))
                labels, spans = zip(*found, strict=True)
                yield pa.RecordBatch.from_pydict({"label": pa.array(labels), "span": pa.array(spans, pa.binary())})

    spans = sample.mapInArrow(cut, "label string, span binary").collect()  # bounded by `training`
    return fit([(label, span.split()) for label, span in sorted((row[0], bytes(row[1])) for row in spans)], training)


class _Scores:
    """Label scores of words, computed for the new ones of a batch together."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.scores = np.zeros((0, len(self.model.labels)), dtype=np.float32)
        self.letters = np.zeros(0, dtype=bool)

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of each word, and whether it has a letter."""
        new = list(set(words) - self.index.keys())
        if len(self.index) + len(new) > REMEMBERED:
            self._forget()
            new = list(set(words))
        if new:
            rows, buckets = features(new)
            scores = _word_scores((rows, buckets), len(new), self.model.weights).astype(np.float32)
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
            self.scores = np.concatenate([self.scores, scores])
            self.letters = np.concatenate([self.letters, np.bincount(rows, minlength=len(new)) > 0])
        ids = np.fromiter(map(self.index.__getitem__, words), dtype=np.int64, count=len(words))
        return self.scores[ids], self.letters[ids]


def word_marginals(texts: Sequence[str | None], scores: _Scores) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Label probabilities of all words of each text, and which of them have a letter, text by text.

    Each text is read as chains of at most ``CHAIN`` words, and the chains of all texts go through together.
    """
    split = [(text or "").lower().encode("utf-8", "replace").split() for text in texts]
    sizes = np.array([len(words) for words in split], dtype=np.int64)
    total = int(sizes.sum())
    if not total:
        return
    word_scores, letters = scores([word for words in split for word in words])
    chains = -(-sizes // CHAIN)
    first_chain = np.cumsum(chains) - chains
    place = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.repeat(first_chain, sizes) + place // CHAIN, place % CHAIN
    padded = np.zeros((int(chains.sum()), CHAIN, word_scores.shape[1]), dtype=np.float32)
    mask = np.zeros(padded.shape[:2], dtype=bool)
    padded[at] = word_scores
    mask[at] = True
    marginal = _marginals(padded, mask, scores.model)[at]
    ends = np.cumsum(sizes)
    for number in np.flatnonzero(sizes).tolist():
        part = slice(int(ends[number] - sizes[number]), int(ends[number]))
        yield number, marginal[part], letters[part]


def predict(docs: DataFrame, model: Model, text_column: str = "text", word_labels: bool = False) -> DataFrame:
    """Language of every whole text from the labels of its words.

    Returns ``row`` (a struct of the other columns), ``lang_pred``, the label with the most words, counted by
    probability, and ``score``, its share of them; with ``word_labels`` also ``labels``, the likeliest label of each
    word (null for words without a letter). A text that is null or has no letter is ``und`` with score 0, and so is
    every text if the model has no label. Nothing but the text is looked at. Rows that repeat get the same
    prediction; an empty table gives no rows.
    """
    source = docs.select(whole_row(docs.drop(text_column)), F.col(text_column).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _Scores(model)
        for batch in batches:
            for part, texts in text_slices(batch, limit=2 << 20):
                found = [UNKNOWN] * len(texts)
                sure = np.zeros(len(texts))
                labels: list = [[] for _ in texts]
                for number, marginal, letters in word_marginals(texts, scores) if model.labels else ():
                    if letters.any():
                        votes = marginal[letters].sum(axis=0, dtype=np.float64)
                        best = int(votes.argmax())
                        found[number], sure[number] = model.labels[best], min(1.0, votes[best] / votes.sum())
                    if word_labels:
                        best = marginal.argmax(axis=1)
                        labels[number] = [model.labels[i] if letter else None for i, letter in zip(best, letters, strict=True)]
                columns = {"row": part.column("row"), "lang_pred": pa.array(found), "score": pa.array(sure)}
                if word_labels:
                    columns["labels"] = pa.array(labels, pa.list_(pa.string()))
                yield pa.RecordBatch.from_pydict(columns)

    schema = StructType([source.schema["row"]]).add("lang_pred", "string").add("score", "double")
    return source.mapInArrow(run, schema.add("labels", ArrayType(StringType())) if word_labels else schema)
