"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

A word has a symbol: one of its own for the most frequent words, for the others one that words with like ends and
beginnings share. A symbol is a member of a class. The model multiplies the probability of the class after the words
before it, that of the member given the class and those words, and the word's share of its symbol in the training
texts. Class and member are log-linear in features of the two words before: the last word, the pair of the last two by
hash, and the skip, the word before the last alone.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from ..scratch import stored, stored_and_observed
from .rows import SPACE, lowered_slices, text_slices, whole_row

# Words that features look back on.
HISTORY = 2
# Bytes of text of a block of documents, and words of it that go through the softmax together.
BLOCK, TOGETHER = 8 << 20, 1 << 15
# Characters of a piece of a long text.
PIECE = 1 << 20
# Numbers of a model's tables that travel in one row, and the steps that fractions of a count are rounded to.
SLOT, FRACTION = 1 << 16, 1 << 8


@dataclass(frozen=True)
class Shape:
    """Sizes and training of a model. They bound what a task keeps and sends, whatever the number of documents."""

    classes: int = 32
    members: int = 48  # of a class; the first half are single words
    pairs: int = 1 << 13  # rows for hashed pairs of words
    followers: int = 512  # rows of each class for the word before a member
    rounds: int = 3  # each a step of the gradient over as large a part of the texts
    rate: float = 0.5  # of a step; 0.25, one by the number of features, can never overshoot
    warm: float = 0.5  # share of the log ratio of each feature alone that weights start from
    smoothing: float = 20.0
    common: int = 1 << 17  # most frequent words whose number every task knows; that of others is joined

    @property
    def symbols(self) -> int:
        return self.classes * self.members

    @property
    def tables(self) -> list[tuple[int, int]]:
        """Outputs and rows of each table of weights: three for the class, then two for the member."""
        rows = [self.symbols + 1, self.symbols + 1, self.pairs]
        members = [self.classes * self.followers, self.classes * (self.classes + 1)]
        return [(self.classes, n) for n in rows] + [(self.members, n) for n in members]


class Symbols:
    """Symbols of words. ``head`` has the most frequent words, most frequent first.

    The class of a word follows from its last two bytes. The first words of each class in ``head`` are members of their
    own; others share a member with the words that begin alike and have the same two bytes before the last.
    """

    def __init__(self, shape: Shape, head: list[bytes]) -> None:
        self.shape = shape
        words = pa.array(head[: shape.symbols // 2], pa.binary())
        classes = self._shared(words) // shape.members
        alone, taken = [], [0] * shape.classes
        for at, of in enumerate(classes.tolist()):
            if taken[of] < shape.members // 2:
                alone.append((at, of * shape.members + taken[of]))
                taken[of] += 1
        self.single = words.take(pa.array([at for at, _ in alone], pa.int32()))
        self._of_single = np.array([symbol for _, symbol in alone], dtype=np.int64)

    def _shared(self, words: pa.BinaryArray) -> np.ndarray:
        """Symbols by the bytes at the ends of words; a byte that a word hasn't got counts as 0."""
        offsets = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
        data = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)
        start, end = offsets[:-1], offsets[1:]

        def byte(at: np.ndarray) -> np.ndarray:
            there = (at >= start) & (at < end)
            return np.where(there, data[np.where(there, at, 0)] if len(data) else 0, 0).astype(np.int64)

        half = self.shape.members // 2
        of = (byte(end - 1) * 509 + byte(end - 2)) * 40_503 % 65_521 % self.shape.classes
        member = ((byte(end - 3) * 257 + byte(end - 4)) * 251 + byte(start) * 263 + byte(start + 1)) * 30_011 % 65_521
        return of * self.shape.members + half + member % (self.shape.members - half)

    def of(self, words: pa.BinaryArray) -> np.ndarray:
        symbols = self._shared(words)
        if len(self.single):
            found = pc.index_in(words, value_set=self.single)
            rows = np.flatnonzero(pc.is_valid(found).to_numpy(zero_copy_only=False))
            symbols[rows] = self._of_single[found.drop_null().to_numpy()]
        return symbols

    def is_shared(self) -> np.ndarray:
        """Whether more than one word may have a symbol, for each symbol."""
        shared = np.ones(self.shape.symbols, dtype=bool)
        shared[self._of_single] = False
        return shared


@dataclass
class Lexicon:
    """What is known of words: their symbols, how often the most common ones were learned, and the mass of symbols."""

    symbols: Symbols
    common: dict[bytes, int]
    mass: np.ndarray  # of each symbol: occurrences in training of the words that share it, one added to each
    total: int  # words in training
    different: int

    def numbers(self, words: pa.BinaryArray) -> np.ndarray:
        """How often words were learned, -1 for those that are not among the most common ones."""
        return np.fromiter((self.common.get(word, -1) for word in words.to_pylist()), dtype=np.int64, count=len(words))


@dataclass
class Model:
    """Weights of the features, one table per feature with a row for each output, and shares of classes and members."""

    shape: Shape
    class_share: np.ndarray
    member_share: np.ndarray
    weights: list[np.ndarray]


def tokenised(docs: DataFrame, learn: Column, text_column: str = "text") -> DataFrame:
    """Blocks of documents as numbers of words, with the words of the block.

    Words of the text with A-Z lower-cased and an end (the empty word) after the last. A long text goes on in several
    pieces, each with the last words of the one before as context, so a block has bounded size.
    """
    source = docs.select(whole_row(docs.drop(text_column)), learn.alias("learn"), F.col(text_column).cast("string").alias("text"))

    def pieces(text: str | None) -> Iterator[tuple[int, list[bytes]]]:
        before: list[bytes] = []
        words: list[bytes] = []
        skip = 0
        for low in lowered_slices(text, SPACE, PIECE):
            if len(words) > skip:
                yield skip, words
                before = words[-HISTORY:]
                words, skip = list(before), len(before)
            words += low.encode().split()
        yield skip, [*words, b""]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, blocks, documents = TaskContext.get().partitionId() << 33, 0, 0

        def block(part: pa.RecordBatch, numbers: list[int], doc: list[int], sizes: list[int], skips: list[int], words: list[bytes]) -> pa.RecordBatch:
            index = _Numbers()
            ids = np.fromiter(map(index.__getitem__, words), dtype=np.int32, count=len(words))
            at = pa.array(numbers, pa.int64())
            columns = {
                "block": pa.array([partition + blocks]),
                "row": _one(part.column("row").take(at)),
                "learn": _one(part.column("learn").take(at)),
                "doc": _one(pa.array(doc, pa.int64())),
                "size": _one(pa.array(sizes, pa.int32())),
                "skip": _one(pa.array(skips, pa.int32())),
                "ids": pa.array([_planes(ids)], pa.binary()),
                "words": pa.array([b"".join(index)], pa.binary()),
                "ends": pa.array([np.cumsum([0, *map(len, index)], dtype=np.int32).tobytes()], pa.binary()),
            }
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            for part, texts in text_slices(batch, limit=BLOCK):
                numbers, doc, sizes, skips, all_words = [], [], [], [], []
                for number, text in enumerate(texts):
                    for skip, words in pieces(text):
                        if len(all_words) > BLOCK // 4:
                            yield block(part, numbers, doc, sizes, skips, all_words)
                            blocks += 1
                            numbers, doc, sizes, skips, all_words = [], [], [], [], []
                        numbers.append(number)
                        doc.append(partition + documents)
                        sizes.append(len(words))
                        skips.append(skip)
                        all_words += words
                    documents += 1
                yield block(part, numbers, doc, sizes, skips, all_words)
                blocks += 1

    schema = StructType.fromDDL(
        "block long, learn array<boolean>, doc array<long>, size array<int>, skip array<int>, ids binary, words binary, ends binary"
    )
    rows = StructField("row", ArrayType(source.schema["row"].dataType))
    return source.mapInArrow(run, StructType([schema["block"], rows, *schema.fields[1:]]))


class _Numbers(dict):
    """Numbers of words in the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class _Block:
    """One row of :func:`tokenised` or :func:`encoded`: words or symbols, and which of them count, as context does not."""

    def __init__(self, batch: pa.RecordBatch, number: int, name: str = "ids") -> None:
        values = lambda name: batch.column(name)[number].values.to_numpy(zero_copy_only=False)
        kind = {"ids": np.int32, "symbols": np.uint16}[name]
        self.ids = _from_planes(batch.column(name)[number].as_py(), kind).astype(np.int64)
        size = values("size").astype(np.int64)
        self.pieces = len(size)
        self.piece = np.repeat(np.arange(self.pieces), size)
        self.place = np.arange(len(self.ids)) - np.repeat(np.cumsum(size) - size, size)
        self.scored = self.place >= values("skip")[self.piece]
        self.learned = self.scored & values("learn").astype(bool)[self.piece]


def _words(batch: pa.RecordBatch, number: int) -> pa.BinaryArray:
    """The different words of one row of :func:`tokenised`, which are stored as one text and where they end in it."""
    text, ends = batch.column("words")[number].as_buffer(), batch.column("ends")[number].as_buffer()
    return pa.BinaryArray.from_buffers(pa.binary(), ends.size // 4 - 1, [None, ends, text])


def word_counts(blocks: DataFrame) -> DataFrame:
    """``word`` and ``n``, its occurrences in the training texts, ends included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in range(batch.num_rows):
                block, words = _Block(batch, number), _words(batch, number)
                n = np.bincount(block.ids[block.learned], minlength=len(words))
                found = np.flatnonzero(n)
                yield from pa.Table.from_arrays([words.take(pa.array(found)), pa.array(n[found])], ["word", "n"]).to_batches(1 << 16)

    narrow = blocks.select("learn", "size", "skip", "ids", "words", "ends")
    return narrow.mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def lexicon(counts: DataFrame, total: int, different: int, shape: Shape = Shape()) -> Lexicon:
    """What ``counts``, the table of :func:`word_counts`, says of words. The driver gets ``shape.common`` words at most."""
    # Numbers from some step on a logarithmic scale up, as low as it may be for so many words.
    step = F.floor(F.log2("n") * 8)
    words_of_step = sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True)
    steps = [row["step"] for row, words in zip(words_of_step, itertools.accumulate(row["count"] for row in words_of_step)) if words <= shape.common]
    found = counts.where(step >= steps[-1]).collect() if steps else []
    common = dict(sorted(((bytes(word), n) for word, n in found), key=lambda pair: (-pair[1], pair[0])))
    symbols = Symbols(shape, list(common))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass = np.zeros(shape.symbols, dtype=np.int64)
        for batch in batches:
            np.add.at(mass, symbols.of(batch.column("word")), batch.column("n").to_numpy(zero_copy_only=False) + 1)
        found = np.flatnonzero(mass)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(mass[found])], ["symbol", "mass"])

    mass = np.zeros(shape.symbols, dtype=np.int64)
    sums = counts.select("word", "n").mapInArrow(weigh, "symbol int, mass bigint").groupBy("symbol").agg(F.sum("mass"))
    for symbol, n in sums.collect():  # a row per symbol
        mass[symbol] = n
    return Lexicon(symbols, common, mass, total, different)


def encoded(blocks: DataFrame, known: Lexicon) -> DataFrame:
    """Blocks with symbols in place of words, and of each piece what its common words add to the scores.

    ``share`` is the sum of the logarithms of the shares that words have of their symbols.
    """
    shared = known.symbols.is_shared()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in range(batch.num_rows):
                block, words = _Block(batch, number), _words(batch, number)
                n, symbol = known.numbers(words), known.symbols.of(words)
                common = n >= 0
                share = np.where(shared[symbol] & common, np.log10((n + 1).clip(1) / (known.mass[symbol] + 1)), 0.0)
                base = np.where(common, np.log10((n + 1).clip(1) / (known.total + known.different + 1)), 0.0)
                sums = lambda values, block=block: np.bincount(block.piece, weights=values * block.scored, minlength=block.pieces)
                columns = {name: batch.column(name).slice(number, 1) for name in ("block", "row", "learn", "doc", "size", "skip")}
                columns["symbols"] = pa.array([_planes(symbol[block.ids].astype(np.uint16))], pa.binary())
                columns["n_tokens"] = _one(pa.array(sums(np.ones(len(block.ids))).astype(np.int64)))
                columns["n_known"] = _one(pa.array(sums((n > 0)[block.ids]).astype(np.int64)))
                columns["base"] = _one(pa.array(sums(base[block.ids])))
                columns["share"] = _one(pa.array(sums(share[block.ids])))
                yield pa.RecordBatch.from_pydict(columns)

    added = StructType.fromDDL("symbols binary, n_tokens array<long>, n_known array<long>, base array<double>, share array<double>")
    kept = [blocks.schema[name] for name in ("block", "row", "learn", "doc", "size", "skip")]
    return blocks.mapInArrow(run, StructType([*kept, *added]))


def _one(values: pa.Array) -> pa.ListArray:
    """A list of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def features(shape: Shape, symbol: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Class and member of each word of a block, and its rows in the tables; ``place`` counts from a piece's start."""

    def back(steps: int) -> np.ndarray:
        before = np.full(len(symbol), shape.symbols, dtype=np.int64)  # what stands before a text
        before[steps:] = symbol[:-steps] if len(symbol) > steps else symbol[:0]
        before[place < steps] = shape.symbols
        return before

    last, second = back(1), back(2)
    of = symbol // shape.members
    pair = (last * 40_503 + second * 30_011 + last * second % 8_191) % shape.pairs
    follower = of * shape.followers + last * 40_503 % 65_521 % shape.followers
    skip = of * (shape.classes + 1) + second // shape.members
    return of, symbol % shape.members, [last, second, pair, follower, skip]


def outputs(factors: list[np.ndarray], rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Products of the factors of the features for each output and word, and their sums over outputs."""
    products = np.empty((len(factors[0]), len(rows[0])), dtype=np.float32)
    other = np.empty(len(rows[0]), dtype=np.float32)
    for output, row in enumerate(products):
        np.take(factors[0][output], rows[0], out=row, mode="clip")
        for factor, at in zip(factors[1:], rows[1:], strict=True):
            row *= np.take(factor[output], at, out=other, mode="clip")
    return products, products.sum(axis=0)


def model_factors(model: Model) -> list[np.ndarray]:
    """Powers of e of the weights, so that a word costs products alone; shares are in the first table of each kind."""
    factors = [np.exp(weights) for weights in model.weights]
    factors[0] *= model.class_share[:, None]
    factors[3] *= np.repeat(model.member_share.T, model.shape.followers, axis=1)
    return factors


def _softmaxes(shape: Shape, symbol: np.ndarray, place: np.ndarray, wanted: np.ndarray) -> Iterator[tuple]:
    """For some wanted words at a time: their places, and for both softmaxes the tables, rows and what came out."""
    of, member, rows = features(shape, symbol, place)
    for at in range(0, len(wanted), TOGETHER):
        cut = wanted[at : at + TOGETHER]
        some = [row[cut] for row in rows]
        yield cut, [(range(3), some[:3], of[cut]), (range(3, 5), some[3:], member[cut])]


def log_probabilities(shape: Shape, symbol: np.ndarray, place: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Natural logarithm of the probability of each symbol after those before it."""
    result = np.zeros(len(symbol))
    for cut, kinds in _softmaxes(shape, symbol, place, np.arange(len(symbol))):
        for tables, rows, out in kinds:
            products, sums = outputs([factors[i] for i in tables], rows)
            result[cut] += np.log(products[out, np.arange(len(out))].astype(np.float64) / sums)
    return result


def observed(shape: Shape, symbol: np.ndarray, place: np.ndarray, wanted: np.ndarray) -> list[np.ndarray]:
    """How often each output followed each feature, table by table, over the ``wanted`` words."""
    of, member, rows = features(shape, symbol, place)
    result = []
    for (n_outputs, n_rows), row, out in zip(shape.tables, rows, [of] * 3 + [member] * 2, strict=True):
        counts = np.bincount(out[wanted] * n_rows + row[wanted], minlength=n_outputs * n_rows)
        result.append(counts.reshape(n_outputs, n_rows))
    return result


def expected(shape: Shape, symbol: np.ndarray, place: np.ndarray, wanted: np.ndarray, factors: list[np.ndarray]) -> list[np.ndarray]:
    """How often the model expects each output after each feature; less than observed means a higher weight."""
    result = [np.zeros(table, dtype=np.float32) for table in shape.tables]
    for _, kinds in _softmaxes(shape, symbol, place, wanted):
        for tables, rows, _ in kinds:
            products, sums = outputs([factors[i] for i in tables], rows)
            products /= sums
            for table, row in zip(tables, rows, strict=True):
                for sums_of, product in zip(result[table], products, strict=True):
                    np.add.at(sums_of, row, product)
    return result


def _summed(blocks: DataFrame, shape: Shape, measure) -> list[np.ndarray]:
    """Sum over all blocks of ``measure(symbol, place, wanted)``, a number for each weight of a model.

    Every task adds up its blocks; the sums travel in slots, which other tasks add up as they stream by.
    """
    size = sum(a * b for a, b in shape.tables)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(table) for table in shape.tables]
        for batch in batches:
            for symbol, place, learned in _some_blocks(batch):
                for table, found in zip(sums, measure(symbol, place, np.flatnonzero(learned)), strict=True):
                    table += found
        total = np.rint(np.concatenate([table.reshape(-1) for table in sums]) * FRACTION).astype(np.int64)
        if total.any():
            yield from _slots({i: total[at : at + SLOT] for i, at in enumerate(range(0, size, SLOT))})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, values in zip(batch.column("slot").to_pylist(), batch.column("sums"), strict=True):
                numbers = _unpacked(values.as_py())
                sums[slot] = sums[slot] + numbers if slot in sums else numbers
        yield from _slots(sums)

    schema = "slot int, sums binary"
    partial = blocks.select("learn", "size", "skip", "symbols").mapInArrow(part, schema)
    total = np.zeros(size, dtype=np.int64)
    for slot, sums in partial.repartition("slot").mapInArrow(add, schema).toLocalIterator():  # as many rows as slots
        numbers = _unpacked(bytes(sums))
        total[slot * SLOT : slot * SLOT + len(numbers)] = numbers
    ends = np.cumsum([a * b for a, b in shape.tables])
    return [part.reshape(table) / FRACTION for part, table in zip(np.split(total, ends[:-1]), shape.tables, strict=True)]


def _some_blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Symbols, places and whether they are learned, of as many blocks of a batch as make some hundred thousand words."""
    some: list[_Block] = []
    for number in range(batch.num_rows):
        some.append(_Block(batch, number, "symbols"))
        if number == batch.num_rows - 1 or sum(len(block.ids) for block in some) > 8 * TOGETHER:
            yield tuple(np.concatenate([getattr(block, name) for block in some]) for name in ("ids", "place", "learned"))
            some = []


def _slots(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for slot, values in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([_packed(values)], pa.binary())], ["slot", "sums"])


def _packed(numbers: np.ndarray) -> bytes:
    return _planes((numbers << 1) ^ (numbers >> 63))


def _unpacked(packed: bytes) -> np.ndarray:
    signs = _from_planes(packed, np.uint64)
    return (signs >> np.uint64(1)).view(np.int64) ^ -(signs & np.uint64(1)).view(np.int64)


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers, most of them small, as compressed byte planes: empty planes take no space."""
    return zlib.compress(numbers.view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes(), 1)


def _from_planes(packed: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def warm_model(shape: Shape, seen: list[np.ndarray]) -> Model:
    """Shares of classes and members, and weights that give each feature alone its share of the log ratio it shows."""
    class_share = seen[0].sum(axis=1) + 1.0
    class_share /= class_share.sum()
    # The rows of the last table are classes by the class before: summed, how often each member is the class's.
    members = seen[4].reshape(shape.members, shape.classes, shape.classes + 1).sum(axis=2).T + 0.1
    member_share = members / members.sum(axis=1, keepdims=True)
    weights = []
    for number, (counts, (_, n_rows)) in enumerate(zip(seen, shape.tables, strict=True)):
        share = class_share[:, None] if number < 3 else np.repeat(member_share.T, n_rows // shape.classes, axis=1)
        ratio = (counts + shape.smoothing * share) / ((counts.sum(axis=0) + shape.smoothing) * share)
        weights.append((shape.warm * np.log(ratio)).astype(np.float32))
    return Model(shape, class_share.astype(np.float32), member_share.astype(np.float32), weights)


def stepped(model: Model, seen: list[np.ndarray], excess: list[np.ndarray]) -> Model:
    """A step up the gradient of the likelihood, ``excess``, what was observed less what was expected.

    It is scaled by how often a weight is in use, the larger of what was observed and expected. ``seen`` has the
    counts of all training texts, of which a step takes its share.
    """
    shape = model.shape
    for weights, all_seen, gradient in zip(model.weights, seen, excess, strict=True):
        share = all_seen / shape.rounds
        weights += (shape.rate * gradient / (np.maximum(share, share - gradient) + shape.smoothing)).astype(np.float32)
    return model


def learn(blocks: DataFrame, shape: Shape = Shape()) -> Model:
    """Fit a model to the training documents of all blocks of :func:`encoded`.

    One pass counts what follows each feature; then ``shape.rounds`` steps of the gradient, each summed over the
    tasks on a part of the blocks, which together are all of them. Sums travel as whole numbers, so the order in which
    tasks end changes nothing. The driver holds the model, whose size ``shape`` says.
    """
    seen = _summed(blocks, shape, lambda *words: observed(shape, *words))
    model = warm_model(shape, seen)
    for turn in range(shape.rounds):
        factors = model_factors(model)

        def gradient(symbol: np.ndarray, place: np.ndarray, wanted: np.ndarray, factors=factors) -> list[np.ndarray]:
            tables = zip(observed(shape, symbol, place, wanted), expected(shape, symbol, place, wanted, factors), strict=True)
            return [o - e for o, e in tables]

        share = blocks.where(F.pmod(F.xxhash64("block"), F.lit(shape.rounds)) == turn)
        model = stepped(model, seen, _summed(share, shape, gradient))
    return model


def lm_scores(docs: DataFrame, learn_from: Column, shape: Shape = Shape(), text_column: str = "text") -> DataFrame:
    """Log probability of every whole text under a model learned from the rows where ``learn_from`` holds.

    Returns for every row ``row`` (a struct of the other columns), ``learned``, ``n_tokens`` (words and the end),
    ``n_known`` (those found in training), ``train_tokens``, ``base_score`` (add-one unigram) and ``score`` (the model),
    both as logarithms to base 10. A word not found in training counts as one occurrence in its symbol. A null text
    is an empty one, whose only token is the end; where ``learn_from`` is null the row is not learned from. Rows that
    repeat are rows of their own; an empty table gives no rows, and one without training texts scores by a model
    of nothing, all words alike. Long texts go through in pieces, so a task holds a few MB of text at a time.
    """
    blocks = stored(tokenised(docs, F.coalesce(learn_from, F.lit(False)), text_column))
    counts, seen = stored_and_observed(word_counts(blocks), total=F.sum("n"), different=F.count(F.lit(1)))
    known = lexicon(counts, seen["total"] or 0, seen["different"] or 0, shape)
    in_symbols = stored(encoded(blocks, known))
    model = learn(in_symbols, shape)
    row = blocks.schema["row"].dataType.elementType
    schema = StructType.fromDDL("doc long, learned boolean, n_tokens long, n_known long, base_score double, score double")
    scored = in_symbols.mapInArrow(_score(model), StructType([StructField("row", row), *schema]))
    # A text's words that are not among the most common ones are joined with their numbers.
    rare = blocks.select("doc", "size", "skip", "learn", "ids", "words", "ends").mapInArrow(_rare(known), "doc bigint, word binary, times bigint, mass bigint")
    n = F.coalesce("n", F.lit(0))
    found = rare.join(counts, "word", "left").groupBy("doc")
    added = found.agg(
        F.sum(F.when(n > 0, F.col("times"))).alias("n_known"),
        F.sum(F.col("times") * F.log10((n + 1) / F.lit(float(known.total + known.different + 1)))).alias("base_score"),
        F.sum(F.col("times") * F.log10((n + 1) / (F.col("mass") + 1))).alias("score"),
    )
    nulls = [F.lit(None).cast(field.dataType).alias(field.name) for field in scored.schema if field.name in ("row", "learned", "n_tokens")]
    both = scored.unionByName(added.select("doc", *nulls, "n_known", "base_score", "score"))
    sums = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("n_tokens", "n_known", "base_score", "score")]
    whole = both.groupBy("doc").agg(F.first("row", True).alias("row"), F.first("learned", True).alias("learned"), *sums)
    return whole.select("row", "learned", "n_tokens", "n_known", F.lit(known.total).cast("long").alias("train_tokens"), "base_score", "score")


def _score(model: Model):
    """Scores of the pieces of each block, without the shares that rare words have of their symbols."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = model_factors(model)
        for batch in batches:
            for number in range(batch.num_rows):
                block = _Block(batch, number, "symbols")
                log_p = log_probabilities(model.shape, block.ids, block.place, factors) * block.scored
                of_piece = lambda name, batch=batch, number=number: batch.column(name)[number].values
                score = np.bincount(block.piece, weights=log_p, minlength=block.pieces) / np.log(10)
                columns = {"row": of_piece("row"), "doc": of_piece("doc"), "learned": of_piece("learn")}
                columns |= {"n_tokens": of_piece("n_tokens"), "n_known": of_piece("n_known"), "base_score": of_piece("base")}
                columns["score"] = pa.array(score + of_piece("share").to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _rare(known: Lexicon):
    """Of each text its words that are not among the most common ones: how often, and the mass of their symbols."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in range(batch.num_rows):
                block, words = _Block(batch, number), _words(batch, number)
                rows = np.flatnonzero((known.numbers(words) < 0)[block.ids] & block.scored)
                pairs, times = np.unique(block.piece[rows] * len(words) + block.ids[rows], return_counts=True)
                piece, word = np.divmod(pairs, max(1, len(words)))
                columns = {
                    "doc": batch.column("doc")[number].values.take(pa.array(piece)),
                    "word": words.take(pa.array(word)),
                    "times": pa.array(times, pa.int64()),
                    "mass": pa.array(known.mass[known.symbols.of(words)[word]]),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return run
