"""Importance resampling: draw the documents whose words look most like those of target texts."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..scratch import stored
from .rows import lowered_slices, ranked, text_slices, whole_row

# Fixed value: a word is a run of digits, lower-case letters and characters beyond ASCII.
NOT_WORD = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
# Bytes of text that go through the splitter at once; a longer word goes through whole.
SLICE = 1 << 20
# Features whose buckets a worker remembers before it forgets all of them.
REMEMBERED = 1 << 18


def splitter():
    """The pre-tokeniser: a split by pattern alone, which knows no vocabulary and is not trained."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    return Split(Regex(f"[^{NOT_WORD}]+"), behavior="removed", invert=True)


def windows(text: str | None, split, n: int) -> Iterator[tuple[int, list[str]]]:
    """Number of words and features of each slice of a text: runs of 1 to ``n`` words, joined by one space.

    The splitter gives the words as pairs of offsets. The last ``n - 1`` words of a slice are taken along to the
    next one, so runs go across slices, and no run is counted twice.
    """
    kept: list[str] = []
    for low in lowered_slices(text, f"[{NOT_WORD}]", SLICE):
        new = [low[start:end] for _, (start, end) in split.pre_tokenize_str(low)]
        words = kept + new
        features = list(new)
        for size in range(2, n + 1):
            first = max(0, len(kept) - size + 1)
            features += [" ".join(words[at : at + size]) for at in range(first, len(words) - size + 1)]
        kept = words[-(n - 1) :] if n > 1 else []
        yield len(new), features


class _Buckets(dict):
    """Buckets of features: CRC-32 of their UTF-8 modulo the number of buckets."""

    def __init__(self, buckets: int) -> None:
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        bucket = self[feature] = zlib.crc32(feature.encode()) % self.buckets
        return bucket


def bucket_counts(docs: DataFrame, n: int = 1, buckets: int = 10_000, text_column: str = "text") -> DataFrame:
    """Per document its histogram of features: ``row`` (the other columns), ``n_words``, ``n_features``, ``found``.

    ``found`` has the bucket and the number of features of each bucket that the document has. A null text has none.
    """
    source = docs.select(whole_row(docs.drop(text_column)), F.col(text_column).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, bucket_of = splitter(), _Buckets(buckets)
        for batch in batches:
            for part, texts in text_slices(batch):
                n_words = np.zeros(len(texts), dtype=np.int64)
                n_features = np.zeros(len(texts), dtype=np.int64)
                histograms = []
                for number, text in enumerate(texts):
                    merged = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
                    for words, features in windows(text, split, n):
                        n_words[number] += words
                        n_features[number] += len(features)
                        found, counts = np.unique(np.array([bucket_of[f] for f in features], dtype=np.int64), return_counts=True)
                        if len(merged[0]):  # a further slice of a long text
                            total = np.bincount(merged[0], merged[1], buckets) + np.bincount(found, counts, buckets)
                            found = np.flatnonzero(total)
                            counts = total[found].astype(np.int64)
                        merged = found, counts
                    histograms.append(merged)
                ends = np.cumsum([0, *(len(found) for found, _ in histograms)])
                pairs = pa.StructArray.from_arrays(
                    [pa.array(np.concatenate([h[i] for h in histograms]), kind) for i, kind in enumerate((pa.int32(), pa.int64()))],
                    ["bucket", "n"],
                )
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": part.column("row"),
                        "n_words": pa.array(n_words),
                        "n_features": pa.array(n_features),
                        "found": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs),
                    }
                )

    counts = StructType.fromDDL("n_words long, n_features long, found array<struct<bucket:int,n:long>>")
    return source.mapInArrow(run, StructType([source.schema["row"], *counts]))


def _pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and number of all pairs of a list column."""
    pairs = column.flatten()
    rows = pc.list_parent_indices(column).to_numpy(zero_copy_only=False)
    return rows, pairs.field("bucket").to_numpy(zero_copy_only=False), pairs.field("n").to_numpy(zero_copy_only=False)


def histogram(counted: DataFrame, buckets: int = 10_000) -> np.ndarray:
    """Features of all documents per bucket, from :func:`bucket_counts`. Every task sends one number per bucket."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            _, found, n = _pairs(batch.column(0))
            np.add.at(total, found, n)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found])], ["bucket", "n"])

    sums = counted.select("found").mapInArrow(add, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(buckets, dtype=np.int64)
    for bucket, n in sums.collect():  # a row per bucket
        total[bucket] = n
    return total


def gains(all_docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's share of the target and of all documents, one added to each."""
    size, s_all, t_all = len(all_docs), int(all_docs.sum()), int(target.sum())
    ratios = [(t + 1) * (s_all + size) / ((s + 1) * (t_all + size)) for s, t in zip(all_docs.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(ratio)) for ratio in ratios], dtype=np.int64)


def noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variate, drawn by a hash of seed and id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    share = (h.cast("long").cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(share))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    seed: int = 2024,
    n: int = 1,
    buckets: int = 10_000,
    min_words: int = 20,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Draw ``percent`` of the documents without replacement, likelier the more their words are those of ``target``.

    Features are runs of 1 to ``n`` words of the text with A-Z lower-cased, hashed into buckets. A document's
    ``weight`` sums the gains of its features, see :func:`gains`; its ``score`` adds Gumbel noise from a hash of seed
    and id, so the highest scores are a sample by weight. Of the documents with ``min_words`` words or more, the
    share with the highest scores is drawn, ties by the smaller id.

    Returns for every row ``row`` (a struct of the other columns), ``n_words``, ``n_features``, ``weight``, ``score``
    and ``rank``, 1 for the highest score, null if not drawn. A null or empty text has no features and weight 0; a
    null id counts as an empty one and goes first in ties. Rows that repeat are rows of their own. Texts go
    through in slices, so a long one takes memory for one slice and its histogram. Without target texts all buckets
    of the target are alike; an empty table gives no rows. Texts are read once; their histograms are stored.
    """
    counted = stored(bucket_counts(docs, n, buckets, text_column))
    gain = gains(histogram(counted, buckets), histogram(bucket_counts(target.select(text_column), n, buckets, text_column), buckets))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found, number = _pairs(batch.column("found"))
            weight = np.zeros(batch.num_rows, dtype=np.int64)
            np.add.at(weight, rows, gain[found] * number)
            columns = [batch.column(name) for name in ("row", "n_words", "n_features")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(weight)], ["row", "n_words", "n_features", "weight"])

    schema = StructType([counted.schema[name] for name in ("row", "n_words", "n_features")]).add("weight", "long")
    id_ = F.col(f"row.`{id_column}`")
    scored = counted.mapInArrow(weigh, schema).withColumn("score", F.col("weight") + noise(id_, seed))
    fit = F.col("n_words") >= min_words
    drawn = counted.where(fit).count() * percent // 100
    order = [F.col("_fit").desc(), F.col("score").desc(), id_.asc(), F.col("n_features").desc()]
    placed = ranked(scored.withColumn("_fit", fit), order, "_rank")
    rank = F.when(F.col("_fit") & (F.col("_rank") < drawn), F.col("_rank") + 1)
    return placed.withColumn("rank", rank.cast("long")).drop("_fit", "_rank")
