"""Substring dedup: texts are cut where a gear rolling hash says so, and chunks seen before are dropped."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..scratch import stored
from .rows import text_slices, whole_row

# A 32-bit gear hash forgets a byte after 32 shifts.
WINDOW = 32
# Bits of a chunk's place that are for its size.
SIZE_BITS = 20


class Cutting(NamedTuple):
    """Sizes of chunks in bytes: ``1 << bits`` on average beyond ``least``; and the least run of chunks that is dropped, 1 for all."""

    bits: int = 5
    least: int = 16
    most: int = 256
    least_run: int = 1


@functools.cache
def _gear() -> np.ndarray:
    """A fixed random number for each byte."""
    digests = (hashlib.sha256(bytes([byte])).digest()[:4] for byte in range(256))
    return np.frombuffer(b"".join(digests), dtype="<u4").astype(np.uint32)


def gear_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Gear hash after each byte of texts that begin at ``starts``: shifts of the last 32 bytes' numbers, summed.

    Summed in doubling steps. Texts must be at least ``WINDOW`` bytes apart, over bytes that count as nothing.
    """
    hashes = _gear()[data]
    pads = np.zeros(len(data) + 1, dtype=np.int8)
    np.add.at(pads, starts[1:] - WINDOW, 1)
    np.add.at(pads, starts[1:], -1)
    hashes[np.cumsum(pads[:-1]).astype(bool)] = 0
    shift = 1
    while shift < WINDOW:
        longer = hashes.copy()
        longer[shift:] += hashes[:-shift] << np.uint32(shift)
        hashes = longer
        shift *= 2
    return hashes


def cut_points(texts: list[bytes], cutting: Cutting = Cutting()) -> list[list[int]]:
    """Ends of the chunks of each text.

    A chunk ends where the top ``bits`` of the hash are zero, but not before ``least`` bytes, and after ``most`` at
    the latest. What ends it depends on the 32 bytes before, so cuts shift along with inserted text.
    """
    sizes = np.array([len(text) for text in texts], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + WINDOW)])[:-1]
    data = np.frombuffer((b"\0" * WINDOW).join(texts), dtype=np.uint8)
    if not len(data):
        return [[] for _ in texts]
    marks = np.flatnonzero(gear_hashes(data, starts) >> np.uint32(32 - cutting.bits) == 0) + 1
    bounds = marks.searchsorted(starts, side="right"), marks.searchsorted(starts + sizes, side="right")
    found = []
    for begin, size, low, high in zip(starts.tolist(), sizes.tolist(), *(b.tolist() for b in bounds), strict=True):
        ends, start = [], 0
        for mark in (*(marks[low:high] - begin).tolist(), size):
            while mark - start > cutting.most:
                start += cutting.most
                ends.append(start)
            if mark - start >= cutting.least or mark == size > start:
                start = mark
                ends.append(start)
        found.append(ends)
    return found


def keyed(docs: DataFrame, id_column: str, text_column: str) -> list[Column]:
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return [F.col(id_column).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")]


def text_chunks(docs: DataFrame, cutting: Cutting = Cutting(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, text_hash, place, high, low`` of every chunk of every whole text, in UTF-8 bytes.

    ``place`` is where the chunk starts, shifted by ``SIZE_BITS`` bits for its size; ``high`` and ``low`` are the halves
    of its 128-bit digest. So a chunk is five numbers wherever it is stored or shuffled.
    """
    if cutting.most >> SIZE_BITS:
        raise ValueError(f"Chunks of {cutting.most} bytes are too long")
    source = docs.select(*keyed(docs, id_column, text_column))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for part, texts in text_slices(batch, limit=2 << 20):
                texts = [text.encode("utf-8", "replace") for text in texts]
                points = cut_points(texts, cutting)
                at = np.repeat(np.arange(len(texts)), [len(ends) for ends in points])
                starts = [start for ends in points for start in (0, *ends[:-1])[: len(ends)]]
                ends = [end for ends in points for end in ends]
                digests = b"".join([digest(texts[i][a:b]) for i, a, b in zip(at.tolist(), starts, ends, strict=True)])
                high, low = np.frombuffer(digests, dtype="<i8").reshape(-1, 2).T
                start = np.array(starts, dtype=np.int64)
                taken = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id").take(taken),
                        "text_hash": part.column("text_hash").take(taken),
                        "place": pa.array((start << SIZE_BITS) + np.array(ends, dtype=np.int64) - start),
                        "high": pa.array(high),
                        "low": pa.array(low),
                    }
                )

    schema = StructType([source.schema["doc_id"], source.schema["text_hash"]])
    return source.mapInArrow(run, schema.add("place", "long").add("high", "long").add("low", "long"))


def repeated_spans(chunks: DataFrame, least_run: int = Cutting().least_run) -> DataFrame:
    """``doc_id, text_hash, spans``: runs of chunks seen before, as (start, end) in bytes, for texts that have any.

    The first occurrence of a digest, by id (nulls first), text hash and start, stays; the others are seen before.
    Runs of neighbouring such chunks shorter than ``least_run`` bytes are left alone, by default none. Occurrences are
    counted before the shuffle, and the join that marks them is one that Spark splits where a digest is in most
    texts; only the chunks of one document are gathered.
    """
    # Most chunks are found once: half of the digest tells these before whole rows are grouped. Texts may be more than
    # their files show, so the join is one that never sends a side whole to all tasks.
    again = chunks.groupBy("low").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("low")
    candidates = stored(chunks.join(again.hint("merge"), "low"))
    first = F.min(F.struct("doc_id", "text_hash", "place"))
    repeated = candidates.groupBy("low", "high").agg(first.alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = candidates.join(repeated, ["low", "high"]).where(~F.struct("doc_id", "text_hash", "place").eqNullSafe(F.col("first")))
    start, size = F.shiftright("place", SIZE_BITS), F.col("place").bitwiseAND(F.lit((1 << SIZE_BITS) - 1))
    spans = F.array_sort(F.collect_list(F.struct(start.alias("start"), (start + size).alias("end"))))
    by_text = later.groupBy("doc_id", "text_hash").agg(F.array_distinct(spans).alias("spans"))

    return merged_spans(by_text, least_run)


def merged_spans(spans: DataFrame, least: int = 1) -> DataFrame:
    """The table with the sorted ``spans`` of each row joined where they touch; runs of ``least`` bytes stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [run for run in merged([(s["start"], s["end"]) for s in own]) if run["end"] - run["start"] >= least]
                for own in batch.column("spans").to_pylist()
            ]
            place = batch.schema.get_field_index("spans")
            yield batch.set_column(place, "spans", pa.array(found, SPAN_TYPE))

    return spans.mapInArrow(run, spans.schema).where(F.size("spans") > 0)


SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def merged(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    runs: list[dict[str, int]] = []
    for start, end in spans:
        if runs and start <= runs[-1]["end"]:
            runs[-1]["end"] = max(end, runs[-1]["end"])
        else:
            runs.append({"start": start, "end": end})
    return runs


def without_spans(
    docs: DataFrame, spans: DataFrame, id_column: str = "doc_id", text_column: str = "text", more: Sequence[str] = ()
) -> DataFrame:
    """Each document's bytes without its spans: ``row``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (binary).

    ``spans`` has ``doc_id, text_hash, spans`` once for each text that has any; ``row`` is a struct of the other columns.
    ``more`` names whole numbers of ``spans`` that are returned too, 0 for texts it does not have.
    """
    others = docs.drop(text_column)
    rows = docs.select(whole_row(others), *keyed(docs, id_column, text_column))
    known = spans.select(F.col("doc_id").alias("span_id"), F.col("text_hash").alias("span_hash"), "spans", *more)
    same = F.col("doc_id").eqNullSafe(F.col("span_id")) & (F.col("text_hash") == F.col("span_hash"))
    numbers_too = [F.coalesce(F.col(name), F.lit(0).cast("long")).alias(name) for name in more]
    joined = rows.join(known, same, "left").select("row", "text", "spans", *numbers_too)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch):
                rows = [
                    _without(text.encode("utf-8", "replace"), found or [])
                    for text, found in zip(texts, part.column("spans").to_pylist(), strict=True)
                ]
                n_bytes, n_removed, n_spans, kept = zip(*rows, strict=True)
                numbers = {"n_bytes": n_bytes, "n_removed": n_removed, "n_spans": n_spans}
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": part.column("row"),
                        **{name: pa.array(values, pa.int64()) for name, values in numbers.items()},
                        **{name: part.column(name) for name in more},
                        "kept": pa.array(kept, pa.binary()),
                    }
                )

    schema = StructType([joined.schema["row"]])
    for name in ("n_bytes", "n_removed", "n_spans", *more):
        schema = schema.add(name, "long")
    return joined.mapInArrow(run, schema.add("kept", "binary"))


def _without(data: bytes, spans: list[dict[str, int]]) -> tuple[int, int, int, bytes]:
    parts, at = [], 0
    for span in spans:
        parts.append(data[at : span["start"]])
        at = span["end"]
    kept = b"".join([*parts, data[at:]])
    return len(data), len(data) - len(kept), len(spans), kept


def dedup_substrings(
    docs: DataFrame, cutting: Cutting = Cutting(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Every document without the chunks that occur before it, or earlier in it: columns of :func:`without_spans`.

    Chunks are equal if their 128-bit digests are. Passages longer than a few chunks are found wherever they
    stand, whatever is inserted before them; the chunks that straddle their ends stay. A null or empty text has no
    chunks and nothing removed. Rows that repeat both id and text are the same document: they lose the same
    spans, and its first occurrence stays in each. An empty table gives no rows.

    Texts are cut twice, to count halves of digests and to keep the chunks whose half is found again: only these are
    stored, for all chunks are nearly as large as the texts.
    """
    chunks = text_chunks(docs, cutting, id_column, text_column)
    return without_spans(docs, repeated_spans(chunks, cutting.least_run), id_column, text_column)
