"""Near duplicates by SimHash: fingerprints of word shingles, linked at a small Hamming distance."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..scratch import stored
from .components import components
from .rows import row_key, rows_with_keys, text_slices, whole_row

BITS = 64
SEED = 42
# Pieces a fingerprint is cut into. Close pairs agree on all but `max_bits` of them.
PIECES = 8
# Fingerprints of one block that are compared in one task; a larger block is linked through shared neighbours.
BLOCK_ROWS = 20_000


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash of one text: of the 64-bit hashes of its shingles, the bits that are set in over half.

    A-Z are lower-cased; a text of fewer words is one shingle, one without words has fingerprint 0.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    last = min(shingle, len(words)) - 1
    spans = zip(starts[: len(words) - last].tolist(), ends[last:].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
    votes = np.zeros(BITS, dtype=np.int64)
    for part in np.array_split(hashes, len(hashes) // 65536 + 1):
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * votes > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, text_column: str = "text") -> DataFrame:
    """``row`` (a struct of the document's other columns) and ``fingerprint`` (64 bits as a long) of every whole text."""
    source = docs.select(whole_row(docs.drop(text_column)), F.col(text_column).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch):
                found = np.array([fingerprint(text, shingle) for text in texts], dtype="<u8").view("<i8")
                yield pa.RecordBatch.from_pydict({"row": part.column("row"), "fingerprint": pa.array(found)})

    return source.mapInArrow(run, StructType([source.schema["row"]]).add("fingerprint", "long"))


def _masks(max_bits: int, pieces: int) -> list[int]:
    """Masks of the bits on which a close pair agrees, for one of the masks at least.

    ``max_bits`` differing bits touch as many pieces at most, so some choice of the other pieces is equal.
    """
    width = BITS // pieces
    ones = [((1 << width) - 1) << (width * i) for i in range(pieces)]
    return [sum(ones[i] for i in chosen) for chosen in itertools.combinations(range(pieces), pieces - max_bits)]


def _block_keys(prints: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """A 64-bit key of each (mask, masked fingerprint), mask by mask. Mixing is one to one within a mask."""
    keys = prints[None, :] & masks[:, None]
    keys ^= (np.arange(1, len(masks) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None]
    keys ^= keys >> np.uint64(32)
    keys *= np.uint64(0xD6E8FEB86659FD93)
    keys ^= keys >> np.uint64(32)
    return keys


def spanning_links(prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of at most ``max_bits`` differing bits that connect all of ``prints`` that such links connect.

    Grows one component at a time: whatever is close to its members joins it and is not compared again, so a
    dense block takes a few passes, and no list of all its pairs is ever made.
    """
    rest = prints
    from_, to = [], []
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            here = queue.pop()
            close = np.bitwise_count(rest ^ here) <= max_bits
            if close.any():
                near = rest[close]
                from_.append(np.full(len(near), here))
                to.append(near)
                queue.extend(near)
                rest = rest[~close]
    empty = np.zeros(0, dtype=np.uint64)
    return np.concatenate([empty, *from_]), np.concatenate([empty, *to])


def links(
    distinct: DataFrame, max_bits: int = 4, pieces: int = PIECES, block_rows: int = BLOCK_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Verified links (``a``, ``b``) among distinct fingerprints, and the fingerprints (``a``) of very large blocks.

    Each fingerprint is cut into ``pieces``; a close pair agrees on ``pieces - max_bits`` of them, so it meets in
    the block of one such choice. Blocks are sorted together and read as a stream; in each, the Hamming distance
    decides, and the links that connect it are returned. Of a block above ``block_rows`` only the members are
    returned, for :func:`_neighbour_links`.
    """
    masks = np.array(_masks(max_bits, pieces), dtype=np.uint64)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("fingerprint").to_numpy().view(np.uint64)
            for part in np.array_split(prints, len(prints) // 4096 + 1):
                keys = _block_keys(part, masks).reshape(-1).view(np.int64)
                yield pa.RecordBatch.from_pydict(
                    {"block": pa.array(keys), "fingerprint": pa.array(np.tile(part.view(np.int64), len(masks)))}
                )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for prints, whole in _blocks(batches, block_rows):
            if whole:
                a, b = spanning_links(np.unique(prints), max_bits)
                arrays = pa.array(a.view(np.int64)), pa.array(b.view(np.int64))
            else:
                arrays = pa.array(prints.view(np.int64)), pa.nulls(len(prints), pa.int64())
            if len(arrays[0]):
                yield pa.RecordBatch.from_arrays(list(arrays), names=["a", "b"])

    blocks = distinct.mapInArrow(spread, "block long, fingerprint long")
    dealt = blocks.repartition("block").sortWithinPartitions("block")
    found = stored(dealt.mapInArrow(link, "a long, b long").distinct())
    return found.where("b is not null"), found.where("b is null").select("a")


def _blocks(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[tuple[np.ndarray, bool]]:
    """Fingerprints of each block of two or more, from rows sorted by block, and whether that is the whole block.

    A block above ``block_rows`` comes in parts, so no more than that and a batch is held.
    """
    key, held, large = None, [], False

    def ended() -> Iterator[tuple[np.ndarray, bool]]:
        prints = np.concatenate([np.zeros(0, dtype=np.uint64), *held])
        if large or len(prints) > 1:
            yield prints, not large

    for batch in batches:
        keys = batch.column("block").to_numpy()
        prints = batch.column("fingerprint").to_numpy().view(np.uint64)
        if not len(keys):
            continue
        edges = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        first, last = edges[1], edges[-2]
        if keys[0] != key:
            yield from ended()
            key, held, large = keys[0], [], False
        held.append(prints[:first])
        if last:  # more than one block in the batch
            yield from ended()
            middle = np.flatnonzero(np.diff(edges[1:-1]) > 1) + 1
            for start, stop in zip(edges[middle].tolist(), edges[middle + 1].tolist(), strict=True):
                yield prints[start:stop], stop - start <= block_rows
            key, held, large = keys[last], [prints[last:]], False
        if sum(map(len, held)) > block_rows:
            large = True
            yield from ended()
            held = []
    yield from ended()


def _neighbour_links(dense: DataFrame, max_bits: int) -> DataFrame:
    """Links that connect the fingerprints of very large blocks, through the points between them.

    Two fingerprints differ in at most ``max_bits`` bits exactly if there is a point within half of that from the
    one and the rest of that from the other. Each fingerprint is linked to the points around it, so the work grows with
    the number of fingerprints and not with that of pairs. A point takes part only if two fingerprints reach it.
    """
    near, far = max_bits // 2, max_bits - max_bits // 2

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = [
            sum(1 << bit for bit in chosen) for n in range(far + 1) for chosen in itertools.combinations(range(BITS), n)
        ]
        flips = np.array(flips, dtype=np.uint64)
        for batch in batches:
            prints = batch.column("a").to_numpy().view(np.uint64)
            for part in np.array_split(prints, len(prints) // 256 + 1):
                points = (part[:, None] ^ flips[None, :]).reshape(-1).view(np.int64)
                owners = np.repeat(part.view(np.int64), len(flips))
                close = np.tile(np.bitwise_count(flips) <= near, len(part))
                yield pa.RecordBatch.from_pydict({"point": pa.array(points), "a": pa.array(owners), "near": pa.array(close)})

    points = dense.distinct().mapInArrow(around, "point long, a long, near boolean")
    met = points.groupBy("point").agg(F.min(F.when(F.col("near"), F.col("a"))).alias("b"), F.count(F.lit(1)).alias("n"))
    met = met.where("n > 1 and b is not null").drop("n")
    # Many more points than the fingerprints that Spark sees them come from.
    return points.join(met.hint("merge"), "point").where("a <> b").select("a", "b").distinct()


def near_components(
    docs: DataFrame,
    shingle: int = 4,
    max_bits: int = 4,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Class of each document among those that links of at most ``max_bits`` differing fingerprint bits connect.

    Returns ``row`` (a struct of the document's columns but the text), ``fingerprint`` (long), ``component_id``,
    the smallest id that can be reached, itself included, and ``root``, a fingerprint of the class, the same for
    all of it. Copies share a fingerprint and are joined through it;
    only distinct fingerprints are compared, so no pairs of copies arise. Null and empty texts have fingerprint 0
    and are linked like any other. Null ids count for nothing in ``component_id``, which is null only where all
    ids of a class are. Rows that repeat are returned as often; an empty table gives no rows.
    """
    prints = stored(fingerprints(docs, shingle, text_column))
    least = prints.groupBy("fingerprint").agg(F.min(F.col("row")[id_column]).alias("least"))
    distinct = stored(least)
    found, dense = links(distinct.select("fingerprint"), max_bits)
    if not dense.isEmpty():
        found = found.unionByName(_neighbour_links(dense, max_bits))
    roots = stored(components(found).withColumnRenamed("node", "fingerprint"))
    by_root = roots.join(distinct, "fingerprint").groupBy("root").agg(F.min("least").alias("root_least"))
    known = distinct.join(roots, "fingerprint", "left").join(by_root, "root", "left")
    classes = known.select(
        "fingerprint",
        F.coalesce("root", "fingerprint").alias("root"),
        F.when(F.col("root").isNotNull(), F.col("root_least")).otherwise(F.col("least")).alias("component_id"),
    )
    return prints.join(classes, "fingerprint").select("row", "fingerprint", "component_id", "root")


def drop_near(
    docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One document of each class of :func:`near_components`, with all its columns: the one with the smallest id.

    Where documents of a class share that id, or none has one, the one with the least hash of its text stays.
    """
    key = row_key(F.col(id_column), F.col(text_column))
    narrow = docs.select(F.col(id_column).alias("doc_id"), key.alias("key"), F.col(text_column).alias("text"))
    classes = near_components(narrow, shingle, max_bits)
    least = F.min(F.struct(F.col("row.doc_id").isNull().alias("no_id"), F.col("row.doc_id"), F.col("row.key")))
    kept = classes.groupBy("root").agg(least.alias("least")).select("least.key")
    return rows_with_keys(docs, kept, id_column, text_column)
