"""Token sequences of bounded length, filled by best-two-fit."""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..scratch import stored
from .rows import ranked, text_slices, whole_row

CAPACITY = 1024

# Fixed value: the pattern by which byte-level BPE of this family cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# White space of that pattern in runs that are kept from its look-ahead, which fails at some 1,000,000 characters.
LONG_RUN = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{65536,}")


@functools.cache
def encoding(vocabulary: str):
    """Byte-level BPE of a ``tokenizers`` file, run by ``tiktoken``, which gives the same ids in a fifth of the time.

    The ids of the vocabulary grow in the order of its merges, single bytes first, so they are the ranks that
    ``tiktoken`` needs. Special tokens of the file are found in texts, as the file's own library does.
    """
    import tiktoken

    with open(vocabulary, encoding="utf-8") as file:
        tokenizer = json.load(file)
    special = {token["content"]: token["id"] for token in tokenizer["added_tokens"]}
    byte_of = _byte_alphabet()
    ranks = {
        bytes(byte_of[c] for c in piece): number
        for piece, number in tokenizer["model"]["vocab"].items()
        if piece not in special
    }
    return tiktoken.Encoding(vocabulary, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def _byte_alphabet() -> dict[str, int]:
    """The byte that each printable character of such a vocabulary file stands for."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = sorted(set(range(256)) - set(printable))
    return {chr(byte): byte for byte in printable} | {chr(256 + i): byte for i, byte in enumerate(others)}


def tokenized_pieces(
    docs: DataFrame,
    vocabulary: str,
    end_id: int = 2,
    capacity: int = CAPACITY,
    text_column: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """The token ids of every whole text, then ``end_id``, cut into pieces of at most ``capacity`` tokens.

    Returns ``row`` (a struct of the document's other columns), ``piece`` from 0, ``start`` (ids of the document
    before the piece), ``length``, ``ids`` (unsigned 32-bit, little-endian; left out unless ``keep_ids``) and
    ``ids_crc32``, their CRC. Only documents longer than ``capacity`` are cut, and then all pieces but the first
    are full. A null or empty text is the end id alone. Rows that repeat give pieces that repeat; an empty table
    gives none. ``vocabulary`` is the path of a ``tokenizers`` file of byte-level BPE, present on every executor.
    """
    others = docs.drop(text_column)
    source = docs.select(whole_row(others), F.col(text_column).cast("string").alias("text"))
    fields = {"piece": ("integer", pa.int32()), "start": ("long", pa.int64()), "length": ("long", pa.int64())}
    fields |= {"ids": ("binary", pa.binary())} if keep_ids else {}
    fields |= {"ids_crc32": ("long", pa.int64())}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoding(vocabulary)
        for batch in batches:
            for part, texts in text_slices(batch):
                pieces = [
                    (at, piece, start, len(ids) // 4, ids, zlib.crc32(ids))
                    for at, text in enumerate(texts)
                    for piece, start, ids in _pieces(bpe, text or "", end_id, capacity)
                ]
                at, *columns = zip(*pieces, strict=True)
                columns = dict(zip(("piece", "start", "length", "ids", "ids_crc32"), columns, strict=True))
                arrays = {name: pa.array(columns[name], kind) for name, (_, kind) in fields.items()}
                yield pa.RecordBatch.from_pydict({"row": part.column("row").take(pa.array(at)), **arrays})

    schema = StructType([source.schema["row"]])
    for name, (kind, _) in fields.items():
        schema = schema.add(name, kind)
    return source.mapInArrow(cut, schema)


def _pieces(bpe, text: str, end_id: int, capacity: int) -> Iterator[tuple[int, int, bytes]]:
    """Number, start and ids of each piece of one text."""
    found = _ids(bpe, text)
    found.append(end_id)
    ids = np.array(found, dtype="<u4")
    first = len(ids) % capacity or capacity
    for piece, stop in enumerate(range(first, len(ids) + 1, capacity)):
        start = max(0, stop - capacity) if piece else 0
        yield piece, start, ids[start:stop].tobytes()


def _ids(bpe, text: str) -> list[int]:
    special = [token for token in bpe.special_tokens_set if token in text]
    if len(text) < 65536 or not LONG_RUN.search(text):
        return bpe.encode(text, allowed_special="all") if special else bpe.encode_ordinary(text)
    if not special:
        return _ids_around_runs(bpe, text)
    longest_first = sorted(special, key=len, reverse=True)
    parts = re.split(f"({'|'.join(map(re.escape, longest_first))})", text)
    ids: list[int] = []
    for i, part in enumerate(parts):
        ids += [bpe.encode_single_token(part)] if i % 2 else _ids_around_runs(bpe, part)
    return ids


def _ids_around_runs(bpe, text: str) -> list[int]:
    """Ids of a text without special tokens; a long run of white space is merged as what the pattern would cut.

    That is the whole run at the end of the text, and all but its last character elsewhere.
    """
    ids: list[int] = []
    at = 0
    for run in LONG_RUN.finditer(text):
        stop = run.end() if run.end() == len(text) else run.end() - 1
        ids += bpe.encode_ordinary(text[at : run.start()])
        ids += bpe._encode_single_piece(text[run.start() : stop])
        at = stop
    return ids + bpe.encode_ordinary(text[at:])


def best_two_fit(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Fill bins with items of the given lengths; ``counts[n]`` items have length ``n``.

    Returns (lengths in the bin, number of such bins). A bin is filled greedily with the longest item that
    still fits; if a gap is left, its smallest item is replaced by the two unpacked items that together fill
    the widened gap best, where they fill it better than the one did. What goes into a bin depends only on
    which lengths are left, so equal bins are made together until one of their lengths runs out: the work
    depends on the capacity, not on the number of items.
    """
    left = counts.astype(np.int64).copy()
    bins = []
    while left.any():
        bin_ = _one_bin(left, capacity)
        lengths, times = np.unique(bin_, return_counts=True)
        made = int((left[lengths] // times).min())
        left[lengths] -= made * times
        bins.append((tuple(sorted(bin_, reverse=True)), made))
    return bins


def _one_bin(left: np.ndarray, capacity: int) -> list[int]:
    left = left.copy()
    bin_: list[int] = []
    gap = capacity
    while (fits := np.flatnonzero(left[: gap + 1])).size:
        bin_.append(int(fits[-1]))
        left[fits[-1]] -= 1
        gap -= bin_[-1]
    if gap and bin_:
        smallest = min(bin_)
        room = gap + smallest
        # One item of each length, and a second partner of each: the best sum of two that is at most the room.
        first = np.flatnonzero(left[: room + 1])
        available = np.concatenate([[0], np.maximum.accumulate(np.where(left[1:] > 0, np.arange(1, len(left)), 0))])
        partner = available[room - first]
        same = (partner == first) & (left[first] < 2)
        partner = np.where(same, available[np.maximum(first - 1, 0)], partner)
        sums = np.where(partner > 0, first + partner, 0)
        if sums.size and sums.max() > smallest:
            best = int(sums.argmax())
            bin_.remove(smallest)
            bin_ += [int(first[best]), int(partner[best])]
    return bin_


def pack(pieces: DataFrame, capacity: int = CAPACITY, length_column: str = "length") -> DataFrame:
    """Place pieces of at most ``capacity`` tokens into as few sequences as best-two-fit finds.

    Adds ``sequence_id`` (from 0) and ``offset`` (place in the sequence, from 0 without gaps) to the columns of
    ``pieces``. The pieces are ranked by length and stored; only the number of pieces of each length, at most
    ``capacity`` numbers, is gathered. Bins are planned from these, and each piece finds its place from its
    rank, so no task holds more than its share, even if most pieces have one length. Pieces that repeat are
    each placed. A length that is null, below 1 or above the capacity is an error; an empty table gives no rows.
    """
    columns = [F.monotonically_increasing_id().alias("_piece"), whole_row(pieces, "_row")]
    wide = stored(pieces.select(*columns, F.col(length_column).cast("long").alias("_length")))
    # Numbers alone are sorted; the pieces, with their ids, move once.
    table = ranked(wide.select("_piece", "_length"), ["_length", "_piece"], "_rank")
    wrong = F.col("_length").isNull() | ~F.col("_length").between(1, capacity)
    if not table.where(wrong).isEmpty():
        raise ValueError(f"Lengths must be from 1 to {capacity}")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in table.groupBy("_length").count().collect():  # at most one row per possible length
        counts[length] = n
    starts, sequences, offsets = _slots(best_two_fit(counts, capacity), counts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("_rank").to_numpy()
            slot = starts.searchsorted(rank, side="right") - 1
            sequence = pa.array(sequences[slot] + rank - starts[slot])
            yield pa.RecordBatch.from_pydict(
                {"_piece": batch.column("_piece"), "sequence_id": sequence, "offset": pa.array(offsets[slot])}
            )

    placed = table.select("_piece", "_rank").mapInArrow(place, "_piece long, sequence_id long, offset long")
    return wide.join(placed, "_piece").select("_row.*", "sequence_id", "offset")


def _slots(bins: list[tuple[tuple[int, ...], int]], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First rank, first sequence and offset of each run of pieces that take the same place in equal bins."""
    next_rank = np.concatenate([[0], np.cumsum(counts)[:-1]])
    slots = []
    sequence = 0
    for lengths, made in bins:
        offset = 0
        for length in lengths:
            slots.append((next_rank[length], sequence, offset))
            next_rank[length] += made
            offset += length
        sequence += made
    table = np.array(sorted(slots), dtype=np.int64).reshape(-1, 3)
    return table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy()


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id`` and ``ids``, the pieces' ids in order of their offsets."""
    pieces = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most a sequence's tokens
    joined = packed.groupBy("sequence_id").agg(pieces.alias("pieces"))
    return joined.select("sequence_id", F.concat_ws("", F.transform("pieces", lambda p: F.hex(p["ids"]))).alias("hex")).select(
        "sequence_id", F.unhex("hex").alias("ids")
    )
