"""Suffix-array dedup: every byte covered by a string of some length that also occurs elsewhere."""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from ..scratch import stored
from .chunks import SPAN_TYPE, keyed, merged, without_spans
from .rows import text_slices
from .suffixes import SuffixArray

LENGTH = 400
# Bytes of the strings whose least hash tells in which group a longer string is compared.
MARK = 64
# Most strings of `length` bytes in one segment.
SEGMENT = 1024
# Of a rolling hash; odd, so that no power of it loses bits.
FACTOR = 0x9E3779B97F4A7C15
# Bytes of text that are compared at once, in whole groups.
ARRAY_BYTES = 1 << 18
# Bytes of text in a group above which it is settled by hashes of its strings.
GROUP_BYTES = 1 << 20

# A segment's group and the halves of its digest.
SEGMENT_KEY = ("mark", "high", "low")
SEGMENT_COLUMNS = "mark long, high long, low long"
SPANS_FIELD = StructField("spans", ArrayType(StructType().add("start", "long").add("end", "long")))
# Spans of repeats by the length of string that they were found for.
SPANS = "array<struct<length:int,start:bigint,end:bigint>>"
MARKED_SPANS = pa.list_(pa.struct([("length", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))


def _mark_hashes(data: np.ndarray, size: int = MARK) -> np.ndarray:
    """A 64-bit hash of each string of ``size`` bytes, a power of two, by doubling."""
    factor = np.array([0x9E3779B97F4A7C15], dtype=np.uint64)
    hashes = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    step = 1
    while step < size:
        hashes = hashes[:-step] + hashes[step:] * factor
        factor = factor * factor
        step *= 2
    hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    return hashes ^ (hashes >> np.uint64(32))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value in each window of ``width``."""
    step = 1
    while 2 * step <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def segments(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive strings of ``length`` bytes with the same least mark: mark, first, number, and weight.

    Equal strings have the same least mark, so they meet in its group; a run needs only ``length - 1`` bytes more
    than it has strings. Strings of the same run can be equal only if their mark occurs twice in it, which weighs 2.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return none, none, none, none
    hashes = _mark_hashes(np.frombuffer(data, dtype=np.uint8))
    width = length - MARK + 1
    least = _least(hashes, width)
    first = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    size = np.diff(np.append(first, len(least)))
    if size.max() > SEGMENT:
        parts = -(-size // SEGMENT)
        inner = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        ends = np.repeat(first + size, parts)
        first = np.repeat(first, parts) + inner * SEGMENT
        size = np.minimum(ends - first, SEGMENT)
    marks = least[first]
    weight = np.ones(len(first), dtype=np.int64)
    values, times = np.unique(hashes, return_counts=True)
    if len(values) < len(hashes):
        for i in np.flatnonzero(np.isin(marks, values[times > 1])).tolist():
            weight[i] = min(2, int((hashes[first[i] : first[i] + size[i] + width - 1] == marks[i]).sum()))
    return marks.view(np.int64), first, size, weight


def _segment_rows(texts: DataFrame, length: int, longest: int) -> DataFrame:
    """``doc_id, text_hash, mark, first, size, bytes, weight, high, low`` of every segment of every text.

    ``bytes`` is what the strings of ``longest`` bytes need that start in the segment, as far as the text goes;
    ``high`` and ``low`` are the halves of the 128-bit digest of these bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        more = longest - 1
        for batch in batches:
            for part, values in text_slices(batch, limit=1 << 20):
                found = []
                sizes = []
                digests = []
                for text in values:
                    data = text.encode("utf-8", "replace")
                    rows = segments(data, length)
                    found.append(rows)
                    sizes.append(np.minimum(rows[2] + more, len(data) - rows[1]))
                    digests += [digest(data[a : a + n + more]) for a, n in zip(rows[1].tolist(), rows[2].tolist(), strict=True)]
                marks, first, size, weight = (np.concatenate(column) for column in zip(*found, strict=True))
                taken = pa.array(np.repeat(np.arange(len(found)), [len(rows[0]) for rows in found]))
                high, low = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2).T
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id").take(taken),
                        "text_hash": part.column("text_hash").take(taken),
                        "mark": pa.array(marks),
                        "first": pa.array(first.astype(np.int32)),
                        "size": pa.array(size.astype(np.int32)),
                        "bytes": pa.array(np.concatenate(sizes).astype(np.int32)),
                        "weight": pa.array(weight.astype(np.int32)),
                        "high": pa.array(high),
                        "low": pa.array(low),
                    }
                )

    schema = StructType([texts.schema["doc_id"], texts.schema["text_hash"]]).add("mark", "long")
    for name in ("first", "size", "bytes", "weight"):
        schema = schema.add(name, "integer")
    return texts.mapInArrow(run, schema.add("high", "long").add("low", "long"))


def _segment_texts(texts: DataFrame, distinct: DataFrame) -> DataFrame:
    """``mark, high, low, n, size, text`` of each of the distinct segments, read from the document that has it first."""
    wanted = F.collect_list(F.struct(*SEGMENT_KEY, "n", "at.first", "at.size", "at.bytes")).alias("wanted")
    by_text = distinct.groupBy(F.col("at.doc_id").alias("in_id"), F.col("at.text_hash").alias("in_hash")).agg(wanted)
    same = F.col("doc_id").eqNullSafe(F.col("in_id")) & (F.col("text_hash") == F.col("in_hash"))
    # Rows that repeat id and text are read once.
    found = by_text.join(texts.select("doc_id", "text_hash", "text"), same).dropDuplicates(["in_id", "in_hash"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, values in text_slices(batch, limit=1 << 20):
                for text, segs in zip(values, part.column("wanted"), strict=True):
                    data = text.encode("utf-8", "replace")
                    segs = segs.values
                    spans = zip(segs.field("first").to_pylist(), segs.field("bytes").to_pylist(), strict=True)
                    yield pa.RecordBatch.from_pydict(
                        {
                            **{name: segs.field(name) for name in (*SEGMENT_KEY, "n", "size")},
                            "text": pa.array([data[a : a + n] for a, n in spans], pa.binary()),
                        }
                    )

    return found.select("text", "wanted").mapInArrow(run, f"{SEGMENT_COLUMNS}, n long, size int, text binary")


class _Groups:
    """Whole groups of segments, gathered until their texts fill an array."""

    def __init__(self) -> None:
        self.parts: list[pa.Table] = []
        self.bytes = 0

    def add(self, rows: pa.Table) -> None:
        self.parts.append(rows)
        self.bytes += sum(map(len, rows.column("text").to_pylist()))

    def take(self) -> pa.Table:
        table = pa.concat_tables(self.parts)
        self.parts, self.bytes = [], 0
        return table


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by mark, in tables of whole groups of about ``ARRAY_BYTES``."""
    held = _Groups()
    open_: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        marks = batch.column("mark").to_numpy()
        last = int(np.flatnonzero(marks != marks[-1])[-1]) + 1 if (marks != marks[-1]).any() else 0
        if open_ and marks[0] != open_[-1].column("mark")[-1].as_py():
            held.add(pa.concat_tables(open_))
            open_ = []
        start = 0
        while start < last:
            # Whole groups up to the size of an array.
            sizes = np.cumsum([len(text) for text in table.column("text").slice(start, last - start).to_pylist()])
            fits = max(1, int(sizes.searchsorted(ARRAY_BYTES, side="right")))
            stop = last if fits >= last - start else start + fits
            while stop < last and marks[stop] == marks[stop - 1]:
                stop += 1
            held.add(pa.concat_tables([*open_, table.slice(start, stop - start)]))
            open_ = []
            if held.bytes >= ARRAY_BYTES:
                yield held.take()
            start = stop
        open_.append(table.slice(last))
    if open_:
        held.add(pa.concat_tables(open_))
    if held.parts:
        yield held.take()


def shared_runs(texts: list[bytes], length: int) -> list[tuple[int, int, bytes]]:
    """Runs of consecutive strings of ``length`` bytes that may occur twice in the texts: text number, first, bytes."""
    starts = np.array([max(0, len(text) - length + 1) for text in texts], dtype=np.int64)
    return [(run.row, run.first, texts[run.row][run.first : run.end]) for run in _shared_runs(texts, [length], starts)]


class _Run(NamedTuple):
    """Consecutive strings of one text: its number, the first of them and how many, and the end of their bytes."""

    row: int
    first: int
    size: int
    end: int


def _shared_runs(texts: list[bytes], lengths: Sequence[int], starts: np.ndarray) -> list[_Run]:
    """Runs of strings of the first length that may occur twice, of those among the first ``starts`` of each text.

    A rolling hash of every string, from running sums, tells those that occur once. What it lets through is left
    to the suffix array, which so gets the repeated parts and not all their surroundings. A run goes on for strings
    of the greater ``lengths`` only as far as these may occur twice.
    """
    sizes = np.array([len(text) for text in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    n = len(data)
    values = _mark_hashes(np.arange(256, dtype=np.uint8), 1)[data]
    powers = np.cumprod(np.full(n, FACTOR, dtype=np.uint64))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(values * powers)])
    ends = np.cumsum(sizes)
    first = np.flatnonzero(np.arange(n) < np.repeat(ends - sizes + starts, sizes))
    owner = np.repeat(np.arange(len(texts)), starts)
    for length in lengths:
        long = np.flatnonzero(first + length <= ends[owner])
        # Moved to a common power: what stands in front of a string doesn't matter.
        hashes = (sums[first[long] + length] - sums[first[long]]) * powers[n - 1 - first[long]]
        order = np.argsort(hashes)
        equal = hashes[order[1:]] == hashes[order[:-1]]
        twice = np.zeros(len(first), dtype=bool)
        twice[long[order[1:][equal]]] = True
        twice[long[order[:-1][equal]]] = True
        if length == lengths[0]:
            first, owner = first[twice], owner[twice]
            reach = first + length
        else:
            reach[twice] = first[twice] + length
    if not len(first):
        return []
    begins = np.flatnonzero(np.append(True, (np.diff(first) != 1) | (np.diff(owner) != 0)))
    rows = owner[begins]
    before = (ends - sizes)[rows]
    columns = rows, first[begins] - before, np.diff(np.append(begins, len(first))), np.maximum.reduceat(reach, begins) - before
    return [_Run(*run) for run in zip(*(column.tolist() for column in columns), strict=True)]


class _Repeats:
    """Maximal repeats among distinct segments, in the suffix array of the runs that may repeat.

    ``sizes`` is the number of strings of the first of the ``lengths`` that start in each segment. Its bytes go on as
    far as strings of the last one need; strings that start there belong to other segments.
    """

    def __init__(self, texts: list[bytes], sizes: list[int], lengths: Sequence[int]) -> None:
        self.lengths = lengths
        self.runs = _shared_runs(texts, lengths, np.array(sizes, dtype=np.int64))
        parts = [texts[run.row][run.first : run.end] for run in self.runs]
        self.array = SuffixArray(parts, lengths[0], [run.size for run in self.runs])

    def groups(self) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """Length, and the (segment, place in it) of all occurrences, of every maximal repeat."""
        for size, places in self.array.repeats(self.lengths[0]):
            numbers = self.array.starts.searchsorted(places, side="right") - 1
            offsets = (places - self.array.starts[numbers]).tolist()
            yield size, [(self.runs[i].row, self.runs[i].first + offset) for i, offset in zip(numbers.tolist(), offsets, strict=True)]

    def covered(self) -> Iterator[tuple[int, int, int, int]]:
        """Segment, length, start and end of the bytes covered by occurrences of at least each of the lengths.

        Of occurrences at one place, the longest counts.
        """
        n = len(self.array.data)
        reach = np.zeros(n, dtype=np.int64)
        for size, places in self.array.repeats(self.lengths[0]):
            reach[places] = np.maximum(reach[places], size)
        first = np.zeros(n, dtype=bool)
        first[self.array.starts] = True
        for length in self.lengths:
            at = np.flatnonzero(reach >= length)
            change = np.zeros(n + 1, dtype=np.int64)
            np.add.at(change, at, 1)
            np.add.at(change, at + reach[at], -1)
            inside = np.cumsum(change)[:n] > 0
            begins = np.flatnonzero(inside & (first | ~np.append(False, inside[:-1])))
            stops = np.flatnonzero(inside & np.append(first[1:] | ~inside[1:], True)) + 1
            numbers = self.array.starts.searchsorted(begins, side="right") - 1
            for number, begin, stop in zip(numbers.tolist(), begins.tolist(), stops.tolist(), strict=True):
                moved = self.runs[number].first - int(self.array.starts[number])
                yield self.runs[number].row, length, begin + moved, stop + moved


def _marked(spans: list[tuple[int, int, int]]) -> list[dict[str, int]]:
    """Spans (length, start, end) joined where those of one length touch."""
    by_length = itertools.groupby(sorted(spans), key=lambda span: span[0])
    return [{"length": length, **run} for length, own in by_length for run in merged([span[1:] for span in own])]


def _covered_whole(copies: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """``mark, high, low, spans`` of segments that occur twice: they are repeats as a whole."""
    ends = [F.least("at.bytes", F.col("at.size") + (length - 1)) for length in lengths]
    spans = F.array(
        *[
            F.struct(F.lit(length).alias("length"), F.lit(0).cast("long").alias("start"), end.cast("long").alias("end"))
            for length, end in zip(lengths, ends, strict=True)
        ]
    )
    return copies.select(*SEGMENT_KEY, F.filter(spans, lambda span: span["end"] >= span["length"]).alias("spans"))


def _covered(distinct: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """``mark, high, low, spans``: bytes of each distinct segment that a repeat covers, by length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _arrays(batches):
            texts, sizes, times = (table.column(name).to_pylist() for name in ("text", "size", "n"))
            spans: dict[int, list[tuple[int, int, int]]] = {}
            for row, (text, size, n) in enumerate(zip(texts, sizes, times, strict=True)):
                # A segment that occurs twice is a repeat as a whole.
                ends = [(length, min(len(text), size + length - 1)) for length in lengths] if n > 1 else []
                for length, end in ends:
                    if end >= length:
                        spans.setdefault(row, []).append((length, 0, end))
            for row, *span in _Repeats(texts, sizes, lengths).covered():
                spans.setdefault(row, []).append(tuple(span))
            if spans:
                rows = table.select(SEGMENT_KEY).take(pa.array(list(spans)))
                found = pa.array([_marked(own) for own in spans.values()], MARKED_SPANS)
                yield from rows.append_column("spans", found).combine_chunks().to_batches()

    dealt = distinct.repartition("mark").sortWithinPartitions("mark")
    return dealt.mapInArrow(run, f"{SEGMENT_COLUMNS}, spans {SPANS}")


def _covered_in_large(distinct: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """What :func:`_covered` gives, for groups too large for one array, from counts of their strings' hashes."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in (*SEGMENT_KEY, "n", "size", "text"))
            for mark, high, low, n, starts, text in zip(*columns, strict=True):
                for length in lengths:
                    size = max(0, min(starts, len(text) - length + 1))
                    yield pa.RecordBatch.from_pydict(
                        {
                            "string": pa.array([digest(text[i : i + length]) for i in range(size)], pa.binary()),
                            "mark": pa.array([mark] * size, pa.int64()),
                            "high": pa.array([high] * size, pa.int64()),
                            "low": pa.array([low] * size, pa.int64()),
                            "n": pa.array([n] * size, pa.int64()),
                            "length": pa.array([length] * size, pa.int32()),
                            "start": pa.array(range(size), pa.int64()),
                        }
                    )

    found = stored(distinct.mapInArrow(strings, f"string binary, {SEGMENT_COLUMNS}, n long, length int, start long"))
    again = found.groupBy("string").agg(F.sum("n").alias("times")).where("times > 1").drop("times")
    span = F.struct("length", "start", (F.col("start") + F.col("length")).alias("end"))
    spans = found.join(again, "string").groupBy(*SEGMENT_KEY).agg(F.collect_list(span).alias("spans"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [_marked([tuple(span.values()) for span in own]) for own in batch.column("spans").to_pylist()]
            yield batch.set_column(batch.schema.get_field_index("spans"), "spans", pa.array(runs, MARKED_SPANS))

    return spans.mapInArrow(joined, f"{SEGMENT_COLUMNS}, spans {SPANS}")


class _Segments(NamedTuple):
    """Segments of groups with two or more: where they are, and the distinct ones, with one place of ``n`` and their group's ``kinds``."""

    placed: DataFrame
    distinct: DataFrame


def _find_segments(texts: DataFrame, length: int, longest: int) -> _Segments:
    table = stored(_segment_rows(texts, length, longest))
    groups = table.groupBy("mark").agg(F.sum("weight").alias("weight")).where("weight > 1").select("mark")
    placed = stored(table.join(groups, "mark").drop("weight"))
    at = F.min(F.struct("doc_id", "text_hash", "first", "size", "bytes")).alias("at")
    distinct = stored(placed.groupBy(*SEGMENT_KEY).agg(at, F.count(F.lit(1)).alias("n")))
    kinds = distinct.groupBy("mark").agg(F.count(F.lit(1)).alias("kinds"))
    return _Segments(placed, distinct.join(kinds, "mark"))


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text", shorter: int | None = None
) -> DataFrame:
    """``doc_id, text_hash, spans``: the bytes of each text that lie in a string of ``length`` bytes found twice.

    With ``shorter``, a length too, the texts with a string of that many bytes found twice are returned, and
    ``n_repeated`` is the number of bytes of them that such strings cover; ``spans`` may be empty.

    Every string of the least of these lengths belongs to the group of its least mark (a hash of ``MARK`` bytes),
    and equal strings to the same one. So texts fall into segments, runs of strings of one group, and only segments
    of groups with two or more are looked at. A segment has the bytes that strings of the greatest length need which
    start in it, so these meet in the group of their beginning. Equal segments are counted, not compared, and those
    of a group with no others are never read; the distinct ones of other groups come together, and runs of their
    strings that may repeat go into an enhanced suffix array, whose scan gives the maximal repeats with all their
    occurrences. Groups whose distinct segments are more than ``GROUP_BYTES`` are settled by counting their strings'
    128-bit hashes, spread over all tasks. Matches never cross documents.
    """
    lengths = sorted({length, length if shorter is None else shorter})
    texts = docs.select(*keyed(docs, id_column, text_column))
    placed, found = _find_segments(texts, lengths[0], lengths[-1])
    alone = (F.col("kinds") == 1) & (F.col("n") > 1)
    distinct = stored(_segment_texts(texts, found.where(~alone)))
    sizes = distinct.groupBy("mark").agg(F.sum(F.octet_length("text")).alias("bytes"))
    large = stored(sizes.where(F.col("bytes") > GROUP_BYTES).select("mark"))
    if large.isEmpty():
        covered = _covered(distinct, lengths)
    else:
        small = _covered(distinct.join(large, "mark", "left_anti"), lengths)
        covered = small.unionByName(_covered_in_large(distinct.join(large, "mark", "left_semi"), lengths))
    covered = covered.unionByName(_covered_whole(found.where(alone), lengths))
    first = F.col("first").cast("long")
    shift = F.transform(
        "spans", lambda s: F.struct(s["length"].alias("length"), (s["start"] + first).alias("start"), (s["end"] + first).alias("end"))
    )
    moved = placed.join(covered, list(SEGMENT_KEY)).select("doc_id", "text_hash", shift.alias("spans"))
    by_text = moved.groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("spans")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [_marked([tuple(span.values()) for span in own]) for own in batch.column("spans").to_pylist()]
            spans = [[{"start": s["start"], "end": s["end"]} for s in own if s["length"] == length] for own in runs]
            columns = {"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"), "spans": pa.array(spans, SPAN_TYPE)}
            if shorter is not None:
                repeated = [sum(s["end"] - s["start"] for s in own if s["length"] == shorter) for own in runs]
                columns["n_repeated"] = pa.array(repeated, pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    schema = StructType([texts.schema["doc_id"], texts.schema["text_hash"], SPANS_FIELD])
    return by_text.mapInArrow(run, schema if shorter is None else schema.add("n_repeated", "long"))


def repeat_groups(docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Maximal repeats of at least ``length`` bytes with all their occurrences: ``repeat, size, doc_id, text_hash, start``.

    ``repeat`` is the hash of the string, ``size`` its bytes. A repeat that is longer than the segments it lies in is
    reported in parts, one per segment. One row per occurrence; a string within longer repeats has rows of its own.
    """
    texts = docs.select(*keyed(docs, id_column, text_column))
    placed, found = _find_segments(texts, length, length)
    distinct = _segment_texts(texts, found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for table in _arrays(batches):
            texts, sizes, times = (table.column(name).to_pylist() for name in ("text", "size", "n"))
            whole = ((len(text), [(row, 0)]) for row, (text, n) in enumerate(zip(texts, times, strict=True)) if n > 1)
            for size, places in itertools.chain(whole, _Repeats(texts, sizes, [length]).groups()):
                rows, offsets = zip(*places, strict=True)
                name = digest(texts[rows[0]][offsets[0] : offsets[0] + size])
                found = table.select(SEGMENT_KEY).take(pa.array(rows)).combine_chunks()
                found = found.append_column("repeat", pa.array([name] * len(rows), pa.binary()))
                found = found.append_column("size", pa.array([size] * len(rows), pa.int64()))
                yield from found.append_column("offset", pa.array(offsets, pa.int64())).to_batches()

    dealt = distinct.repartition("mark").sortWithinPartitions("mark")
    found = dealt.mapInArrow(run, f"{SEGMENT_COLUMNS}, repeat binary, size long, offset long")
    start = (F.col("first") + F.col("offset")).alias("start")
    placed = placed.drop("size").join(found, list(SEGMENT_KEY))
    return placed.select("repeat", "size", "doc_id", "text_hash", start).distinct()


def drop_repeats(
    docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text", shorter: int | None = None
) -> DataFrame:
    """Every document without the bytes that lie in a string of ``length`` bytes that starts anywhere else too.

    Returns ``row`` (a struct of the document's other columns), ``n_bytes``, ``n_removed``, ``n_spans`` (maximal runs
    that go) and ``kept`` (what is left of the text's UTF-8 bytes). All occurrences go, the first as well; strings
    are judged on the input. A null or empty text, and one shorter than ``length``, loses nothing, unless it
    repeats inside itself. Rows that repeat id and text are occurrences of each other; an empty table gives no rows.

    With ``shorter``, a length too, ``n_repeated`` tells how many bytes lie in a string of that many bytes that starts
    anywhere else too, so that shorter passages are seen; none of them goes for that. Both come from one search.
    """
    spans = repeated_spans(docs, length, id_column, text_column, shorter)
    return without_spans(docs, spans, id_column, text_column, [] if shorter is None else ["n_repeated"])
