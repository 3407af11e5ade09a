"""Features of GeoJSON documents of any layout, found by a structural scan of byte ranges in parallel.

A document may be one line of any length, so its lines can't be what is dealt out to tasks. Instead the text is read in
records that end at each ``}``, which Spark splits by byte ranges like lines. What a range does to the state of a scan
(inside a string or not, which brackets are open) is summed up without knowing the state that it starts in; the
summaries of a file's ranges, one small row each, are then put together in order, and with its start known every range
gives its features. Features that run over the end of a range are put together from the parts that the ranges give.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import stored

# What a record ends with: the last character of every feature.
END = b"}"
# The key whose array has the features, and what may stand between features and between documents.
FEATURES_KEY = re.compile(rb'"features"[ \t\r\n]*:[ \t\r\n]*\[')
BETWEEN_FEATURES, BETWEEN_DOCUMENTS = b" \t\r\n,", b" \t\r\n,\x1e\xef\xbb\xbf"
COMPRESSED = (".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst", ".zstd")
# What is known of an open bracket: it is the array of features, or the object that such an array was found in.
FEATURES, COLLECTION = 1, 2
# Bytes that are scanned together.
CHUNK = 4 << 20

_SUMMARIES = (
    "file string, block bigint, size bigint, bytes bigint, blank boolean,"
    "inside array<boolean>, closed array<int>, opened array<array<int>>, touched array<array<int>>"
)
_STARTS = "file string, block bigint, inside boolean, open array<int>, top_since bigint, since bigint, unfinished boolean"
_FOUND = "file string, top boolean, since bigint, block bigint, void boolean, text string"


@dataclass
class Summary:
    """What some text does to the state of a scan.

    ``inside`` says whether it ends in a string. It closes ``closed`` brackets that were open before, and leaves those
    of ``opened`` open, outermost first, with what is known of them. ``touched`` has the brackets open before, counted
    from the innermost, in which the array of features was opened.
    """

    inside: bool = False
    closed: int = 0
    opened: list[int] = field(default_factory=list)
    touched: list[int] = field(default_factory=list)

    def then(self, after: Summary) -> Summary:
        """Of this text followed by that of ``after``, which must start in the string state that this one ends in."""
        opened, touched = list(self.opened), list(self.touched)
        for back in after.touched:
            if back < len(opened):
                opened[len(opened) - 1 - back] |= COLLECTION
            else:
                touched.append(back - len(opened) + self.closed)
        kept = max(0, len(opened) - after.closed)
        closed = self.closed + max(0, after.closed - len(opened))
        return Summary(after.inside, closed, opened[:kept] + after.opened, touched)


def brackets(data: bytes, inside: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places of the brackets outside of strings, 1 for each that opens and -1 for one that closes, and the end state."""
    codes = np.frombuffer(data, dtype=np.uint8)
    quotes = np.flatnonzero(codes == ord('"'))
    slashes = codes == ord("\\")
    if slashes.any():
        # A quote is part of a string if an odd number of backslashes stands before it.
        last_other = np.maximum.accumulate(np.where(slashes, -1, np.arange(len(codes))))
        before = np.where(quotes > 0, quotes - 1 - last_other[quotes - 1], 0)
        quotes = quotes[before % 2 == 0]
    folded = codes | 0x20
    places = np.flatnonzero((folded == ord("{")) | (folded == ord("}")))
    in_string = (np.searchsorted(quotes, places) + inside) % 2 == 1
    places = places[~in_string]
    return places, np.where(folded[places] == ord("{"), 1, -1), bool((len(quotes) + inside) % 2)


def summarise(data: bytes, inside: bool) -> Summary:
    """The :class:`Summary` of a text that starts inside a string or not."""
    places, steps, ends_inside = brackets(data, inside)
    if not len(places):
        return Summary(ends_inside)
    depth = np.cumsum(steps)
    lowest_after = np.minimum.accumulate(depth[::-1])[::-1]
    left_open = np.flatnonzero((steps > 0) & (lowest_after >= depth))
    marks = {int(at): 0 for at in left_open}
    touched = []
    for match in FEATURES_KEY.finditer(data):
        at = int(np.searchsorted(places, match.end() - 1))
        if at < len(places) and places[at] == match.end() - 1:
            if at in marks:
                marks[at] |= FEATURES
            around = int(depth[at]) - 1
            holder = next((i for i in marks if depth[i] == around), None)
            if holder is not None and holder < at:
                marks[holder] |= COLLECTION
            elif around <= 0 and int(depth[:at].min(initial=0)) >= around:
                touched.append(-around)
    return Summary(ends_inside, max(0, -int(depth.min())), [marks[int(at)] for at in left_open], touched)


def _records(spark: SparkSession, path: str) -> DataFrame:
    read = spark.read.option("lineSep", END.decode()).text(path)
    place = {"file": "file_path", "block": "file_block_start", "size": "file_size"}
    return read.select(*[F.col(f"_metadata.{name}").alias(alias) for alias, name in place.items()], F.col("value").cast("binary").alias("value"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, bytes, bool]]:
    """Text of each byte range in order: the batch and row it is from, the text, whether a new range starts.

    A chunk goes on behind the ``}`` that ended the last record of the chunk before, and starts with it. So what is
    held back at the end of a range is the ``}`` alone, which the last record of a file may not have had.
    """
    current = None
    for batch in batches:
        files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
        values = batch.column("value").to_pylist()
        start = 0
        while start < len(values):
            new = current != (files[start], blocks[start])
            current = files[start], blocks[start]
            stop, size = start, 0
            while stop < len(values) and size < CHUNK and (files[stop], blocks[stop]) == current:
                size += len(values[stop]) + 1
                stop += 1
            text = END.join(values[start:stop])
            yield batch, start, text if new else END + text, new
            start = stop


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per byte range, for both string states that it may start in."""
    row: dict = {}
    both: list[Summary] = []

    def ended() -> pa.RecordBatch:
        columns = {
            **row,
            "inside": [s.inside for s in both],
            "closed": [s.closed for s in both],
            "opened": [s.opened for s in both],
            "touched": [s.touched for s in both],
        }
        kinds = {"inside": pa.bool_(), "closed": pa.int32(), "opened": pa.list_(pa.int32()), "touched": pa.list_(pa.int32())}
        arrays = {name: pa.array([value], pa.list_(kinds[name]) if name in kinds else None) for name, value in columns.items()}
        return pa.RecordBatch.from_pydict(arrays)

    for batch, at, text, new in _chunks(batches):
        if new:
            if row:
                yield ended()
            row = {name: batch.column(name)[at].as_py() for name in ("file", "block", "size")} | {"bytes": 1, "blank": True}
            both = [Summary(False), Summary(True)]
        row["bytes"] += len(text)
        row["blank"] = not text.rpartition(END)[2].strip(BETWEEN_DOCUMENTS)
        both = [before.then(summarise(text, before.inside)) for before in both]
    if row:
        yield ended()


def _starts(table: pa.Table) -> pa.Table:
    """The state in which each byte range of one file starts, from the summaries of all of them."""
    rows = sorted(table.to_pylist(), key=lambda row: row["block"])
    file = rows[0]["file"]
    # The last record of a file is counted with a ``}`` behind it, and a byte order mark isn't read.
    surplus = sum(row["bytes"] for row in rows) - rows[0]["size"]
    if file.lower().endswith(COMPRESSED):
        unfinished = rows[-1]["blank"]
    elif surplus in (1, -2, 0, -3):
        unfinished = surplus in (1, -2)
    else:
        raise ValueError(f"{file} was changed while it was read")
    found = []
    state, since = Summary(), []  # the range in which each open bracket was opened
    for number, row in enumerate(rows):
        finished = not (unfinished and number == len(rows) - 1)
        found.append((file, row["block"], state.inside, state.opened, since[0] if since else None, since[2] if len(since) > 2 else None, not finished))
        part = Summary(*(row[name][state.inside] for name in ("inside", "closed", "opened", "touched")))
        if finished:
            part = part.then(summarise(END, part.inside))
        state = state.then(part)
        since = since[: len(state.opened) - len(part.opened)] + [row["block"]] * len(part.opened)
        if state.closed:
            break
    if state.closed or state.opened or state.inside:
        raise ValueError(f"Malformed JSON: {file} closes brackets that it didn't open" if state.closed else f"Malformed JSON: {file} ends too early")
    names = ("file", "block", "inside", "open", "top_since", "since", "unfinished")
    kinds = (pa.string(), pa.int64(), pa.bool_(), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.bool_())
    return pa.table({name: pa.array(values, kind) for name, values, kind in zip(names, zip(*found, strict=True), kinds, strict=True)})


class _Range:
    """The scan of one byte range from a known start, which gives whole features and parts of those that it cuts.

    What is being read is a ``piece``: an element of the array of features, or a document (``top``) that has shown no
    such array yet. A piece goes on over chunks, and a part of one that goes on over ranges is told by the range in
    which it began.
    """

    def __init__(self, file: str, block: int, inside: bool, open_: list[int], top_since: int | None, since: int | None) -> None:
        self.file, self.block, self.inside, self.depth = file, block, inside, len(open_)
        self.collection = bool(open_) and bool(open_[0] & COLLECTION)
        self.in_features = len(open_) > 1 and bool(open_[1] & FEATURES)
        self.whole: list[tuple[bool, str]] = []
        self.parts: list[tuple] = []
        self.piece: list[bytes] | None = None
        self.began = block
        if self.in_features and self.depth > 2:
            self.piece, self.began = [], since
        elif self.depth and not self.collection:
            self.piece, self.began = [], top_since

    def _ended(self, text: bytes) -> None:
        if self.began == self.block:
            self.whole.append((not self.in_features, b"".join([*self.piece, text]).decode("utf-8", "replace")))
        else:
            self._part(text)
        self.piece = None

    def _part(self, text: bytes, void: bool = False) -> None:
        text = b"".join([*self.piece, text]).decode("utf-8", "replace")
        self.parts.append((self.file, not self.in_features, self.began, self.block, void, text))

    def _blank(self, text: bytes) -> None:
        between = BETWEEN_FEATURES if self.in_features else BETWEEN_DOCUMENTS
        if text.strip(between):
            raise ValueError(f"Malformed GeoJSON in {self.file}: {text.strip(between)[:80]!r} where a feature should be")

    def scan(self, data: bytes) -> None:
        places, steps, inside = brackets(data, self.inside)
        depth = self.depth + np.cumsum(steps)
        keys = {match.end() - 1 for match in FEATURES_KEY.finditer(data)}
        begin = 0  # of the piece, or of what stands between pieces
        outer = np.flatnonzero(depth <= np.where(steps > 0, 3, 2))
        for at, step, level in zip(places[outer].tolist(), steps[outer].tolist(), depth[outer].tolist(), strict=True):
            if step > 0:
                if level == 1 or level == 3 and self.in_features:
                    self._blank(data[begin:at])
                    if data[at : at + 1] != b"{":
                        raise ValueError(f"Malformed GeoJSON in {self.file}: an array where a feature should be")
                    self.piece, self.began, begin = [], self.block, at
                elif level == 2 and at in keys:
                    if self.piece is not None and self.began != self.block:
                        self._part(b"", void=True)
                    self.collection, self.in_features, self.piece, begin = True, True, None, at + 1
            elif level == 2 and self.in_features:
                self._ended(data[begin : at + 1])
                begin = at + 1
            elif level == 1 and self.in_features:
                self._blank(data[begin:at])
                self.in_features = False
            elif level == 0:
                if not self.collection:
                    self._ended(data[begin : at + 1])
                self.collection, begin = False, at + 1
        if self.piece is not None:
            self.piece.append(data[begin:])
        elif self.in_features or not (int(depth[-1]) if len(depth) else self.depth):
            self._blank(data[begin:])
        self.inside = inside
        self.depth = int(depth[-1]) if len(depth) else self.depth

    def end(self, unfinished: bool) -> None:
        if not unfinished:
            self.scan(END)
        if self.piece is not None:
            self._part(b"")


def _found(whole: bool):
    """Texts of whole features, or else the parts of cut ones, of records joined with the start of their range."""

    def rows(found: _Range) -> Iterator[pa.RecordBatch]:
        kept = [(found.file, top, None, found.block, False, text) for top, text in found.whole] if whole else found.parts
        kinds = (pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
        if kept:
            columns = [pa.array(values, kind) for values, kind in zip(zip(*kept, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["file", "top", "since", "block", "void", "text"])
        found.whole, found.parts = [], []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, unfinished = None, False
        for batch, at, text, new in _chunks(batches):
            if new:
                if current:
                    current.end(unfinished)
                    yield from rows(current)
                start = {name: batch.column(name)[at].as_py() for name in ("file", "block", "inside", "open", "top_since", "since", "unfinished")}
                unfinished = start.pop("unfinished")
                current = _Range(start["file"], start["block"], start["inside"], start["open"], start["top_since"], start["since"])
            current.scan(text)
            yield from rows(current)
        if current:
            current.end(unfinished)
            yield from rows(current)

    return run


def feature_texts(spark: SparkSession, path: str) -> DataFrame:
    """``text`` of every feature below ``path`` and ``top``, whether it is a document of its own.

    Documents may be a FeatureCollection, of which the elements are given, or objects of their own, also many in a
    file. Text that is no such JSON is an error. The files are read once to sum up their byte ranges when this is
    called, once for the features of the result, and once more for the parts of cut ones if any file has several ranges.
    """
    records = _records(spark, path)
    summaries = records.mapInArrow(_summaries, _SUMMARIES)
    starts = stored(summaries.groupBy("file").applyInArrow(_starts, _STARTS))  # a small row per byte range
    # Whichever way Spark joins, every range is then in one task, with its records in order.
    placed = records.withColumn("at", F.monotonically_increasing_id())
    ordered = placed.join(starts, ["file", "block"]).sortWithinPartitions("file", "block", "at")
    whole = ordered.mapInArrow(_found(True), _FOUND).select("text", "top")
    if starts.where("block > 0").isEmpty():
        return whole
    parts = ordered.mapInArrow(_found(False), _FOUND).groupBy("file", "top", "since")
    texts = F.sort_array(F.collect_list(F.struct("block", "text")))
    cut = parts.agg(F.bool_or("void").alias("void"), texts.alias("parts")).where("not void")
    return whole.union(cut.select(F.array_join(F.transform("parts", lambda part: part["text"]), "").alias("text"), "top"))
