"""Spelling variants: words that differ by one letter, grouped under their most frequent form."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import stored, stored_and_observed
from .rows import lowered_slices, text_slices

# Fixed value: letters of a word, once A-Z are lower-cased.
LETTERS = "a-zÀ-ÿ"
# Levels of the trie, and how many of them a word goes down from one table to the next.
LEVELS, STEP = 16, 4
# Letters fall into groups by their code point modulo 16; level by level these are the groups, e and u first.
GROUPS = (5, 15, 1, 9, 14, 4, 2, 3, 12, 8, 13, 0, 7, 6, 10, 11)
# Rows of a subtree that go through one task; a larger one is divided by its next levels.
SUBTREE = 1 << 16
# Different words that a worker counts before it passes them on.
REMEMBERED = 1 << 18
# Words whose subtree is searched together, and letters of candidates that are compared together.
SEARCHED, COMPARED = 1 << 12, 1 << 21
ROWS = "node bigint, own boolean, surplus int, deficit int, vector bigint, word string, n bigint"


def word_counts(
    docs: DataFrame, min_chars: int = 7, min_count: int = 2, damage: int = 0, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``word`` and ``n``, its occurrences in all texts, for words of at least ``min_chars`` letters and that many ``n``.

    With ``damage`` an occurrence loses a letter where the CRC-32 of ``<id>:<word>`` is divisible by it: the letter at
    that number modulo the length. That plants spelling errors for tests of the grouping.
    """
    run = re.compile(f"[{LETTERS}]{{{min_chars},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for part, texts in text_slices(batch):
                for id_, text in zip(part.column("id").to_pylist(), texts, strict=True):
                    start = zlib.crc32(f"{id_}:".encode())
                    for low in lowered_slices(text, f"[^{LETTERS}]"):
                        for word, n in Counter(run.findall(low)).items():
                            if damage and not (h := zlib.crc32(word.encode(), start)) % damage:
                                at = h % len(word)
                                word = word[:at] + word[at + 1 :]
                                if len(word) < min_chars:
                                    continue
                            counts[word] += n
                    if len(counts) > REMEMBERED:
                        yield _counted(counts)
                        counts.clear()
        yield _counted(counts)

    texts = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.col(text_column).cast("string").alias("text"))
    found = texts.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= min_count)


def _counted(counts: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"word": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())})


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words one after another, and where each word starts."""
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return codes, np.cumsum([0, *map(len, words)])


def vectors(words: list[str]) -> np.ndarray:
    """Frequency vectors: the number of letters of each group, 15 at most, in four bits a level from the highest.

    One letter more, less or other adds at most one to one count and takes at most one from another, cut or not.
    """
    codes, starts = letters(words)
    of_word = np.repeat(np.arange(len(words)), np.diff(starts))
    counts = np.bincount(of_word * 16 + codes % 16, minlength=len(words) * 16).reshape(-1, 16)
    packed = np.zeros(len(words), dtype=np.uint64)
    for group in GROUPS:
        packed = (packed << np.uint64(4)) | np.minimum(counts[:, group], 15).astype(np.uint64)
    return packed


def _changes() -> list[tuple[int, int, dict[int, int]]]:
    """What may change between two words in the levels of one step: surplus and deficit spent, and change by level."""
    more = [(1, 0, {i: 1}) for i in range(STEP)]
    fewer = [(0, 1, {i: -1}) for i in range(STEP)]
    return more + fewer + [(1, 1, {i: 1, j: -1}) for i in range(STEP) for j in range(STEP) if i != j]


def _descend(depth: int):
    """Rows of the nodes at ``depth`` go on to the nodes ``STEP`` levels below.

    A word goes to its own node there, and as a query to every node that its budgets reach. Of two words of one node
    that part here only that with the higher counts asks, so two words meet in exactly one node.
    """
    shift = np.uint64(64 - 4 * (depth + STEP))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
            own, surplus, deficit = column("own"), column("surplus"), column("deficit")
            below = (column("vector").view(np.uint64) >> shift) & np.uint64((1 << 4 * STEP) - 1)
            node = (column("node").view(np.uint64) << np.uint64(4 * STEP)) | below
            counts = [(below >> np.uint64(4 * (STEP - 1 - i))) & np.uint64(15) for i in range(STEP)]
            taken = [(np.arange(len(own)), node, own, surplus, deficit)]
            for more, fewer, change in _changes():
                delta = sum(by << 4 * (STEP - 1 - i) for i, by in change.items())
                fits = (surplus >= more) & (deficit >= fewer) & (~own | (delta < 0))
                for i, by in change.items():
                    fits &= counts[i] < 15 if by > 0 else counts[i] > 0
                rows = np.flatnonzero(fits)
                to = (node[rows].view(np.int64) + delta).view(np.uint64)
                taken.append((rows, to, np.zeros(len(rows), dtype=bool), surplus[rows] - more, deficit[rows] - fewer))
            rows, node, own, surplus, deficit = (np.concatenate(part) for part in zip(*taken, strict=True))
            for at in range(0, len(rows), 1 << 16):
                cut = slice(at, at + (1 << 16))
                kept = batch.select(["vector", "word", "n"]).take(pa.array(rows[cut]))
                found = [pa.array(a) for a in (node[cut].view(np.int64), own[cut], surplus[cut].astype(np.int32), deficit[cut].astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*found, *kept.columns], ["node", "own", "surplus", "deficit", "vector", "word", "n"])

    return run


def reached(leaves: np.ndarray, node: np.ndarray, vector: np.ndarray, surplus: np.ndarray, deficit: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a query and the place of a leaf it reaches from its node at ``depth``, going down level by level.

    ``leaves`` are different vectors in order, so that a node of the trie is a range of them. At each level a query
    goes on with its own count, with one more if it has surplus left, and with one less if it has deficit left.
    """
    asks, path = np.arange(len(node)), node << np.uint64(64 - 4 * depth) if depth else np.zeros_like(node)
    for level in range(depth, LEVELS):
        shift = np.uint64(60 - 4 * level)
        count = (vector[asks] >> shift) & np.uint64(15)
        more, fewer = (surplus > 0) & (count < 15), (deficit > 0) & (count > 0)
        one = np.uint64(1) << shift
        same = path | (count << shift)
        asks = np.concatenate([asks, asks[more], asks[fewer]])
        path = np.concatenate([same, same[more] + one, same[fewer] - one])
        surplus, deficit = (
            np.concatenate([surplus, surplus[more] - 1, surplus[fewer]]),
            np.concatenate([deficit, deficit[more], deficit[fewer] - 1]),
        )
        # A leaf at or above the path that has the path's levels.
        place = np.minimum(np.searchsorted(leaves, path), len(leaves) - 1)
        there = np.flatnonzero(leaves[place] >> shift == path >> shift)
        asks, path, surplus, deficit = asks[there], path[there], surplus[there], deficit[there]
    return asks, np.searchsorted(leaves, path)


def halves(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashes of the first and the last letters of each word: of half its length, and of half its length less one.

    Of near words the shorter's first half, or else its last half, is found at the same end of the other.
    """
    size = np.diff(starts)
    powers = np.cumprod(np.full(int(size.max(initial=0)) + 1, 0x9E3779B97F4A7C15, dtype=np.uint64))
    place = np.arange(len(codes)) - np.repeat(starts[:-1], size)
    from_end = np.repeat(size, size) - 1 - place
    result = []
    for steps in (place, from_end):
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((codes + np.uint64(1)) * powers[steps])])
        for length in (size // 2, np.maximum(size - 1, 0) // 2):
            at = starts[:-1] if steps is place else starts[1:] - length
            result.append(sums[at + length] - sums[at])
    return np.array(result)


def share_half(size: np.ndarray, hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs that may be near, for words of :func:`halves`; all near pairs are among them."""
    size_a, size_b = size[a], size[b]
    near = np.flatnonzero(np.abs(size_a - size_b) <= 1)
    a, b = a[near], b[near]
    # Of the longer word half the other's length counts.
    row_a, row_b = (size_a > size_b)[near].astype(np.int64), (size_b > size_a)[near].astype(np.int64)
    same = (hashes[row_a, a] == hashes[row_b, b]) | (hashes[2 + row_a, a] == hashes[2 + row_b, b])
    return near[same]


def one_apart(codes: np.ndarray, starts: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the different words ``a`` and ``b`` are one inserted, deleted or replaced letter apart, pair by pair.

    That is so if all letters but one of the longer word are in what both begin with and what both end with.
    """
    size_a, size_b = starts[a + 1] - starts[a], starts[b + 1] - starts[b]
    longer, shorter = np.maximum(size_a, size_b), np.minimum(size_a, size_b)
    result = np.zeros(len(a), dtype=bool)
    order = np.argsort(longer, kind="stable")
    order = order[(longer - shorter <= 1)[order]]
    at = 0
    while at < len(order):
        # As many pairs as fit: the order is by length, so the last of them is the longest.
        pairs = max(1, COMPARED // max(1, int(longer[order[at]])))
        while pairs > 1 and pairs * int(longer[order[min(at + pairs, len(order)) - 1]]) > 2 * COMPARED:
            pairs //= 2
        rows = order[at : at + pairs]
        at += pairs
        width = int(shorter[rows].max(initial=0)) + 1
        steps = np.arange(width)
        within = steps < shorter[rows, None]
        last = len(codes) - 1
        heads = [codes[np.minimum(starts[side[rows], None] + steps, last)] for side in (a, b)]
        tails = [codes[np.maximum(starts[side[rows] + 1, None] - 1 - steps, 0)] for side in (a, b)]
        same = sum(np.argmin((left == right) & within, axis=1) for left, right in (heads, tails))
        result[rows] = same >= longer[rows] - 1
    return result


def _search(depth: int):
    """Near words of all words in some nodes at ``depth``: how many, and the most frequent, as far as these nodes go."""

    def run(table: pa.Table) -> pa.Table:
        column = lambda name: table.column(name).to_numpy()
        words, n = table.column("word").to_pylist(), column("n")
        own, alone = pc.fill_null(table.column("own"), False).to_numpy(), pc.is_null(table.column("own")).to_numpy()
        node, vector = column("node").view(np.uint64), column("vector").view(np.uint64)
        surplus, deficit = column("surplus"), column("deficit")
        codes, starts = letters(words)
        sizes, hashes = np.diff(starts), halves(codes, starts)
        data = np.flatnonzero(own)
        data = data[np.argsort(vector[data], kind="stable")]
        leaves, first, size = np.unique(vector[data], return_index=True, return_counts=True)
        # The words from the best form to the worst: by number, then by code points.
        numbers = n.tolist()
        best_first = np.array(sorted(range(len(words)), key=lambda i: (-numbers[i], words[i])), dtype=np.int64)
        place = np.empty(len(words), dtype=np.int64)
        place[best_first] = np.arange(len(words))
        n_near = np.zeros(len(words), dtype=np.int64)
        best = np.full(len(words), len(words), dtype=np.int64)
        for at in range(0, len(words) if len(data) else 0, SEARCHED):
            part = slice(at, at + SEARCHED)
            asks, leaf = reached(leaves, node[part], vector[part], surplus[part], deficit[part], depth)
            asks = asks + at
            # The words of the leaves, as many pairs at a time as letters may be compared at once.
            ends = np.cumsum(size[leaf])
            start = 0
            while start < len(asks):
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + COMPARED // 8, side="right")))
                number = size[leaf[start:stop]]
                offset = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
                query = np.repeat(asks[start:stop], number)
                other = data[np.repeat(first[leaf[start:stop]], number) + offset]
                start = stop
                query, other = query[different := query != other], other[different]
                may = share_half(sizes, hashes, query, other)
                query, other = query[may], other[may]
                near = one_apart(codes, starts, query, other)
                query, other = query[near], other[near]
                # Words of the node find each other both ways; a query from elsewhere answers for both.
                from_elsewhere = ~own[query] & ~alone[query]
                to = np.concatenate([query, other[from_elsewhere]])
                form = np.concatenate([other, query[from_elsewhere]])
                n_near += np.bincount(to, minlength=len(words))
                np.minimum.at(best, to, place[form])
        found = np.flatnonzero(n_near)
        forms = best_first[best[found]]
        return pa.table(
            {
                "word": table.column("word").take(pa.array(found)),
                "n_near": pa.array(n_near[found]),
                "form": table.column("word").take(pa.array(forms)),
                "form_n": pa.array(n[forms]),
            }
        )

    return run


def _in_parts(rows: DataFrame) -> DataFrame:
    """Rows of the last level, where a node has words with one vector, and those of large nodes in parts.

    Each word of a node is searched for in one part. All ask in every part: words of the node for themselves, which
    ``own`` tells by a null in the other parts, for what they find asks in their part in turn.
    """
    parts = F.ceil(F.col("size") / SUBTREE).cast("int")
    one = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1)))
    here = F.pmod(F.xxhash64("word"), F.greatest(parts, F.lit(1))) == F.col("part")
    return one.withColumn("own", F.when(~F.col("own"), False).when(here, True))


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n``: the number of near words and the most frequent of them.

    Near words differ by exactly one inserted, deleted or replaced letter. ``words`` has each ``word`` once, with its
    number ``n``; of equally frequent near words the first by code points is the form. A word without near ones has
    ``n_near`` 0 and no form.

    The words are leaves of a trie of their frequency vectors. They go down it by a few levels from table to table;
    a subtree of up to ``SUBTREE`` rows is searched in one task, larger ones go on down. What goes to a task and
    comes back are words and the best of their near ones, never pairs.
    """
    words = stored(words.select("word", "n"))

    def root(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            one = pa.array(np.ones(size, dtype=np.int32))
            vector = pa.array(vectors(batch.column("word").to_pylist()).view(np.int64))
            columns = [pa.array(np.zeros(size, dtype=np.int64)), pa.array(np.ones(size, dtype=bool)), one, one, vector]
            yield pa.RecordBatch.from_arrays([*columns, *batch.columns], ["node", "own", "surplus", "deficit", "vector", "word", "n"])

    rows = words.mapInArrow(root, ROWS)
    parts = []
    for depth in range(0, LEVELS, STEP):
        rows = stored(rows.mapInArrow(_descend(depth), ROWS))
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.bool_or("own").alias("has_own"))
        alive, seen = stored_and_observed(
            sizes.where("has_own and size > 1").select("node", "size"),
            small=F.sum(F.when(F.col("size") <= SUBTREE, F.col("size"))),
            large=F.count(F.when(F.col("size") > SUBTREE, 1)),
        )
        last = depth + STEP == LEVELS
        rows = rows.join(alive, "node")
        ready = _in_parts(rows) if last else rows.where(F.col("size") <= SUBTREE).withColumn("part", F.lit(0))
        tasks = max(1, math.ceil((seen["small"] or 0) / SUBTREE))
        group = F.when(F.col("size") <= SUBTREE, F.pmod(F.xxhash64("node"), F.lit(tasks))).otherwise(F.col("node"))
        searched = ready.withColumn("group", group).drop("size")
        found = searched.groupBy("group", "part").applyInArrow(_search(depth + STEP), "word string, n_near bigint, form string, form_n bigint")
        parts.append(stored(found))
        if last or not seen["large"]:
            break
        rows = rows.where(F.col("size") > SUBTREE).drop("size")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return words.join(summed, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n")
    )


def spelling_groups(words: DataFrame, factor: int = 10) -> DataFrame:
    """Words with the form they are variants of: ``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root``.

    ``form`` is the most frequent near word (see :func:`near_words`) if it occurs at least ``factor`` times as often
    as the word, else null. ``root`` is where the forms lead from word to word, the word itself if it has none. A
    null word is ignored; no words give no rows. ``factor`` must be above 1, so that forms never lead in a circle.
    """
    if factor <= 1:
        raise ValueError("The factor must be above 1")
    is_variant = F.col("form_n") >= factor * F.col("n")
    near = near_words(words.where("word is not null"))
    near = stored(near.withColumns({name: F.when(is_variant, F.col(name)) for name in ("form", "form_n")}))
    # Each round doubles the steps that are taken; numbers grow by the factor with each step, so rounds are few.
    leads = near.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        on = leads.select(F.col("word").alias("root"), F.col("root").alias("further"))
        leads, seen = stored_and_observed(
            leads.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            moved=F.count(F.when(F.col("moved"), 1)),
        )
        leads = leads.select("word", "root")
        if not seen["moved"]:
            break
    return near.join(leads, "word", "left").withColumn("root", F.coalesce("root", "word"))
