"""Word-piece counts by a linear longest-match automaton."""

from __future__ import annotations

import functools
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .rows import split_words, text_slices, whole_row

# Fixed value: the character that starts the first piece of a word.
WORD_START = "▁"
# Words whose counts a worker remembers before it forgets all of them.
REMEMBERED = 1 << 18


@functools.cache
def vocabulary_pieces(path: str) -> frozenset[str]:
    """Pieces of a ``sentencepiece`` model that stand for text: no control, unknown or byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    numbers = range(model.get_piece_size())
    return frozenset(
        model.id_to_piece(i) for i in numbers if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    )


class LongestMatch:
    """Counts the pieces of greedy longest match in one pass over a word.

    A trie holds the pieces. A node that cannot be continued fails over to the node of what is left of its text
    after the pieces that greedy match takes from it; how many these are is stored with the node. So each
    character moves down once and each failure leaves text behind: the steps are linear in the length of the
    word, and no piece is ever built. A character that is no piece counts as its UTF-8 bytes.
    """

    def __init__(self, pieces: Iterable[str]) -> None:
        pieces = set(pieces)
        self.step: list[dict[str, int]] = [{}]
        takes: list[int | None] = [None]  # pieces that the node's whole text is, if it is taken at once
        for piece in sorted({*pieces, *(char for piece in pieces for char in piece)}):
            node = 0
            for char in piece:
                if char not in self.step[node]:
                    self.step[node][char] = len(self.step)
                    self.step.append({})
                    takes.append(None)
                node = self.step[node][char]
            takes[node] = 1 if piece in pieces else len(piece.encode())
        size = len(self.step)
        self.fail, self.popped, self.rest = [0] * size, [0] * size, [0] * size
        queue = deque((0, char, child) for char, child in self.step[0].items())
        while queue:
            parent, char, node = queue.popleft()
            if takes[node] is not None:
                self.fail[node], self.popped[node] = 0, takes[node]
            else:
                # Every single character is in the trie, so a way on is found at the root at the latest.
                at, popped = self.fail[parent], self.popped[parent]
                while char not in self.step[at]:
                    popped += self.popped[at]
                    at = self.fail[at]
                self.fail[node], self.popped[node] = self.step[at][char], popped
            self.rest[node] = self.popped[node] + self.rest[self.fail[node]]
            queue.extend((node, char, child) for char, child in self.step[node].items())

    def count(self, word: str) -> int:
        """Pieces of one word, with the word-start character before it."""
        step, fail, popped = self.step, self.fail, self.popped
        node = n = 0
        for char in WORD_START + word:
            while char not in step[node]:
                if not node:
                    n += len(char.encode("utf-8", "replace"))
                    break
                n += popped[node]
                node = fail[node]
            else:
                node = step[node][char]
        return n + self.rest[node]


class _Remembered(dict):
    """Counts of words given as UTF-8."""

    def __init__(self, automaton: LongestMatch) -> None:
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        n = self[word] = self.automaton.count(word.decode())
        return n


@functools.cache
def _counts(path: str) -> _Remembered:
    return _Remembered(LongestMatch(vocabulary_pieces(path)))


def token_counts(docs: DataFrame, vocabulary: str, text_column: str = "text") -> DataFrame:
    """``n_words`` and ``n_tokens``, the word pieces of every whole text, beside ``row``.

    ``row`` is a struct of the document's other columns, ``vocabulary`` the path of a ``sentencepiece`` model on
    every executor. Words are separated by ASCII white space; each is matched greedily, longest piece first, after
    a word-start character. A null or empty text has no words and no tokens. Rows are counted one by one, so rows
    that repeat count the same; an empty table gives no rows.
    """
    source = docs.select(whole_row(docs.drop(text_column)), F.col(text_column).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(vocabulary)
        for batch in batches:
            for part, texts in text_slices(batch):
                found = np.zeros((2, len(texts)), dtype=np.int64)
                for at, text in enumerate(texts):
                    words = split_words(text)
                    found[:, at] = len(words), sum(map(counts.__getitem__, words))
                yield pa.RecordBatch.from_pydict(
                    {"row": part.column("row"), "n_words": pa.array(found[0]), "n_tokens": pa.array(found[1])}
                )

    return source.mapInArrow(run, StructType([source.schema["row"]]).add("n_words", "long").add("n_tokens", "long"))
