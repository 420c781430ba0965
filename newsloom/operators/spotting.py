"""Finding the keywords of a dictionary, or of a slice of one, in the texts of a task.

The texts of a batch are put behind one another, with a mark between them that no keyword holds, and
all their places are looked at together: numpy takes one character of all the keywords that are still
possible at a time. What leaves a task are results of whole texts (keywords, counts, terms), not places.

A matcher has the keywords in the order of their positions, so of several keywords the later one has
the larger number. :class:`Trie` holds a dictionary that is small enough for each task;
:class:`newsloom.operators.grams.FiledKeywords` a slice of one that isn't.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands behind each text; not a character.
MARK = 0x110000

#: Characters that are looked at together, if no single text has more.
TOGETHER = 1 << 20

#: Cells of the table of steps of a trie; steps from later nodes are looked up in a list.
STEPS = 1 << 23

#: So few chains of matches are followed one by one.
FEW_CHAINS = 32

#: Cells that are counted in an array instead of being sorted.
CELLS = 1 << 22


def points(text: str) -> np.ndarray:
    """The code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Texts:
    """Texts behind one another: their ``codes``, each text followed by a mark, and the text that each place is in."""

    def __init__(self, values: Sequence[str | None]):
        values = [value or "" for value in values]
        self.sizes = np.array([len(value) for value in values], np.int64)
        self.row_of = np.repeat(np.arange(len(values)), self.sizes + 1)
        self.codes = np.full(len(self.row_of), MARK, np.uint32)
        plain = np.repeat(np.arange(len(values)), self.sizes)
        self.codes[np.arange(len(plain)) + plain] = points("".join(values))

    def __len__(self) -> int:
        return len(self.sizes)


def together(column: pa.Array) -> Iterator[tuple[int, Texts]]:
    """The texts of a column in groups of bounded size: the row of the first, and the texts."""
    values = column.to_pylist()
    start, n = 0, 0
    for i, value in enumerate(values):
        n += len(value or "") + 1
        if n > TOGETHER or i + 1 == len(values):
            yield start, Texts(values[start : i + 1])
            start, n = i + 1, 0


class Words:
    """Keywords by number, in the order of their positions."""

    def __init__(self, ids: np.ndarray, words: Sequence[str]):
        order = np.argsort(ids, kind="stable")
        self.ids = np.asarray(ids, np.int64)[order]
        listed = [words[i] for i in order]
        self.words = pa.array(listed, pa.string())
        self.length = np.array([len(w) for w in listed], np.int64)
        #: The keywords in the order of their bytes, and the place of each in it.
        self.sorted = np.array(sorted(range(len(listed)), key=lambda i: listed[i].encode("utf-8", "surrogatepass")), np.int64)
        self.rank = np.empty(len(listed), np.int64)
        self.rank[self.sorted] = np.arange(len(listed))
        self.flat = points("".join(listed))
        self.at = np.cumsum(self.length) - self.length
        #: Only a keyword that ends as it begins can overlap itself.
        self.overlaps = np.array([any(w.endswith(w[:n]) for n in range(1, len(w)) if w[n - 1] == w[-1]) for w in listed], bool)

    def found(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """``place, word``: all occurrences of all keywords, overlaps included, in any order; here there are none."""
        return np.zeros(0, np.int64), np.zeros(0, np.int64)

    def distinct(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """``row, word``: the keywords of each text, by row and word."""
        rows, words, _ = self._counted(texts.row_of, *self.found(texts), len(texts))
        return rows, words

    def counts(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``row, word, n``: how often each text holds each of its keywords, without overlap."""
        place, word = self.found(texts)
        if not len(word):
            return word, word, word
        some = self.overlaps[word]
        if some.any():
            # Each keyword of a text on a line of its own, one line behind the other.
            far = len(texts.codes) + int(self.length.max())
            mine = np.flatnonzero(some)
            order = mine[np.lexsort((place[mine], word[mine]))]
            line = np.append(0, np.cumsum(word[order][1:] != word[order][:-1]))
            start = line * far + place[order]
            kept = np.concatenate((np.flatnonzero(~some), order[taken(start, start + self.length[word[order]])]))
            place, word = place[kept], word[kept]
        return self._counted(texts.row_of, place, word, len(texts))

    def cut(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """``row, word``: each text cut into keywords, leftmost first, of several at a place the latest."""
        place, word = self.found(texts)
        best = np.full(len(texts.codes), -1, np.int64)
        np.maximum.at(best, place, word)
        start = np.flatnonzero(best >= 0)
        word = best[start]
        kept = taken(start, start + self.length[word])
        return texts.row_of[start[kept]], word[kept]

    def _counted(self, row_of: np.ndarray, place: np.ndarray, word: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = max(len(self.ids), 1)
        code = row_of[place] * size + word
        if rows * size <= CELLS:
            n = np.bincount(code, minlength=rows * size)
            code = np.flatnonzero(n)
            n = n[code]
        else:
            code, n = np.unique(code, return_counts=True)
        return code // size, code % size, n


def taken(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of the spans, by ascending starts, are taken if each one that begins behind the last one taken is.

    A span that begins where all before it have ended is taken in any case. The chains between those
    are followed together, and the last few, which may be long, one by one.
    """
    if not len(start):
        return np.zeros(0, bool)
    following = np.searchsorted(start, end)
    free = np.concatenate(([True], np.maximum.accumulate(end)[:-1] <= start[1:], [True]))
    kept = free[:-1].copy()
    now = np.flatnonzero(kept)
    while len(now) > FEW_CHAINS:
        now = following[now]
        now = now[~free[now]]
        kept[now] = True
    if len(now):
        following, free = following.tolist(), free.tolist()
        for i in now.tolist():
            while not free[i := following[i]]:
                kept[i] = True
    return kept


class Trie(Words):
    """Keywords by common beginnings: a text's places go down the trie together."""

    def __init__(self, ids: np.ndarray, words: Sequence[str]):
        super().__init__(ids, words)
        letters = np.unique(self.flat)
        #: 0 is any character that no keyword holds.
        self.kind_of = np.zeros(MARK + 1, np.int32)
        self.kind_of[letters] = np.arange(1, len(letters) + 1)
        self.kinds = len(letters) + 1
        node = np.zeros(len(self.length), np.int64)
        edges, nodes, word_at, n = [], [], [np.full(1, -1, np.int64)], 1
        for depth in range(int(self.length.max(initial=0))):
            on = np.flatnonzero(self.length > depth)
            keys, which = np.unique(node[on] * self.kinds + self.kind_of[self.flat[self.at[on] + depth]], return_inverse=True)
            node[on] = n + which
            edges.append(keys)
            nodes.append(np.arange(n, n + len(keys)))
            here = np.full(len(keys), -1, np.int64)
            ended = on[self.length[on] == depth + 1]
            here[node[ended] - n] = ended
            word_at.append(here)
            n += len(keys)
        self.word_at = np.concatenate(word_at)
        # Nodes are numbered by depth, so the keys of all depths ascend.
        self.keys, self.nodes = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (edges, nodes))
        self.dense = min(n, max(STEPS // self.kinds, 1))
        first = np.searchsorted(self.keys, self.dense * self.kinds)
        self.steps = np.zeros(self.dense * self.kinds, np.int32)
        self.steps[self.keys[:first]] = self.nodes[:first]
        self.whole = n == self.dense

    def _step(self, node: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """The nodes reached from nodes by characters, 0 if there are none."""
        key = node * self.kinds + kind
        if self.whole:
            return self.steps[key]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        listed = np.where(self.keys[at] == key, self.nodes[at], 0)
        return np.where(node < self.dense, self.steps[np.minimum(key, len(self.steps) - 1)], listed)

    def found(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        kind = self.kind_of[texts.codes]
        node = self.steps[kind]
        place = np.flatnonzero(node)
        node, depth = node[place].astype(np.int64), 1
        places, words = [place[:0]], [np.zeros(0, np.int64)]
        while len(place):
            word = self.word_at[node]
            here = word >= 0
            places.append(place[here])
            words.append(word[here])
            # The mark behind a text leads nowhere, so no place runs over the end.
            node = self._step(node, kind[place + depth]).astype(np.int64)
            alive = np.flatnonzero(node)
            place, node = place[alive], node[alive]
            depth += 1
        return np.concatenate(places), np.concatenate(words)


def _lists(rows: np.ndarray, values: pa.Array, n: int) -> pa.ListArray:
    """Values by ascending rows as one list for each of ``n`` rows."""
    ends = np.cumsum(np.bincount(rows, minlength=n))
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32), pa.int32()), values)


def keywords_of(text: Column, docs: DataFrame, matcher: Words) -> Column:
    """The distinct keywords of a text as an array, in the order of their bytes."""

    def lists(own: Words, texts: Texts) -> pa.Array:
        rows, words = own.distinct(texts)
        ranks = own.rank[words]
        order = np.lexsort((ranks, rows))
        return _lists(rows[order], own.words.take(pa.array(words[order])), len(texts))

    return _column(text, docs, matcher, lists)


def terms_of(text: Column, docs: DataFrame, matcher: Words) -> Column:
    """The text cut into keywords, as an array."""

    def lists(own: Words, texts: Texts) -> pa.Array:
        rows, words = own.cut(texts)
        return _lists(rows, own.words.take(pa.array(words)), len(texts))

    return _column(text, docs, matcher, lists)


def _column(text: Column, docs: DataFrame, matcher: Words, lists: Callable[[Words, Texts], pa.Array]) -> Column:
    sent = docs.sparkSession.sparkContext.broadcast(matcher)

    def run(column: pa.Array) -> pa.Array:
        found = [lists(sent.value, texts) for _, texts in together(column)]
        return pa.concat_arrays(found) if found else pa.array([], pa.list_(pa.string()))

    # The types are named, as the annotations of this module are not evaluated.
    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<string>")(text.cast("string"))


def keyword_rows(docs: DataFrame, matcher: Words, *, text: str, key: Sequence[str]) -> DataFrame:
    """``key, kw, n``: how often each text holds each of its keywords, without overlap."""
    sent = docs.sparkSession.sparkContext.broadcast(matcher)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for start, texts in together(batch.column(len(key))):
                rows, words, n = own.counts(texts)
                keys = [batch.column(i).take(pa.array(rows + start)) for i in range(len(key))]
                columns = [*keys, own.words.take(pa.array(words)), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*key, "kw", "n"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in key)
    return docs.select(*key, F.col(text).cast("string")).mapInArrow(run, f"{kinds}, kw string, n bigint")


def document_counts(docs: DataFrame, matcher: Words, *, text: str) -> DataFrame:
    """``kw, n``: how many texts of a task hold each keyword; keywords repeat."""
    sent = docs.sparkSession.sparkContext.broadcast(matcher)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        n = np.zeros(len(own.ids), np.int64)
        for batch in batches:
            for _, texts in together(batch.column(0)):
                n += np.bincount(own.distinct(texts)[1], minlength=len(n))
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([own.words.take(pa.array(held)), pa.array(n[held])], names=["kw", "n"])

    return docs.select(F.col(text).cast("string")).mapInArrow(run, "kw string, n bigint")


def keyword_ids(docs: DataFrame, matcher: Words, *, text: str) -> DataFrame:
    """``ids``: the positions of the keywords of each text, ascending."""
    sent = docs.sparkSession.sparkContext.broadcast(matcher)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for _, texts in together(batch.column(0)):
                rows, words = own.distinct(texts)
                yield pa.RecordBatch.from_arrays([_lists(rows, pa.array(own.ids[words]), len(texts))], names=["ids"])

    return docs.select(F.col(text).cast("string")).mapInArrow(run, "ids array<bigint>")
