"""Which keywords occur in the same documents, and how often."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.lineage import materialize
from newsloom.operators import spotting
from newsloom.operators.joins import lookup
from newsloom.operators.lexicon import UNKNOWN_INDEX, Lexicon
from newsloom.operators.matching import ROW, Key, exploded, identified, keyword_positions, matcher_of, with_keywords
from newsloom.sizes import fits_broadcast


#: Sets with more keywords than this are cut into blocks of so many.
HEAVY = 2048

#: Keywords that occur most are counted in a dense square of this side in each task.
DENSE = 5120

#: Dictionaries up to this size are counted straight from the matching; a task hands on few sums for them.
DIRECT = 512

#: Pairs of other keywords that a task holds before it sums them up, and sums it holds before it hands them on.
PAIRS, SUMS = 1 << 22, 1 << 21

#: Sets multiplied at a time; their products stay exact in 32-bit floats.
TOGETHER = 1024


def keyword_sets(
    docs: DataFrame, lexicon: Lexicon, *, text: str = "text", key: Key = ("doc_id",)
) -> DataFrame:
    """``ids``: the positions of the keywords that each document contains, ascending.

    Words become positions in the task that holds them if the dictionary is small, so that neither
    words nor sets of them are shuffled.
    """
    if not lexicon.has_few:
        dictionary, matcher = matcher_of(docs, lexicon, text=text)
        if matcher:
            return spotting.keyword_ids(docs, matcher, text=text)
        rows = identified(docs.select(text))
        found = keyword_positions(rows, dictionary, text=text, key=(ROW,), once=True)
        return found.groupBy(ROW).agg(F.sort_array(F.collect_set("kw_id")).alias("ids")).select("ids")
    rows = lexicon.table.toArrow().sort_by("kw_id")  # as many as lexicon.words
    words, ids = rows.column("kw").combine_chunks(), rows.column("kw_id").to_numpy().astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0)
            mine = ids[pc.index_in(found.flatten(), value_set=words).to_numpy(zero_copy_only=False).astype(np.int64)]
            starts = found.offsets.to_numpy()
            of = np.repeat(np.arange(len(found)), np.diff(starts))
            ordered = pa.array(mine[np.lexsort((mine, of))])
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(starts - starts[0], ordered)], names=["ids"])

    found = with_keywords(docs, lexicon, text=text, key=key).select("keywords")
    return found.mapInArrow(run, "ids array<bigint>")


def block_pairs(sets: DataFrame, heavy: int) -> DataFrame:
    """``left, right``: every set above ``heavy`` as pairs of its blocks, each a row of its own.

    A set of k blocks becomes the k (k + 1) / 2 pairs of a block with itself or a later one. Rows are
    dealt out by a hash of their own, so the pairs of one set are formed in many tasks.
    """
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("ids"), F.lit(1)), F.lit(heavy))
    cut = F.transform(starts, lambda at: F.slice("ids", at, heavy))
    blocks = sets.where(F.size("ids") > heavy).select(cut.alias("blocks"))
    lefts = blocks.select("blocks", F.posexplode("blocks").alias("i", "left"))
    rights = F.posexplode(F.slice("blocks", F.col("i") + 1, F.size("blocks"))).alias("j", "right")
    pairs = lefts.select("left", rights)
    # The first block is the left one itself: its pairs lie above the diagonal.
    rows = pairs.select("left", F.when(F.col("j") > 0, F.col("right")).alias("right"))
    return rows.withColumn("_row", F.monotonically_increasing_id()).repartition(parts, "_row").drop("_row")


def frequent_ids(sets: DataFrame) -> np.ndarray:
    """The ids that most of the sets have, at most ``DENSE``, ascending."""
    counts = sets.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    most = counts.orderBy(F.desc("n"), "id").limit(DENSE).collect()
    return np.array(sorted(row["id"] for row in most), np.int64)


def pair_sums(sets: DataFrame, dense: np.ndarray, *, heavy: int | None = None) -> DataFrame:
    """``kw_id, other_id, n`` with ``kw_id < other_id``: in how many of ``sets (ids)`` both are.

    Every task adds up its own pairs before any shuffle. Pairs of two ids in ``dense`` are counted by
    a product of a 0/1 matrix with itself, all others one by one. Sets above ``heavy`` are cut into
    blocks whose pairs are dealt to tasks of their own; with ``heavy`` 0 there are none.
    """
    heavy = HEAVY if heavy is None else heavy

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _PairSums(dense)
        for batch in batches:
            for i in range(0, len(batch), TOGETHER):
                part = batch.slice(i, TOGETHER)
                lefts, rights = part.column(0).to_pylist(), part.column(1).to_pylist()
                sums.add([np.array(x, np.int64) for x in lefts], [None if x is None else np.array(x, np.int64) for x in rights])
                if sums.full():
                    yield sums.handed_on()
        yield sums.handed_on()
        yield sums.of_dense()

    whole = [F.col("ids").alias("left"), F.lit(None).cast("array<bigint>").alias("right")]
    rows = sets.select(*whole)
    if heavy:
        # A task hands on its sums however few sets it has, so there are no more tasks than run at a time or twice that.
        some = sets.where(F.size("ids") <= heavy).coalesce(2 * sets.sparkSession.sparkContext.defaultParallelism)
        rows = some.select(*whole).unionByName(block_pairs(sets, heavy))
    found = rows.mapInArrow(run, "kw_id bigint, other_id bigint, n bigint")
    return found.groupBy("kw_id", "other_id").agg(F.sum("n").alias("n"))


class _PairSums:
    """The pairs that one task has counted."""

    def __init__(self, dense: np.ndarray):
        self.ids = dense
        self.square = np.zeros((len(dense), len(dense)), np.int32)
        self.held: list[np.ndarray] = []
        self.n_held = 0
        self.pairs, self.counts = np.zeros((0, 2), np.int64), np.zeros(0, np.int64)

    def add(self, lefts: list[np.ndarray], rights: list[np.ndarray | None]) -> None:
        """Count the pairs of each left set, or those between a left and a right one."""
        matrix, other = (np.zeros((len(lefts), len(self.ids)), np.float32) for _ in range(2))
        for i, (left, right) in enumerate(zip(lefts, rights, strict=True)):
            ours = self._marked(matrix[i], left)
            theirs = ours if right is None else self._marked(other[i], right)
            self._hold(left, ours, right, theirs)
        one = np.array([right is None for right in rights])
        if one.any():
            whole = matrix[one]
            self.square += (whole.T @ whole).astype(np.int32)
        if not one.all():
            self.square += (matrix[~one].T @ other[~one]).astype(np.int32)

    def _marked(self, row: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which of the ids are counted densely; they are marked in ``row``."""
        if not len(self.ids):
            return np.zeros(len(ids), bool)
        at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        dense = self.ids[at] == ids
        row[at[dense]] = 1
        return dense

    def _hold(self, left: np.ndarray, ours: np.ndarray, right: np.ndarray | None, theirs: np.ndarray) -> None:
        """Pairs with at least one id that isn't counted densely."""
        if ours.all() and theirs.all():
            return
        if right is None:
            # A rare one with all behind it, and with the dense ones before it.
            rare = np.flatnonzero(~ours)
            i, j = np.repeat(rare, len(left)), np.tile(np.arange(len(left)), len(rare))
            keep = (j > i) | ((j < i) & ours[j])
            i, j = i[keep], j[keep]
            pairs = np.stack([left[np.minimum(i, j)], left[np.maximum(i, j)]])
        else:
            i, j = np.repeat(np.arange(len(left)), len(right)), np.tile(np.arange(len(right)), len(left))
            keep = ~(ours[i] & theirs[j])
            pairs = np.stack([left[i[keep]], right[j[keep]]])
        self.held.append(pairs)
        self.n_held += pairs.shape[1]
        if self.n_held > PAIRS:
            self._sum_up()

    def _sum_up(self) -> None:
        if self.held:
            held = np.concatenate(self.held, axis=1)
            self.held, self.n_held = [], 0
            new, n = _packed_counts(held)
            pairs, counts = np.concatenate([self.pairs, new]), np.concatenate([self.counts, n])
            order = np.lexsort((pairs[:, 1], pairs[:, 0]))
            pairs, counts = pairs[order], counts[order]
            first = np.flatnonzero(np.append(len(counts) > 0, (pairs[1:] != pairs[:-1]).any(axis=1)))
            self.pairs, self.counts = pairs[first], np.add.reduceat(counts, first) if len(first) else counts

    def full(self) -> bool:
        return len(self.counts) > SUMS

    def handed_on(self) -> pa.RecordBatch:
        self._sum_up()
        pairs, counts = self.pairs, self.counts
        self.pairs, self.counts = np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
        return _batch(pairs[:, 0], pairs[:, 1], counts)

    def of_dense(self) -> pa.RecordBatch:
        i, j = np.nonzero(np.triu(self.square, 1))
        return _batch(self.ids[i], self.ids[j], self.square[i, j].astype(np.int64))


def _packed_counts(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ones of two rows of ids as rows of pairs, and how often each comes; sorted as one number each."""
    names = None
    if pairs.max(initial=0) >= 1 << 31:
        names, pairs = np.unique(pairs, return_inverse=True)
        pairs = pairs.reshape(2, -1)
    codes, n = np.unique((pairs[0] << 31) | pairs[1], return_counts=True)
    found = np.stack([codes >> 31, codes & ((1 << 31) - 1)], axis=1)
    return found if names is None else names[found], n


def _batch(i: np.ndarray, j: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(n)], names=["kw_id", "other_id", "n"])


def upper_edges(
    docs: DataFrame, lexicon: Lexicon, *, text: str = "text", key: Key = ("doc_id",)
) -> DataFrame:
    """``kw_id, other_id, kw, other_kw, n`` with ``kw_id < other_id``: documents with both."""
    return named_edges(edge_counts(docs, lexicon, text=text, key=key), lexicon)


def edge_counts(
    docs: DataFrame, lexicon: Lexicon, *, text: str = "text", key: Key = ("doc_id",)
) -> DataFrame:
    """``kw_id, other_id, n`` with ``kw_id < other_id``: documents with both.

    A dictionary of at most ``DIRECT`` words is counted densely, straight from the matching. For
    others the sets are written first, as they are read to find the frequent words and the heavy sets.
    """
    sets = keyword_sets(docs, lexicon, text=text, key=key)
    if lexicon.words is not None and len(lexicon.words) <= DIRECT:
        ids = lexicon.table.select("kw_id").toArrow().column(0).to_numpy()
        return pair_sums(sets, np.sort(ids.astype(np.int64)), heavy=0)
    sets = materialize(sets, "keyword-sets")
    return pair_sums(sets, frequent_ids(sets))


def named_edges(sums: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``kw_id, other_id, n`` with both keywords added."""
    ids = lexicon.table
    others = ids.select(F.col("kw_id").alias("other_id"), F.col("kw").alias("other_kw"))
    small = lexicon.is_small or fits_broadcast(ids)
    # Joins that spread their keys read the sums more than once.
    sums = sums if small else materialize(sums, "pair-sums")
    named = lookup(sums, ids, "kw_id", small=small)
    kind = ids.schema["kw_id"].dataType
    return lookup(named, others, "other_id", small=small).select(
        F.col("kw_id").cast(kind).alias("kw_id"), F.col("other_id").cast(kind).alias("other_id"), "kw", "other_kw", "n"
    )


def both_directions(upper: DataFrame) -> DataFrame:
    """Each edge from either end; the documents are not read again."""
    there = F.struct("kw_id", "other_id", "kw", "other_kw", "n")
    back = F.struct(
        F.col("other_id").alias("kw_id"),
        F.col("kw_id").alias("other_id"),
        F.col("other_kw").alias("kw"),
        F.col("kw").alias("other_kw"),
        "n",
    )
    return upper.select(F.inline(F.array(there, back)))


def edges(
    docs: DataFrame, lexicon: Lexicon, *, text: str = "text", key: Key = ("doc_id",)
) -> DataFrame:
    """``kw_id, other_id, kw, other_kw, n`` for all ordered pairs; n is symmetric."""
    return both_directions(upper_edges(docs, lexicon, text=text, key=key))


def partners_of(edge_table: DataFrame, kw: str, *, ascending: bool = True) -> DataFrame:
    """``other_kw, n``: the partners of a keyword, rarest first; empty if it is unknown."""
    found = edge_table.where(F.col("kw") == kw).select("other_kw", "n")
    return found.orderBy("n", "other_kw", ascending=ascending)


def partner_ids(edge_table: DataFrame, kw_id: int) -> DataFrame:
    """``other_id, n``: the partners of the keyword at a position."""
    return edge_table.where(F.col("kw_id") == kw_id).select("other_id", "n")


def partners_in(
    docs: DataFrame, lexicon: Lexicon, kw: str, *, text: str = "text", key: Key = ("doc_id",)
) -> DataFrame:
    """``other_id, other_kw, n``: the partners of a keyword, straight from the documents.

    Only documents that contain the keyword are matched, and no pairs are formed: the same rows as
    from the table of all edges, for the price of a filter and a count. Empty if the keyword isn't
    in the dictionary.
    """
    known = not lexicon.table.where(F.col("kw") == kw).isEmpty()
    having = docs.where(F.contains(F.col(text), F.lit(kw)) & F.lit(known))
    counts = (
        exploded(with_keywords(having, lexicon, text=text, key=key), "keywords", "kw")
        .where(F.col("kw") != kw)
        .groupBy("kw")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    named = lookup(counts, lexicon.table, "kw", small=lexicon.is_small)
    return named.select(F.col("kw_id").alias("other_id"), F.col("kw").alias("other_kw"), "n")


def partner_count(edge_table: DataFrame, lexicon: Lexicon, asked: DataFrame) -> DataFrame:
    """``kw, n_partners`` for the keywords asked for: -1 where a keyword is unknown."""
    counts = edge_table.groupBy("kw").agg(F.count(F.lit(1)).alias("_n"))
    known = lexicon.index_of(asked)
    counted = lookup(known, counts, "kw", "left", small=lexicon.is_small)
    unknown = F.col("kw_id") == UNKNOWN_INDEX
    return counted.select(
        "kw",
        F.when(unknown, F.lit(-1)).otherwise(F.coalesce("_n", F.lit(0))).cast("bigint").alias(
            "n_partners"
        ),
    )


def keyword_report(edge_table: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``kw_id, kw, n_partners, partners`` for every keyword of the dictionary.

    ``partners`` lists ``keyword:count``, rarest first. A list has at most one entry per
    keyword of the dictionary, however many documents there are.
    """
    lists = edge_table.groupBy("kw_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sort_array(F.collect_list(F.struct("n", "other_kw"))).alias("_list"),
    )
    listed = lexicon.table.join(lists, "kw_id", "left")
    shown = F.transform("_list", lambda p: F.concat_ws(":", p["other_kw"], p["n"]))
    return listed.select(
        "kw_id",
        "kw",
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("n_partners"),
        F.coalesce(F.array_join(shown, ","), F.lit("")).alias("partners"),
    )


def adjacency(upper: DataFrame) -> DataFrame:
    """``kw_id, n_pairs, neighbours``: later partners of each keyword with their counts.

    ``n_pairs`` is the length the list would have with every repeat written out; the list
    itself holds each partner once, as ``map<int, bigint>``.
    """
    return upper.groupBy("kw_id").agg(
        F.sum("n").alias("n_pairs"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("other_id", "n")))).alias(
            "neighbours"
        ),
    )


def adjacency_rows(upper: DataFrame) -> DataFrame:
    """``kw_id, indices, counts``: the neighbours as sparse rows, ordered by index."""
    pairs = F.sort_array(F.collect_list(F.struct("other_id", "n")))
    return (
        upper.groupBy("kw_id")
        .agg(pairs.alias("_row"))
        .select(
            "kw_id", F.col("_row.other_id").alias("indices"), F.col("_row.n").alias("counts")
        )
    )
