"""The product of two large matrices by tiles.

Cells are gathered into square tiles, one row each, so that what is shuffled and joined is tiles and
not single products. Tiles of both sides meet by their inner index; an index with many tiles is
spread over tasks. Each pair is multiplied densely or, if the left tile holds few cells, cell by
cell, and every task adds up its products of an output tile before they are shuffled. The sums of an
output tile are added up in the order of their inner index ranges, one after another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators.joins import spread_join

#: Rows and columns of a tile, and output tiles that a task holds before it hands them on.
TILE, HELD = 256, 256

#: Tiles with fewer cells than a share of this are multiplied cell by cell.
SPARSE = 32

TILES = "i bigint, j bigint, rows binary, cols binary, cells binary"


def tiled(cells: DataFrame, tile: int) -> DataFrame:
    """``i, j, rows, cols, cells``: the cells ``row, col, value`` of each tile as packed numbers.

    A tile's group is at most ``tile`` squared cells, if no cell repeats.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("col").to_numpy(), table.column("row").to_numpy()))
        packed = [
            (table.column("row").to_numpy()[order] % tile).astype("<u4").tobytes(),
            (table.column("col").to_numpy()[order] % tile).astype("<u4").tobytes(),
            table.column("value").to_numpy()[order].astype("<f8").tobytes(),
        ]
        names = ["i", "j", "rows", "cols", "cells"]
        return pa.table([pa.array([x.as_py()]) for x in key] + [pa.array([x], pa.binary()) for x in packed], names=names)

    placed = cells.select(
        F.col("row").cast("bigint"),
        F.col("col").cast("bigint"),
        F.col("value").cast("double"),
        F.floor(F.col("row") / tile).alias("i"),
        F.floor(F.col("col") / tile).alias("j"),
    )
    return placed.groupBy("i", "j").applyInArrow(run, TILES)


def _unpacked(rows: bytes, cols: bytes, cells: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(rows, "<u4"), np.frombuffer(cols, "<u4"), np.frombuffer(cells, "<f8")


def product_tiles(a: DataFrame, b: DataFrame, *, tile: int = TILE) -> DataFrame:
    """``i, k, block``: the product of two cell tables as dense tiles of doubles, zero tiles left out."""
    left = tiled(a, tile).select("i", "j", "rows", "cols", "cells")
    right = tiled(b, tile).select(
        F.col("i").alias("j"), F.col("j").alias("k"), F.col("rows").alias("b_rows"), F.col("cols").alias("b_cols"), F.col("cells").alias("b_cells")
    )
    pairs = spread_join(left, right, "j").select("i", "k", "rows", "cols", "cells", "b_rows", "b_cols", "b_cells")
    names = ["i", "k", "block"]

    def out(held: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
        columns = [[i for i, _ in held], [k for _, k in held], [x.tobytes() for x in held.values()]]
        kinds = (pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for i, k, *packed in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (i, k) not in held and len(held) >= HELD:
                    yield out(held)
                    held.clear()
                total = held.setdefault((i, k), np.zeros((tile, tile)))
                rows, cols, cells = _unpacked(*packed[:3])
                dense = np.zeros((tile, tile))
                b_rows, b_cols, b_cells = _unpacked(*packed[3:])
                np.add.at(dense, (b_rows, b_cols), b_cells)
                if SPARSE * len(cells) < tile * tile:
                    np.add.at(total, rows, cells[:, None] * dense[cols])
                else:
                    ours = np.zeros((tile, tile))
                    np.add.at(ours, (rows, cols), cells)
                    total += ours @ dense
        yield out(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, np.zeros((tile, tile))
        for batch in batches:
            for i, k, block in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if at not in (None, (i, k)):
                    yield out({at: total})
                    total = np.zeros((tile, tile))
                at = i, k
                total = total + np.frombuffer(block, "<f8").reshape(tile, tile)
        if at is not None:
            yield out({at: total})

    partial = pairs.mapInArrow(multiply, "i bigint, k bigint, block binary")
    return partial.repartition("i", "k").sortWithinPartitions("i", "k").mapInArrow(add, "i bigint, k bigint, block binary")


def product(a: DataFrame, b: DataFrame, *, tile: int = TILE) -> DataFrame:
    """``row, col, value``: the product of two cell tables of any size, without zeros."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, k, block in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                values = np.frombuffer(block, "<f8").reshape(tile, tile)
                rows, cols = np.nonzero(values)
                columns = [pa.array(rows + i * tile), pa.array(cols + k * tile), pa.array(values[rows, cols])]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "col", "value"])

    return product_tiles(a, b, tile=tile).mapInArrow(cells, "row bigint, col bigint, value double")
