"""Voxels packed into cubic blocks, so that neighbours meet inside a row.

Texture counts look at the 26 neighbours of every voxel. Instead of sending each voxel
to each neighbour, voxels are grouped once into blocks of EDGE voxels a side; a voxel at a
block's surface also goes to the blocks it touches (the halo, about a fifth more rows). A
row then holds at most (EDGE + 2) cubed cells, however large or skewed a volume is, and numpy looks
all neighbours of a batch of rows up at once. What leaves a block is already counted:
pairs of levels, runs, zones. Only pieces of runs and zones that reach the surface
of their block meet again, in small tables.

A coordinate that is given twice counts once, with its smallest level.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelark.functions.columns import KEYS, col
from voxelark.functions.sizing import PART_ROWS, parts_of

XYZ = ("x", "y", "z")
# One of each opposite pair of the 26 neighbour directions, as (dx, dy, dz).
DIRECTIONS = [
    (dx, dy, dz)
    for dz in (-1, 0, 1)
    for dy in (-1, 0, 1)
    for dx in (-1, 0, 1)
    if (dz, dy, dx) > (0, 0, 0)
]
#: Voxels along an edge of a block: a power of two.
EDGE = 32
_BITS = EDGE.bit_length() - 1
_WIDE = EDGE + 2
#: Cells looked up together.
_CELLS = 1 << 20


def _step(d: Sequence[int]) -> int:
    """Difference of the codes of two cells that lie ``d`` apart."""
    return (d[2] * _WIDE + d[1]) * _WIDE + d[0]


def packed(voxels: DataFrame, keys: Sequence[str], halo: bool, payload: Sequence[str] = ("level",)) -> DataFrame:
    """``keys, bx, by, bz, cells``: one row per block, cells being structs of a local code and the payload.

    Local coordinates run from 1 to EDGE inside the block, 0 and EDGE + 1 are the halo.
    """
    keys = list(keys)
    rows = voxels.select(*[col(k) for k in keys], *XYZ, *payload)
    for a in XYZ:
        inner, own = F.col(a).bitwiseAND(EDGE - 1), F.shiftright(a, _BITS)
        places = F.array(F.lit(0))
        if halo:
            low, high = F.array(F.lit(0), F.lit(-1)), F.array(F.lit(0), F.lit(1))
            places = F.when(inner == 0, low).when(inner == EDGE - 1, high).otherwise(places)
        rows = rows.select("*", F.explode(places).alias("__o")) if halo else rows.withColumn("__o", F.lit(0))
        rows = rows.withColumns({f"b{a}": own + F.col("__o"), a: inner - EDGE * F.col("__o") + 1}).drop("__o")
    code = ((F.col("z") * _WIDE + F.col("y")) * _WIDE + F.col("x")).cast("int").alias("code")
    by = [*[col(k) for k in keys], *[F.col(f"b{a}") for a in XYZ]]
    # Lists can't be combined to less before the shuffle, only sorted; so rows go to their block as they are.
    dealt = parts_of(voxels.sparkSession, voxels.count(), PART_ROWS)
    table = rows.repartition(dealt, *by).groupBy(*by).agg(F.collect_list(F.struct(code, *payload)).alias("cells"))
    table.dealt = dealt
    return table


class Cells:
    """Cells of some rows, sorted by row and code: the place of a neighbour is a search."""

    def __init__(self, rows: pa.RecordBatch, payload: Sequence[str] = ("level",)):
        lists = rows.column(rows.num_columns - 1)
        offsets = lists.offsets.to_numpy()
        flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
        row = np.repeat(np.arange(len(lists)), np.diff(offsets))
        code = flat.field("code").to_numpy(zero_copy_only=False).astype(np.int64)
        values = [flat.field(p).to_numpy(zero_copy_only=False) for p in payload]
        key = row * _WIDE**3 + code
        order = np.lexsort((*reversed(values), key))
        keep = np.ones(len(order), bool)
        keep[1:] = key[order][1:] != key[order][:-1]
        order = order[keep]
        self.key, self.row, self.code = key[order], row[order], code[order]
        for name, value in zip(payload, values):
            setattr(self, name, value[order])
        self.local = np.stack([self.code % _WIDE, self.code // _WIDE % _WIDE, self.code // _WIDE**2])
        self.own = np.flatnonzero(((self.local >= 1) & (self.local <= EDGE)).all(axis=0))
        self.blocks = np.stack([rows.column(f"b{a}").to_numpy(zero_copy_only=False) for a in XYZ]).astype(np.int64)

    def neighbour(self, at: np.ndarray, d: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
        """Places of the cells ``d`` away from those at ``at``, and whether they exist."""
        want = self.key[at] + _step(d)
        found = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return found, self.key[found] == want

    def place(self, at: np.ndarray) -> np.ndarray:
        """Global coordinates of some cells."""
        return self.blocks[:, self.row[at]] * EDGE + self.local[:, at] - 1


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in slices of about _CELLS cells."""
    for batch in batches:
        ends = batch.column(batch.num_columns - 1).offsets.to_numpy()
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(ends, ends[start] + _CELLS, side="right")) - 1)
            yield batch.slice(start, end - start)
            start = end


def _mapped(blocks: DataFrame, keys: Sequence[str], work: Callable, payload: Sequence[str], shape: str) -> DataFrame:
    """Rows of ``keys`` and what ``work`` makes of the cells: row numbers and arrays of the columns of ``shape``."""
    keys = list(keys)
    names = [c.strip().split(" ")[0] for c in shape.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _slices(batches):
            for row, columns in work(Cells(rows, payload)):
                own = [rows.column(k).take(pa.array(row)) for k in range(len(keys))]
                yield pa.RecordBatch.from_arrays([*own, *map(pa.array, columns)], names=[*keys, *names])

    kinds = [f"`{k}` {blocks.schema[k].dataType.simpleString()}" for k in keys]
    return blocks.mapInArrow(run, ", ".join([*kinds, shape]))


def _counted(row: np.ndarray, *levels: np.ndarray):
    """Distinct combinations of row and levels with their counts."""
    known, numbers = np.unique(np.concatenate(levels), return_inverse=True)
    code = row.astype(np.int64)
    for part in np.split(numbers, len(levels)):
        code = code * len(known) + part
    code, n = np.unique(code, return_counts=True)
    found = []
    for _ in levels:
        code, part = np.divmod(code, max(len(known), 1))
        found.append(known[part])
    return code, found[::-1], n


def pair_counts(levels: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``keys, angle, i, j, n``: pairs of levels along each direction, counted."""

    def work(cells: Cells):
        for angle, d in enumerate(DIRECTIONS):
            at, there = cells.neighbour(cells.own, d)
            a, b = cells.own[there], at[there]
            row, (i, j), n = _counted(cells.row[a], cells.level[a], cells.level[b])
            yield row, (np.full(len(row), angle, np.int32), i, j, n)

    shape = "angle int, i int, j int, n long"
    blocks = packed(levels, keys, True)
    parts = _mapped(blocks, keys, work, ("level",), shape)
    # Pairs of one block are counted already; by region and direction they serve all that comes after.
    parts = parts.repartition(4 * blocks.dealt, *[col(k) for k in keys], "angle")
    return parts.groupBy(*[col(k) for k in keys], "angle", "i", "j").agg(F.sum("n").alias("n"))


def surroundings(levels: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Per voxel: level, number of neighbours ``n``, their level sum ``total``, how many are equal ``same``."""

    def work(cells: Cells):
        own = cells.own
        mine = cells.level[own].astype(np.int64)
        n, total, same = (np.zeros(len(own), np.int64) for _ in range(3))
        for d in DIRECTIONS:
            for sign in (1, -1):
                at, there = cells.neighbour(own, [sign * v for v in d])
                level = cells.level[at].astype(np.int64)
                n += there
                total += np.where(there, level, 0)
                same += there & (level == mine)
        place = [c.astype(np.int32) for c in cells.place(own)]
        yield cells.row[own], (*place, cells.level[own], n, total, same)

    shape = "x int, y int, z int, level int, n long, total long, same long"
    return _mapped(packed(levels, keys, True), keys, work, ("level",), shape)


def run_pieces(levels: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``keys, angle, i, j, n, t, px, py, pz``: runs of equal level inside their block.

    Runs of length ``j`` that no neighbouring block goes on with are counted (``t`` is null). A run that goes on
    there, as the halo shows, is a piece of its own, with the position ``t`` of its first voxel on its line and
    the place where the line meets a coordinate plane.
    """

    def work(cells: Cells):
        n = len(cells.key)
        every, own = np.arange(n), np.zeros(n, bool)
        own[cells.own] = True
        for angle, d in enumerate(DIRECTIONS):
            at, there = cells.neighbour(every, d)
            joined = there & (cells.level[at] == cells.level)
            after = np.where(joined & own & own[at], at, -1)
            head = own.copy()
            head[after[after >= 0]] = False
            # What lies two halo cells apart is no business of this block.
            leaves, enters = joined & own & ~own[at], np.zeros(n, bool)
            enters[at[joined & ~own & own[at]]] = True
            first = np.flatnonzero(head)
            last, length = first.copy(), np.ones(len(first), np.int64)
            moving = np.arange(len(first))
            while len(moving):
                moving = moving[after[last[moving]] >= 0]
                last[moving] = after[last[moving]]
                length[moving] += 1
            inside = ~(enters[first] | leaves[last])
            row, (i, j), count = _counted(cells.row[first[inside]], cells.level[first[inside]], length[inside])
            none = pa.nulls(len(row), pa.int32())
            yield row, (np.full(len(row), angle, np.int32), i.astype(np.int32), j, count, none, none, none, none)
            rest = ~inside
            main = next(a for a in range(3) if d[a] != 0)
            place = cells.place(first[rest])
            t = place[main] * d[main]
            line = [(place[a] - t * d[a]).astype(np.int32) for a in range(3)]
            ones = np.ones(len(t), np.int64)
            angles = np.full(len(t), angle, np.int32)
            yield cells.row[first[rest]], (angles, cells.level[first[rest]], length[rest], ones, t.astype(np.int32), *line)

    shape = "angle int, i int, j long, n long, t int, px int, py int, pz int"
    return _mapped(packed(levels, keys, True), keys, work, ("level",), shape)


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest connected cell of each of ``n`` cells, by hooking roots and jumping pointers."""
    label = np.arange(n)
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            above = label[label]
            if (above == label).all():
                break
            label = above
    return label


# Places are packed into one number, in order of z, y and x.
_SHIFT, _ORIGIN = 21, 1 << 20


def _packed_place(x, y, z):
    return ((z + _ORIGIN) << (2 * _SHIFT)) + ((y + _ORIGIN) << _SHIFT) + x + _ORIGIN


def zone_pieces(levels: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``keys, node, level, size, surface``: connected voxels of equal level inside their block.

    ``node`` is the smallest place of the piece, ``surface`` its voxels at the surface of the block.
    """

    def work(cells: Cells):
        every, ends = np.arange(len(cells.key)), []
        for d in DIRECTIONS:
            at, there = cells.neighbour(every, d)
            same = there & (cells.level[at] == cells.level)
            ends.append((every[same], at[same]))
        label = _labels(len(every), *(np.concatenate(e) for e in zip(*ends)))
        roots, number, size = np.unique(label, return_inverse=True, return_counts=True)
        outer = np.flatnonzero(((cells.local == 1) | (cells.local == EDGE)).any(axis=0))
        outer = outer[np.argsort(number[outer], kind="stable")]
        offsets = np.searchsorted(number[outer], np.arange(len(roots) + 1)).astype(np.int32)
        place = pa.StructArray.from_arrays([pa.array(c.astype(np.int32)) for c in cells.place(outer)], names=list(XYZ))
        surface = pa.ListArray.from_arrays(pa.array(offsets), place)
        node = _packed_place(*cells.place(roots))
        yield cells.row[roots], (node, cells.level[roots], size, surface)

    shape = "node long, level int, size long, surface array<struct<x:int,y:int,z:int>>"
    return _mapped(packed(levels, keys, False), keys, work, ("level",), shape)


def zone_contacts(pieces: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``keys, a, b``: pieces of one zone that touch across a block's surface."""

    def work(cells: Cells):
        found = []
        for d in DIRECTIONS:
            for sign in (1, -1):
                at, there = cells.neighbour(cells.own, [sign * v for v in d])
                a, b = cells.own[there], at[there]
                across = (cells.level[a] == cells.level[b]) & (cells.node[a] != cells.node[b])
                found.append((cells.row[a[across]], cells.node[a[across]], cells.node[b[across]]))
        row, a, b = (np.concatenate(f) for f in zip(*found))
        order = np.lexsort((b, a, row))
        row, a, b = row[order], a[order], b[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        yield row[new], (a[new], b[new])

    surface = pieces.select(*[col(k) for k in keys], "level", "node", F.inline("surface"))
    cells = packed(surface, keys, True, ("level", "node"))
    return _mapped(cells, keys, work, ("level", "node"), "a long, b long")
