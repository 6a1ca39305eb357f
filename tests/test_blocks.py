"""Voxel blocks: counts must not depend on where block borders fall."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from voxelark.functions.sizing import parts_of
from voxelark.operators import blocks, texture
from voxelark.operators.zones import zone_sizes

K = ["patientID"]
SHAPE = "patientID string, x int, y int, z int, value double, level int"


def frame(spark, cells, patient="p"):
    return spark.createDataFrame([(patient, *p, float(v), int(v)) for p, v in cells.items()], SHAPE)


def voxels(seed, shape, origin, levels=3, share=0.8):
    rng = np.random.default_rng(seed)
    return {
        tuple(int(o + i) for o, i in zip(origin, p)): int(rng.integers(1, levels + 1))
        for p in np.ndindex(*shape)
        if rng.random() < share
    }


def step(p, d, n=1):
    return tuple(a + n * b for a, b in zip(p, d))


ORIGINS = [(0, 0, 0), (29, -3, 62), (-34, 30, -66)]


@pytest.mark.parametrize("origin", ORIGINS)
def test_pairs_and_surroundings(spark, origin):
    cells = voxels(1, (6, 7, 5), origin)
    df = frame(spark, cells)
    want = Counter((a, cells[p], cells[q]) for a, d in enumerate(blocks.DIRECTIONS) for p in cells if (q := step(p, d)) in cells)
    got = {(r["angle"], r["i"], r["j"]): r["n"] for r in blocks.pair_counts(df, K).collect()}
    assert got == want
    near = {}
    for p, v in cells.items():
        around = [cells[q] for d in itertools.product((-1, 0, 1), repeat=3) if d != (0, 0, 0) and (q := step(p, d)) in cells]
        near[p] = (v, len(around), sum(around), sum(x == v for x in around))
    got = {(r["x"], r["y"], r["z"]): (r["level"], r["n"], r["total"], r["same"]) for r in blocks.surroundings(df, K).collect()}
    assert got == near


def brute_runs(cells):
    counts = Counter()
    for angle, d in enumerate(blocks.DIRECTIONS):
        for p, v in cells.items():
            if cells.get(step(p, d, -1)) != v:
                n = next(k for k in itertools.count(1) if cells.get(step(p, d, k)) != v)
                counts[angle, v, n] += 1
    return counts


@pytest.mark.parametrize("origin", ORIGINS)
def test_runs_over_blocks(spark, origin):
    cells = voxels(2, (6, 5, 7), origin, levels=2, share=0.9)
    cells |= {step(origin, (1, 1, 1), 20 + k): 3 for k in range(100)} | {(k, 500, 500): 1 for k in range(-70, 90)}
    got = {(r["angle"], r["i"], r["j"]): r["n"] for r in texture.runs(frame(spark, cells), K).collect()}
    assert got == brute_runs(cells)


def brute_zones(cells):
    seen, found = set(), []
    for p in cells:
        if p in seen:
            continue
        seen.add(p)
        queue, members = [p], []
        while queue:
            q = queue.pop()
            members.append(q)
            for d in itertools.product((-1, 0, 1), repeat=3):
                r = step(q, d)
                if r not in seen and cells.get(r) == cells[p]:
                    seen.add(r)
                    queue.append(r)
        x, y, z = min(members, key=lambda q: q[::-1])
        found.append((int(blocks._packed_place(x, y, z)), cells[p], len(members)))
    return sorted(found)


@pytest.mark.parametrize("origin", ORIGINS)
def test_zones_over_blocks(spark, origin):
    cells = voxels(3, (6, 7, 5), origin, levels=2, share=0.6)
    # A comb and a winding line through several blocks.
    cells |= {(300 + k, 7 * (k // 40), 0): 5 for k in range(150)}
    cells |= {(k, 400, 400): 4 for k in range(-50, 120)} | {(k, 401 + j, 400): 4 for k in range(-50, 120, 3) for j in range(4)}
    got = sorted((r["node"], r["level"], r["size"]) for r in zone_sizes(frame(spark, cells), K).collect())
    assert got == brute_zones(cells)


def test_regions_stay_apart_and_repeated_voxels_count_once(spark):
    cells = voxels(4, (5, 4, 3), (30, 30, 30))
    both = frame(spark, cells).unionByName(frame(spark, cells, "q")).unionByName(frame(spark, cells, "q"))
    counts = {}
    for r in blocks.pair_counts(both, K).collect():
        counts.setdefault(r["patientID"], {})[r["angle"], r["i"], r["j"]] = r["n"]
    assert counts["p"] == counts["q"]
    sizes = zone_sizes(both, K).groupBy("patientID").sum("size").collect()
    assert {r["patientID"]: r["sum(size)"] for r in sizes} == {"p": len(cells), "q": len(cells)}
    nothing = both.limit(0)
    assert blocks.pair_counts(nothing, K).count() == texture.runs(nothing, K).count() == zone_sizes(nothing, K).count() == 0


def test_voxels_are_exchanged_once(spark):
    df = frame(spark, voxels(5, (3, 3, 3), (0, 0, 0)))
    for counted in (blocks.pair_counts(df, K), blocks.surroundings(df, K), blocks.run_pieces(df, K)):
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert plan.count("hashpartitioning(patientID#") <= 2 and "SortMergeJoin" not in plan and "Window" not in plan


def test_level_pair_sums_of_many_levels():
    rng = np.random.default_rng(6)

    def brute(i, n, s):
        p = n / n.sum()
        gap = np.abs(i[:, None] - i[None, :])
        both = p[:, None] + p[None, :]
        return [
            (p[:, None] * p[None, :] * gap**2).sum(),
            np.abs((i * p)[:, None] - (i * p)[None, :]).sum(),
            (gap * ((p * s)[:, None] + (p * s)[None, :]) / both).sum(),
            (both * gap**2).sum(),
        ]

    cases = [(np.array([3.0]), np.array([4.0]), np.array([0.5]))]
    for size in (2, 7, 300):
        cases.append((np.sort(rng.choice(1000, size, False)).astype(float), rng.integers(1, 50, size).astype(float), rng.random(size)))
    got = texture._level_pair_sums(*(pd.Series([c[k].tolist() for c in cases]) for k in range(3)))
    for row, case in zip(got.to_numpy(), cases):
        assert row == pytest.approx(brute(*case), rel=1e-9)
    i = np.arange(1.0, 10_001)
    many = texture._level_pair_sums(*(pd.Series([x.tolist()]) for x in (i, np.ones(10_000), np.ones(10_000))))
    # Equal counts: every pair of levels contributes its distance.
    assert many["complexity"][0] == pytest.approx(2 * sum((10_000 - k) * k for k in range(1, 10_000)))
    assert math.isclose(many["contrast"][0], 2 * i.var())


def test_runs_of_one_block_are_closed_by_the_halo(spark):
    """Runs that no neighbouring block goes on with leave no piece, also at the surface; others still meet."""
    rng = random.Random(11)
    small = [("s", x, y, z, rng.randint(1, 2)) for x in range(4) for y in range(4) for z in range(4)]
    wide = [("w", x, y, z, rng.randint(1, 2)) for x in range(29, 36) for y in range(-2, 2) for z in range(63, 66) if rng.random() < 0.9]
    wide += [("w", 31, -1, 64, 1), ("w", 32, 0, 64, 1)]
    levels = spark.createDataFrame(small + wide, "p string, x int, y int, z int, level int")
    pieces = blocks.run_pieces(levels, ["p"]).filter("t is not null")
    assert {r["p"] for r in pieces.select("p").distinct().collect()} == {"w"}
    at = {}
    for p, x, y, z, level in small + wide:
        at[p, x, y, z] = min(level, at.get((p, x, y, z), level))
    want = {}
    for (p, x, y, z), level in at.items():
        for angle, (dx, dy, dz) in enumerate(blocks.DIRECTIONS):
            if at.get((p, x - dx, y - dy, z - dz)) == level:
                continue
            j = 1
            while at.get((p, x + j * dx, y + j * dy, z + j * dz)) == level:
                j += 1
            want[p, angle, level, j] = want.get((p, angle, level, j), 0) + 1
    got = {(r["p"], r["angle"], r["i"], r["j"]): r["n"] for r in texture.runs(levels, ["p"]).collect()}
    assert got == want


def test_sized_partitions_grow_with_the_data(spark):
    assert parts_of(spark, 0, 100) == 1 and parts_of(spark, 25, 100) == 3
    assert parts_of(spark, 100, 100) == 4 and parts_of(spark, 12345, 100) == 124
