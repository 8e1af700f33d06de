"""Hard negatives against all pairs, the curve, and what the zone maps leave out."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from stewardry.llm import hard_negatives
from stewardry.llm.staging import prepare

SCHEMA = "vec_id long, label int, embedding array<double>, rank string, score string"


@pytest.fixture
def small_blocks(monkeypatch):
    for name, value in (("BLOCK_ROWS", 16), ("ANCHOR_ROWS", 4), ("ZONES_AT_ONCE", 3), ("BLOCKS_A_UNIT", 2)):
        monkeypatch.setattr(hard_negatives, name, value)


def all_pairs(rows):
    used, out = [], []
    for i, label, vector in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        used.append((i, label, [math.floor(256 * x) for x in vector]))
    for a, (i, label, q) in enumerate(used):
        if i is None or i % 50:
            continue
        scored = sorted((-sum(map(int.__mul__, q, p)), j is None, j or 0, b) for b, (j, _, p) in enumerate(used) if b != a)
        for p in [s for s in scored if used[s[3]][1] == label][:5]:
            inside = [s for s in scored if used[s[3]][1] != label and -50 * p[0] <= -100 * s[0] <= -95 * p[0]]
            out += [(i, used[p[3]][0], n + 1, used[s[3]][0], -p[0], -s[0]) for n, s in enumerate(inside[:3])]
    return sorted(out, key=repr)


def mined(spark, rows):
    given = prepare(spark).createDataFrame([(*r, "r", "s") for r in rows], SCHEMA)
    return sorted(map(tuple, hard_negatives.mine(spark, given, F.col("vec_id") % 50 == 0).collect()), key=repr)


def clusters(n=400, width=6):
    draw = np.random.default_rng(4)
    middles = draw.normal(size=(8, width))
    return [(i, int(draw.integers(0, 4)), (middles[i % 8] + 0.1 * draw.normal(size=width)).tolist()) for i in range(n)]


def odd_rows():
    rows = clusters()
    copies = [(8000 + i, 3, rows[0][2]) for i in range(120)] + [rows[50], rows[50], (50, 1, rows[3][2])]
    infinite, missing = [1.0, math.inf, 0.0], [1.0, None, 0.0]
    odd = [(None, 3, rows[0][2]), (None, None, rows[1][2]), (9001, 2, None), (9002, 2, missing), (9003, 2, [math.nan] * 6)]
    return rows + copies + odd + [(9004, 2, infinite), (9005, 2, []), (9006, 2, [1.0, 1.0]), (9050, 1, [0.0] * 6), (9100, 2, [1e308])]


@pytest.mark.parametrize("rows", [[], [(50, 1, [1.0, 2.0])], [(50, 1, []), (51, 1, []), (52, 2, [])]], ids=["empty", "one", "no width"])
def test_few_rows(spark, rows):
    assert mined(spark, rows) == all_pairs(rows)


def test_equals_all_pairs(spark, small_blocks):
    rows = odd_rows()
    found = mined(spark, rows)
    assert found == all_pairs([r for r in rows if r[0] != 9100])  # 256 times 1e308 isn't finite


def test_scores_beyond_doubles_are_exact(spark, small_blocks):
    draw = np.random.default_rng(5)
    rows = [(i, i % 3, (1e6 * draw.normal(size=3)).tolist()) for i in range(120)]
    expected = all_pairs(rows)
    assert max(abs(r[4]) for r in expected) > 2**53
    assert mined(spark, rows) == expected


def test_neighbours_on_the_curve_are_neighbouring_cells():
    for axes, bits in ((2, 4), (3, 3), (5, 1)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
        keys = [k.tobytes() for k in hard_negatives.hilbert_keys(cells, bits)]
        order = sorted(range(len(cells)), key=keys.__getitem__)
        assert len(set(keys)) == len(cells)
        assert set(np.abs(np.diff(cells[order], axis=0)).sum(axis=1)) == {1}


def test_zone_maps_leave_blocks_out(spark, small_blocks, monkeypatch):
    read, evaluate = [], hard_negatives.evaluate

    def counted(units, *rest):
        read.append(sum(len(r["blocks"]) for r in units.collect()))
        return evaluate(units, *rest)

    monkeypatch.setattr(hard_negatives, "evaluate", counted)
    rows = clusters(800)
    assert mined(spark, rows) == all_pairs(rows)
    pairs = (-(-800 // 16)) * 4  # blocks by anchor blocks
    assert sum(read) < 2 * pairs * 0.7
