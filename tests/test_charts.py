import numpy as np
import pytest

from tallycast.operators import charts


def slots_of(spark, rows):
    return spark.createDataFrame(rows, "key string, hour int, minute int, v double")


def test_boxes_match_numpy(spark):
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.normal(50, 5, 40), [500.0, -300.0]])
    slots = slots_of(spark, [("a", 9, i, float(v)) for i, v in enumerate(values)])
    boxes = {r.hour: r for r in charts.box_stats(slots, "v").collect()}
    assert sorted(boxes) == list(range(24)) and boxes[3].n == 0 and boxes[3].median is None
    q1, median, q3 = np.percentile(values, [25, 50, 75])
    inside = values[(values >= q1 - 1.5 * (q3 - q1)) & (values <= q3 + 1.5 * (q3 - q1))]
    box = boxes[9]
    assert np.allclose([box.q1, box.median, box.q3, box.whisker_low, box.whisker_high], [q1, median, q3, inside.min(), inside.max()])
    assert -300.0 in box.outliers and 500.0 in box.outliers and len(box.outliers) + len(inside) == 42


@pytest.mark.parametrize("hours", [range(8, 17), [5], range(24)])
def test_histogram_matches_numpy(spark, hours):
    rows = [("a", h, m, 1.0) for h in hours for m in range(h + 1)]
    got = charts.hour_histogram(slots_of(spark, rows)).orderBy("bin").collect()
    counts, edges = np.histogram([r[1] for r in rows], bins=24)
    assert [r.n for r in got] == counts.tolist() and np.allclose([r.bin_start for r in got], edges[:-1])


def test_weighted_histogram(spark):
    got = charts.hour_histogram(slots_of(spark, [("a", 0, 0, 3.0), ("a", 23, 0, 4.0)]), weight="v")
    assert {r.bin: r.n for r in got.collect() if r.n} == {1: 3, 24: 4}


def test_pivot_leaves_empty_cells_null(spark):
    row = charts.heatmap_pivot(slots_of(spark, [("a", 8, 0, 1.0), ("b", 8, 0, 2.0), ("a", 8, 59, 4.0)]), "v").collect()[0]
    assert (row.hour, row.m0, row.m1, row.m59) == (8, 3.0, None, 4.0)
