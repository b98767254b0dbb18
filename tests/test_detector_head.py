"""The detector's head against numpy: decoding, classes, suppression, the way back to the frame, padding."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline.operators import boxes

BINS, CLASSES = 4, 9
WIDTH = 4 * BINS + CLASSES


def plain(maps, size, confidence, overlap, scale, left, top, frame):
    cells = []
    for stride, flat in sorted(maps.items()):
        n = size // stride
        v = np.array(flat).reshape(n * n, WIDTH)
        for i, row in enumerate(v):
            p = 1 / (1 + np.exp(-np.clip(row[4 * BINS :], -30, 30)))
            c = int(np.argmax(p))
            if p[c] < confidence or c not in (2, 3, 5, 7):
                continue
            e = np.exp(row[: 4 * BINS].reshape(4, BINS) - row[: 4 * BINS].reshape(4, BINS).max(axis=1, keepdims=True))
            d = (e * np.arange(BINS)).sum(axis=1) / e.sum(axis=1)
            x, y = i % n + 0.5, i // n + 0.5
            cells.append((c, p[c], stride, i, (x - d[0]) * stride, (y - d[1]) * stride, (x + d[2]) * stride, (y + d[3]) * stride))
    out = []
    for c in {x[0] for x in cells}:
        kept = []
        for b in sorted((x for x in cells if x[0] == c), key=lambda x: (-x[1], x[2], x[3])):
            over = False
            for k in kept:
                w = max(0, min(b[6], k[6]) - max(b[4], k[4])) * max(0, min(b[7], k[7]) - max(b[5], k[5]))
                area = lambda q: max(0, q[6] - q[4]) * max(0, q[7] - q[5])
                over |= w / max(area(b) + area(k) - w, 1e-9) > overlap
            if not over:
                kept.append(b)
        out += kept
    done = []
    for b in out:
        x1, x2 = (min(max((v - left) / scale, 0), frame[0]) for v in (b[4], b[6]))
        y1, y2 = (min(max((v - top) / scale, 0), frame[1]) for v in (b[5], b[7]))
        if x2 > x1 and y2 > y1:
            done.append((b[0], b[1], x1, y1, x2, y2))
    return sorted(done, key=lambda r: (-r[1], r[0]))


def test_head_equals_numpy(spark):
    rng = np.random.default_rng(5)
    frames, rows = {}, []
    for k in range(4):
        frames[k] = {s: rng.normal(0, 2, (64 // s) ** 2 * WIDTH).tolist() for s in (8, 16, 32)}
        rows += [(k, s, f) for s, f in frames[k].items()]
    rows += [(9, s, [-5.0] * ((64 // s) ** 2 * WIDTH)) for s in (8, 16, 32)]  # nothing is seen
    df = spark.createDataFrame(rows, "frame long, stride int, features array<double>")
    got = boxes.detections(df, ["frame"], (640, 360), 0.1, 0.0, 14.0, 64, BINS, CLASSES, confidence=0.7).collect()
    seen = 0
    for k, maps in frames.items():
        want = plain(maps, 64, 0.7, 0.45, 0.1, 0.0, 14.0, (640, 360))
        mine = sorted((r for r in got if r.frame == k), key=lambda r: r.place)
        assert [r.place for r in mine] == list(range(1, len(want) + 1))
        for r, w in zip(mine, want, strict=True):
            assert (r.class_id, r.confidence) == (w[0], pytest.approx(w[1], abs=1e-5))
            assert (r.x1, r.y1, r.x2, r.y2) == pytest.approx(w[2:], abs=0.006)
            assert (r.u1, r.v2) == pytest.approx((w[2] / 640, w[5] / 360), abs=1e-5)
        cells = sum(len(f) // WIDTH for f in maps.values())
        assert 0 < len(want) < cells
        seen += len(want)
    assert len(got) == seen and {r.class_name for r in got} <= {"car", "motorcycle", "bus", "truck"}


def test_full_grid_has_a_cell_for_each_anchor(spark):
    assert boxes.anchor_grid(spark).count() == 8400
    # one confident cell in each map: its box is centred on the anchor of its place
    rows = []
    for s, cell in ((8, 6399), (16, 41), (32, 0)):
        v = np.full(((640 // s) ** 2, 4 * 2 + 4), -9.0)
        v[:, :8] = 0  # two bins of equal weight: each side is half a cell away
        v[cell, 8 + 2] = 9.0
        rows.append((1, s, v.reshape(-1).tolist()))
    df = spark.createDataFrame(rows, "frame int, stride int, features array<double>")
    got = {(r.x1, r.y1, r.x2, r.y2) for r in boxes.detections(df, ["frame"], (640, 640), 1.0, 0.0, 0.0, 640, 2, 4).collect()}
    centre = lambda x, y, s: (x * s, y * s, (x + 1) * s, (y + 1) * s)
    assert got == {tuple(map(float, centre(*p))) for p in ((79, 79, 8), (1, 1, 16), (0, 0, 32))}


def test_maps_of_another_size_are_errors(spark):
    df = spark.createDataFrame([(1, 32, [0.0] * 10)], "frame long, stride int, features array<double>")
    with pytest.raises(Exception, match="another size"):
        boxes.detections(df, ["frame"], (640, 360), 0.1, 0.0, 14.0, 64, BINS, CLASSES).collect()


def test_padding(spark):
    df = spark.createDataFrame([(bytes(range(24)),), (None,)], "d binary")
    got = [r[0] for r in df.select(boxes.letterboxed(F.col("d"), 4, 2, 4)).collect()]
    assert bytes(got[0]) == bytes([114] * 12) + bytes(range(24)) + bytes([114] * 12) and got[1] is None
    with pytest.raises(ValueError, match="must be 8 x 4"):
        boxes.letterboxed(F.col("d"), 4, 2, 8)
    with pytest.raises(Exception, match="24 bytes, expected 48"):
        df.select(boxes.letterboxed(F.col("d"), 8, 2, 8)).collect()
