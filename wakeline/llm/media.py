"""Media columns: copies of images by local descriptors, also cropped, turned, resized or otherwise edited ones.

Images are grey pixels in a binary column with width and height. Equal pixels collapse first.

1. Corners are taken at LEVELS sizes of the image, each half of the one before: places whose smaller structure-tensor
   eigenvalue is the largest within SPREAD pixels. Their number follows the image's area; there is no other bound.
2. A corner's descriptor is 128 comparisons of smoothed pixels at point pairs, turned by the corner's orientation (its
   intensity centroid). A bit is set if the second pixel is lighter by more than MARGIN grey levels.
3. Hamming tables: a descriptor is four words of 32 bits, each a table of its own. In a bucket (one value of one
   table) the first descriptor is linked to all within LINK_BITS of it, then the first of those left, and so on: a
   bucket of n rows gives fewer than n links (all pairs only where there are at most SMALL rows). Buckets of
   more than about BLOCK_ROWS rows (by one picture in SAMPLED) are dealt to several tasks.
4. Two images with two links are a candidate: all their descriptors are compared, and MIN_VOTES pairs of corners
   with one scale, rotation and shift (geometric consensus) link the images.
5. Linked images form classes. What is left of each bucket is then one row for each class, in another order, and steps
   3 and 4 go on until a round brings no new link, ROUNDS times at most. So classes of n copies cost n, not n squared.
6. At last the near rows of different classes in every bucket are found, all of them, whatever the bucket's size, and step 4
   settles what is new. Pairs within a class need no look, as they are one class already. Two images that one corner
   alone links are no rows on the way; see links_across().

Near rows of a bucket are found without looking at all pairs: two descriptors that differ in fewer than six bits share one of
the six times 16 bits outside their word, so rows of buckets over MANY are compared in groups that share 16 bits more.

So no pair of images with two corners that share a word and lie within LINK_BITS is left out. The words are an index all the
same: images whose corners share no word, or only one, are no candidates. Every image is indexed, and tests measure the
classes against brute force.

Result: one row for each input row with class_id (the smallest id of its class) and n_links (the other rows of its class).

Defined results: null pixels, or a size that does not fit them, give a class of their own and no links, however many
rows share the id; images too small or flat for corners match equal pixels only. Rows with a null id take part; a class without
ids has a null class_id. Extra columns do not matter. No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.components import connected_components
from wakeline.session import settle

LEVELS = 3
SPREAD = 4
RADIUS = 7
TESTS = 128
TURNS = 32
MARGIN = 2
LEAST_STRENGTH = 600
MAX_BITS = 10
LINK_BITS = 5
ROUNDS = 4
MIN_VOTES = 3
SMALL = 4
BLOCK_ROWS = 1 << 16
SAMPLED = 64
LISTED = 256
MANY = 64
PEELED = 16
AT_ONCE = 1 << 18
HELD_ROWS = 1 << 16
SIDE = 80

#: A corner: its place in pixels of the whole image, its level, its orientation in turns and its descriptor.
CORNER = np.dtype([("y", "<f4"), ("x", "<f4"), ("level", "<i2"), ("turn", "<i2"), ("word", "<u4", 4)])


def _all_turns(p: np.ndarray) -> np.ndarray:
    """TURNS x tests x 2 points (y, x) of tests turned by each angle; quarter turns are exact."""
    a = 2 * np.pi * np.arange(TURNS // 4) / TURNS
    turn = np.stack([np.cos(a), np.sin(a), -np.sin(a), np.cos(a)], 1).reshape(-1, 2, 2)
    quarter = [np.rint(np.einsum("tij,nkj->tnki", turn, p)).astype(np.int64)]
    for _ in range(3):
        y, x = quarter[-1][..., 0], quarter[-1][..., 1]
        quarter.append(np.stack([x, -y], -1))
    return np.concatenate(quarter)


@lru_cache(1)
def _tests() -> np.ndarray:
    """TURNS x TESTS x 2 points: of many random tests those that split the corners of soft random noise most evenly and
    agree least with one another, so that words are spread over many values."""
    rnd = np.random.default_rng(3)
    p = rnd.normal(0, RADIUS / 1.8, (1500, 2, 2))
    p *= np.minimum(1, (RADIUS - 1) / np.linalg.norm(p, axis=2, keepdims=True))
    pool = _all_turns(p)
    noise = rnd.normal(0, 1, (24, SIDE, SIDE))
    for width in (2, 3):
        noise = sum(np.roll(noise, (y, x), (1, 2)) for y in range(width) for x in range(width)) / width
    grey = (128 + 50 * noise / noise.std()).clip(0, 255).astype(np.int32)
    k, y, x = _corners(grey).T
    value = _values(grey, k, y, x, pool[_turn(grey, k, y, x)])
    bits = np.where(value[..., 0] + 9 * MARGIN < value[..., 1], 1.0, -1.0)
    mean = bits.mean(0)
    bits = (bits - mean) / np.maximum(bits.std(0), 1e-6)
    # the most even test first, then always the one that is even and least like those chosen
    chosen, like = [int(np.abs(mean).argmin())], np.zeros(len(mean))
    while len(chosen) < TESTS:
        like = np.maximum(like, np.abs(bits[:, chosen[-1]] @ bits) / len(bits))
        like[chosen] = np.inf
        chosen.append(int((like + np.abs(mean) / 2).argmin()))
    # neighbours in this order go to different words
    return pool[:, np.array(chosen).reshape(-1, 4).T.ravel()]


def _turn(grey: np.ndarray, k: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Orientation of each corner: the angle of its disc's intensity centroid, in turns."""
    dy, dx = _disc()
    patch = grey[k[:, None], y[:, None] + dy, x[:, None] + dx]
    return np.rint(np.arctan2(patch @ dy, patch @ dx) / (2 * np.pi) * TURNS).astype(int) % TURNS


def _values(grey: np.ndarray, k: np.ndarray, y: np.ndarray, x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Smoothed pixels at both points of each test of each corner."""
    h, w = grey.shape[1:]
    at = ((k * h + y) * w + x)[:, None, None] + points[..., 0] * w + points[..., 1]
    return _smooth(grey).ravel()[at]


@lru_cache(1)
def _disc() -> tuple[np.ndarray, np.ndarray]:
    d = np.mgrid[-RADIUS : RADIUS + 1, -RADIUS : RADIUS + 1].reshape(2, -1)
    return d[:, (d**2).sum(0) <= RADIUS**2].astype(np.int32)


def _smooth(x: np.ndarray) -> np.ndarray:
    """Sums over 3 x 3 places of each image, edges repeated."""
    for axis in (1, 2):
        n = x.shape[axis]
        pad = np.pad(x, [(1, 1) if k == axis else (0, 0) for k in range(3)], mode="edge")
        x = sum(pad.take(range(k, k + n), axis) for k in range(3))
    return x


def _most_around(x: np.ndarray, radius: int) -> np.ndarray:
    """The largest value within radius of each place, in rows and columns."""
    for axis in (1, 2):
        n, size = x.shape[axis], 1
        pad = np.pad(x, [(radius, radius) if k == axis else (0, 0) for k in range(3)])
        cut = lambda a, first, count: a.take(range(first, first + count), axis)  # noqa: E731, B023
        while 2 * size <= 2 * radius + 1:
            pad = np.maximum(cut(pad, 0, pad.shape[axis] - size), cut(pad, size, pad.shape[axis] - size))
            size *= 2
        rest = 2 * radius + 1 - size
        x = np.maximum(cut(pad, 0, n), cut(pad, rest, n))
    return x


def _corners(grey: np.ndarray) -> np.ndarray:
    """(image, y, x) of the corners of images of one size, away from the border."""
    gy, gx = np.zeros_like(grey), np.zeros_like(grey)
    gy[:, 1:-1] = grey[:, 2:] - grey[:, :-2]
    gx[:, :, 1:-1] = grey[:, :, 2:] - grey[:, :, :-2]
    a, b, c = _smooth(gy * gy), _smooth(gy * gx), _smooth(gx * gx)
    strength = ((a + c) - np.sqrt((a - c).astype(float) ** 2 + 4.0 * b.astype(float) ** 2)).round(3)
    best = (strength >= LEAST_STRENGTH) & (strength == _most_around(strength, SPREAD))
    edge = RADIUS + 1
    best[:, :edge] = best[:, -edge:] = best[:, :, :edge] = best[:, :, -edge:] = False
    return np.argwhere(best)


def describe(grey: np.ndarray) -> list[np.ndarray]:
    """CORNER records of each of the images (n x height x width)."""
    grey = grey.astype(np.int32)
    n, found = len(grey), []
    for level in range(LEVELS):
        if min(grey.shape[1:]) < 2 * RADIUS + 3:
            break
        at = _corners(grey)
        if len(at):
            k, y, x = at.T
            turn = _turn(grey, k, y, x)
            value = _values(grey, k, y, x, _tests()[turn])
            out = np.zeros(len(at), CORNER)
            out["y"], out["x"], out["level"], out["turn"] = (y + 0.5) * 2**level, (x + 0.5) * 2**level, level, turn
            out["word"] = np.packbits(value[..., 0] + 9 * MARGIN < value[..., 1], axis=1).view("<u4")
            found.append((k, out))
        h, w = grey.shape[1] // 2 * 2, grey.shape[2] // 2 * 2
        grey = (grey[:, :h:2, :w:2] + grey[:, 1:h:2, :w:2] + grey[:, :h:2, 1:w:2] + grey[:, 1:h:2, 1:w:2] + 2) >> 2
    if not found:
        return [np.empty(0, CORNER)] * n
    image, out = (np.concatenate(c) for c in zip(*found, strict=True))
    by = np.argsort(image, kind="stable")
    return np.split(out[by], np.searchsorted(image[by], np.arange(1, n)))


def votes(a: np.ndarray, b: np.ndarray) -> int:
    """The most pairs of corners of two images that agree in one scale, rotation and shift."""
    if len(a) < 2 or len(b) < 2:
        return min(len(a), len(b), 1)
    bits = np.bitwise_count(a["word"][:, None] ^ b["word"][None]).sum(2, dtype=np.int64)
    i = np.arange(len(a))
    j = bits.argmin(1)
    # the nearest of one another
    ok = (bits[i, j] <= MAX_BITS) & (bits.argmin(0)[j] == i)
    i, j = i[ok], j[ok]
    if len(i) < 2:
        return len(i)
    a, b = a[i], b[j]
    p, q = (s["x"].astype(float) + 1j * s["y"] for s in (a, b))
    dp, dq = p[None] - p[:, None], q[None] - q[:, None]
    far = (np.abs(dp) > 4) & (np.abs(dq) > 4)
    ratio = np.where(far, dp, 1) / np.where(far, dq, 1)
    # both corners of a pair have the scale and the rotation that the line between them has
    step = a["level"].astype(int) - b["level"]
    turn = np.angle(ratio) / (2 * np.pi) * TURNS - (a["turn"].astype(int) - b["turn"])[:, None]
    turned = np.abs((turn + TURNS / 2) % TURNS - TURNS / 2) <= 1.5
    ok = far & (step == step[:, None]) & (np.abs(np.abs(ratio) / 2.0 ** step[:, None] - 1) < 0.12) & turned & turned.T
    # what agrees with the anchor of a row in rotation: two neighbouring parts of the circle
    parts = 60
    part = (np.angle(ratio) / (2 * np.pi) * parts).astype(int) % parts
    row, other = np.nonzero(ok)
    table = np.zeros((len(i), parts), np.int64)
    np.add.at(table, (row, part[row, other]), 1)
    return int((table + np.roll(table, -1, 1)).max()) + 1


def _fitting(width, height, pixels) -> bool:
    return pixels is not None and width is not None and height is not None and width > 0 and height > 0 and len(pixels) == width * height


def features(df: DataFrame, id_col: str, width: str, height: str, pixels: str) -> DataFrame:
    """_id, _node (64 bits of a digest of size and pixels; null where they do not fit) and _corners (CORNER records)."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = list(zip(*(b.column(c).to_pylist() for c in ("_w", "_h", "_p")), strict=True))
            nodes, found, shapes = [None] * len(rows), [None] * len(rows), {}
            for k, (w, h, p) in enumerate(rows):
                if _fitting(w, h, p):
                    nodes[k] = int.from_bytes(hashlib.sha256(b"%d,%d," % (w, h) + p).digest()[:8], "little", signed=True)
                    shapes.setdefault((h, w), []).append(k)
            for (h, w), at in shapes.items():
                step = max(1, (1 << 20) // (h * w))  # pixels at a time
                for s in range(0, len(at), step):
                    part = at[s : s + step]
                    grey = np.stack([np.frombuffer(rows[k][2], np.uint8).reshape(h, w) for k in part])
                    for k, c in zip(part, describe(grey), strict=True):
                        found[k] = c.tobytes()
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(nodes, pa.int64()), pa.array(found, pa.binary())], names=["_id", "_node", "_corners"])

    named = df.select(F.col(id_col).alias("_id"), F.col(width).cast("int").alias("_w"), F.col(height).cast("int").alias("_h"), F.col(pixels).alias("_p"))
    return named.mapInArrow(run, f"_id {kind}, _node long, _corners binary")


def tables(images: DataFrame) -> DataFrame:
    """key (table and word), node, at (the corner's number) and the descriptor d0, d1, from rows of (node, corners)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            each = [np.frombuffer(x.as_buffer(), CORNER) for x in b.column("corners")]
            n = [len(c) for c in each]
            word = np.concatenate([np.empty(0, CORNER), *each])["word"]
            node = np.repeat(b.column("node").to_numpy(), n)
            at = np.concatenate([np.empty(0, np.int32), *(np.arange(k, dtype=np.int32) for k in n)])
            d = np.ascontiguousarray(word).view(np.int64)
            key = (np.arange(4, dtype=np.int64) << 32) | word.astype(np.int64)
            cols = [key.ravel(), np.repeat(node, 4), np.repeat(at, 4), np.repeat(d[:, 0], 4), np.repeat(d[:, 1], 4)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["key", "node", "at", "d0", "d1"])

    return images.select("node", "corners").mapInArrow(run, "key long, node long, at int, d0 long, d1 long")


@lru_cache(None)
def _two_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n, 1)


def _all_pairs(rows: np.ndarray, start: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All two of the rows of each group (rows[start : start + size]), the earlier first, some at a time."""
    for n in np.unique(size[size > 1]).tolist():
        first = start[size == n]
        if n <= MANY:
            p, q = _two_of(n)
            step = max(1, AT_ONCE // len(p))
            for k in range(0, len(first), step):
                at = first[k : k + step, None]
                yield rows[(at + p).ravel()], rows[(at + q).ravel()]
            continue
        step = max(1, AT_ONCE // n)
        for s in first.tolist():
            own = rows[s : s + n]
            for k in range(0, n - 1, step):
                p, q = np.nonzero(np.arange(k, min(k + step, n))[:, None] < np.arange(n)[None])
                yield own[p + k], own[q]


def _bits_apart(d: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of descriptors d (two rows of 64 bits)."""
    return np.bitwise_count(d[0][i] ^ d[0][j]) + np.bitwise_count(d[1][i] ^ d[1][j])


def _by_blocks(key: np.ndarray, bucket: np.ndarray, d: np.ndarray, rows: np.ndarray) -> Iterator[tuple]:
    """Rows of large buckets in groups that share 16 more bits (rows, start, size), and a test that tells whether two near
    rows of such a group share no earlier 16 bits: they are then met here first.

    Outside its word a descriptor has six times 16 bits, so two that differ in fewer than six bits share one of them.
    """
    parts, word = np.ascontiguousarray(d.T).view(np.uint16), (key >> 32) * 2
    for c in range(parts.shape[1]):
        mine = rows[(word[rows] >> 1) != c >> 1]
        if not len(mine):
            continue
        value = bucket[mine] << 16 | parts[mine, c]
        by = np.argsort(value, kind="stable")
        mine, value = mine[by], value[by]
        start = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))

        def first(i: np.ndarray, j: np.ndarray, c: int = c) -> np.ndarray:
            same = (parts[i, :c] == parts[j, :c]) & ((word[i] >> 1)[:, None] != np.arange(c) >> 1)
            return ~same.any(1)

        yield mine, start, np.diff(np.append(start, len(mine))), first


def _peeled(d: np.ndarray, s: int, n: int, max_bits: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Links of a large bucket's first rows to all near ones, as long as these take away many rows; the rows left."""
    left, out = np.arange(s, s + n), []
    while len(left) > MANY:
        roots = left[:PEELED]
        near = _bits_apart(d, roots[:, None], left[None]) <= max_bits
        gone = np.zeros(len(left), bool)
        for k in range(len(roots)):
            if not gone[k]:
                found = near[k] & ~gone
                found[: k + 1] = False
                gone |= found
                out.append((np.full(int(found.sum()), roots[k]), left[found]))
        gone[: len(roots)] = True
        few = gone.sum() - len(roots) < len(left) // 20
        left = left[~gone]
        if few:
            break
    return out, left


def _stars(key: np.ndarray, bucket: np.ndarray, d: np.ndarray, start: np.ndarray, size: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, second) places: in each bucket the first row with all near ones, then the first of those left, and so on."""
    out, near, rest = [], [], []

    def kept(i: np.ndarray, j: np.ndarray, first=None) -> None:
        ok = _bits_apart(d, i, j) <= max_bits
        i, j = i[ok], j[ok]
        if first is not None:
            ok = first(i, j)
            i, j = i[ok], j[ok]
        near.append((i, j))

    large = size > MANY
    for i, j in _all_pairs(np.arange(len(key)), start[~large], size[~large]):
        kept(i, j)
    for s, n in zip(start[large].tolist(), size[large].tolist(), strict=True):
        links, left = _peeled(d, s, n, max_bits)
        out += links
        rest.append(left)
    if rest:
        rest = np.concatenate(rest)
        if max_bits < 6:
            groups = _by_blocks(key, bucket, d, rest)
        else:
            at = np.flatnonzero(np.concatenate([[True], bucket[rest][1:] != bucket[rest][:-1]])) if len(rest) else np.empty(0, np.int64)
            groups = [(rest, at, np.diff(np.append(at, len(rest))), None)]
        for rows, at, many, first in groups:
            for i, j in _all_pairs(rows, at, many):
                kept(i, j, first)
    if near:
        i, j = (np.concatenate(x) for x in zip(*near, strict=True))
        by = np.lexsort((j, i))
        gone, links = bytearray(len(key)), []
        for k, a, b in zip(by.tolist(), i[by].tolist(), j[by].tolist(), strict=True):
            if not (gone[a] or gone[b]):
                gone[b] = 1
                links.append(k)
        out.append((i[links], j[links]))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*out, strict=True))


def _pairs_of_buckets(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (key, sub): a, b, mask (the linked corners of b, modulo 64) of each bucket's links.

    A bucket in which not all pairs were looked at is named by its key in a and a null b.
    """
    def close(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows)
        key, sub, node, at, d0, d1 = (t.column(c).to_numpy() for c in ("key", "sub", "node", "at", "d0", "d1"))
        d = np.stack([d0, d1]).view(np.uint64)
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (sub[1:] != sub[:-1])])
        start, bucket = np.flatnonzero(fresh), np.cumsum(fresh)
        size = np.diff(np.append(start, len(key)))
        i, j = [], []
        for p, q in _all_pairs(np.arange(len(key)), start[size <= SMALL], size[size <= SMALL]):  # all pairs of small buckets
            ok = _bits_apart(d, p, q) <= max_bits
            i.append(p[ok])
            j.append(q[ok])
        p, q = _stars(key, bucket, d, start[size > SMALL], size[size > SMALL], max_bits)
        i, j = np.concatenate([*i, p]), np.concatenate([*j, q])
        apart = node[i] != node[j]
        i, j = i[apart], j[apart]
        low, high = np.where(node[i] < node[j], i, j), np.where(node[i] < node[j], j, i)
        a, b, mask = node[low], node[high], np.left_shift(np.uint64(1), (at[high] % 64).astype(np.uint64))
        by = np.lexsort((b, a))
        a, b, mask = a[by], b[by], mask[by]
        if len(a):
            new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
            a, b, mask = a[new], b[new], np.bitwise_or.reduceat(mask, new)
        open_keys = np.unique(key[start[(size > SMALL) | (sub[start] > 0)]])
        cols = [np.concatenate([a, open_keys]), pa.concat_arrays([pa.array(b), pa.nulls(len(open_keys), pa.int64())]), np.concatenate([mask.view(np.int64), np.full(len(open_keys), -1)])]
        return pa.RecordBatch.from_arrays([pa.array(cols[0]), cols[1], pa.array(cols[2])], names=["a", "b", "mask"])

    return _by_buckets(batches, lambda rows: [close(rows)])


def one_of_each_class(rows: DataFrame, labels: DataFrame, round_no: int) -> DataFrame:
    """Rows of tables() with one row for each class in a bucket, chosen by the round."""
    of = rows.join(labels, "node", "left").withColumn("of", F.coalesce("component", "node"))
    own = F.min(F.struct(F.xxhash64("node", F.lit(round_no)).alias("o"), "node", "at", "d0", "d1")).alias("m")
    return of.groupBy("key", "of").agg(own).select("key", "m.node", "m.at", "m.d0", "m.d1")


def candidates(rows: DataFrame, round_no: int = 0, link_bits: int = LINK_BITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """a, b (nodes, a < b) with two linked corners from rows of tables(); rows with a null b name a bucket, in column a,
    in which not all pairs were looked at."""
    order = F.xxhash64("node", F.lit(round_no))
    every = SAMPLED if block_rows >= 16 * SAMPLED else 1
    sampled = rows.where(F.pmod(F.xxhash64("node", F.lit(-1)), F.lit(every)) == 0).groupBy("key").agg((F.count("*") * every).alias("n"))
    large = settle(sampled.where(F.col("n") > block_rows).select("key", F.ceil(F.col("n") / block_rows).alias("parts")))
    # sub is 0 where a bucket is whole, else the part, from 1 on
    part = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(order, F.col("parts")) + 1)
    dealt = rows.withColumn("sub", F.lit(0)) if large.isEmpty() else rows.join(large, "key", "left").withColumn("sub", part.cast("int"))
    dealt = dealt.select("key", "sub", "node", "at", "d0", "d1")
    by = ["node", "at"] if not round_no else [order, F.col("at")]
    found = dealt.repartition("key", "sub").sortWithinPartitions("key", "sub", *by).mapInArrow(lambda b: _pairs_of_buckets(b, link_bits), "a long, b long, mask long")
    return found.groupBy("a", "b").agg(F.bit_or("mask").alias("mask")).where(F.bit_count("mask") >= 2).select("a", "b")


def _links_across(t: pa.Table, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all two near descriptors of different classes (of) in each bucket of t, which has whole buckets."""
    key, sub, of, d0, d1 = (t.column(c).to_numpy() for c in ("key", "sub", "of", "d0", "d1"))
    d = np.stack([d0, d1]).view(np.uint64)
    fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (sub[1:] != sub[:-1])])
    start, bucket = np.flatnonzero(fresh), np.cumsum(fresh)
    size = np.diff(np.append(start, len(key)))

    def linked(rows: np.ndarray, start: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        mixed = np.minimum.reduceat(of[rows], start) != np.maximum.reduceat(of[rows], start)
        few = mixed & (size <= MANY)
        for i, j in _all_pairs(rows, start[few], size[few]):
            ok = (of[i] != of[j]) & (_bits_apart(d, i, j) <= max_bits)
            yield i[ok], j[ok]
        for s, n in zip(start[mixed & ~few].tolist(), size[mixed & ~few].tolist(), strict=True):
            # all but the group's largest class, each against the whole group
            own = rows[s : s + n]
            _, which, many = np.unique(of[own], return_inverse=True, return_counts=True)
            rest = own[which != many.argmax()]
            step = max(1, AT_ONCE // n)
            for k in range(0, len(rest), step):
                i = rest[k : k + step]
                p, q = np.nonzero((of[i][:, None] != of[own]) & (_bits_apart(d, i[:, None], own[None]) <= max_bits))
                yield i[p], own[q]

    rows, large = np.arange(len(key)), (size > MANY) & (max_bits < 6)
    if not large.all():
        yield from linked(rows, start[~large], size[~large]) if not large.any() else linked(*_whole(rows, start[~large], size[~large]))
    if large.any():
        mixed = np.minimum.reduceat(of, start) != np.maximum.reduceat(of, start)
        for own, at, many, first in _by_blocks(key, bucket, d, rows[np.repeat(large & mixed, size)]):
            for i, j in linked(own, at, many):
                ok = first(i, j)
                yield i[ok], j[ok]


def _whole(rows: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """These groups alone, one after another."""
    ends = np.cumsum(size)
    return rows[np.repeat(start - (ends - size), size) + np.arange(ends[-1])], ends - size, size


def _linked_rows(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (key, sub): those that have a near descriptor of another class in their bucket."""

    def close(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(rows)
        linked = np.zeros(t.num_rows, bool)
        for i, j in _links_across(t, max_bits):
            linked[i] = linked[j] = True
        yield from t.filter(pa.array(linked)).to_batches()

    return _by_buckets(batches, close)


def _pairs_across(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Rows of _linked_rows() with others, sorted by (key, sub): a, b, mask of the links across classes in each bucket,
    unless no other bucket can link a to another corner of b."""

    def close(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(rows).combine_chunks()
        node, at = t.column("node").to_numpy(), t.column("at").to_numpy()
        others = t.column("others").chunk(0)
        values, ends, listed = others.values.to_numpy(), others.offsets.to_numpy(), others.is_valid().to_numpy(zero_copy_only=False)
        place = dict(zip(*(x.tolist() for x in np.unique(node, return_index=True)), strict=True))

        @lru_cache(1 << 12)
        def corners(n: int) -> dict[int, int] | None:
            """Bits of the corners that the image has in each bucket in which it has links."""
            k = place[n]
            if not listed[k]:
                return None
            out: dict[int, int] = {}
            for x in values[ends[k] : ends[k + 1]].tolist():
                out[x >> 6] = out.get(x >> 6, 0) | 1 << (x & 63)
            return out

        def two(a: int, b: int, mask: int) -> bool:
            of_a, of_b = corners(a), corners(b)
            if of_a is None or of_b is None:
                return True
            for x in of_a.keys() & of_b.keys():
                mask |= of_b[x]
            return mask.bit_count() >= 2

        def settled(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            batch = _once(found)
            a, b, mask = (batch.column(c).to_numpy() for c in ("a", "b", "mask"))
            return batch.filter(pa.array([two(*x) for x in zip(a.tolist(), b.tolist(), mask.view(np.uint64).tolist(), strict=True)], pa.bool_()))

        out, held = [], 0
        for i, j in _links_across(t, max_bits):
            low, high = np.where(node[i] < node[j], i, j), np.where(node[i] < node[j], j, i)
            out.append((node[low], node[high], np.left_shift(np.uint64(1), (at[high] % 64).astype(np.uint64)).view(np.int64)))
            held += len(i)
            if held > 1 << 18:
                yield settled(out)
                out, held = [], 0
        if out:
            yield settled(out)

    return _by_buckets(batches, close, 1)  # rows are long


def _once(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    a, b, mask = (np.concatenate(x) for x in zip(*found, strict=True))
    by = np.lexsort((b, a))
    a, b, mask = a[by], b[by], mask[by]
    if len(a):
        new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        a, b, mask = a[new], b[new], np.bitwise_or.reduceat(mask, new)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(mask)], names=["a", "b", "mask"])


def _by_buckets(batches: Iterator[pa.RecordBatch], close, least: int = HELD_ROWS) -> Iterator[pa.RecordBatch]:
    """close() of runs of whole buckets, of so many rows or more but for the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if sum(b.num_rows for b in held) < least:
            held.append(batch)
            continue
        k, s = (batch.column(c).to_numpy() for c in ("key", "sub"))
        last = held[-1].slice(held[-1].num_rows - 1)
        ends = np.flatnonzero((k[1:] != k[:-1]) | (s[1:] != s[:-1])) + 1
        if last.column("key")[0].as_py() != k[0] or last.column("sub")[0].as_py() != s[0]:
            yield from close(held)
            held = []
        if len(ends):
            yield from close([*held, batch.slice(0, int(ends[-1]))])
            held = [batch.slice(int(ends[-1]))]
        else:
            held.append(batch)
    if held:
        yield from close(held)


def links_across(rows: DataFrame, labels: DataFrame, link_bits: int = LINK_BITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """a, b, mask of links of images of different classes, from rows of tables() and labels (node, component).

    Single links are chance and grow with the square of the images, so they are never made rows: the rows that have any link
    are found first, at most as many as there are. Each then carries the buckets and corners of all linked rows of its
    image, and a link counts only if the two images meet in a bucket by another corner too. This leaves out no two images
    with two links. An image with more than LISTED of them carries none, and all its links are made rows.
    Parts of a bucket of more than block_rows rows meet in pairs.
    """
    of = rows.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("of"), "at", "d0", "d1")
    large = settle(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block_rows).select("key", F.ceil(2 * F.col("n") / block_rows).cast("int").alias("parts")))
    if large.isEmpty():
        dealt = of.withColumn("sub", F.lit(0))
    else:
        mine = F.pmod(F.xxhash64("node", "at"), F.col("parts")).cast("int")
        other = F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1)))
        dealt = of.join(large, "key", "left").select("*", mine.alias("mine"), other.alias("other"))
        pair = F.greatest("mine", "other") * (1 << 15) + F.least("mine", "other") + 1
        dealt = dealt.withColumn("sub", F.when(F.col("parts").isNull(), 0).otherwise(pair).cast("int"))
    columns = "key long, sub int, node long, of long, at int, d0 long, d1 long"
    in_buckets = lambda df: df.repartition("key", "sub").sortWithinPartitions("key", "sub")
    linked = settle(in_buckets(dealt.select("key", "sub", "node", "of", "at", "d0", "d1")).mapInArrow(lambda b: _linked_rows(b, link_bits), columns))
    bucket = F.shiftleft(F.xxhash64("key"), 6).bitwiseOR(F.pmod("at", F.lit(64)).cast("long"))
    own = linked.groupBy("node").agg(F.collect_set(bucket).alias("others")).select("node", F.when(F.size("others") <= LISTED, F.col("others")).alias("others"))
    return in_buckets(linked.join(own, "node")).mapInArrow(lambda b: _pairs_across(b, link_bits), "a long, b long, mask long")


def across(rows: DataFrame, labels: DataFrame, link_bits: int = LINK_BITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """a, b of every two images of different classes with two linked corners."""
    found = links_across(rows, labels, link_bits, block_rows)
    return found.groupBy("a", "b").agg(F.bit_or("mask").alias("mask")).where(F.bit_count("mask") >= 2).select("a", "b")


def confirmed(pairs: DataFrame, images: DataFrame, min_votes: int = MIN_VOTES) -> DataFrame:
    """The pairs (a, b) with a geometric consensus; images: node, corners."""
    of = lambda p: images.select(F.col("node").alias(p), F.col("corners").alias(f"{p}_corners"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sides = ([np.frombuffer(x.as_buffer(), CORNER) for x in b.column(c)] for c in ("a_corners", "b_corners"))
            keep = pa.array([votes(x, y) >= min_votes for x, y in zip(*sides, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], names=["a", "b"])

    return pairs.join(of("a"), "a").join(of("b"), "b").mapInArrow(run, "a long, b long")


def classes(images: DataFrame, rounds: int = ROUNDS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """node, component of the nodes that have links; images: node, corners."""
    now = rows = tables(images)
    edges = tested = labels = None
    for k in range(rounds):
        found = settle(candidates(now, k, block_rows=block_rows))
        pairs = found.where("b is not null")
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        # written, so that both sides of the next join are plain shuffles and Spark splits the rows of a hot image
        pairs = settle(pairs)
        new = settle(confirmed(pairs, images))
        if new.isEmpty():
            break
        tested = pairs if tested is None else tested.unionByName(pairs)
        edges = new if edges is None else edges.unionByName(new)
        labels = settle(connected_components(edges))
        if k == 0:  # buckets of few rows are done
            rows = rows.join(found.where("b is null").select(F.col("a").alias("key")).distinct(), "key", "left_semi")
        now = one_of_each_class(rows, labels, k + 1)
    labels = labels if labels is not None else connected_components(new)
    rest = across(tables(images), labels, block_rows=block_rows)
    rest = settle(rest.join(tested, ["a", "b"], "left_anti") if tested is not None else rest)
    new = settle(confirmed(rest, images))
    if new.isEmpty():
        return labels
    return connected_components(new if edges is None else edges.unionByName(new))


def copies(df: DataFrame, id_col: str = "image_id", width: str = "width", height: str = "height", pixels: str = "pixels", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """id_col, class_id, n_links of each row."""
    rows = settle(features(df, id_col, width, height, pixels))
    images = settle(rows.where("_node is not null").groupBy(F.col("_node").alias("node")).agg(F.min("_id").alias("first_id"), F.count("*").alias("n"), F.first("_corners").alias("corners")))
    labels = classes(images.where(F.length("corners") > 0).select("node", "corners"), block_rows=block_rows)
    joined = images.select("node", "first_id", "n").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    whole = joined.groupBy("component").agg(F.min("first_id").alias("class_id"), (F.sum("n") - 1).alias("n_links"))
    of_node = settle(joined.join(whole, "component").select(F.col("node").alias("_node"), "class_id", "n_links"))
    out = rows.select("_id", "_node").join(of_node, "_node", "left")
    own = F.when(F.col("_node").isNull(), F.col("_id")).otherwise(F.col("class_id"))
    return out.select(F.col("_id").alias(id_col), own.alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


#: Edits that drawn() plants in turn.
EDITS = ("odd_crop", "turned", "half_size", "double_size", "noise")


def edit(grey: np.ndarray, how: str, k: int) -> np.ndarray:
    """The picture cropped by odd steps and darkened, turned by a quarter, at half or double size, or with noise."""
    if how == "odd_crop":
        y, x = 1 + 2 * (k % 5), 1 + 2 * (k // 5 % 5)
        return (grey[y : y + SIDE - 13, x : x + SIDE - 17] * 0.85 + 9).astype(np.uint8)
    if how == "turned":
        return np.rot90(grey, 1 + k % 3)
    if how == "half_size":
        return grey.reshape(SIDE // 2, 2, SIDE // 2, 2).mean((1, 3)).round().astype(np.uint8)
    if how == "double_size":
        return grey.repeat(2, 0).repeat(2, 1)
    return (grey.astype(int) + np.random.default_rng(k).integers(-3, 4, grey.shape)).clip(0, 255).astype(np.uint8)


@lru_cache(1)
def _blobs() -> np.ndarray:
    """A field of soft blobs for each of 64 values: 64 x SIDE x SIDE."""
    rnd = np.random.default_rng(11)
    y, x = np.mgrid[:SIDE, :SIDE]
    out = np.zeros((64, SIDE, SIDE), np.float32)
    for k in range(64):
        for _ in range(24):
            cy, cx, r = rnd.uniform(0, SIDE), rnd.uniform(0, SIDE), rnd.uniform(1.5, 4)
            out[k] += rnd.choice([-1, 1]) * np.exp(-((y - cy) ** 2 + (x - cx) ** 2) / (2 * r * r))
    return out.reshape(64, -1)


def drawn(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """An image for each vector: fields of blobs, as strong as its values say. Every tenth id takes the picture of the id
    before it, changed by one of EDITS in turn.

    image_id, width, height, pixels. A null or empty vector gives null pixels.
    """
    earlier = vectors.select((F.col(id_col) + 1).alias("_next"), F.col(vector_col).alias("_before")).where(F.col("_next") % 10 == 9)
    rows = vectors.join(earlier, F.col(id_col) == F.col("_next"), "left").select(F.col(id_col).alias("image_id"), F.coalesce("_before", vector_col).alias("v"), F.col("_before").isNotNull().alias("edited"))

    def picture(v: list[float]) -> np.ndarray:
        field = np.resize(np.nan_to_num(np.asarray(v, np.float32)), 64) @ _blobs()
        return (128 + 50 * field / max(float(field.std()), 1e-6)).clip(0, 255).astype(np.uint8).reshape(SIDE, SIDE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for k, v, edited in zip(*(b.column(c).to_pylist() for c in ("image_id", "v", "edited")), strict=True):
                if not v:
                    out.append((k, None, None, None))
                    continue
                grey = edit(picture(v), EDITS[k // 10 % len(EDITS)], k // 10) if edited else picture(v)
                out.append((k, grey.shape[1], grey.shape[0], grey.tobytes()))
            cols = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["image_id", "width", "height", "pixels"])

    return rows.mapInArrow(run, "image_id long, width int, height int, pixels binary")
