"""Cropped and edited copies of images by local descriptors.

1. Images (PGM or 8-bit PNG bytes) are decoded; images with equal pixels are one class from here on.
2. On a pyramid of scales, eight to an octave, corners are taken (local maxima of the Harris response, refined to parts of
   a pixel; their number follows from the area of each scale). Around each, the direction of the intensity centroid turns
   a fixed pattern of 256 point pairs, read between pixels; the slope in that direction is taken out, and which point of
   a pair is darker gives one bit.
3. Hamming tables: TABLES keys of KEY_BITS drawn bits each. Descriptors that differ in a tenth of their bits share a key
   of 64 bits with a chance of 1 in 850 in each table, and the dozens of corners of a copy, most of which differ less,
   share some (the README has the measured recall). Images are posted under their keys, and every list joins its members
   to one hub. Keys shared by two images are votes; they are counted before any corners move, and VOTES are asked for.
4. Geometric consensus: of the mutual best matches between two images, those that agree on one turn, scale and shift are
   counted; `least` of them make a link. Linked classes form components: an image and its crops and edits. Lists whose
   members are in several components go on with other hubs; in the end the members outside a list's largest component
   are compared with all others of the list.

Defined results: null, empty and undecodable images have no corners and are linked with nothing (null and undecodable
ones are each a class of their own bytes); plain images have no corners; corners of equal strength go by place; rows of a
repeated id link their images; an empty table gives an empty result; pictures of more than MOST_PIXELS are halved until they have
fewer, so a picture's memory is bounded by that of its decoding; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import bounded_batches, materialise, scratch_mark, settled, small_side
from voxlake.llm.graph import by_hub, contracted, in_blocks, within_lists
from voxlake.llm.shingles import mix

LOWEST = -(2**63)
RADIUS, PAIRS = 8, 256
#: Scales of an octave, and how many scales there are at most.
STEPS, SCALES = 8, 33
#: Pixels of a scale for each corner that is taken, at most.
CORNER_AREA = 200
#: Pixels of a picture that are worked on, and of pictures of one size that are worked on together.
MOST_PIXELS, TOGETHER = 1 << 22, 1 << 18
#: Bytes of one corner in a payload: 32 of bits, then x, y, scale and turn as float32.
CORNER = 48


def decode(raw: bytes | None) -> np.ndarray | None:
    """Grey pixels (float32) of a binary PGM or an 8-bit, not interlaced PNG; None if it is neither."""
    try:
        if not raw:
            return None
        if raw[:2] == b"P5":
            head, at = [], 2
            while len(head) < 3:
                while raw[at : at + 1].isspace():
                    at += 1
                if raw[at : at + 1] == b"#":
                    at = raw.index(b"\n", at)
                    continue
                end = at
                while not raw[end : end + 1].isspace():
                    end += 1
                head.append(int(raw[at:end]))
                at = end
            w, h, most = head
            if most > 255 or w < 1 or h < 1:
                return None
            return np.frombuffer(raw, np.uint8, w * h, at + 1).reshape(h, w).astype(np.float32)
        if raw[:8] == b"\x89PNG\r\n\x1a\n":
            return _png(raw)
    except (ValueError, IndexError, struct.error, zlib.error):
        pass
    return None


def _png(raw: bytes) -> np.ndarray | None:
    at, body, head = 8, [], None
    while at + 8 <= len(raw):
        n, kind = struct.unpack(">I4s", raw[at : at + 8])
        part = raw[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"IDAT":
            body.append(part)
        at += 12 + n
    if head is None or head[2] != 8 or head[3] not in (0, 2, 4, 6) or head[6]:
        return None
    w, h, channels = head[0], head[1], {0: 1, 2: 3, 4: 2, 6: 4}[head[3]]
    lines = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(h, 1 + w * channels)
    out = np.zeros((h + 1, w, channels), np.int64)
    for y in range(h):
        kind, line, above = int(lines[y, 0]), lines[y, 1:].reshape(w, channels).astype(np.int64), out[y]
        if kind == 0:
            out[y + 1] = line
        elif kind == 1:
            out[y + 1] = np.cumsum(line, axis=0) & 255
        elif kind == 2:
            out[y + 1] = (line + above) & 255
        else:
            left, corner = np.zeros(channels, np.int64), np.zeros(channels, np.int64)
            for x in range(w):
                up = above[x]
                if kind == 3:
                    guess = (left + up) >> 1
                else:
                    p = left + up - corner
                    pa_, pb, pc = abs(p - left), abs(p - up), abs(p - corner)
                    guess = np.where((pa_ <= pb) & (pa_ <= pc), left, np.where(pb <= pc, up, corner))
                left, corner = (line[x] + guess) & 255, up
                out[y + 1, x] = left
    grey = out[1:, :, : 3 if channels > 2 else 1]
    return grey.mean(axis=2).astype(np.float32)


def encode_pgm(pixels: np.ndarray) -> bytes:
    return b"P5\n%d %d\n255\n" % (pixels.shape[1], pixels.shape[0]) + np.clip(np.rint(pixels), 0, 255).astype(np.uint8).tobytes()


_draw = np.random.default_rng(17)
#: Both points (y, x) of all pairs, x along the direction of the centroid.
PATTERN = np.clip(_draw.normal(0, RADIUS / 2, (2, PAIRS, 2)), -RADIUS * 0.72, RADIUS * 0.72).astype(np.float32)
_GRID = np.mgrid[-RADIUS : RADIUS + 1, -RADIUS : RADIUS + 1].astype(np.float32)
#: Weights of a patch around a corner, for its direction.
_WEIGHT = np.where((_GRID**2).sum(0) <= RADIUS**2, np.exp(-(_GRID**2).sum(0) / (RADIUS**2 / 2)), 0).astype(np.float32)
#: Bits of each table's keys.
TABLES, KEY_BITS = 7, 64
KEYS = np.stack([_draw.permutation(PAIRS)[:KEY_BITS] for _ in range(TABLES)])


def _box(x: np.ndarray, r: int) -> np.ndarray:
    """Mean over a square of side 2r+1 of the last two axes, edges repeated."""
    p = np.pad(x, [(0, 0)] * (x.ndim - 2) + [(r, r), (r, r)], mode="edge").astype(np.float64)
    s = np.pad(p.cumsum(-2).cumsum(-1), [(0, 0)] * (x.ndim - 2) + [(1, 0), (1, 0)])
    n = 2 * r + 1
    return ((s[..., n:, n:] - s[..., :-n, n:] - s[..., n:, :-n] + s[..., :-n, :-n]) / n**2).astype(np.float32)


def _between(images: np.ndarray, which: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Values of images[which] at places between pixels."""
    h, w = images.shape[1:]
    y, x = np.clip(y, 0, h - 1.001), np.clip(x, 0, w - 1.001)
    top, left = y.astype(np.int64), x.astype(np.int64)
    fy, fx = (y - top).astype(np.float32), (x - left).astype(np.float32)
    flat, at = images.ravel(), (which * h + top) * w + left
    return (flat[at] * (1 - fx) + flat[at + 1] * fx) * (1 - fy) + (flat[at + w] * (1 - fx) + flat[at + w + 1] * fx) * fy


def _scale(images: np.ndarray, factor: float) -> np.ndarray:
    n, h, w = images.shape
    out_h, out_w = round(h / factor), round(w / factor)
    for _ in range(0 if factor < 1.5 else 1 if factor < 2.5 else 2):
        images = _box(images, 1)
    y, x = (np.arange(out_h) + 0.5) * h / out_h - 0.5, (np.arange(out_w) + 0.5) * w / out_w - 0.5
    return _between(images, np.arange(n)[:, None, None], y[None, :, None], x[None, None, :])


def _places(strength: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(image, y, x) of the local maxima of a scale, the strongest ones of each image in order of strength."""
    edge = RADIUS + 1
    h, w = strength.shape[1:]
    inner = strength[:, edge:-edge, edge:-edge]
    rows = np.max([strength[:, edge + d : h - edge + d] for d in range(-2, 3)], axis=0)
    around = np.max([rows[:, :, edge + d : w - edge + d] for d in range(-2, 3)], axis=0)
    k, y, x = np.nonzero((inner == around) & (inner > 1.0))
    order = np.lexsort((x, y, -inner[k, y, x], k))
    k, y, x = k[order], y[order], x[order]
    rank = np.arange(len(k)) - np.searchsorted(k, k)
    first = rank < max(4, inner[0].size // CORNER_AREA)
    return k[first], y[first] + edge, x[first] + edge


def _described_corners(level: np.ndarray, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """(image, corner of CORNER bytes) of one scale of images of one size."""
    smooth = _box(level, 1)
    gy, gx = np.gradient(smooth, axis=(1, 2))
    xx, yy, xy = _box(gx * gx, 2), _box(gy * gy, 2), _box(gx * gy, 2)
    strength = xx * yy - xy * xy - 0.05 * (xx + yy) ** 2
    which, row, column = _places(strength)
    if not len(which):
        return which, np.zeros((0, CORNER), np.uint8)

    def refined(dy: int, dx: int) -> np.ndarray:
        before, here, after = (strength[which, row + d * dy, column + d * dx] for d in (-1, 0, 1))
        return np.clip((before - after) / 2 / np.minimum(after - 2 * here + before, -1e-9), -0.5, 0.5)

    y, x = row + refined(1, 0), column + refined(0, 1)
    out = []
    for a in range(0, len(which), 1024):
        k, cy, cx = (v[a : a + 1024, None, None] for v in (which, y, x))
        patch = _between(smooth, k, cy + _GRID[0], cx + _GRID[1]) * _WEIGHT
        my, mx = (patch * _GRID[0]).sum((1, 2)), (patch * _GRID[1]).sum((1, 2))
        angle = np.arctan2(my, mx)
        s, c = np.sin(angle)[:, None, None], np.cos(angle)[:, None, None]
        value = _between(smooth, k, cy + PATTERN[..., 1] * s + PATTERN[..., 0] * c, cx + PATTERN[..., 1] * c - PATTERN[..., 0] * s)
        slope = np.hypot(my, mx) / (_WEIGHT * _GRID[0] ** 2).sum()
        bits = np.packbits(value[:, 0] - value[:, 1] < slope[:, None] * (PATTERN[0, :, 1] - PATTERN[1, :, 1]), axis=1)
        place = np.stack([cx[:, 0, 0] * factor, cy[:, 0, 0] * factor, np.full(len(k), factor), angle], axis=1).astype("<f4")
        out.append(np.concatenate([bits, place.view(np.uint8).reshape(len(k), 16)], axis=1))
    return which, np.concatenate(out)


def stack_corners(images: np.ndarray) -> list[np.ndarray]:
    """The corners of pictures of one size, each as rows of CORNER bytes."""
    halved = 1
    while images.shape[1] * images.shape[2] > MOST_PIXELS:
        h, w = (n // 2 * 2 for n in images.shape[1:])
        images, halved = images[:, :h, :w].reshape(len(images), h // 2, 2, w // 2, 2).mean((2, 4)), halved * 2
    owner, rows = [], []
    for step in range(SCALES):
        factor = 2 ** (step / STEPS)
        if min(images.shape[1:]) / factor < 2 * RADIUS + 6:
            break
        which, found = _described_corners(_scale(images, factor) if step else images, factor * halved)
        owner.append(which)
        rows.append(found)
    if not rows:
        return [np.zeros((0, CORNER), np.uint8)] * len(images)
    owner, rows = np.concatenate(owner), np.concatenate(rows)
    order = np.argsort(owner, kind="stable")
    return np.split(rows[order], np.searchsorted(owner[order], np.arange(1, len(images))))


def corners(pixels: np.ndarray) -> np.ndarray:
    return stack_corners(pixels[None].astype(np.float32))[0]


def consensus(a: np.ndarray, b: np.ndarray, bits: int = 40) -> int:
    """Mutual best matches between two images' corners that agree on one turn, scale and shift."""
    if not len(a) or not len(b):
        return 0
    x, y = (np.ascontiguousarray(c[:, :32]).view(np.uint64) for c in (a, b))
    far = np.bitwise_count(x[:, None] ^ y[None]).sum(2)
    one, two = far.argmin(1), far.argmin(0)
    i = np.flatnonzero((two[one] == np.arange(len(a))) & (far.min(1) <= bits))
    if not len(i):
        return 0
    p, q = (np.ascontiguousarray(c[:, 32:]).view("<f4") for c in (a[i], b[one[i]]))
    turn, scale = q[:, 3] - p[:, 3], q[:, 2] / p[:, 2]
    # each match proposes the transform that takes p's place, turn and scale to q's; the others vote
    s, c = np.sin(turn), np.cos(turn)
    shift_x = q[:, 0] - scale * (c * p[:, 0] - s * p[:, 1])
    shift_y = q[:, 1] - scale * (s * p[:, 0] + c * p[:, 1])
    at_x = scale[:, None] * (c[:, None] * p[:, 0] - s[:, None] * p[:, 1]) + shift_x[:, None]
    at_y = scale[:, None] * (s[:, None] * p[:, 0] + c[:, None] * p[:, 1]) + shift_y[:, None]
    off = np.hypot(at_x - q[:, 0], at_y - q[:, 1])
    spin = np.abs((turn[:, None] - turn[None] + np.pi) % (2 * np.pi) - np.pi)
    fits = (off <= 3 + 0.05 * np.hypot(p[:, 0, None] - p[None, :, 0], p[:, 1, None] - p[None, :, 1])) & (spin < 0.4) & (np.abs(np.log2(scale[:, None] / scale[None])) < 0.51)
    best = fits[fits.sum(1).argmax()]
    # matches at one place of several scales count once
    return len(np.unique(np.rint(p[best][:, :2] / 2), axis=0))


def described(images: DataFrame, *, id_col: str, image_col: str) -> DataFrame:
    """(id, content, corners): a hash of the pixels and the corners of each image."""
    bounded_batches(images.sparkSession, 256)

    def work(batches):
        for batch in batches:
            names, rows, held, sizes = [], [b""] * batch.num_rows, 0, {}

            def flush(rows=rows, sizes=sizes):
                for group in sizes.values():
                    at, stack = zip(*group, strict=True)
                    for i, found in zip(at, stack_corners(np.stack(stack)), strict=True):
                        rows[i] = found.tobytes()
                sizes.clear()

            for i, raw in enumerate(batch.column(1)):
                raw = raw.as_py()
                pixels = decode(raw)
                if pixels is None:
                    names.append(hashlib.sha256(b"?" + (raw or b"")).hexdigest())
                    continue
                names.append(hashlib.sha256(repr(pixels.shape).encode() + pixels.tobytes()).hexdigest())
                sizes.setdefault(pixels.shape, []).append((i, pixels))
                held += pixels.size
                if held > TOGETHER:
                    flush()
                    held = 0
            flush()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(rows, pa.binary())], names=["id", "content", "corners"])

    return images.select(F.col(id_col).cast("long").alias("id"), image_col).mapInArrow(work, "id long, content string, corners binary")


def table_keys(rows: np.ndarray) -> np.ndarray:
    """Distinct keys of all corners in all tables, hashed to 64 bits together with the table's number."""
    bits = np.unpackbits(rows[:, :32], axis=1)
    out = []
    for t, chosen in enumerate(KEYS):
        words = np.ascontiguousarray(np.packbits(np.pad(bits[:, chosen], ((0, 0), (0, -len(chosen) % 64))), axis=1)).view(np.uint64)
        h = np.full(len(rows), t + 1, np.uint64)
        for k in range(words.shape[1]):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[:, k])
        out.append(h)
    return np.unique(np.concatenate(out))


def _tokens(batches):
    for batch in batches:
        token = [table_keys(np.frombuffer(raw, np.uint8).reshape(-1, CORNER)) for raw in batch.column(1).to_pylist()]
        node = np.repeat(batch.column(0).to_numpy(), [len(t) for t in token])
        yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(np.concatenate(token).view(np.int64) if token else [], pa.int64())], names=["node", "token"])


def _consenting(batches, least: int):
    key = hub = None
    for batch in batches:
        a, blocks, own, b, raw = (batch.column(k).to_pylist() for k in range(5))
        u, v = [], []
        for i in range(batch.num_rows):
            rows = np.frombuffer(raw[i], np.uint8).reshape(-1, CORNER)
            if own[i] == 0:
                key, hub = (a[i], blocks[i]), rows
            elif key == (a[i], blocks[i]) and consensus(hub, rows) >= least:
                u.append(a[i])
                v.append(b[i])
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


#: Keys that two images must share before their corners are compared.
VOTES = 2
#: Keys (8 bytes each) that are sent to all executors at most.
MET_KEYS = 1_000_000
#: Rounds with one hub for each list before the pairs left are joined.
HUB_ROUNDS = 2


def linked(posts: DataFrame, reps: DataFrame, least: int) -> DataFrame:
    """(node, component) of the images posted (node, token), by consensus of those that share a key; reps: (node, payload)."""
    comp = materialise(posts.select("node", F.col("node").alias("component")).distinct(), "components")
    for turn in range(HUB_ROUNDS + 1):
        members = posts.join(comp, "node")
        if turn < HUB_ROUNDS:
            # one order for all lists, so that two images that share many have the same hub in most of them
            order = F.xxhash64("node", F.lit(turn))
            hubs = members.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min_by(F.struct(F.col("node").alias("hub"), F.col("component").alias("hub_component")), order).alias("h")).filter("lo <> hi").select("token", "h.*")
            pairs = members.join(small_side(materialise(hubs, "hubs")), "token").filter("component <> hub_component").select(F.least("hub", "node").alias("hub"), F.greatest("hub", "node").alias("node"))
        else:
            pairs = within_lists(members, ["token"])
        fresh = materialise(pairs.groupBy("hub", "node").agg(F.count("*").alias("votes")).filter(F.col("votes") >= VOTES).select("hub", "node"), "pairs")
        if fresh.isEmpty():
            continue
        found = materialise(by_hub(in_blocks(fresh), reps).mapInArrow(lambda it: _consenting(it, least), "u long, v long"), "links")
        comp = contracted(comp, found)
    return comp


def image_copies(images: DataFrame, *, id_col: str = "image_id", image_col: str = "image", least: int = 5) -> DataFrame:
    """(image_id, class_id, component_id, n_corners): images with equal pixels share class_id, copies share component_id."""
    mark = scratch_mark()
    found = described(images, id_col=id_col, image_col=image_col)
    rows = materialise(found.select("id", F.coalesce("id", F.lit(LOWEST)).alias("own"), F.xxhash64("content").alias("node"), "corners"), "described")
    classes = rows.groupBy("node").agg(F.min("own").alias("class"), F.any_value("corners").alias("payload"), F.count("*").alias("rows"))
    classes = materialise(classes, "classes")
    reps = classes.filter(F.length("payload") > 0).select("node", "payload")
    # nearly all keys stand alone: they are made twice and never stored, and only counts are shuffled while those met are few
    posts = reps.mapInArrow(_tokens, "node long, token long")
    met = materialise(posts.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1").select("token"), "met")
    posts = materialise(posts.join(small_side(met, limit=MET_KEYS), "token"), "postings")
    comp = classes.select("node", "class", "rows").join(linked(posts, reps, least), "node", "left").select("node", "class", "rows", F.coalesce("component", "node").alias("component"))
    # rows of a repeated id link their classes
    ids = materialise(rows.groupBy("own").agg(F.min("node").alias("u"), F.max("node").alias("hi")).filter("u <> hi").select("own", "u"), "ids")
    if not ids.isEmpty():
        several = rows.select("own", "node").distinct().join(small_side(ids), "own").select("u", F.col("node").alias("v")).filter("u <> v")
        comp = contracted(materialise(comp, "components"), materialise(several, "several"))
    comp = materialise(comp, "components")
    # an image that is alone in its class and component is its own first
    lowest = comp.groupBy("component").agg(F.min("class").alias("found"), F.sum("rows").alias("of")).filter("of > 1").select("component", "found")
    named = materialise(comp.join(small_side(materialise(lowest, "lowest")), "component").select("node", "class", "found"), "named")
    blank = lambda c: F.when(F.coalesce(c, F.col("own")) != LOWEST, F.coalesce(c, F.col("own")))
    out = rows.join(small_side(named), "node", "left").select(F.col("id").alias("image_id"), blank(F.col("class")).alias("class_id"), blank(F.col("found")).alias("component_id"), (F.length("corners") / CORNER).cast("long").alias("n_corners"))
    return settled(out, "image_copies", mark)


def rendered(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", side: int = 64, copy_every: int = 20) -> DataFrame:
    """A media column for tables without one: each vector as a 64 x 64 picture (a weighted sum of fixed textures), image_id
    its id; every id divisible by `copy_every` also as a cropped, turned, darkened and noisy copy with image_id -1 - id.
    Null vectors give null images."""
    bounded_batches(vectors.sparkSession, 256)

    def work(batches):
        textures: dict[int, np.ndarray] = {}
        for batch in batches:
            ids, images = [], []
            for name, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if vector is None:
                    ids.append(name)
                    images.append(None)
                    continue
                n = len(vector)
                if n not in textures:
                    draw = np.random.default_rng(n)
                    textures[n] = np.stack([_box(draw.normal(0, 1, (side, side)), 2).ravel() for _ in range(n)]) if n else np.zeros((0, side * side), np.float32)
                field = np.nan_to_num(np.array([0.0 if x is None else x for x in vector], np.float32)) @ textures[n]
                pixels = np.rint(np.clip(128 + 48 * field / max(float(field.std()), 1e-9), 0, 255)).reshape(side, side)
                ids.append(name)
                images.append(encode_pgm(pixels))
                if name is not None and name % copy_every == 0:
                    noise = np.random.default_rng(name % 2**32).normal(0, 1.0, (52, 52))
                    ids.append(-1 - name)
                    images.append(encode_pgm(np.rot90(pixels[4:56, 6:58]) * 0.8 + 15 + noise))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(images, pa.binary())], names=["image_id", "image"])

    return vectors.select(F.col(id_col).cast("long"), vector_col).mapInArrow(work, "image_id long, image binary")
