"""Image copies: recall of the Hamming tables and of the consensus under edits, false merges, ids."""

from __future__ import annotations

import numpy as np
import pytest

from voxlake.llm import image_copies as ic


def pictures(n, side, seed=5):
    rng, draw = np.random.default_rng(seed), np.random.default_rng(64)
    textures = np.stack([ic._box(draw.normal(0, 1, (side, side)), 2).ravel() for _ in range(64)])
    fields = rng.normal(0, 1, (n, 64)).astype(np.float32) @ textures
    return np.rint(np.clip(128 + 48 * fields / fields.std(1, keepdims=True), 0, 255)).reshape(n, side, side).astype(np.float32)


def warped(p, h, w, inverse):
    """A picture of h x w whose pixels are read at inverse(y, x), grey outside."""
    y, x = inverse(*np.mgrid[0:h, 0:w].astype(float))
    inside = (y >= 0) & (y <= p.shape[0] - 1) & (x >= 0) & (x <= p.shape[1] - 1)
    top, left = np.clip(y.astype(int), 0, p.shape[0] - 2), np.clip(x.astype(int), 0, p.shape[1] - 2)
    fy, fx = np.clip(y - top, 0, 1), np.clip(x - left, 0, 1)
    value = (p[top, left] * (1 - fx) + p[top, left + 1] * fx) * (1 - fy) + (p[top + 1, left] * (1 - fx) + p[top + 1, left + 1] * fx) * fy
    return np.where(inside, value, 128)


def turned(p, degrees):
    m, a = (p.shape[0] - 1) / 2, np.deg2rad(degrees)
    return warped(p, *p.shape, lambda y, x: (np.cos(a) * (y - m) - np.sin(a) * (x - m) + m, np.sin(a) * (y - m) + np.cos(a) * (x - m) + m))


def scaled(p, factor):
    h, w = (round(n * factor) for n in p.shape)
    return warped(p, h, w, lambda y, x: ((y + 0.5) / factor - 0.5, (x + 0.5) / factor - 0.5))


def cropped(p, share):
    """The middle part, off the pixel grid."""
    n = round(p.shape[0] * share**0.5)
    at = (p.shape[0] - n) / 2
    return warped(p, n, n, lambda y, x: (y + 0.8 * at + 0.37, x + 0.9 * at + 0.29))


noise = np.random.default_rng(2)
EDITS = {
    "crop": lambda p: cropped(p, 0.7), "crop and noise": lambda p: cropped(p, 0.7) + noise.normal(0, 5, cropped(p, 0.7).shape), "blur": lambda p: ic._box(p, 1), "noise": lambda p: p + noise.normal(0, 5, p.shape), "darker": lambda p: p * 0.6 + 10,
    **{f"turn {d}": lambda p, d=d: turned(p, d) for d in (10, 20, 30, 45)}, **{f"scale {f}": lambda p, f=f: scaled(p, f) for f in (0.7, 0.75, 0.8, 0.85, 0.9, 1.15, 1.25, 1.4)},
}


def recall(side, n, edit):
    """Shares of edited pictures that the consensus links, and that share enough keys as well."""
    linked = found = 0
    for p in pictures(n, side):
        a, b = ic.corners(p), ic.corners(np.rint(np.clip(EDITS[edit](p), 0, 255)).astype(np.float32))
        agreed = ic.consensus(a, b) >= 5
        linked += agreed
        found += agreed and int(np.isin(ic.table_keys(a), ic.table_keys(b)).sum()) >= ic.VOTES
    return linked / n, found / n


@pytest.mark.parametrize("edit", sorted(EDITS))
def test_edited_copies_share_a_key_and_agree(edit):
    # the hardest: a picture of 64 pixels made smaller, to a scale between two steps
    small = 0.8 if edit in ("scale 0.75", "scale 0.8") else 0.9
    assert min(recall(64, 30, edit)) >= small and min(recall(128, 20, edit)) >= 0.95


def test_thousand_pictures_are_not_merged(spark):
    rows = [(i, ic.encode_pgm(p)) for i, p in enumerate(pictures(1000, 64, 9))]
    copies = [(2000 + i, ic.encode_pgm(EDITS[e](p))) for i, (e, p) in enumerate(zip(sorted(EDITS), pictures(len(EDITS), 64, 9), strict=True))]
    got = {r.image_id: r.component_id for r in ic.image_copies(spark.createDataFrame(rows + copies, "image_id long, image binary").repartition(8)).collect()}
    assert len({got[i] for i in range(1000)}) == 1000
    assert sum(got[2000 + i] == got[i] for i in range(len(EDITS))) >= 0.9 * len(EDITS)


def test_repeated_ids_link_their_images(spark):
    a, b, c = pictures(3, 64, 3)
    rows = [(1, a), (1, b), (2, turned(a, 20)), (3, turned(b, 20)), (4, c)]
    df = spark.createDataFrame([(i, ic.encode_pgm(p), "x") for i, p in rows], "image_id long, image binary, class string")
    assert {(r.image_id, r.component_id) for r in ic.image_copies(df).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_stacked_pictures_have_the_corners_of_single_ones(monkeypatch):
    p = pictures(5, 70)
    assert all((x == ic.corners(y)).all() for x, y in zip(ic.stack_corners(p), p, strict=True))
    monkeypatch.setattr(ic, "MOST_PIXELS", 3000)
    halved = np.ascontiguousarray(ic.corners(p[0])[:, 32:]).view("<f4")
    assert len(halved) and halved[:, 2].min() == 2 and not len(ic.corners(np.full((50, 50), 7.0)))
