"""Buckets of near-duplicate candidates are parted by signatures before sets are compared; no similar pair is lost."""

import numpy as np
import pytest

from loomline.operators import dedup


def _texts(n, seed):
    """size, slots of copies with changes of n texts."""
    r = np.random.default_rng(seed)
    base = r.integers(0, 256, (n, 128), dtype=np.uint8)
    slots = base[r.integers(0, n, 4 * n)]
    change = r.random(slots.shape) < r.uniform(0, 0.5, (len(slots), 1))
    return r.integers(50, 130, len(slots)), np.where(change, r.integers(0, 256, slots.shape, dtype=np.uint8), slots)


@pytest.mark.parametrize("sides", [False, True])
def test_groups_hold_every_pair(sides):
    size, slots = _texts(12, 3)
    side = np.arange(len(size)) % 2 if sides else np.full(len(size), -1)
    group = dedup.linked(size, slots, side, 0.8, 73)
    up = np.arange(len(size))
    for i in range(len(size)):
        for j in range(i):
            meet = not sides or side[i] != side[j]
            if meet and min(size[i], size[j]) >= 0.8 * max(size[i], size[j]) and (slots[i] == slots[j]).sum() >= 73:
                up[up == up[i]] = up[j]
    assert len(set(group)) == len(set(up)) == len(set(zip(group, up, strict=True))) > 12


@pytest.mark.parametrize("block", [2000, 8])
def test_unlike_texts_of_a_bucket_are_parted(spark, monkeypatch, block):
    monkeypatch.setattr(dedup, "BLOCK", block)
    slots = np.random.default_rng(1).integers(0, 256, (40, 128), dtype=np.uint8)
    slots[7] = slots[31]
    nodes = spark.createDataFrame([(k, 100, bytearray(s.tobytes()), [5, 6 + k % 2]) for k, s in enumerate(slots)], "node long, size long, slots binary, keys array<long>")
    assert {r["node"] for r in dedup.linked_groups(nodes, 0.8, 128).collect()} == {7, 31}


def test_a_pair_at_the_threshold_has_the_least_slots():
    least = dedup.least_slots(0.8, 128)
    equal = np.random.default_rng(2).binomial(128, 0.8, 1_000_000)
    assert 64 < least <= equal.min()
