import numpy as np
import pytest

from boxloom.llm.count_tree import GROUPS, CountTree, small_groups


@pytest.mark.parametrize("parts", [False, True])
def test_pairs_against_all(parts):
    chance = np.random.default_rng(2)
    centres = chance.integers(0, 12, (6, GROUPS))
    counts = np.maximum(centres[chance.integers(0, 6, 700)] + chance.integers(-1, 2, (700, GROUPS)), 0).astype(np.uint8)
    counts[5] = 255
    sizes = counts.astype(np.int64).sum(axis=1)
    own = chance.integers(0, 3, 700) if parts else None
    tree = CountTree(sizes, counts, 80, own)
    got = {tuple(sorted(p)) for one, two in tree.pairs() for p in zip(one.tolist(), two.tolist(), strict=True)}
    i, j = np.triu_indices(700, 1)
    bound = np.minimum(counts[i], counts[j]).astype(np.int64).sum(axis=1)
    want = (180 * bound >= 80 * (sizes[i] + sizes[j])) & (100 * np.minimum(sizes[i], sizes[j]) >= 80 * np.maximum(sizes[i], sizes[j]))
    if parts:
        want &= own[i] != own[j]
    assert got == set(zip(i[want].tolist(), j[want].tolist(), strict=True))
    stars = [p for one, two in tree.stars(4) for p in zip(one.tolist(), two.tolist(), strict=True)]
    assert stars and {tuple(sorted(p)) for p in stars} <= got


def test_small_groups():
    counts = np.ones((7, GROUPS), dtype=np.uint8)
    tree = CountTree(np.full(7, GROUPS), counts, 80)
    got = {p for one, two in small_groups(np.array([0, 4]), np.array([3, 2]), tree) for p in zip(one.tolist(), two.tolist(), strict=True)}
    assert got == {(0, 1), (0, 2), (1, 2), (4, 5)}


def test_parities_and_rests_bound_pairs():
    """Rows of a template, similarity 0.7, that 64 counts let pass."""
    chance = np.random.default_rng(4)
    template = chance.integers(0, 1 << 10, 330)
    groups = np.stack([np.bincount(np.append(template, chance.integers(0, 1 << 10, 70)), minlength=1 << 10) for _ in range(60)])
    counts = groups.reshape(60, GROUPS, -1).sum(axis=2).astype(np.uint8)
    bits = np.packbits((groups & 1).astype(np.uint8), axis=1).view(np.uint64)
    sizes, (i, j) = np.full(60, 400), np.triu_indices(60, 1)
    assert CountTree(sizes, counts, 80).near(i, j).mean() > 0.9
    assert CountTree(sizes, counts, 80, bits=bits).near(i, j).mean() < 0.1
    assert not CountTree(sizes, counts, 80, rests=np.full(60, 330)).near(i, j).any()
    assert CountTree(sizes, counts, 80, rests=np.full(60, 360)).near(i, j).mean() > 0.9
    sides = np.arange(60) % 2
    cross = {tuple(p) for one, two in CountTree(sizes, counts, 80, sides=sides).pairs() for p in zip(one.tolist(), two.tolist(), strict=True)}
    assert cross and all(sides[a] != sides[b] for a, b in cross)
