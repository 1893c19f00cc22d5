import random

from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.operators import accuracy


def plain(a, b):
    """Edit distance and longest common subsequence by whole tables."""
    cost = [[i + j if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    common = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            cost[i][j] = min(cost[i - 1][j - 1] + (x != y), cost[i - 1][j] + 1, cost[i][j - 1] + 1)
            common[i][j] = common[i - 1][j - 1] + 1 if x == y else max(common[i - 1][j], common[i][j - 1])
    return cost[-1][-1], common[-1][-1]


@settings(max_examples=600, deadline=None)
@given(st.text("abé漢 ", max_size=30), st.text("abé漢 ", max_size=30))
def test_distances_of_texts(a, b):
    assert (accuracy.distances([a], [b])[0], accuracy.common_subsequence(a, b)) == plain(a, b)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["to", "be", "or", ""]), max_size=90), st.lists(st.sampled_from(["to", "be", "not"]), max_size=90))
def test_distances_of_words(a, b):
    assert (accuracy.distances([a], [b])[0], accuracy.common_subsequence(a, b)) == plain(a, b)


def test_long_sides_and_few_kept_places(monkeypatch):
    rng = random.Random(4)
    a, b = ("".join(rng.choice("abcde") for _ in range(n)) for n in (700, 500))
    want = plain(a, b)
    for bits in (1 << 29, 0):
        monkeypatch.setattr(accuracy, "KEPT_BITS", bits)
        assert (accuracy.distances([a, b], [b, a]), accuracy.common_subsequence(a, b)) == ([want[0]] * 2, want[1])
    assert accuracy.distances(["x" * 100_000], ["x" * 60_000 + "y" + "x" * 39_000]) == [1000]
