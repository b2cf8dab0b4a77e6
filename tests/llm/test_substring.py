from collections import Counter
from itertools import product

import pytest

from cases import frame, texts, words
from eventmere.llm import substring


def brute(window):
    docs = [words(t) for _, t in texts()]
    starts = Counter(tuple(w[i : i + window]) for w in docs for i in range(len(w) - window + 1))
    out = []
    for (key, _), w in zip(texts(), docs):
        gone = set()
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((key, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def test_cover_has_every_difference():
    found = {(a - b) % substring.PERIOD for a, b in product(substring.COVER, repeat=2)}
    assert found == set(range(substring.PERIOD))


@pytest.mark.parametrize("window", [22, 35])
def test_against_brute_force(spark, window):
    got = substring.remove_repeats(frame(spark), window).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(window)


def test_empty_table_and_short_windows(spark):
    assert substring.remove_repeats(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        substring.remove_repeats(frame(spark), substring.PERIOD)
