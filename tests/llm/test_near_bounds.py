"""The tests that keep pairs from the comparison of near duplicates never lose a link."""

import numpy as np
import pytest

from lonja.llm import near_dedup


def links(x, y):
    common = len(np.intersect1d(x, y))
    return 100 * common >= 80 * (len(x) + len(y) - common)


@pytest.mark.parametrize("seed", range(6))
def test_parity_and_sizes_keep_every_link(spark, seed):
    random = np.random.default_rng(seed)
    rows, expected = [], []
    for size in (1, 2, 4, 5, 9, 30, 300, 4000):
        for share in (0, 0.05, 0.1, 0.11, 0.12, 0.2, 0.25, 0.5, 1):
            x = np.unique(random.integers(0, 2**64, size, dtype=np.uint64))
            own = int(share * len(x))
            y = np.unique(np.concatenate([x[own:], random.integers(0, 2**64, own // (1 + seed % 2), dtype=np.uint64)]))
            rows.append((len(x), len(y), near_dedup.parity(x).tolist(), near_dedup.parity(y).tolist()))
            expected.append(links(x, y))
    made = spark.createDataFrame(rows, "a_n long, b_n long, a_parity array<bigint>, b_parity array<bigint>")
    found = made.selectExpr(f"{near_dedup._SIZES} AND {near_dedup._PARITIES} AS possible").collect()
    assert all(r.possible for r, linked in zip(found, expected) if linked)
    assert not all(r.possible for r in found) and any(expected)
