"""Every two texts that share a sketch are compared, also where they share it in a bucket that is cut up."""

import collections

import numpy as np
import pytest

from strandline.llm import near_dedup


def texts(n=24):
    """Pairs of 60 words that begin with 28 words that all texts share, with changes to each third word or so of the rest: alike in no shingle outside the passage."""
    rng = np.random.default_rng(11)
    word = lambda: f"w{rng.integers(1 << 40)}"
    passage, rows = [word() for _ in range(28)], []
    for i in range(n):
        own = passage + [word() for _ in range(32)]
        other = [word() if k >= 30 and k % 3 == 0 else w for k, w in enumerate(own)]
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(other))]
    return rows


@pytest.mark.parametrize(("few", "size"), [(4096, 4), (7, 4), (0, 4), (4096, 512)])
def test_none_is_lost_in_large_buckets(spark, monkeypatch, few, size):
    monkeypatch.setattr(near_dedup, "FEW", few)
    rows = texts()
    found = near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), block=size).collect()
    groups = collections.defaultdict(set)
    for r in found:
        groups[bytes(r.root)].add(r.doc_id)
    s, at = near_dedup.labelled([np.array([hash(w) & 0xFFFFFFFF for w in t.split()], "<u4").tobytes() for _, t in rows], near_dedup.K)
    assert all(len(np.intersect1d(s[at[i] : at[i + 1]], s[at[i + 1] : at[i + 2]])) <= 26 for i in range(0, len(rows), 2))
    together = sum({2 * i, 2 * i + 1} in groups.values() for i in range(len(rows) // 2))
    assert max(map(len, groups.values())) == 2 and together >= 22  # a pair that shares no sketch at all isn't met
