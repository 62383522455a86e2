from collections import Counter

import cases
import numpy as np
from tidewatch.llm import sharding
from tidewatch.llm.sharding import _inverted, communication_matrix, shard_rows


def test_matrix_has_exact_sums():
    matrix = communication_matrix([5, 0, 17, 100], [41, 41, 40], 1)
    assert matrix.sum(axis=1).tolist() == [5, 0, 17, 100] and matrix.sum(axis=0).tolist() == [41, 41, 40]
    draws = np.array([communication_matrix([6, 6], [6, 6], s)[0, 0] for s in range(4000)])
    # the hypergeometric law: mean 3, variance 9/11
    assert abs(draws.mean() - 3) < 0.06 and abs(draws.var() - 9 / 11) < 0.06


def test_rows_are_dealt_whole(spark, monkeypatch):
    docs = cases.documents(spark)
    for bucket in (200_000, 3):
        monkeypatch.setattr(sharding, "BUCKET", bucket)
        got = shard_rows(docs, 7)
        assert got.columns == [*docs.columns, "shard", "slot"]
        rows = got.collect()
        assert Counter(map(tuple, docs.collect())) == Counter(tuple(r)[:-2] for r in rows)
        sizes = Counter(r.shard for r in rows)
        assert max(sizes.values()) - min(sizes[k] for k in range(7)) <= 1
        for k in range(7):
            assert sorted(r.slot for r in rows if r.shard == k) == list(range(sizes[k]))


def test_order_is_mixed(spark):
    rows = shard_rows(spark.range(0, 4000, 1, 4), 4).orderBy("shard", "slot").collect()
    for k in range(4):
        ids = np.array([r.id for r in rows if r.shard == k])
        assert abs(np.corrcoef(ids, np.arange(len(ids)))[0, 1]) < 0.1
        assert abs(ids.mean() - 2000) < 150


def test_empty_table(spark):
    assert shard_rows(cases.empty(spark), 16).count() == 0


def test_large_draws_follow_the_same_law():
    random = np.random.default_rng(5)
    for good, bad, draws in ((30, 50, 20), (5, 400, 300), (400, 7, 200), (1000, 1000, 2000), (90, 90, 1)):
        found = np.array([_inverted(random, good, bad, draws) for _ in range(20000)])
        wanted = random.hypergeometric(good, bad, draws, 200000)
        values = np.arange(draws + 2)
        upto = [np.searchsorted(np.sort(x), values, side="right") / len(x) for x in (found, wanted)]
        assert np.abs(upto[0] - upto[1]).max() < 0.02
    good, bad, draws = 10**12, 15 * 10**12, 10**7
    found = np.array([_inverted(random, good, bad, draws) for _ in range(300)])
    spread = np.sqrt(draws / 16 * 15 / 16)
    assert abs(found.mean() - draws / 16) < 0.3 * spread and 0.85 < found.std() / spread < 1.15
    assert _inverted(random, 10**10, 0, 10**9) == 10**9 and _inverted(random, 3, 10**10, 10**10 + 3) == 3
    counts = communication_matrix([2 * 10**9, 10**9, 5], [10**9 + 2, 2 * 10**9 + 3], 3)
    assert counts.sum(axis=1).tolist() == [2 * 10**9, 10**9, 5]
    assert counts.sum(axis=0).tolist() == [10**9 + 2, 2 * 10**9 + 3]
