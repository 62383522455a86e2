import random
import re

import cases
import numpy as np
import pytest
from tidewatch.llm import jaccard_join
from tidewatch.llm.components import local_roots
from tidewatch.llm.jaccard_join import jaccard_components, one_of_each

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text, n=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1))


def brute(rows, n=3, percent=90):
    sets = [grams(r.text, n) for r in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if x and 100 * both >= percent * (len(x) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(k)
    out = [None] * len(rows)
    for members in groups.values():
        ids = [rows[k].doc_id for k in members if rows[k].doc_id is not None]
        for k in members:
            out[k] = (rows[k].doc_id, len(sets[k]), min(ids) if ids else None)
    return out, groups, sets


def key(row):
    return tuple((x is None, x or 0) for x in row)


def varied(count=160, seed=5):
    """Chains of near copies, whose ends don't link, among unrelated texts."""
    rng = random.Random(seed)
    names = [f"w{k}" for k in range(400)]
    rows, number = [], 0
    while len(rows) < count:
        words = rng.choices(names, k=rng.choice([9, 12, 25, 60, 150]))
        for _ in range(rng.choice([1, 1, 2, 6, 25])):
            rows.append((number, " ".join(words)))
            number += 1
            if rng.random() < 0.8:
                words = list(words)
                words[rng.randrange(len(words))] = rng.choice(names)
            if rng.random() < 0.3:
                words = words[: len(words) - rng.randint(0, 2)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("tile, n, percent", [(4096, 3, 90), (4, 3, 90), (4, 5, 80)])
def test_against_brute_force(spark, monkeypatch, tile, n, percent):
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    docs = cases.documents(spark, varied() + [(1000 + k, t) for k, t in enumerate(cases.texts(60))])
    wanted, groups, _ = brute(docs.collect(), n, percent)
    got = jaccard_components(docs, n, percent)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(wanted, key=key)
    assert max(map(len, groups.values())) > 9


def test_awkward_rows(spark):
    docs = cases.documents(spark)
    wanted, groups, sets = brute(docs.collect(), 5, 80)
    got = jaccard_components(docs)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(wanted, key=key)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    blank = sum(not s for s in sets)
    assert kept.count() == blank + sum(bool(sets[m[0]]) for m in groups.values())


def test_empty_table(spark):
    assert jaccard_components(cases.empty(spark)).count() == 0
    assert one_of_each(cases.empty(spark)).count() == 0


def test_local_roots():
    node, root = local_roots(np.array([5, 3, 9, 20]), np.array([3, 1, 8, 20]))
    assert dict(zip(node.tolist(), root.tolist(), strict=True)) == {5: 1, 3: 1, 9: 8}
