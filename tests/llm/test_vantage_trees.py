import random
import re

import cases
import numpy as np
import xxhash
from tidewatch.llm.vantage_trees import (
    fingerprint, fingerprints, forest, shard_tree, shingle_hashes, simhash_components, visits,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_print(text, n):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    n = min(n, len(words))
    hashes = [xxhash.xxh64(" ".join(words[k : k + n]), seed=42).intdigest() for k in range(len(words) - n + 1)]
    if not words:
        return 0
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, n, limit):
    prints = [brute_print(text, n) for _, text in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= limit:
                root[find(i)] = find(j)
    ids = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(k)] = min(doc_id, ids.get(find(k), doc_id))
    return [(doc_id, f"{prints[k]:016x}", ids.get(find(k))) for k, (doc_id, _) in enumerate(rows)]


def key(row):
    return tuple((x is None, x or 0) for x in row)


def chains(count, seed=1):
    """Random fingerprints, and some that differ from another in 1 to 8 bits."""
    rng = random.Random(seed)
    out = [0, 2**64 - 1]
    while len(out) < count:
        x = rng.getrandbits(64)
        if rng.random() < 0.5:
            x = rng.choice(out)
            for b in rng.sample(range(64), rng.randint(1, 8)):
                x ^= 1 << b
        out.append(x)
    return np.unique(np.array(out, np.uint64))


def groups(nodes, edges):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[find(a)] = find(b)
    out = {}
    for x in nodes:
        out.setdefault(find(x), set()).add(x)
    return sorted(sorted(g) for g in out.values())


def all_links(x, limit):
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= limit
    return [(int(x[i]), int(x[j])) for i, j in zip(*np.nonzero(near), strict=True) if i < j]


def test_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(None if k % 41 == 7 else k // 2 if k % 17 == 0 else k, t) for k, t in enumerate(cases.texts())]
    words = [f"w{k}" for k in range(500)]
    for k in range(60):  # long texts with one word changed differ in few bits
        base = random.Random(k // 4).choices(words, k=300)
        base[rng.randrange(300)] = rng.choice(words)
        rows.append((500 + k, " ".join(base)))
    rows.append(rows[30])
    for n, limit in ((4, 4), (2, 10)):
        wanted = brute_components(rows, n, limit)
        docs = cases.documents(spark, rows).withColumnsRenamed({"start": "fp", "length": "component_id", "lang": "root"})
        got = simhash_components(docs, n=n, limit=limit, points=24)  # several shards
        assert sorted(map(tuple, got.collect()), key=key) == sorted(wanted, key=key)
        assert len({w[2] for w in wanted}) < len(rows) - 40


def test_empty_table(spark):
    out = simhash_components(cases.empty(spark))
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.count() == 0
    rows = fingerprints(cases.empty(spark))
    assert rows.count() == 0


def test_forest_connects_what_links_connect():
    for limit in (0, 1, 4, 7):
        x = chains(6000, seed=limit)
        a, b = forest(x[::2], x[1::2], limit)
        inner = {int(v) for v in x[::2]}
        wanted = [e for e in all_links(x, limit) if e[0] in inner or e[1] in inner]
        nodes = x.tolist()
        assert groups(nodes, zip(a.tolist(), b.tolist(), strict=True)) == groups(nodes, wanted)
        assert len(a) < len(x)


def test_a_ball_of_near_copies_gives_a_forest():
    rng = np.random.default_rng(3)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (30000, 3)).astype(np.uint64), axis=1)
    x = np.unique(flips ^ np.uint64(0x0123456789ABCDEF))
    a, b = forest(x, np.empty(0, np.uint64), 4)
    assert len(a) <= len(x) - 1 and len(groups(x.tolist(), zip(a.tolist(), b.tolist(), strict=True))) == 1


def test_every_link_meets_in_a_shard():
    for limit in (2, 4, 9):
        x = chains(3000, seed=9)
        tree, shards = shard_tree(np.random.default_rng(0).permutation(x), len(x), 60)
        assert shards > 20
        row, shard, home = visits(tree, x, limit)
        assert sorted(row[home].tolist()) == list(range(len(x)))
        seen = set(zip(row.tolist(), shard.tolist(), strict=True))
        if limit <= 4:
            assert len(seen) < 0.8 * len(x) * shards  # some are pruned
        own = dict(zip(row[home].tolist(), shard[home].tolist(), strict=True))
        place = {int(v): k for k, v in enumerate(x)}
        for a, b in all_links(x, limit):
            assert (place[a], own[place[b]]) in seen and (place[b], own[place[a]]) in seen


def test_fingerprint_of_ties_and_long_texts():
    assert fingerprint(np.array([], np.uint64)) == 0
    assert fingerprint(np.array([3, 5], np.uint64)) == 1  # half is not over half
    text = "Ab c\td " * 40000
    assert fingerprint(shingle_hashes(text, 4, 42)) == brute_print(text, 4)
