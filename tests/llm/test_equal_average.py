import hashlib
import math
import random

import numpy as np
import pytest
from tidewatch.llm import equal_average
from tidewatch.llm.equal_average import search, vector_codes


def brute(rows, parts, entries, rounds, scale=256):
    """(vec_id, code, error, label_error, digest) by plain loops over every entry."""
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = len(kept[0][1]) // parts
    x = [[math.floor(scale * c) for c in r[1]] for r in kept]
    cut = [[v[p * width : (p + 1) * width] for v in x] for p in range(parts)]
    books = [list(map(list, c[:entries])) for c in cut]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            of = [nearest(v, books[p])[1] for v in cut[p]]
            for k in set(of):
                own = [v for v, o in zip(cut[p], of, strict=True) if o == k]
                books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = [[nearest(cut[p][i], books[p]) for p in range(parts)] for i in range(len(kept))]
    errors = [sum(d for d, _ in f) for f in found]
    totals = {}
    for r, e in zip(kept, errors, strict=True):
        totals[r[2]] = totals.get(r[2], 0) + e
    numbers = ",".join(str(c) for book in books for entry in book for c in entry)
    digest = hashlib.sha256(numbers.encode()).hexdigest()
    return [
        (r[0], "".join(f"{k:02x}" for _, k in f), e, totals[r[2]], digest)
        for r, f, e in zip(kept, found, errors, strict=True)
    ]


def awkward(count=150, dimension=8, seed=1):
    rng = random.Random(seed)
    rows = [
        (k, [round(rng.gauss(0, 1), 2) for _ in range(dimension)], rng.choice([1, 2, None]))
        for k in range(count)
    ]
    rows += [rows[5], rows[5], (7, [0.5] * dimension, 9), (None, [0.25] * dimension, 1), (None, [-0.25] * dimension, 1)]
    rows += [
        (1000, None, 1), (1001, [], 1), (1002, [None] + [0.0] * (dimension - 1), 1),
        (1003, [float("nan")] * dimension, 1), (1004, [float("-inf")] * dimension, 2), (1005, [1.0], 2),
    ]
    rng.shuffle(rows)
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int, code int, piece string, vector string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", None) for r in rows], SCHEMA).repartition(5)


def key(row):
    return tuple((x is None, x or 0) for x in row)


def single(rows):
    """Components as the table holds them: single precision."""
    return [
        (i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label)
        for i, v, label in rows
    ]


@pytest.mark.parametrize("parts, entries, rounds", [(4, 16, 2), (2, 64, 1), (8, 200, 3)])
def test_against_brute_force(spark, parts, entries, rounds):
    rows = awkward()
    got = vector_codes(frame(spark, rows), parts=parts, entries=entries, rounds=rounds)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    wanted = brute(single(rows), parts, entries, rounds)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(wanted, key=key)


def test_many_labels_meet_rows_in_pieces(spark, monkeypatch):
    rows = awkward(60)
    wanted = vector_codes(frame(spark, rows), 4, 8).collect()
    monkeypatch.setattr(equal_average, "FEW_LABELS", 1)
    assert sorted(vector_codes(frame(spark, rows), 4, 8).collect(), key=key) == sorted(wanted, key=key)


def test_search_finds_the_nearest_and_stops_early():
    rng = np.random.default_rng(2)
    entries = rng.integers(-300, 300, (64, 4))
    entries[40] = entries[3]  # a tie goes to the lower index
    parts = np.concatenate([rng.integers(-300, 300, (5000, 4)), entries, np.zeros((2, 4), np.int64)])
    which, best, taken = search(parts, entries)
    away = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (which == away.argmin(axis=1)).all() and (best == away.min(axis=1)).all()
    assert taken < 0.6 * away.size


def test_equal_sums_and_ties_at_the_bound():
    entries = np.array([[3, -3], [0, 0], [1, 1], [-1, -1], [2, 0]])
    parts = np.array([[1, 0], [0, 0], [2, 2], [1, 1], [-9, 9]])
    which, best, _ = search(parts, entries)
    away = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert which.tolist() == away.argmin(axis=1).tolist() and best.tolist() == away.min(axis=1).tolist()


def test_empty_wrong_and_huge(spark):
    none = vector_codes(frame(spark, []))
    assert none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and none.count() == 0
    assert vector_codes(frame(spark, [(1, None, 1)])).count() == 0
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes(frame(spark, [(1, [1.0, 2.0, 3.0], 1)]), parts=2)
    huge = vector_codes(frame(spark, [(k, [3e38 * (-1) ** k] * 16, 1) for k in range(4)] + [(9, [0.0] * 16, 2)]), 16, 2, 1)
    found = {r.vec_id: r for r in huge.collect()}
    assert len(found) == 5 and all(r.error >= 0 for r in found.values())
