import random
import re

import cases
import numpy as np
import pyarrow as pa
from tidewatch.llm.decontamination import (
    Index, _hits, contaminated, decontaminate, distances, most_edits, word_hashes,
)
from tidewatch.llm.arrays import buffers

WORD = re.compile(r"[a-z0-9\x80-\U0010ffff]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def distance(x, y):
    last = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        now = [i]
        for j, b in enumerate(y, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (a != b)))
        last = now
    return last[-1]


def nearest(w, x):
    """Edit distance of x to the nearest run of words in w."""
    last = [0] * (len(w) + 1)
    for i, a in enumerate(x, 1):
        now = [i]
        for j, b in enumerate(w, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (a != b)))
        last = now
    return min(last)


def brute(rows, items, share):
    """{(doc_id, item_id): edits of the item's nearest run of words} within the bound."""
    out = {}
    for doc_id, text in rows:
        w = words(text)
        for item_id, item in items:
            x = words(item)
            if len(x) >= 6 and (edits := nearest(w, x)) <= most_edits(len(x), share):
                out[doc_id, item_id] = edits
    return out


def planted(seed=2):
    rng = random.Random(seed)
    names = [f"n{k}" for k in range(300)]
    items = [(k, " ".join(rng.choices(names, k=rng.randint(6, 40)))) for k in range(25)]
    items += [(90, None), (91, "too short"), (92, items[0][1])]
    rows = []
    for k in range(90):
        text = rng.choices(names, k=rng.randint(0, 60))
        if k % 3:
            part = rng.choice(items[:25])[1].split()
            for _ in range(rng.randint(0, len(part) // 4)):
                at = rng.randrange(len(part))
                move = rng.random()
                if move < 0.5:
                    part[at] = rng.choice(names)
                elif move < 0.75:
                    part.insert(at, rng.choice(names))
                elif len(part) > 4:
                    part.pop(at)
            text[len(text) // 2 : len(text) // 2] = [w.upper() + "," for w in part]
        rows.append((k, " ".join(text)))
    return rows, items


def test_recall_against_brute_force(spark):
    rows, items = planted()
    docs = cases.documents(spark, rows + [(1000 + k, t) for k, t in enumerate(cases.AWKWARD)])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = contaminated(docs, benchmark, block=7)  # several blocks
    got = {(r.doc_id, r.item_id): r for r in found.collect()}
    wanted = brute(rows, items, 0.2)
    lengths = {item_id: len(words(item)) for item_id, item in items}
    assert set(got) <= set(wanted)  # each is verified
    assert len(got) >= 0.99 * len(wanted) and len(wanted) > 40
    texts = dict(rows)
    for (doc_id, item_id), r in got.items():
        run, item = words(texts[doc_id][r.begin : r.end]), words(dict(items)[item_id])
        assert r.n_words == lengths[item_id] and wanted[doc_id, item_id] <= r.edits == distance(run, item)
    kept = decontaminate(docs, benchmark)
    assert kept.columns == docs.columns
    hit = {r[0] for r in got}
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - hit


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame(planted()[1], "item_id long, text string")
    assert contaminated(cases.documents(spark), none).count() == 0
    assert contaminated(cases.empty(spark), some).count() == 0
    assert decontaminate(cases.documents(spark), none).count() == cases.documents(spark).count()


def test_distances_and_dropped_windows():
    rng = random.Random(4)
    x = [[rng.randrange(4) for _ in range(9)] for _ in range(200)]
    y = [[rng.randrange(4) for _ in range(9)] for _ in range(200)]
    got = distances(np.array(x, np.uint64), np.array(y, np.uint64))
    assert got.tolist() == [distance(a, b) for a, b in zip(x, y, strict=True)]
    index = Index(planted()[1], 0.2)
    hashes, _, _, first = word_hashes(*buffers(pa.array([planted()[1][3][1]])))
    starts, lengths = index.windows(hashes, first)
    assert (0, len(hashes)) in zip(starts.tolist(), lengths.tolist(), strict=True)


def test_passages_shorter_and_longer_than_the_item():
    rng = random.Random(7)
    names = [f"n{k}" for k in range(400)]
    items = [(k, " ".join(rng.choices(names, k=rng.randint(6, 40)))) for k in range(40)]
    texts = []
    for k in range(240):
        part = items[k % 40][1].split()
        move = k // 40 % 3
        for _ in range(most_edits(len(part), 0.2)):
            at = rng.randrange(len(part))
            if move == 0:
                part.pop(at)
            elif move == 1:
                part.insert(at, rng.choice(names))
            else:
                part[at] = rng.choice(names)
        # half of the documents are nothing but the passage
        sides = [rng.choices(names, k=rng.randint(0, 20)) if k >= 120 else [] for _ in range(2)]
        texts.append(" ".join([*sides[0], *part, *sides[1]]))
    texts.append(" ".join(items[0][1].split()[1:]))
    got = {(r[0], r[1]): r for r in _hits(pa.array(texts), Index(items, 0.2))}
    wanted = brute(enumerate(texts), items, 0.2)
    assert set(got) <= set(wanted) and len(wanted) >= 241 and (240, 0) in got
    assert len(got) >= 0.99 * len(wanted)
    for (k, i), (_, _, edits, n_words, begin, end) in got.items():
        assert edits == distance(words(texts[k][begin:end]), words(items[i][1])) and edits >= wanted[k, i]
        assert n_words == len(words(items[i][1]))


def test_large_shares():
    rows, items = planted()
    texts = pa.array([text for _, text in rows])
    for share in (0.3, 0.34, 0.4):
        got = {(r[0], r[1]) for r in _hits(texts, Index(items, share))}
        wanted = brute(enumerate(t for _, t in rows), items, share)
        assert got <= set(wanted) and len(got) >= 0.9 * sum(e <= 0.2 * len(words(dict(items)[i])) for (_, i), e in wanted.items())
