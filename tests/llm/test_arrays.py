import random

import numpy as np
import pyarrow as pa
from tidewatch.llm.arrays import buffers, hash_runs, words


def hashes(texts):
    data, offsets = buffers(pa.array(texts))
    begins, ends, _ = words(data, offsets)
    return hash_runs(data, begins, ends)


def thue_morse(length, letters="ab"):
    return "".join(letters[bin(k).count("1") % 2] for k in range(length))


def test_equal_runs_have_equal_hashes_wherever_they_stand():
    rng = random.Random(1)
    runs = ["".join(rng.choices("abc", k=k)) for k in (1, 2, 255, 256, 257, 511, 512, 513, 70_000, 140_000)]
    alone = np.concatenate([hashes([r]) for r in runs])
    assert (hashes([" ".join(["x", *runs]), " ".join(runs)])[1:] == np.tile(alone, 2)).all()
    assert len(set(alone.tolist())) == len(runs)


def test_regular_runs_differ():
    for length in (1024, 2048, 4096, 1 << 18):
        x, y = hashes([thue_morse(length), thue_morse(length, "ba")])
        assert x != y
    # regular in whole pieces, too
    parts = {"a": "p" * 256, "b": "q" * 256}
    x, y = hashes(["".join(parts[c] for c in thue_morse(4096, s)) for s in ("ab", "ba")])
    assert x != y


def test_regular_texts_are_not_linked(spark):
    import cases
    from tidewatch.llm.jaccard_join import jaccard_components

    rows = [(1, thue_morse(2048)), (2, thue_morse(2048, "ba")), (3, thue_morse(2048))]
    got = {r.doc_id: r.component_id for r in jaccard_components(cases.documents(spark, rows), n=3, percent=90).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
