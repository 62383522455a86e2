import random
import zlib

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F
from tidewatch.llm import language
from tidewatch.llm.language import fit, held_out, identify, language_filter, learnable, windows_of

SYLLABLES = {"aa": "the and ing er on th".split(), "bb": "über sch ein ung der zu".split(),
             "cc": "ción los que ñ ado ra".split()}


def labelled(count=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for k in range(count):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(3, 120))]
        rows.append((k, " ".join(words).capitalize() + ".", lang, "s", 1, "x", 2))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    odd = [(None if k % 3 else 900 + k, t, None, "s", 1, "x", 2) for k, t in enumerate(cases.AWKWARD)]
    return spark.createDataFrame(labelled() + odd + labelled()[:5], cases.SCHEMA).repartition(3)


def test_held_out_accuracy(spark, docs, monkeypatch):
    network = fit(learnable(docs), sample_docs=80)
    found = identify(docs.withColumn("h", held_out(F.col("doc_id"))), network)
    assert found.columns == [*docs.columns, "h", "lang_pred", "score"]
    rows = found.collect()
    assert len(rows) == docs.count()
    for r in rows:
        fold = None if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % 4
        assert r.h == (fold == 2) and 0 <= r.score <= 1
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0)
        else:
            assert r.lang_pred in SYLLABLES
    out = [r.lang_pred == r.lang for r in rows if r.h and r.lang]
    assert len(out) > 60 and np.mean(out) > 0.97
    kept = language_filter(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {r[0] for r in labelled()}


def test_windows_cover_texts():
    data = np.frombuffer(b"Ab1" * 100, np.uint8)
    windows, row = windows_of(data, np.array([0, 0, 5, 300]))
    assert row.tolist() == [1, *[2] * -(-295 // language.LENGTH)]
    joined = b"".join(w[: language.LENGTH].tobytes() for w in windows[row == 2])
    assert joined[:295] == (b"ab " * 100)[5:] and set(joined[295:]) <= {0x20}


def test_long_texts_are_cut_alike(docs):
    network = fit(learnable(docs), sample_docs=20)
    import pyarrow as pa

    text = labelled()[0][1] * 40_000  # over one part
    best, score = language._predict(pa.array([text]), network)
    data = np.frombuffer(text.encode(), np.uint8)
    windows, _ = windows_of(data, np.array([0, len(data)]))
    weight = (windows[:, : language.LENGTH] != language.SPACE).sum(axis=1)
    share = (network.probabilities(windows) * weight[:, None]).sum(axis=0) / weight.sum()
    assert best[0] == share.argmax() and abs(score[0] - share.max()) < 1e-4


def test_copies_take_one_place_in_the_sample(spark):
    texts = [f"text {'abcdefghij'[k]} of one language" for k in range(10)]
    keys = spark.createDataFrame([(t,) for t in texts], "text string").select("text", F.xxhash64("text"))
    first = min(keys.collect(), key=lambda r: r[1])[0]  # its copies come first in hash order
    rows = [(t, "aa") for t in texts] + [(first, "aa")] * 50
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    windows, _, _ = language.sample_windows_of(docs, "lang", 10, 8)
    assert len({w.tobytes() for w in windows}) == 10


def test_nothing_to_learn(spark):
    plain = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert identify(plain, fit(plain)).first()["lang_pred"] == "und"
    assert identify(cases.empty(spark), fit(cases.empty(spark))).count() == 0
