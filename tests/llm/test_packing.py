import random
import zlib
from collections import Counter, defaultdict

import cases
import numpy as np
from tidewatch.llm.packing import pack_documents, plan_packing


def check(plan, histogram, capacity):
    """Every piece has one place, sequences are gapless; the number of sequences."""
    placed, content = Counter(), defaultdict(list)
    for length, rank, count, sequence, offset, each in zip(*(plan[k].tolist() for k in plan), strict=True):
        for r in range(count):
            placed[length, rank + r] += 1
            content[sequence + r // each].append((offset + r % each * length, length))
    assert placed == Counter({(n, r): 1 for n, c in histogram.items() for r in range(c)})
    for pieces in content.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(content)


def test_plans_are_whole_and_near_the_bound():
    rng = random.Random(8)
    shapes = {
        "long tail": [min(512, int(rng.lognormvariate(4.5, 1.2)) + 1) for _ in range(4000)],
        "halves": [rng.choice([256, 257, 255, 1]) for _ in range(999)],
        "thirds": [rng.choice([171, 170, 172, 340]) for _ in range(2000)],
        "one": [7], "full": [512] * 5, "tiny": [1] * 3000, "none": [],
    }
    for name, lengths in shapes.items():
        histogram = dict(Counter(lengths))
        n = check(plan_packing(histogram, 512), histogram, 512)
        over = sum(x > 256 for x in lengths)
        bound = max(-(-sum(lengths) // 512), over)
        assert n <= 1.02 * bound + 1 or name in ("thirds", "halves"), (name, n, bound)


def test_documents_are_packed_whole(spark, vocabulary):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    tokenizer.encode_special_tokens = True
    docs = cases.documents(spark)
    got = pack_documents(docs, vocabulary, capacity=64).collect()
    wanted = Counter()
    for r in docs.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 64 or 64
        cuts = [0, *range(first, len(ids) + 1, 64)]
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            wanted[r.doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == wanted
    content = defaultdict(list)
    for r in got:
        content[r.sequence_id].append((r.offset, r.length))
    for pieces in content.values():
        ends = [o + n for o, n in sorted(pieces)]
        assert [o for o, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= 64


def test_empty_table(spark, vocabulary):
    assert pack_documents(cases.empty(spark), vocabulary).count() == 0


def test_query_encodes_as_the_library_does(spark, vocabulary, tmp_path):
    from tidewatch.llm.queries import op8_best_fit_packing
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    texts = ["<|endoftext|>", "a<|endoftext|>b", " <|endoftext|><|endoftext|> ", None, "", "plain",
             "word <|endoftext|> " * 3000]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    wanted = set()
    for doc_id, text in enumerate(texts):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            wanted.add((doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    got = op8_best_fit_packing(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == wanted
    assert len(got) == len(wanted)
