import zlib

import cases
import numpy as np
import pytest
from tidewatch.llm import token_files as tf
from tidewatch.llm.encoding import Encoder
from tidewatch.llm.folders import shared_folder


@pytest.fixture(scope="module")
def library(vocabulary):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 31, 32])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000, np.uint64).astype(np.uint32)
    for n in (0, 1, 63, 64, 65, 1000):
        data = tf.pack(ids[:n], bits)
        assert len(data) == -(-n // 64) * 8 * bits
        assert (tf.unpack(data, bits, n) == ids[:n]).all()


def test_encoder_agrees_with_the_library(vocabulary, library):
    texts = [t or "" for t in cases.texts(300)]
    texts += ["a  b\t\n c", "x'll y've'd 'm 'S", "２０２４ Ⅷ ² ½", "a b c\x1cd", "😀'tb <|endoftext|>"]
    for slots in (1 << 12, 1 << 6):  # the small table is emptied over and over
        code = Encoder(vocabulary, slots)
        for block in (1 << 20, 50):
            ids, counts = code.encode(texts, block)
            wanted = [library(t) for t in texts]
            assert counts.tolist() == [len(w) for w in wanted]
            assert ids.tolist() == [i for w in wanted for i in w]


def test_files_hold_all_documents_in_order(spark, vocabulary, library, monkeypatch):
    docs = cases.documents(spark)
    manifest = tf.write_tokens(docs, shared_folder(spark, "test-tokens"), vocabulary, 2)
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    got = tf.read_tokens(manifest, chunk=500).orderBy("start").collect()
    assert [r.doc_id for r in got] == [r.doc_id for r in rows]
    start, wanted = 0, {}
    for r in rows:
        ids = [*library(r.text), 2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        wanted.setdefault(r.doc_id, []).append((len(ids), crc))
    for r in got:
        assert r.start == start
        wanted[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        start += r.n_tokens
    file = tf.TokenReader(manifest.orderBy("file_no").first()["path"])
    whole = file.ids(0, file.total)
    assert (file.ids(5, 50) == whole[5:50]).all() and file.bits == 16
    assert whole[file.ends - 1].tolist() == [2] * len(file.ends)


def test_damage_is_noticed(spark, vocabulary):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    path = tf.write_tokens(docs, shared_folder(spark, "test-tokens"), vocabulary, 2).first()["path"]
    with open(path, "r+b") as file:
        file.seek(-tf.FOOTER.size - 3, 2)
        file.write(b"\xff\xff\xff")
    with pytest.raises(ValueError, match="damaged"):
        tf.TokenReader(path)


def test_empty_table(spark, vocabulary):
    assert tf.token_output(cases.empty(spark), vocabulary).count() == 0


MARKED = [
    "<|endoftext|>", "one<|endoftext|>two", " a <|endoftext|> b ", "<|endoftext|><|endoftext|>\n",
    "<|endof<|endoftext|>text|>", "<|ENDOFTEXT|>", "'<|endoftext|>s",
]


@pytest.fixture(scope="module")
def plain_library(vocabulary):
    """The library as it is, without a setting of ours."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_special_tokens_where_asked_for(vocabulary, plain_library):
    texts = [*MARKED, *(t or "" for t in cases.texts(60)), "word " * 50 + "<|endoftext|>" + " word" * 50]
    wanted = [plain_library(t) for t in texts]
    for block in (1 << 20, 50):
        ids, counts = Encoder(vocabulary, 1 << 12, special_tokens=True).encode(texts, block)
        assert counts.tolist() == [len(w) for w in wanted]
        assert ids.tolist() == [i for w in wanted for i in w]


def test_emptying_the_table_keeps_pieces_that_were_known(vocabulary, library):
    code = Encoder(vocabulary, 1 << 6)
    for k in range(40):
        texts = [f"known words and word{k} of w{k * k}x", "and known"]
        ids, counts = code.encode(texts)
        wanted = [library(t) for t in texts]
        assert counts.tolist() == [len(w) for w in wanted]
        assert ids.tolist() == [i for w in wanted for i in w]


def test_query_encodes_as_the_library_does(spark, plain_library, tmp_path):
    from tidewatch.llm.queries import op1_token_output

    rows = dict(enumerate([*MARKED, None, "", "plain"]))
    spark.createDataFrame(list(rows.items()), "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    start = 0
    for r in op1_token_output(spark, str(tmp_path)).orderBy("doc_id").collect():
        ids = [*plain_library(rows.pop(r.doc_id)), 2]
        assert (r.start, r.n_tokens) == (start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert not rows
