import base64
import gzip
import hashlib
import io

import cases
import pytest
from tidewatch.llm import warc
from tidewatch.llm.folders import shared_folder

SCHEMA = "page_id long, url string, html string, refers_to string, payload int"


def pages(spark):
    texts = cases.texts(80)
    rows = [(k if k % 13 else None, f"http://h/{k}" if k % 5 else None, t, "x", 1) for k, t in enumerate(texts)]
    rows += [rows[20], (500, "http://h/a b\r\nX: y", "", "x", 1), (7, "u", texts[40], "x", 1)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("least", [0, 30])
def test_round_trip(spark, least):
    docs = pages(spark)
    manifest = warc.write_archives(docs, shared_folder(spark, "test-warc"), least, file_bytes=4000)
    got = warc.read_archives(manifest).collect()
    rows = [(r.page_id, (r.html or "").encode()) for r in docs.collect()]
    groups = {}
    for page_id, data in rows:
        groups.setdefault(data, []).append(page_id)
    wanted = []
    for page_id, data in rows:
        ids = [k for k in groups[data] if k is not None]
        revisit = len(data) >= least and ids and page_id != max(ids)
        wanted.append((
            page_id, "revisit" if revisit else "response", max(ids) if revisit else None, len(data),
            base64.b32encode(hashlib.sha1(data).digest()).decode(), None if revisit else data,
        ))
    found = [
        (r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest,
         None if r.payload is None else bytes(r.payload)) for r in got
    ]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    assert all(r.digests_ok for r in got)
    for path, records, size in manifest.collect():
        with open(path, "rb") as file:
            data = file.read()
        assert len(data) == size and gzip.decompress(data).count(b"WARC/1.1\r\n") == records


def test_damage_is_noticed():
    good = warc.format_record(1, "http://h/", b"<p>hello</p>", None, "2024-01-01T00:00:00Z")
    member = warc.gzip_member(good)
    records = list(warc.read_records(io.BytesIO(member + member)))
    assert len(records) == 2 and all(r.digests_ok for r in records)
    changed = warc.gzip_member(good.replace(b"hello", b"hallo"))
    assert [r.digests_ok for r in warc.read_records(io.BytesIO(changed))] == [False]
    with pytest.raises((EOFError, ValueError)):
        list(warc.read_records(io.BytesIO(member[:-20])))
    with pytest.raises(ValueError, match="longer"):
        list(warc.read_records(io.BytesIO(warc.gzip_member(good + b"more"))))


def test_empty_table(spark):
    assert warc.warc_round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
