import pytest
from pyspark.sql import functions as F

from tidewatch.operators.answers import AnswerStore


def asked(folder):
    """A completion function that notes what it is asked, one file per call."""
    folder = str(folder)

    def complete(prompts):
        import pathlib
        import uuid

        pathlib.Path(folder, uuid.uuid4().hex).write_text("\n".join(prompts))
        return [None if p == "none" else p[::-1] for p in prompts]

    return complete


def notes(folder):
    return sorted(p for f in folder.iterdir() for p in f.read_text().split("\n"))


@pytest.fixture
def calls(tmp_path):
    folder = tmp_path / "calls"
    folder.mkdir()
    return folder


def test_equal_prompts_are_asked_once(spark, tmp_path, calls):
    prompts = ["a b", "a b", None, "none", "ünï", "", *(f"p{k % 40}" for k in range(400))]
    rows = spark.createDataFrame(list(enumerate(prompts)), "id long, prompt string").repartition(7)
    store = AnswerStore(spark, str(tmp_path / "store"), batch=3, buckets=5)
    for extra in ([], ["late"]):  # a later run asks only what is new
        more = rows.unionByName(spark.createDataFrame([(-1, p) for p in extra], "id long, prompt string"))
        got = store.answered(more, asked(calls)).collect()
        assert len(got) == len(prompts) + len(extra)
        for r in got:
            assert r.answer == (None if r.prompt in (None, "none") else r.prompt[::-1])
        assert notes(calls) == sorted({p for p in prompts if p is not None} | set(extra))
    assert max(len(f.read_text().split("\n")) for f in calls.iterdir()) <= 3
    assert store.ask(rows, asked(calls)) == 0


def test_a_failed_run_keeps_what_it_was_told(spark, tmp_path, calls):
    rows = spark.range(60).select(F.concat(F.lit("p"), "id").alias("prompt"))
    note, broken = asked(calls), str(tmp_path / "broken")

    def breaks(prompts):
        import pathlib

        if "p33" in prompts and not pathlib.Path(broken).exists():
            pathlib.Path(broken).touch()
            raise RuntimeError("no answer")
        return note(prompts)

    store = AnswerStore(spark, str(tmp_path / "store"), batch=4, buckets=2)
    with pytest.raises(Exception, match="no answer"):
        store.ask(rows, breaks)
    before = len(notes(calls))
    assert 0 < before < 60
    assert store.ask(rows, breaks) == 60 - before
    assert notes(calls) == sorted(f"p{k}" for k in range(60))
    assert store.read().count() == 60


def test_wrong_number_of_answers_and_no_prompts(spark, tmp_path):
    store = AnswerStore(spark, str(tmp_path / "store"))
    rows = spark.createDataFrame([("a",), ("b",)], "prompt string")
    with pytest.raises(Exception, match="answers to"):
        store.ask(rows, lambda prompts: [])
    assert store.ask(rows.limit(0), lambda prompts: []) == 0
    assert store.answered(rows.limit(0), lambda prompts: []).count() == 0


def test_first_of_two_answers_counts(spark, tmp_path):
    from tidewatch.operators import answers as a

    store = AnswerStore(spark, str(tmp_path / "store"))
    a._put(f"{store.path}/bucket=1", "x", ["k"], ["first"])
    a._put(f"{store.path}/bucket=1", "y", ["k", "l"], ["second", None])
    assert sorted(map(tuple, store.read().collect())) == [("k", "first"), ("l", None)]
    assert a._keys(f"{store.path}/bucket=1", "y") == {"k", "l"} and a._keys(f"{store.path}/bucket=2", "y") == set()


def test_a_task_that_runs_again_asks_only_the_rest(spark, tmp_path, calls, monkeypatch):
    from tidewatch.operators import answers as a

    class Fixed:
        hex = "run"

    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "prompt string")
    keys = {r.prompt: r.key for r in rows.select("prompt", a.prompt_key(F.col("prompt")).alias("key")).collect()}
    store = AnswerStore(spark, str(tmp_path / "store"), buckets=1)
    # what an earlier attempt of the same run left, put there after the run has looked for answers
    monkeypatch.setattr(a.uuid, "uuid4", lambda: Fixed)
    monkeypatch.setattr(store, "read", lambda: spark.createDataFrame([], "key string, answer string"))
    a._put(f"{store.path}/bucket=0", "run", [keys["b"]], ["told before"])
    assert store.ask(rows, asked(calls)) == 2 and notes(calls) == ["a", "c"]
