"""What a Python worker keeps when a task has ended, and how many workers a task has."""

import pyarrow as pa

from siftstone.llm import common, suffix_dedup, toxicity


class _Rows:
    """Stands for a DataFrame: runs the task's function here."""

    def __init__(self, *batches):
        self.batches = batches

    def mapInArrow(self, f, _):  # noqa: N802
        return list(f(iter(self.batches)))


def test_word_caches_can_end_with_the_task():
    words = common.Recent(str.upper, "toxicity")
    batch = pa.record_batch({"x": ["a", "b"]})

    def seen(b):
        assert [words[x] for x in b.column(0).to_pylist()] == ["A", "B"] and len(words) == 2
        return b

    common.by_batch(_Rows(batch), seen, "x string", "toxicity")
    assert len(words) == 2
    common.by_batch(_Rows(batch), seen, "x string", "toxicity", keep=False)
    assert not words and not words.old


def test_toxicity_keeps_no_words_when_rows_are_dropped(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"word{i} other text {i % 3}") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    said, plain = [], toxicity.by_batch
    monkeypatch.setattr(toxicity, "by_batch", lambda *a, **k: said.append((a[1].__name__, k.get("keep", True))) or plain(*a, **k))
    assert toxicity.keep_clean(docs, labels).count() <= 40
    assert ("clean", False) in said


def test_one_worker_a_task_makes_spans_and_digests(spark):
    docs = spark.createDataFrame([(1, "x" * 80), (2, "x" * 80)], "doc_id long, text string")
    for made in (suffix_dedup.digests(docs), suffix_dedup.remaining(docs)):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert plan.split("Join")[0].count("MapInArrow") == 1  # after the last join
