"""What the driver keeps and plans while stages run."""

from __future__ import annotations

from payscope.llm import quality as Q
from payscope.llm.common import stored


def test_garbage_of_finished_jobs_is_collected(spark):
    """A dead object of the driver's heap is gone after the next stored frame."""
    lang = spark.sparkContext._jvm.java.lang
    dead = lang.ref.WeakReference(lang.Object())
    assert stored(spark.range(3).toDF("n"), "three").count() == 3
    assert dead.get() is None


def test_the_model_is_asked_once(spark, sf_dir, monkeypatch):
    """The documents that set the thresholds are among all documents: one look-up answers both."""
    asked, answer = [], Q.answer
    monkeypatch.setattr(Q, "answer", lambda needed, model: asked.append(1) or answer(needed, model))
    folder = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    found = Q.classify(docs, labels)
    assert len(asked) == 1 and found.count() == docs.count()
