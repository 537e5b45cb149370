"""What the driver keeps while the log-bilinear model is trained."""

import pytest

from wattloom.llm import lm_score
from wattloom.llm.common import broadcast


def test_models_of_past_rounds_leave_the_driver(spark, monkeypatch):
    sent = []

    def kept(session, value):
        sent.append(broadcast(session, value))
        return sent[-1]

    monkeypatch.setattr(lm_score, "broadcast", kept)
    rows = [(i, f"some words of text {i} and some more {i % 7}") for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    scored = lm_score.score_texts(frame, dim=4, task_tokens=300)
    assert scored.count() == 200 and len(sent) > 4
    # The first holds the words, the last the model that scores.
    for model in sent[1:-1]:
        with pytest.raises(Exception, match="destroyed"):
            model.unpersist()


def test_tasks_of_a_round_are_not_merged(spark, monkeypatch):
    """Small tasks learn beside each other, each in a partition, whatever adaptive execution does."""
    monkeypatch.setattr(lm_score, "_plan", lambda *a: (1, 3))
    seen = spark.sparkContext.accumulator(0)
    real = lm_score._parts

    def counted(net, start):
        from pyspark import TaskContext
        seen.add(1 << 8 * TaskContext.get().partitionId())
        return real(net, start)

    monkeypatch.setattr(lm_score, "_parts", counted)
    rows = [(i, f"some words of text {i} and some more {i % 7}") for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert lm_score.score_texts(frame, dim=4).count() == 200
    assert seen.value == (1 << 24) // 255  # one task in each of three partitions
