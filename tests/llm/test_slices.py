"""How much of a batch is encoded at once when texts are packed."""

import public_tokenizers
import pyarrow as pa

from wattloom.llm import packing
from wattloom.llm.common import CHUNK_BYTES, broadcast


def test_batches_are_cut_in_slices(spark, monkeypatch):
    class Task:
        @staticmethod
        def get():
            return Task

        @staticmethod
        def partitionId():
            return 3

    monkeypatch.setattr(packing, "TaskContext", Task)
    path = public_tokenizers.path("byte_bpe_50k.json")
    shared = broadcast(spark, (packing.read_vocabulary(path), packing.read_added(path)))
    texts = ["some words " * (CHUNK_BYTES // 40), None, "", "a b"] * 8
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    found = list(packing._cut(shared, 1 << 30, 2)([batch]))
    assert len(found) > 2 and sum(x.num_rows for x in found) == len(texts)
    whole = pa.Table.from_batches(found)
    assert whole["doc_id"].to_pylist() == list(range(len(texts)))
    assert whole["nth"].to_pylist()[1::4] == list(range(0, 16, 2))
    assert {tuple(x) for x in whole["ids"].to_pylist()[2::4]} == {(2,)}
