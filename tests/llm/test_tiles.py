"""Which rows of tiles go on once the sets of a large group are compared with a few of them."""

from wattloom.llm import ngram_join
from wattloom.session import written


def test_tiles_of_members_that_are_together_do_not_go_on(spark, monkeypatch):
    tiles = []

    def counted(df, name):
        out = written(df, name)
        if {"key", "top"} <= set(out.columns):
            tiles.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "written", counted)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*words[:i], f"x{i}", *words[i + 1:]])) for i in range(180)]
    found = ngram_join.similar_sets(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.component_id for r in found.collect()} == {0}
    assert tiles and sum(tiles) == 0
