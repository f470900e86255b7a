import pytest

from scorebook.llm.shared import blocks, scratch


def test_a_folder_of_one_machine_is_refused_on_a_cluster(spark, monkeypatch):
    assert scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    monkeypatch.setattr(spark.sparkContext, "master", "yarn")
    with pytest.raises(ValueError, match="executors"):
        scratch(spark, "x")


def test_blocks_hold_neighbours_within_bounds():
    texts = ["a" * 5, None, "", "b" * 20, "c", "d" * 9, "e"]
    found = [texts[part] for part in blocks(texts, 10, 3)]
    assert sum(found, []) == texts
    assert all(len(b) == 1 or (len(b) <= 3 and sum(len(t or "") for t in b) <= 10) for b in found)
    assert list(blocks([], 10, 3)) == []
