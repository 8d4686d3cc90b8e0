"""Numbered commits: readers see whole ones, writers in conflict try again."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from curbflow.sources import commits


def test_numbers_grow_and_conflicts_are_reported(spark, tmp_path):
    path = f"file://{tmp_path}/table"
    assert commits.latest(spark, path) is None and commits.numbers(spark, path) == []
    assert commits.commit_next(spark, path, lambda old: {"parts": ["a"]}) == (1, {"parts": ["a"]})
    assert commits.commit_next(spark, path, lambda old: {"parts": [*old["parts"], "é"]})[0] == 2
    assert commits.latest(spark, path) == (2, {"parts": ["a", "é"]})
    assert commits.read_commit(spark, path, 1) == {"parts": ["a"]}
    with pytest.raises(commits.CommitConflict):
        commits.commit(spark, path, 2, {"parts": []})
    assert commits.latest(spark, path) == (2, {"parts": ["a", "é"]})


def test_writers_at_once_lose_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/table"

    def add(i: int) -> None:
        commits.commit_next(spark, path, lambda old: {"parts": [*(old or {"parts": []})["parts"], i]})

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(add, range(12)))
    number, content = commits.latest(spark, path)
    assert number == 12 and sorted(content["parts"]) == list(range(12))
