"""Numbers are given out once, pointers move at once."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from modelyard.sources import commits
from modelyard.sources.commits import CommitLog, point, pointed, put


def test_numbers_are_given_out_once(spark, tmp_path):
    log = CommitLog(spark, f"file://{tmp_path}/log", "name string, n bigint")
    assert log.last() == 0 and log.read().count() == 0
    assert log.append(lambda n: {"name": "a", "n": n}) == 1
    stale = CommitLog(spark, f"file://{tmp_path}/log", "name string, n bigint")
    stale.last = lambda: 0  # a writer that read before the first commit
    assert stale.append(lambda n: {"name": "b", "n": n}) == 2
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda i: log.append(lambda n: {"name": str(i), "n": n}), range(8)))
    assert sorted(numbers) == list(range(3, 11))
    assert all(r.n == r.number for r in log.read().collect()) and log.read().count() == 10


def test_put_does_not_replace_unless_told(spark, tmp_path):
    path = f"file://{tmp_path}/x/y.json"
    assert put(spark, path, "one") and not put(spark, path, "two")
    assert spark.read.text(path).first()[0] == "one"
    assert put(spark, path, "three", replace=True) and spark.read.text(path).first()[0] == "three"


def test_a_failure_before_the_swap_leaves_the_old_target(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/latest"
    point(spark, path, "first")

    class Broken(Exception):
        pass

    def fail(*args, **kwargs):
        raise Broken

    monkeypatch.setattr(commits, "put", fail)
    with pytest.raises(Broken):
        point(spark, path, "second")
    monkeypatch.undo()
    assert pointed(spark, path) == "first"
    point(spark, path, "second")
    assert pointed(spark, path) == "second"
