"""K1/K4 by key range: the same table as a full rewrite, and only touched files written."""

import random

import pytest

from catalog_lake.operators.keyed_table import FEW_TASKS, KeyedTable


def files(t):
    return {f for s in t.slots() for f in s.files}


def rows(t):
    return sorted(tuple(r) for r in t.read().collect())


@pytest.mark.parametrize("text", [False, True])
def test_merges_like_a_dict(spark, tmp_path, text):
    name = (lambda k: f"k{k:04d}é" if k % 3 else f"k{k:04d}") if text else (lambda k: k)
    kind = "string" if text else "long"
    t = KeyedTable(spark, str(tmp_path), "k", f"k {kind}, v long", rows_per_file=50)
    rnd, want = random.Random(3), {}
    assert t.read().count() == 0 and t.versions() == []
    for step in range(6):
        batch = [(name(rnd.choice([rnd.randint(0, 400), rnd.randint(300, 320)])), rnd.randint(0, 9)) for _ in range(rnd.choice([300, 40, 1]))]
        t.upsert(spark.createDataFrame([*batch, (None, 1)], f"k {kind}, v long"))
        new = {}
        for k, v in batch:
            new[k] = min(v, new.get(k, v))
        want.update(new)
        assert rows(t) == sorted(want.items())
        slots = t.slots()
        assert all(a.high < b.low for a, b in zip(slots, slots[1:], strict=False)) and sum(s.rows for s in slots) == len(want)
        assert len(t.versions()) == step + 1
    some = [name(5), name(310), name(9999)]
    assert sorted(tuple(r) for r in t.find(some).collect()) == sorted((k, want[k]) for k in some if k in want)
    assert t.read(1).count() <= 300


def test_one_key_rewrites_one_file(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path), "k", "k long, v string", rows_per_file=1000)
    t.overwrite(spark.range(20_000).selectExpr("id * 2 AS k", "'old' AS v"))
    before = files(t)
    assert len(before) == 20
    for key in (5000, 5001, -7, 99_999):  # there, new between others, below and above all
        before = files(t)
        assert t.upsert(spark.createDataFrame([(key, "new")], "k long, v string")) == 1
        assert len(before - files(t)) == 1 == len(files(t) - before)
        assert [r["v"] for r in t.find([key]).collect()] == ["new"]
    assert t.read().count() == 20_003 and t.read().filter("v = 'new'").count() == 4
    assert t.read(1).filter("v = 'new'").count() == 0  # the old version is whole
    assert t.upsert(spark.createDataFrame([], "k long, v string")) == 0


def test_children_of_a_hot_parent(spark, tmp_path):
    """K4: a parent whose children fill several files is replaced whole; one without new children loses its old ones."""
    t = KeyedTable(spark, str(tmp_path), "p", "p long, c long", rows_per_file=100)
    t.overwrite(spark.range(3000).selectExpr("IF(id < 1000, 7, id) AS p", "id AS c"))
    hot = next(s for s in t.slots() if s.low <= 7 <= s.high)
    assert hot.rows >= 1000
    assert t.merge(spark.range(500).selectExpr("7L AS p", "-id AS c"), spark.createDataFrame([(7,), (2000,)], "p long")) == 2
    assert t.find([7]).count() == 500 and t.find([2000]).count() == 0 and t.read().count() == 500 + 1999
    assert len(next(s for s in t.slots() if s.low <= 7 <= s.high).files) >= 3


def test_tasks_follow_rows_not_files(spark, tmp_path):
    """Far more files than tasks, and still ranges that do not overlap."""
    t = KeyedTable(spark, str(tmp_path), "k", "k long, v long", rows_per_file=10)
    t.overwrite(spark.range(0, 3000).selectExpr("id AS k", "id AS v"))
    tasks = FEW_TASKS
    assert t._tasks(300, 3000) == tasks and len({f.rsplit("/", 1)[1][:10] for f in files(t)}) <= tasks
    slots = t.slots()
    assert len(slots) >= 300 and all(a.high < b.low for a, b in zip(slots, slots[1:], strict=False))
    assert t.upsert(spark.range(0, 3000, 20).selectExpr("id AS k", "-1L AS v")) >= 100
    assert rows(t) == [(k, -1 if k % 20 == 0 else k) for k in range(3000)]
