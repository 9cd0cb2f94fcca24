"""I5 keep-first with evicted state, I6 parked upsert with its epoch ledger, W4 dense ids."""

import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalog_lake.operators.dedup import assign_ids, dense_ids
from catalog_lake.streaming import incremental as inc
from catalog_lake.streaming.keep_first import _first_after, keep_first
from catalog_lake.streaming.parked import Entity, ParkedUpsert

DAY0 = dt.datetime(2024, 1, 1)


def greedy(rows, delay):
    """The rows that no kept row of their key precedes by ``delay`` seconds or less."""
    last, out = {}, []
    for key, at in sorted(rows, key=lambda r: r[1]):
        if key not in last or at > last[key] + delay:
            last[key] = at
            out.append((key, at))
    return sorted(out, key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 60)), st.integers(0, 20))
def test_first_after_is_greedy(times, delay):
    times = np.sort(np.array(times, np.int64))
    want = [at for _, at in sorted(greedy([(0, int(t)) for t in times], delay), key=lambda r: r[1])]
    assert [int(times[k]) for k in _first_after(times, None, delay)] == want
    half = len(times) // 2
    first = _first_after(times[:half], None, delay)
    last = int(times[first[-1]]) if first else None
    assert [int(times[k]) for k in first] + [int(times[half:][k]) for k in _first_after(times[half:], last, delay)] == want


@pytest.mark.parametrize("cuts", [1, 2, 7])
def test_keep_first_does_not_depend_on_the_batches(spark, tmp_path, cuts):
    rnd = random.Random(9)
    rows = sorted(((rnd.choice([None, 1, 2, 3, 50 + k]), k * 600 + rnd.randint(0, 300)) for k in range(700)), key=lambda r: r[1])
    delay = 7200
    for k in range(cuts):
        part = rows[k * len(rows) // cuts:(k + 1) * len(rows) // cuts]
        spark.createDataFrame([(a, DAY0 + dt.timedelta(seconds=b)) for a, b in part], "k long, ts timestamp") \
            .write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("k long, ts timestamp").parquet(str(tmp_path / "in"))
        q = inc.run_to_table(keep_first(stream, "k", "ts", delay), str(tmp_path / "out"), str(tmp_path / "ck"))
    got = sorted(((r["k"], int((r["ts"] - DAY0).total_seconds())) for r in spark.read.parquet(str(tmp_path / "out")).collect()), key=str)
    assert got == greedy(rows, delay)
    # hundreds of keys went through; only those of the last delay are still held
    held = {k for k, t in rows if t > rows[-1][1] - 2 * delay}
    if cuts == 7:
        assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= len(held) + 105 < len({k for k, _ in rows})


PARENT = Entity("p", "p bigint, name string")
RECORD = Entity("r", "r bigint, ref bigint, v string, kids array<int>")
SCHEMA = "kind string, p bigint, name string, r bigint, ref bigint, v string, kids array<int>"


def parent(p, name="n"):
    return ("parent", p, name, None, None, None, None)


def record(r, ref, v="v", kids=()):
    return ("record", None, None, r, ref, v, list(kids))


class Model:
    """The same rules over dicts."""

    def __init__(self):
        self.parents, self.records, self.parked = {}, {}, {}

    def batch(self, rows):
        for kind, p, name, *_ in sorted((r for r in rows if r[0] == "parent" and r[1] is not None), key=lambda r: str(r[2]), reverse=True):
            self.parents[p] = name
        came = {}
        for row in sorted((r for r in rows if r[0] == "record" and r[3] is not None), key=lambda r: (r[4] is not None, r[4], r[5], r[6]), reverse=True):
            came[row[3]] = row[4:]
        waiting = {**self.parked, **came}
        self.parked = {k: v for k, v in waiting.items() if v[0] not in self.parents}
        self.records.update({k: v for k, v in waiting.items() if v[0] in self.parents})

    def check(self, store):
        assert {r["p"]: r["name"] for r in store.parents().collect()} == self.parents
        assert {r["r"]: (r["ref"], r["v"], r["kids"]) for r in store.records().collect()} == {k: tuple(v) for k, v in self.records.items()}
        assert {r["r"]: (r["ref"], r["v"], r["kids"]) for r in store.parked().collect()} == {k: tuple(v) for k, v in self.parked.items()}
        kids = sorted((r["r"], r["child"]) for r in store.children("kids").collect())
        assert kids == sorted((k, c) for k, v in self.records.items() for c in v[2])


def test_parked_upsert_like_the_model(spark, tmp_path):
    store, model, rnd = ParkedUpsert(spark, str(tmp_path / "s"), PARENT, RECORD, "ref"), Model(), random.Random(1)
    model.check(store)  # nothing has come yet
    for epoch in range(5):
        rows = [parent(rnd.choice([None, *range(8)]), rnd.choice("abc")) for _ in range(rnd.randint(0, 3))]
        rows += [record(rnd.choice([None, *range(10)]), rnd.choice([None, *range(9)]), rnd.choice("xyz"), [rnd.randint(0, 3)] * rnd.randint(0, 3)) for _ in range(8)]
        batch = spark.createDataFrame(rows, SCHEMA)
        store.handle(batch, epoch)
        model.batch(rows)
        if epoch == 2:
            assert store.compact() == 2 and store.compact() == 2
        store.handle(spark.createDataFrame([parent(99), record(99, 99)], SCHEMA), epoch)  # the epoch is done: a no-op
        model.check(store)
    assert store.committed() == list(range(5))
    store.handle(spark.createDataFrame([], SCHEMA), 5)
    model.check(store)


def test_epoch_that_died_is_written_again(spark, tmp_path, monkeypatch):
    store = ParkedUpsert(spark, str(tmp_path / "s"), PARENT, RECORD, "ref")
    store.handle(spark.createDataFrame([record(1, 7, "old", [1, 2]), record(2, 8)], SCHEMA), 0)
    monkeypatch.setattr(store, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost before the commit")))
    batch = spark.createDataFrame([parent(7), record(1, 7, "new", [3])], SCHEMA)
    with pytest.raises(RuntimeError):
        store.handle(batch, 1)
    assert store.committed() == [0] and store.records().count() == 0 and store.parked().count() == 2 and store.parents().count() == 0
    monkeypatch.undo()
    store.handle(batch, 1)
    assert [tuple(r) for r in store.records().collect()] == [(1, 7, "new", [3])]
    assert [r["child"] for r in store.children("kids").collect()] == [3]
    assert [(r["r"], r["_epoch"]) for r in store.parked().collect()] == [(2, 0)]


def test_stream_drives_the_store(spark, tmp_path):
    src, store = str(tmp_path / "in"), ParkedUpsert(spark, str(tmp_path / "s"), PARENT, RECORD, "ref")
    for rows in ([record(1, 7), record(2, 8)], [parent(7)], [parent(8), record(1, 7, "again")]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        store.run(spark.readStream.schema(SCHEMA).parquet(src), str(tmp_path / "ck"))
    assert sorted((r["r"], r["v"]) for r in store.records().collect()) == [(1, "again"), (2, "v")] and store.parked().count() == 0


def test_dense_ids_over_many_partitions(spark):
    names = [f"n{k * 7919 % 5000:05d}" for k in range(9000)]
    df = spark.createDataFrame([(n,) for n in [*names, None, "", "ß", "é"]], "n string").repartition(7)
    want = {n: k for k, n in enumerate(sorted({*names, "", "ß", "é"}, key=lambda s: s.encode()), start=1)}
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ids = dense_ids(df, "n")
        assert {r["n"]: r["new_id"] for r in ids.collect()} == want
        assert ids.rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    base = spark.createDataFrame([(100,)], "b long")
    got = {r["n"]: r["new_id"] for r in assign_ids(df, "n", base).collect()}
    assert got == {n: k + 99 for n, k in want.items() if n}
    assert dense_ids(df.filter(F.lit(False)), "n").count() == 0 and assign_ids(df.filter(F.lit(False)), "n", 5).count() == 0
