"""Sources and sinks A1–A16 on temp dirs (the reference's failure table as edge cases)."""

import json
import os


from catalog_lake.sources import files as fl
from catalog_lake.sources import rounds as rs


def _write_lines(path, lines, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as f:
        f.write("\n".join(lines) + "\n")


def test_read_entity_explicit_schema_blank_and_bad_lines(spark, tmp_path):
    p = str(tmp_path / "articles" / "part-0.json")
    _write_lines(p, [json.dumps({"article_id": "12", "part_name": "Filtre", "is_oem": True}), "",
                     "{not json", json.dumps({"article_id": 13, "part_name": "Disque"}),
                     json.dumps({"article_id": None, "part_name": "no key"})])
    df = rs.read_entity(spark, str(tmp_path / "articles"), "articles")
    all_rows = df.collect()
    rows = {r["part_name"]: r for r in all_rows if r["part_name"]}
    assert rows["Filtre"]["article_id"] == 12          # string id parsed by the explicit schema
    assert rows["Disque"]["article_id"] == 13
    assert sum(1 for r in all_rows if r["_corrupt_record"] is not None) == 1
    assert len(all_rows) == 4                          # blank line skipped (A15)
    inferred = rs.read_entity(spark, str(tmp_path / "articles"), infer=True)
    assert "article_id" in inferred.columns            # A1


def test_rounds_roundtrip_corrupt_files_and_round_order(spark, tmp_path):
    root = str(tmp_path / "rounds")
    a = spark.createDataFrame([(1, "old"), (2, "old"), (2, "old-dup")], "article_id long, part_name string")
    b = spark.createDataFrame([(2, "new"), (3, "new"), (3, "new-dup")], "article_id long, part_name string")
    rs.write_round(a.coalesce(1), root, "articles", "r9")
    rs.write_round(b.coalesce(1), root, "articles", "r10")
    d = os.path.join(root, "entity_type=articles", "crawl_date=r10")
    open(os.path.join(d, "zero.parquet"), "wb").close()
    with open(os.path.join(d, "garbage.parquet"), "wb") as f:
        f.write(b"this is not parquet")
    rounds = rs.read_rounds(spark, root, "articles")
    assert rounds.count() == 6
    skipped = rs.skipped_files(spark, root, "articles", rounds).collect()
    assert sorted(os.path.basename(r["_file"]) for r in skipped) == ["garbage.parquet", "zero.parquet"]
    newest = {r["article_id"]: r["part_name"] for r in rs.dedup_rounds(rounds, "article_id").collect()}
    assert newest == {1: "old", 2: "new", 3: "new"}      # r10 is newer than r9 (quirk 5 fixed)
    oldest = {r["article_id"]: r["part_name"] for r in rs.dedup_rounds(rounds, "article_id", "oldest").collect()}
    assert oldest == {1: "old", 2: "old", 3: "new"}


def test_max_records_per_file_and_partition_label(spark, tmp_path):
    root = str(tmp_path / "r")
    df = spark.range(2500).withColumnRenamed("id", "article_id")
    path = rs.write_round(df.coalesce(1), root, "articles", "2026-05-16", max_records=1000)
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert len(files) == 3                                # A7: 1000-record chunks
    rounds = rs.read_rounds(spark, root, "articles")
    assert dict(rounds.dtypes)["crawl_date"] == "string"  # D29
    assert rounds.select("round_no").distinct().first()[0] == 20260516


def test_snapshot_publish_and_current(spark, tmp_path):
    root = str(tmp_path / "lake")
    assert rs.current(spark, root, "articles") is None
    v1 = rs.write_snapshot(spark.range(10).withColumnRenamed("id", "article_id"), root, "articles")
    rs.publish(spark, v1)
    v2 = rs.write_snapshot(spark.range(20).withColumnRenamed("id", "article_id"), root, "articles", num_files=2)
    assert rs.current(spark, root, "articles").count() == 10   # not live until published
    rs.publish(spark, v2)
    assert rs.current(spark, root, "articles").count() == 20
    status = rs.load_all(spark, root, lambda e, df: df.count())
    got = {r["entity"]: (r["status"], r["rows"]) for r in status.collect()}
    assert got["articles"] == ("loaded", 20) and got["models"][0] == "missing"  # A14


def test_convert_all_skips_missing_and_reports(spark, tmp_path):
    src = str(tmp_path / "jsonl")
    _write_lines(os.path.join(src, "manufacturers", "a.json"),
                 [json.dumps({"manufacturer_id": 5, "name": "FORD", "url": "/models/manufacturer-id-5/"})])
    out = rs.convert_all(spark, src, str(tmp_path / "pq"), "2026-05-16")
    got = {r["entity"]: (r["status"], r["rows"]) for r in out.collect()}
    assert got["manufacturers"] == ("converted", 1)
    assert got["articles"] == ("missing", 0)


def test_append_entity_and_manifest(spark, tmp_path):
    df = spark.createDataFrame([(1, 1, "u", "cached")], "article_id long, image_index int, url string, status string")
    fl.append_manifest(df, str(tmp_path / "m"))
    fl.append_manifest(df, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).count() == 2
    rs.append_entity(df, str(tmp_path), "images_manifest")
    assert spark.read.json(str(tmp_path / "images_manifest")).count() == 1
    assert rs.sample_raw(df, 1).count() == 1


def test_allowlist_encodings(spark, tmp_path):
    p1 = tmp_path / "a.txt"
    p1.write_bytes("﻿Citroën\n\n# comment\n  Škoda  \r\nFORD\n".encode("utf-8"))
    names = [r["name"] for r in fl.read_allowlist(spark, str(p1)).orderBy("line_no").collect()]
    assert names == ["Citroën", "Škoda", "FORD"]
    p2 = tmp_path / "b.txt"
    p2.write_bytes("Citroën\nRENAULT\n".encode("latin-1"))
    names = [r["name"] for r in fl.read_allowlist(spark, str(p2)).orderBy("line_no").collect()]
    assert names == ["Citroën", "RENAULT"]


def test_load_rounds_idempotent_and_picks_up_orphans(spark, tmp_path):
    """E2 cycle: dedup newest round, FK-filter details, upsert, publish; K8 on reload."""
    from catalog_lake.plans.load import load_rounds
    from catalog_lake.sources.schemas import SCHEMAS
    rounds, lake = str(tmp_path / "rounds"), str(tmp_path / "lake")
    art = lambda rows: spark.createDataFrame(
        [{"article_id": a, "part_name": n} for a, n in rows], SCHEMAS["articles"])
    cars = [{"car_type_id": 7, "model_series_id": 5, "manufacturer_name": "FORD", "model_name": "KUGA",
             "engine_or_variant": "1.5", "year_from": "2013", "year_to": "", "extra_qualifier": ""}]
    det = lambda rows: spark.createDataFrame(
        [{"article_id": a, "article_name": n, "compatible_cars": cars} for a, n in rows], SCHEMAS["article_details"])
    rs.write_round(art([(1, "a1"), (2, "b1")]), rounds, "articles", "r1")
    rs.write_round(det([(1, "d1"), (3, "orphan")]), rounds, "article_details", "r1")
    first = {r["entity"]: (r["rows"], r["skipped"]) for r in load_rounds(spark, rounds, lake).collect()}
    assert first["articles"] == (2, 0) and first["article_details"] == (1, 1)
    assert first["compatible_cars"][0] == 1
    rs.write_round(art([(2, "b2"), (3, "c2")]), rounds, "articles", "r2")
    load_rounds(spark, rounds, lake)
    again = {r["entity"]: (r["rows"], r["skipped"]) for r in load_rounds(spark, rounds, lake).collect()}
    assert again["article_details"] == (2, 0)                       # K8: the orphan is loaded now
    names = {r["article_id"]: r["part_name"] for r in rs.current(spark, lake, "articles").collect()}
    assert names == {1: "a1", 2: "b2", 3: "c2"}                     # newest round wins
    assert rs.current(spark, lake, "compatible_cars").count() == 2  # children replaced, not duplicated


def test_materialised_catalogue_is_reused(spark):
    """A second Catalog over unchanged inputs reads the tables the first one published."""
    from catalog_lake.binding import Catalog
    from catalog_lake.session import checkpoint_dir
    from tests.conftest import SF_SMALL
    a = Catalog(spark, SF_SMALL)
    n = a.compatible_cars.count()
    base = f"{checkpoint_dir(spark).rstrip('/')}/catalog-{a._fingerprint()}"
    assert os.path.exists(os.path.join(base.replace("file:", ""), "compatible_cars", "_SUCCESS"))
    before = sorted(os.listdir(base.replace("file:", "")))
    b = Catalog(spark, SF_SMALL)
    assert b._fingerprint() == a._fingerprint() and b.compatible_cars.count() == n
    assert sorted(os.listdir(base.replace("file:", ""))) == before        # nothing rewritten
    assert not [d for d in before if d.startswith("_tmp-")]                 # no half-published table
    lazy = Catalog(spark, SF_SMALL, materialize=False).compatible_cars
    assert lazy.count() == n
