"""T2 by place: the pages of OFFSET, without sorting for a page."""

import pytest

from catalog_lake.operators.ordering import SortedPages, paginate


def test_every_page_is_the_offset_page(spark, tmp_path):
    df = spark.range(537).selectExpr("id", "concat('n', id % 50) AS name", "IF(id % 9 = 0, NULL, id % 7) AS v").repartition(5)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pages = SortedPages.build(df, ["v", "name", "id"], str(tmp_path / "p"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert pages.total == 537 and len(pages.files) > 3
    for page in (1, 2, 9, 14, 27, 28):
        got = pages.page(page, 20)
        assert [r["id"] for r in got.collect()] == [r["id"] for r in paginate(df, ["v", "name", "id"], page, 20).collect()]
        assert [r["position"] for r in got.collect()] == list(range(20 * page - 19, min(20 * page, 537) + 1)[:20] if page < 28 else [])[:got.count()]
        assert len(got.drop("position").inputFiles()) <= 2  # a page opens the files that hold it
    assert pages.page(27, 20).count() == 17 and pages.page(28, 20).count() == 0
    for bad in ((0, 20), (1, 0), (1, 101)):
        with pytest.raises(ValueError, match="required"):
            pages.page(*bad)


def test_empty_table(spark, tmp_path):
    pages = SortedPages.build(spark.range(0), ["id"], str(tmp_path / "p"))
    assert pages.total == 0 and pages.page(1).count() == 0


def test_load_counts_in_its_own_scan(spark, tmp_path):
    """A4: the files and keys are counted by the scan that loads; no other job reads the rounds."""
    from catalog_lake.plans import load
    from catalog_lake.sources import rounds as rs
    root = str(tmp_path / "rounds")
    rs.write_round(spark.range(100).selectExpr("IF(id < 7, NULL, id) AS article_id", "'p' AS part_name"), root, "articles", "r1", max_records=10)
    (tmp_path / "rounds" / "entity_type=articles" / "crawl_date=r1" / "zero.parquet").write_bytes(b"")
    inc, seen = load._incoming(spark, root, "articles", "newest")
    files = len(rs.listed_files(spark, root, "articles"))
    assert inc.count() == 93
    assert seen.get == {"files": files - 1, "keyless": 7}
    report = {r["entity"]: r for r in load.load_rounds(spark, root, str(tmp_path / "lake")).collect()}["articles"]
    assert (report["rows"], report["skipped_files"], report["keyless"]) == (93, 1, 7)
