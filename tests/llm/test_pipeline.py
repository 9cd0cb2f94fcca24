"""The corpus pipeline, stage by stage, against plain versions on the small tables."""

import corpus_pipeline
from catalog_lake.llm import quality
from tests.conftest import SF_SMALL
from tests.llm.test_decontaminate import _words
from tests.llm.test_quality_and_lines import _brute, _lines_brute
from tests.llm.test_simhash import _closure, _fp


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_SMALL).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        out[name] = (before.collect(), docs.collect())
        if name != "packing":
            assert docs.columns == columns
    before, after = out["quality_rules"]
    verdict = {r["row"]["doc_id"]: r for r in quality.apply_rules(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).collect()}
    for r in before:
        n_words, *_, n_repeat = _brute(r["text"])
        v = verdict[r["doc_id"]]
        assert v["base_failed"] == (n_words < 50 or 100 * n_repeat > 50 * n_words)
    assert sorted(r["doc_id"] for r in after) == sorted(d for d, v in verdict.items() if v["kept"])
    before, after = out["line_dedup"]
    assert sorted(((r["doc_id"], r["text"]) for r in after), key=str) == _lines_brute(
        [(r["doc_id"], r["text"], r["source"]) for r in before], 10)
    assert all(r["n_chars"] == len(r["text"]) for r in after)
    before, after = out["simhash_near_dedup"]
    rows = sorted(before, key=lambda r: r["doc_id"])
    root = _closure([_fp(r["text"]) for r in rows], 3)
    assert sorted(r["doc_id"] for r in after) == sorted(rows[i]["doc_id"] for i in set(root))
    before, after = out["benchmark_decontamination"]
    wins = set()
    for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect():
        w = _words(r["text"])
        k = min(13, len(w))
        wins |= {tuple(w[s:s + k]) for s in range(len(w) - k + 1) if w}
    kept = []
    for r in before:
        w = _words(r["text"])
        hit = {s + i for k in {len(x) for x in wins} for s in range(len(w) - k + 1) if tuple(w[s:s + k]) in wins for i in range(k)}
        if not (hit and 20 * len(hit) >= len(w)):
            kept.append(r["doc_id"])
    assert sorted(r["doc_id"] for r in after) == sorted(kept)
    before, after = out["packing"]
    tokens = {}
    for r in after:
        tokens.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["doc_tokens"]))
    assert set(tokens) == {r["doc_id"] for r in before}
    assert all(sum(n for _, n, _ in p) == p[0][2] for p in tokens.values())


def test_run_gives_the_last_stages_rows(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns[:1] == ["doc_id"] and out.count() > 0
