"""Packing (2): exact round trip of every id, full windows, the level rule."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from catalog_lake.llm import packing
from tests.llm.conftest import PROSE

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", "a", PROSE * 30, PROSE * 3, "日本語のテキスト 😀 mixed", "tabs\t\n\n  and   runs \r\n", "x" * 5000, "<|endoftext|> is text",
         "ß  é 12.5%", PROSE * 200]


@pytest.fixture(scope="module")
def ids():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return {i: np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4") for i, x in enumerate(TEXTS)}


def test_encoder_is_the_tokenizers(ids):
    enc = packing.encoder(PATH)
    assert enc.fast is not None
    for i, x in enumerate(TEXTS):
        assert np.array_equal(np.frombuffer(enc.ids(x or ""), "<u4"), ids[i][:-1])


def test_every_id_once(spark, make_docs, ids):
    docs = make_docs(list(enumerate(TEXTS))).repartition(3)
    rows = packing.pack(docs, PATH, with_ids=True).collect()
    for d, want in ids.items():
        mine = sorted((r["start"], r) for r in rows if r["doc"] == d)
        assert np.array_equal(np.concatenate([np.frombuffer(r["ids"], "<u4") for _, r in mine]), want)
        at = 0
        for start, r in mine:
            assert (start, r["doc_tokens"]) == (at, len(want)) and r["ids_crc32"] == zlib.crc32(r["ids"])
            assert r["length"] == len(r["ids"]) // 4 > 0
            at += r["length"]
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 1024 or at & (at - 1) == 0 and at < 1024  # nothing is padded


def test_edge_tables(spark, make_docs, clash):
    docs = make_docs([(1, "same"), (1, "same"), (None, "no id")])
    got = packing.pack(clash(docs).drop("doc"), PATH).collect()
    whole = {r["doc"]: r["doc_tokens"] for r in got}
    assert set(whole) == {1, None} and sum(r["length"] for r in got) == 2 * whole[1] + whole[None]
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_level_minimises_the_sum_of_squares():
    rnd = np.random.default_rng(1)
    for _ in range(300):
        levels = packing.SumOfSquares(16)
        levels.count[1:16] = rnd.integers(0, 4, 15)
        size = int(rnd.integers(1, 17))
        costs = {}
        for h in range(17 - size):
            if h and not levels.count[h]:
                continue
            n = levels.count.copy()
            n[h] -= h > 0
            n[h + size] += h + size < 16
            costs[h] = int((n[1:16] ** 2).sum())
        assert costs[levels.level(size)] == min(costs.values())


MARKED = ["<|endoftext|> is text", "a <|endoftext|>b<|endoftext|>", "é <|endoftext|>", "<|endoftex|>", "<|ENDOFTEXT|>", PROSE * 30 + "<|endoftext|>"]


def test_queries_give_the_ids_of_the_tokenizer_as_loaded(spark, make_docs, tmp_path):
    import corpus_pipeline
    from catalog_lake.llm import queries
    t = Tokenizer.from_file(PATH)
    texts = [*TEXTS, *MARKED]
    want = {i: [*t.encode(x or "", add_special_tokens=False).ids, 0] for i, x in enumerate(texts)}
    assert want[8] == [50256, 318, 2420, 0]
    enc = packing.encoder(PATH, as_loaded=True)
    assert enc.fast is not None
    for i, x in enumerate(texts):
        assert np.frombuffer(enc.ids(x or ""), "<u4").tolist() == want[i][:-1]
    docs = make_docs(list(enumerate(texts)))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for out in (queries.op2_packing(spark, str(tmp_path)), corpus_pipeline.pack(spark, docs, str(tmp_path))):
        rows = out.collect()
        assert {r["doc_id"] for r in rows} == set(want)
        for r in rows:
            ids = np.array(want[r["doc_id"]][r["start"]:r["start"] + r["length"]], "<u4")
            assert (r["doc_tokens"], r["ids_crc32"]) == (len(want[r["doc_id"]]), zlib.crc32(ids.tobytes()))
