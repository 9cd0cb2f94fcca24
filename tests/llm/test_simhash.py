"""SimHash near-duplicates (8) against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from catalog_lake.llm import simhash
from catalog_lake.llm.components import components
from tests.llm.conftest import PROSE


def _fp(text, n=3):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    grams = [b" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [b" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def _closure(values, bits):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "one two", "A b\x0bC d\x0ce", "É é x y z ÀB", PROSE * 60])
def test_fingerprint(text):
    assert simhash.fingerprint(text, 3) == _fp(text)


def test_fingerprint_hash_is_sparks(spark):
    assert spark.sql("select xxhash64('a b c')").first()[0] % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("group", [4096, 8])
def test_pairs_close_over_all_links(spark, group):
    rnd = random.Random(group)
    values = set()
    for _ in range(40):
        v = rnd.getrandbits(64)
        for _ in range(6):
            values.add(v)
            for _ in range(rnd.randint(1, 4)):
                v ^= 1 << rnd.randrange(64)
    centre = rnd.getrandbits(64)  # many values that share most of their blocks
    values |= {centre ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for _ in range(120)}
    values |= {0, 2**64 - 1, 1}
    values = sorted(values)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    links = simhash.close_pairs(spark.createDataFrame([(x,) for x in signed], "fp long"), 3, group)
    assert all((a ^ b) % 2**64 != 0 for a, b in links.collect())
    root = {r["node"]: r["root"] for r in components(links).collect()}
    want = _closure(values, 3)
    by_want, by_got = {}, {}
    for x, w in zip(signed, want, strict=True):
        by_want.setdefault(w, set()).add(x)
        by_got.setdefault(root.get(x, x), set()).add(x)
    assert sorted(map(sorted, by_want.values())) == sorted(map(sorted, by_got.values()))


def test_trie_join_is_exact_on_dense_sets():
    rnd = random.Random(3)
    keys = np.unique(np.array([rnd.getrandbits(20) for _ in range(3000)] + [(1 << 48) | rnd.getrandbits(14) for _ in range(900)], np.uint64))
    got = simhash.trie_join(keys, 48, 2)
    parent = np.arange(len(keys))
    for i in range(len(keys)):
        same = (keys[:i] >> np.uint64(48)) == (keys[i] >> np.uint64(48))
        j = np.flatnonzero(same & (np.bitwise_count(keys[:i] ^ keys[i]) <= 2))
        parent = simhash._roots(parent, np.full(len(j), i), j)
    assert np.array_equal(got, parent)


def test_groups_and_kept_rows(spark, make_docs, clash):
    other = " ".join(f"word{i}" for i in range(60))
    docs = make_docs([(5, PROSE), (3, PROSE), (9, PROSE.upper()), (4, other), (4, other), (7, None), (8, ""), (None, other), (None, "alone here now ok")])
    got = sorted(((r["doc"], r["component"]) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (9, 3), (4, 4), (4, 4), (7, 7), (8, 7), (None, 4), (None, None)], key=str)
    kept = simhash.keep_one(clash(docs))
    assert kept.columns == clash(docs).columns
    assert sorted((str(r["doc_id"]) for r in kept.collect())) == ["3", "4", "7", "None"]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.keep_one(docs.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    n = 300
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (1001, 1001)], "a long, b long")
    root = {r["node"]: r["root"] for r in components(links).collect()}
    assert root == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000}
