"""Periodic runs (12) against a brute-force version."""

import hashlib
import random
import time
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from catalog_lake.llm import periodic_runs as pr
from catalog_lake.llm import queries


def brute(w):
    """Every stretch that is maximal for its own smallest period, from all lags."""
    n, out = len(w), set()
    for q in range(1, n // 4 + 1):
        k = q
        while k < n:
            start = k - q
            while k < n and w[k] == w[k - q]:
                k += 1
            length = k - start
            x = w[start:k]
            if length >= max(6, 4 * q) and q == next(p for p in range(1, length + 1) if x[p:] == x[:length - p]):
                out.add((start, length, q))
            k += 1
    return sorted(out)


def expected(doc, text):
    words = [x for x in (text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if x]
    h, n = (zlib.crc32(str(doc).encode()), len(words)) if doc is not None else (1, len(words))
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    return (doc, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(words) if i not in gone).encode()).hexdigest())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=6), st.integers(1, 9)), max_size=9))
def test_runs_are_all_runs(parts):
    words = list("".join(u * n for u, n in parts))
    runs = pr.find_runs(words)
    assert runs == brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    assert pr.collapse(words, runs) == [x for i, x in enumerate(words) if i not in gone]


def test_long_equal_and_random_words_end_soon():
    rnd = random.Random(5)
    start = time.time()
    assert pr.find_runs(["a"] * 300_000) == [(0, 300_000, 1)]
    assert pr.find_runs(["a", "b"] * 150_000 + ["a"]) == [(0, 300_001, 2)]
    assert pr.find_runs([str(i % 7919) for i in range(40_000)]) == [(0, 40_000, 7919)]
    words = [rnd.choice("ab") for _ in range(3000)]
    assert pr.find_runs(words) == brute(words)
    pr.find_runs([rnd.choice("ab") for _ in range(100_000)])
    assert time.time() - start < 30


TEXTS = [None, "", " \t\n", "a " * 5, "a " * 6, "x y " * 4 + "x", "b a b c " * 9 + "tail", "one two three four five six seven", " a " * 7, "a\x0b" * 9 + "é é é é é é",
         " ".join(str(i) for i in range(300)), "w " * 20000]


def test_against_brute_force(spark, make_docs, clash):
    rows = [(i + 100 * k, t) for k in range(12) for i, t in enumerate(TEXTS[:-1])] + [(7, TEXTS[10]), (7, TEXTS[10]), (None, "a " * 9), (5000, TEXTS[-1])]
    docs = clash(make_docs(rows)).drop("doc").repartition(4)
    got = [tuple(r) for r in pr.periodic_runs(docs, with_loops=True).collect()]
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows) > 5
    want = [expected(d, t) if t != TEXTS[-1] else
            (d, 1, 0, 20000, 1, 20_000_000, hashlib.sha256(b"0,20000,1\n").hexdigest(), hashlib.sha256(b"w").hexdigest()) for d, t in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_spans_and_empty_table(spark, make_docs):
    docs = make_docs([(1, "go on and " * 5 + "stop")])
    r = pr.periodic_runs(docs, with_spans=True).first()
    assert [tuple(x) for x in r["runs"]] == [(0, 15, 3)] and r["collapsed"] == "go on and stop"
    assert pr.periodic_runs(docs.limit(0)).count() == 0


def test_query(spark, make_docs, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS[:-1] * 3)]
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(expected(d, t)) for d, t in rows)
