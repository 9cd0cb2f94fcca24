"""Suffix-array dedup (4) against every string, substring dedup (9) against planted passages."""

import hashlib
import random

import numpy as np
import pytest

from catalog_lake.llm import substring_dedup, suffix_dedup


def _brute(rows, length=50):
    least = {}
    for d, t in rows:
        b = (t or "").encode()
        if d is not None:
            for i in range(len(b) - length + 1):
                w = b[i:i + length]
                least[w] = min(least.get(w, d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1 if d is not None else 0):
            if least[b[i:i + length]] < d:
                gone[i:i + length] = True
        gone = gone[:len(b)]
        kept = bytes(np.frombuffer(b, np.uint8)[~gone]) if len(b) else b""
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_suffixes_match_brute_force(spark, make_docs, clash, seed):
    rnd = random.Random(seed)
    alphabet = ["ab", "abcdefgh é", "abcdefghijklmnopqrstuvwxyz  ,."][seed - 1]
    say = lambda n: "".join(rnd.choice(alphabet) for _ in range(n))
    pool = [say(n) for n in (49, 50, 51, 60, 75, 120, 300, 900)]
    rows = []
    for i in range(70):
        t = "".join(rnd.choice([say(rnd.randint(0, 90)), rnd.choice(pool), rnd.choice(pool)[rnd.randint(0, 20):]]) for _ in range(rnd.randint(0, 5)))
        rows.append((rnd.randint(-5, 60), t))
    rows += [(100, None), (101, ""), (None, pool[6]), rows[3], rows[3], (rows[4][0], "another " + pool[7]), (200, rows[5][1]),
             (201, rows[5][1]), (202, "x" * 4000), (203, "y" + "x" * 3000)]
    out = suffix_dedup.remove_repeats(clash(make_docs(rows)))
    assert sorted((tuple(r) for r in out.collect()), key=str) == _brute(rows)


def test_suffix_kept_bytes_and_empty_table(spark, make_docs):
    shared = "".join(chr(97 + i % 26) + str(i) for i in range(40))
    docs = make_docs([(1, "a " + shared), (2, "b " + shared + " tail"), (3, "short")])
    kept = {r["doc"]: bytes(r["kept"]) for r in suffix_dedup.remove_repeats(docs, with_text=True).collect()}
    assert kept == {1: ("a " + shared).encode(), 2: b"b tail", 3: b"short"}
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_many_documents_share_one_passage(spark, make_docs):
    """One group larger than a bucket: its suffixes are compared across boundaries."""
    rnd = random.Random(9)
    passage = "".join(rnd.choice("abcdefghij ") for _ in range(130))
    rows = [(i, f"{rnd.getrandbits(64):x} {passage}{rnd.getrandbits(64):x}") for i in range(400)]
    out = suffix_dedup.remove_repeats(make_docs(rows))
    assert sorted((tuple(r) for r in out.collect()), key=str) == _brute(rows)


@pytest.mark.parametrize("small", [1, 7, 10_000])
@pytest.mark.parametrize("values", [1, 3, 1 << 60])
def test_multikey_sort_ranks(small, values):
    rng = np.random.default_rng(2)
    words = [rng.integers(0, values, 500).astype(np.uint64) for _ in range(4)]
    rank = suffix_dedup.multikey_sort(words, small)
    rows = list(zip(*[w.tolist() for w in words], strict=True))
    assert rank.tolist() == [sum(o < r for o in rows) for r in rows]
    assert len(suffix_dedup.multikey_sort([np.empty(0, np.uint64)] * 2, small)) == 0


@pytest.mark.parametrize("values", [1, 2, 7, 1 << 40])
def test_compact_windows_are_the_minima_of_all_ranges(values):
    """Every range of at least the width lies in one window whose minimum is its own, the leftmost of equal ones."""
    v = np.random.default_rng(5).integers(0, values, 60).astype(np.uint64)
    nodes = substring_dedup.compact_windows(v, 7)
    for lo in range(60):
        for hi in range(lo + 7, 61):
            c = lo + int(v[lo:hi].argmin())
            assert sum(n[1] == c and n[0] <= lo and hi <= n[2] for n in nodes) == 1
    assert all(hi - lo >= 7 and v[lo:hi].argmin() == c - lo for lo, c, hi in nodes)
    assert substring_dedup.compact_windows(v[:6], 7) == []


def test_planted_passages_are_linked_and_clean_documents_left(spark, make_docs, clash):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("bcdfglmnprst") + rnd.choice("aeiou") for _ in range(rnd.randint(1, 4)))
    say = lambda n: [word() for _ in range(n)]
    text = lambda w: " ".join(w)
    same, near, wide = say(60), say(120), say(55)
    edited = [word() if i % 55 == 30 else w for i, w in enumerate(near)]
    rows = [(1, text(say(200) + same + say(90))), (2, text(say(20) + same + say(300))),
            (3, text(say(40) + near + say(30))), (4, text(say(10) + edited)),
            (5, text(say(300))), (6, text(say(49))), (7, None), (8, ""), (None, text(same))]
    rows += [(100 + i, text(say(30) + wide + say(30))) for i in range(40)]  # more documents than are paired off
    rows += [(300, rows[4][1]), (301, rows[4][1]), (300, rows[4][1])]
    docs = make_docs(rows)
    out, links = substring_dedup.near_duplicate_passages(clash(docs))
    got = {}
    for r in out.collect():
        got.setdefault(r["doc"], []).append((r["class_id"], r["n_links"] > 0))
    assert got[1] == got[2] == [(1, True)] and got[3] == got[4] == [(3, True)]
    assert all(got[100 + i] == [(100, True)] for i in range(40))
    assert got[5] == [(5, True)] and got[301] == [(5, True)] and got[300] == [(5, True)] * 2
    assert got[6] == [(6, False)] and got[None] == [(None, False)] and got[7] == [(7, False)] and got[8] == [(8, False)]
    span = links.where("a = 1 and b = 2").first()
    assert (span["to_a"] - span["from_a"], span["similarity"]) == (60, 1.0)
    empty, _ = substring_dedup.near_duplicate_passages(docs.limit(0))
    assert empty.count() == 0


def _say(rnd, n):
    return ["".join(rnd.choice("bcdfglmnprst") + rnd.choice("aeiou") for _ in range(rnd.randint(2, 5))) for _ in range(n)]


def _similar(a, b, words=50, similarity=0.8):
    """Some passages of so many words of the two texts are similar: all against all, over sets of five-word tuples."""
    def windows(w):
        s = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        return [set(s[i:i + words - 4]) for i in range(len(s) - words + 5)]
    return any(len(x & y) >= similarity * len(x | y) for x in windows(a) for y in windows(b))


def _linked(texts):
    """(class, number of links) of every text by all its pairs."""
    with_link = {(i, j) for i in texts for j in texts if i < j and _similar(texts[i], texts[j])}
    root = {i: i for i in texts}
    for _ in texts:
        for i, j in sorted(with_link):
            root[i] = root[j] = min(root[i], root[j])
    return {i: (root[i], sum(i in p for p in with_link)) for i in texts}


@pytest.mark.parametrize("block", [3, 256])
def test_signature_of_many_documents_links_them_all(spark, make_docs, monkeypatch, block):
    """A passage in 40 documents, and versions that drift from one to the next, against all pairs."""
    monkeypatch.setattr(substring_dedup, "BLOCK", block)
    rnd = random.Random(6)
    shared, version = _say(rnd, 80), _say(rnd, 80)
    verbatim = {i: _say(rnd, 10 + i % 7) + shared + _say(rnd, 12) for i in range(40)}
    drift = {}
    for i in range(100, 109):  # each version ends a dozen words later, and has lost as many at the start
        drift[i] = list(version)
        version = version[12:] + _say(rnd, 12)
    out, links = substring_dedup.near_duplicate_passages(make_docs([(i, " ".join(w)) for i, w in {**verbatim, **drift}.items()]))
    got = {r["doc"]: (r["class_id"], r["n_links"], r["n_words"]) for r in out.collect()}
    assert all(got[i] == (0, 39, 80) for i in verbatim)
    want = _linked(drift)
    assert {i: got[i][:2] for i in drift} == want and len({n for _, n in want.values()}) > 1
    assert links.where("a < 100").select("a", "b").distinct().count() == 40 * 39 // 2


def test_short_passages_with_one_edit_at_every_place():
    """Every similar passage of 50 words is found, wherever its edit is, against all pairs of ranges."""
    rnd = random.Random(12)
    hashes = lambda w: substring_dedup.shingles(" ".join(w).encode())
    cases = [(n, at) for n in (50, 55, 60) for at in range(n)] + [(n, None) for n in (43, 44, 45, 46, 49, 50)]
    seen = set()
    for n, at in cases:
        passage = _say(rnd, n)
        edited = [f"{w}x" if i == at else w for i, w in enumerate(passage)]
        a, b = _say(rnd, 30) + passage + _say(rnd, 25), _say(rnd, 9) + edited + _say(rnd, 40)
        found = substring_dedup.passages(hashes(a), hashes(b), 46, 0.8)
        assert bool(found) == _similar(a, b), (n, at)
        seen.add(bool(found))
        for p, q, r, s, similarity in found:
            x, y = set(hashes(a)[p:q].tolist()), set(hashes(b)[r:s].tolist())
            assert q - p >= 46 and s - r >= 46 and similarity == len(x & y) / len(x | y) >= 0.8
    assert seen == {True, False}


def test_ranges_that_share_too_little_are_not_searched(monkeypatch):
    """A shared line of ten words and a repeated one leave no similar passage, which is seen without a search; a long enough one is searched."""
    rnd = random.Random(15)
    x = lambda w: substring_dedup.shingles(" ".join(w).encode())
    line, own = _say(rnd, 10), [_say(rnd, 70) for _ in range(4)]
    short = own[0] + line + own[1], own[2] + line * 3 + own[3]
    few = own[0] + ["so"] * 60, own[2] + ["so"] * 60  # one shingle again and again is a passage
    assert substring_dedup.passages(x(few[0]), x(few[1]), 46, 0.8)
    monkeypatch.setattr(substring_dedup, "_stretch", None)
    assert substring_dedup.passages(x(short[0]), x(short[1]), 46, 0.8) == substring_dedup.passages(x(short[1]), x(short[0]), 46, 0.8) == []
    with pytest.raises(TypeError):
        substring_dedup.passages(x(few[0]), x(few[1]), 46, 0.8)


def test_short_passages_of_few_words():
    """Shingles that come again, and moved parts: what all pairs of ranges show is found."""
    rnd = random.Random(13)
    for _ in range(60):
        part = [rnd.choice("ab") for _ in range(60)] if rnd.random() < 0.5 else _say(rnd, 60)
        cut = rnd.randrange(60)
        other = part[cut:] + part[:cut] if rnd.random() < 0.5 else [w for i, w in enumerate(part) if i % rnd.randint(20, 40)]
        a, b = _say(rnd, rnd.randint(0, 20)) + part, other + _say(rnd, rnd.randint(0, 20))
        xa, xb = (substring_dedup.shingles(" ".join(w).encode()) for w in (a, b))
        assert bool(substring_dedup.passages(xa, xb, 46, 0.8)) >= _similar(a, b)


@pytest.mark.parametrize("block", [5, 256])
def test_windows_that_no_candidate_needs_are_dropped(monkeypatch, block):
    """Against all windows by all others; and two documents' candidates are the same without the windows dropped."""
    monkeypatch.setattr(substring_dedup, "BLOCK", block)
    rng = np.random.default_rng(3)
    for n in (0, 1, 30, 90):
        c = rng.integers(0, 400, n)
        e = c + rng.integers(0, 20, n) * (rng.random(n) < 0.3)
        at = np.column_stack([rng.integers(0, 6, n), c - rng.integers(0, 40, n), c, e, e + 1 + rng.integers(0, 40, n)]).astype(np.int32)
        near = [[q for q in range(n) if at[q, 1] <= at[p, 3] and at[p, 2] < at[q, 4] and at[p, 1] <= at[q, 3] and at[q, 2] < at[p, 4]] for p in range(n)]
        centre = [len({at[q, 0] for q in near[p]}) >= 3 for p in range(n)]
        keep = substring_dedup.supported(at, 3)
        assert keep.tolist() == [any(centre[q] for q in near[p]) for p in range(n)]
        other = at + np.array([0, 7, 7, 7, 7], np.int32)  # the same windows, some of them gone
        there = rng.random(n) < 0.7
        meet = lambda k: np.column_stack([at, other[:, 1:]])[k].astype(np.int64)
        if there.any():
            both = np.zeros(n, bool)
            both[there] = keep[there] & substring_dedup.supported(other[there], 3)
            assert substring_dedup.overlaps(meet(there), 3, 10) == substring_dedup.overlaps(meet(both), 3, 10)


def test_a_common_line_makes_few_documents_meet(spark, make_docs):
    """Documents of their own words around one line: without enough functions' windows there, none of the pairs meets."""
    rnd = random.Random(9)
    line = []
    while sum(int(substring_dedup._mix(substring_dedup.shingles(" ".join(line).encode()) ^ seed).min(initial=2**64 - 1)) < 2**64 // 150
              for seed in substring_dedup._SEEDS[:6]) not in (1, 2):  # the line's windows are those of so many functions
        line = _say(rnd, 12)
    texts = {i: _say(rnd, 60) + line + _say(rnd, 60) for i in range(60)}
    docs = make_docs([(i, " ".join(w)) for i, w in texts.items()])
    reps = substring_dedup.identify(docs, "doc_id", "text")
    packed = substring_dedup.distinct_texts(docs, reps.select("doc", "v", "ta", "tb"), "doc_id", "text")
    repeats = substring_dedup.repeated(packed, lambda t: substring_dedup._signatures(substring_dedup.shingles(t), 46, 6)[0])
    rows = [substring_dedup._windows(packed, repeats, 46, 6, n).collect() for n in (1, 3)]
    assert len(rows[1]) < 0.5 * len(rows[0]) and rows[0]
    out, links = substring_dedup.near_duplicate_passages(docs)
    assert links.count() == 0 and {(r["class_id"] == r["doc"], r["n_links"]) for r in out.collect()} == {(True, 0)}


def test_repeated_words_make_few_windows():
    """Equal words, and a word pair that alternates: one row per run and function."""
    for words in (["word"] * 20_000, ["one", "two", "three"] * 7_000, _say(random.Random(1), 300) + ["word"] * 20_000):
        x = substring_dedup.shingles(" ".join(words).encode())
        sig, at = substring_dedup._signatures(x, 46, 6)
        assert len(sig) <= 6 * 60 and (at[:, 1] <= at[:, 2]).all() and (at[:, 2] <= at[:, 3]).all() and (at[:, 3] < at[:, 4]).all()
        v = substring_dedup._mix(x ^ substring_dedup._SEEDS[0])
        mine = at[:, 0] == 0
        assert (v[at[mine, 2]] == sig[mine]).all() and (v[at[mine, 3]] == sig[mine]).all()


def test_documents_of_repeated_words_are_linked(spark, make_docs):
    """Long runs of equal words in several documents, alone and inside other text."""
    rnd = random.Random(15)
    own = {i: _say(rnd, 120) for i in range(5)}
    texts = {0: ["word"] * 20_000, 1: ["word"] * 500, 2: own[0] + ["word"] * 20_000 + own[1], 3: own[2] + ["word"] * 60 + own[3],
             4: ["left", "right"] * 5_000, 5: own[4] + ["left", "right"] * 400, 6: _say(rnd, 400)}
    out, links = substring_dedup.near_duplicate_passages(make_docs([(i, " ".join(w)) for i, w in texts.items()]))
    got = {r["doc"]: (r["class_id"], r["n_links"]) for r in out.collect()}
    assert got == {0: (0, 3), 1: (0, 3), 2: (0, 3), 3: (0, 3), 4: (4, 1), 5: (4, 1), 6: (6, 0)}
    words = {r["doc"]: r["n_words"] for r in out.collect()}
    assert words[0] == 20_000 and words[1] == 500 and words[4] == 10_000 and 20_000 <= words[2] < 20_240 and words[6] == 0


def test_recall_of_planted_near_passages(spark, make_docs):
    """Pairs of passages of 60 to 120 words with edits, at a similarity of 0.8 or a little more, inside other words."""
    rnd = random.Random(16)
    rows, pairs = [], 120
    for k in range(pairs):
        n = rnd.randint(60, 120)
        passage = _say(rnd, n)
        edited = list(passage)
        for at in rnd.sample(range(n), max(1, n // 60)):
            edited[at] += "x"
        rows += [(2 * k, " ".join(_say(rnd, rnd.randint(20, 300)) + passage + _say(rnd, rnd.randint(20, 300)))),
                 (2 * k + 1, " ".join(_say(rnd, rnd.randint(20, 300)) + edited + _say(rnd, rnd.randint(20, 300))))]
    out, _ = substring_dedup.near_duplicate_passages(make_docs(rows))
    root = {r["doc"]: r["class_id"] for r in out.collect()}
    found = sum(root[2 * k] == root[2 * k + 1] for k in range(pairs))
    assert found >= 0.9 * pairs and all(root[2 * k] == 2 * k for k in range(pairs))


def test_windows_of_many_documents_are_those_of_each():
    """Laid end to end, empty, short and repeated texts among them."""
    rnd = random.Random(21)
    texts = [_say(rnd, n) for n in (0, 3, 50, 49, 400, 51)] + [["word"] * 300, _say(rnd, 90) + ["so", "on"] * 60, []]
    xs = [substring_dedup.shingles(" ".join(w).encode()) for w in texts]
    for some in (xs, xs[::-1], xs[:1], []):
        doc, sig, at = substring_dedup.signatures(some, 46, 6)
        for k, x in enumerate(some):
            want = substring_dedup._signatures(x, 46, 6)
            assert np.array_equal(sig[doc == k], want[0]) and np.array_equal(at[doc == k], want[1])
    _, _, xs_back = list(substring_dedup._signed((" ".join(w).encode() for w in texts), 46, 6))[-1][2:]
    assert len(xs_back) == len(texts)


@pytest.mark.parametrize("side", [3, 64])
def test_a_common_line_makes_no_documents_meet(spark, make_docs, monkeypatch, side):
    """A line that enough functions' windows are of, among documents' own words, and one real passage: only its pair meets."""
    monkeypatch.setattr(substring_dedup, "SIDE", side)
    rnd = random.Random(22)
    line = []
    while sum(int(substring_dedup._mix(substring_dedup.shingles(" ".join(line).encode()) ^ seed).min(initial=2**64 - 1)) < 2**64 // 250
              for seed in substring_dedup._SEEDS[:6]) < 4:
        line = _say(rnd, 14)
    passage = _say(rnd, 64)
    texts = {i: _say(rnd, 60) + line + _say(rnd, 60) + (passage + _say(rnd, 30) if i > 34 else []) for i in range(40)}
    docs = make_docs([(i, " ".join(w)) for i, w in texts.items()])
    reps = substring_dedup.identify(docs, "doc_id", "text")
    packed = substring_dedup.distinct_texts(docs, reps.select("doc", "v", "ta", "tb"), "doc_id", "text")
    repeats = substring_dedup.repeated(packed, lambda t: substring_dedup._signatures(substring_dedup.shingles(t), 46, 6)[0])
    kept = substring_dedup._windows(packed, repeats, 46, 6, 3)
    shared = substring_dedup.repeated_in(kept, lambda b: (np.zeros(0, int), np.zeros(0, np.uint64)) if not b.num_rows else (
        np.repeat(np.arange(b.num_rows), [len(x) // 8 for x in b.column("x").to_pylist()]),
        np.frombuffer(b"".join(b.column("x").to_pylist()), np.uint64)))
    met = substring_dedup._pairs(kept, 3).count()
    left = {tuple(r) for r in substring_dedup._pairs(substring_dedup._useful(kept, shared, 46, 0.8, 3), 3).collect()}
    real = {(i, j) for i in range(35, 40) for j in range(i + 1, 40)}
    assert met > 100 and left == real
    out, links = substring_dedup.near_duplicate_passages(docs)
    assert {(r["a"], r["b"]) for r in links.collect()} == real
    assert {r["doc"]: (r["class_id"], r["n_links"]) for r in out.collect()} == {i: (35, 4) if i > 34 else (i, 0) for i in texts}


def test_places_alike():
    """No range that can be similar is lost, against all ranges; and few unshared places more than that are kept."""
    rng = np.random.default_rng(5)
    for n, p in ((5, 1.0), (46, 0.9), (120, 0.8), (200, 0.75)):
        hit = rng.random(n) < p
        got, most = substring_dedup.alike(hit, 46, 0.8), int((~hit).sum())
        for i in range(n):
            for j in range(i + 46, n + 1):
                if (~hit[i:j]).sum() <= 0.2 * (j - i):
                    assert got[i:j].any() and most >= 0
    assert not substring_dedup.alike(np.arange(200) % 2 == 0, 46, 0.8).any()


def test_links_found_in_rounds_are_those_found_at_once(spark, make_docs, monkeypatch):
    """Many slices and many blocks at a time give the rows and the links of one round."""
    rnd = random.Random(21)
    lines = [_say(rnd, 70) for _ in range(3)]
    texts = {i: _say(rnd, 12) + lines[i % 3] + _say(rnd, 9) + (lines[(i + 1) % 3] if i % 4 == 0 else []) for i in range(48)}
    docs = make_docs([(i, " ".join(w)) for i, w in texts.items()])
    rounds, got = [], []
    checked = substring_dedup._checked
    monkeypatch.setattr(substring_dedup, "_checked", lambda *x: (rounds.append(1) or r for r in checked(*x)))
    for meetings, sent, side in ((64, 1000, 128), (6, 3, 10)):
        for name, value in (("MEETINGS", meetings), ("SENT", sent), ("SIDE", side)):
            monkeypatch.setattr(substring_dedup, name, value)
        rounds.clear()
        out, links = substring_dedup.near_duplicate_passages(docs)
        got.append((sorted(map(tuple, out.collect())), sorted(map(tuple, links.collect()))))
        assert len(rounds) == 1 if meetings == 64 else len(rounds) >= 4
    assert got[0] == got[1] and len(got[0][1]) > 500
    assert substring_dedup.near_duplicate_passages(docs, keep_links=False)[1] is None
