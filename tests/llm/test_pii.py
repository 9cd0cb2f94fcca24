"""Personal data (13): patterns against plain regular expressions, Viterbi against all paths, spellings held out."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from catalog_lake.llm import pii, queries
from tests.llm.conftest import PROSE

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def check_digit(digits):
    odd = [int(c) for c in digits[::-1]]
    return (sum(odd[::2]) + sum(sum(divmod(2 * d, 10)) for d in odd[1::2])) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        spans = []
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) or kind == "phone" and not 8 <= len(digits) <= 15 \
                    or kind == "card" and not (16 <= len(digits) <= 19 and check_digit(digits)):
                continue
            spans.append(m.span())
        out.append(spans)
    return out


@pytest.fixture(scope="module")
def crf(spark):
    return pii.fit_table(pii.labelled_table(spark))


@settings(max_examples=800, deadline=None)
@given(st.lists(st.sampled_from(["a", "@", ".", "-", "%", " ", "1", "22", "4111111111111111", "4111 1111", "+", "(", ")", "255", "256", "000", "x.y", "é", "\n"]), max_size=24).map("".join))
def test_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_patterns_in_long_texts():
    for text in ("a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "+" * 100_000 + "1", "+1" + "(" * 100_000, "a@" * 100_000, "a@b." * 50_000):
        pii.base_spans(text)
        list(pii.chains(text[:20_000]))


def test_viterbi_is_the_best_path():
    rnd, k = np.random.default_rng(4), len(pii.LABELS)
    words = ["a", "1", "@", "dot", "x1"]
    names = sorted({p + f for w in words for f in pii._features(w)[0] for p in ("", "-", "+")})
    crf = pii.Crf({f: i for i, f in enumerate(names)}, rnd.normal(size=(len(names), k)), rnd.normal(size=(k, k)), rnd.normal(size=k))
    batch = [words[:n] for n in (3, 1, 4, 2, 0)]
    for own, labels in zip(batch, crf.decode(batch), strict=True):
        if not own:
            assert not len(labels)
            continue
        s = crf.scores(own)
        paths = {p: crf.first[p[0]] + sum(s[t][x] for t, x in enumerate(p)) + sum(crf.steps[x, y] for x, y in itertools.pairwise(p))
                 for p in itertools.product(range(k), repeat=len(own))}
        assert tuple(labels) == max(paths, key=paths.get)


def test_held_out_rows(crf):
    rows = pii.labelled_rows(500, seed=2024)
    got = crf.decode([w for w, _ in rows])
    pairs = [(y, pii.LABELS[x]) for (_, ys), xs in zip(rows, got, strict=True) for y, x in zip(ys, xs, strict=True)]
    marked, found = [p for p in pairs if p[0] != "O"], [p for p in pairs if p[1] != "O"]
    assert sum(a == b for a, b in marked) >= 0.97 * len(marked) and sum(a == b for a, b in found) >= 0.97 * len(found)


def test_spellings(crf):
    """What the patterns miss is found, what only looks alike is left."""
    found = {"write to jo.kales at muto dot org now": "email:9:33", "call (415) 555-0123 soon": "phone:5:19", "the card 3782 822463 10005 is": "card:9:26",
             "from 2001:db8::ff00:42:8329 it": "ip:5:27", "tel +1 (269) 555-3296 4524132264652876 and": "card:22:38,phone:4:21"}
    for text, want in found.items():
        assert pii.written(pii.find_batch([text], crf)[0][1]) == want
    for text in ("order no 8725828797960379 was", "version 1.2.3 of 2024-05-06 at 10:30:00", "the dot on the i, 5% of 1,000.50", PROSE, "std::vector", "300.1.2.3", "isbn 978-3-1614-8410-0"):
        assert pii.written(pii.find_batch([text], crf)[0][1]) == "", text


ROWS = [(0, None), (1, ""), (2, "mail a.b@c.example.org, ip 10.0.0.1; +1 (212) 555-0199 4111 1111 1111 1111."), (2, "x@y.z"), (2, "x@y.z"), (None, "x@y.z"),
        (3, "é😀 x@y.z 😀"), (4, PROSE * 500 + " 1.2.3.4"), (5, "7 " * 30_000), (6, "999.1.1.1 4111111111111112 +12")]


def want_base(text):
    listed = ",".join(f"{k}:{s}:{e}" for k, of in zip(PATTERNS, brute(text or ""), strict=True) for s, e in of)
    return (*map(len, brute(text or "")), hashlib.sha256(listed.encode()).hexdigest())


def test_rows(spark, make_docs, clash, crf):
    docs = clash(make_docs(ROWS)).drop("doc").repartition(3)
    got = pii.find_personal_data(docs, crf).collect()
    assert sorted(map(str, (tuple(r)[:6] for r in got))) == sorted(str((d, *want_base(t))) for d, t in ROWS)
    for r in got:
        spans = [s.split(":") for s in r["spans"].split(",") if s]
        text = next(t for d, t in ROWS if d == r["doc"] and want_base(t)[:4] == tuple(r)[1:5]) or ""
        assert {(pii.KINDS[k], str(s), str(e)) for k, of in enumerate(brute(text)) for s, e in of} <= {tuple(s) for s in spans}
        assert spans == sorted(spans, key=lambda s: (pii.KINDS.index(s[0]), int(s[1])))
    assert pii.find_personal_data(docs.limit(0), crf).count() == 0


def test_batches_do_not_matter(crf):
    rnd, parts = random.Random(3), ["4111 1111", "call (415) 555-0123", "a at b dot com", "x@y.z", "the", "10.0.0.1", "word"]
    texts = [" ".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(60)]
    assert pii.find_batch(texts, crf) == [pii.find_batch([t], crf)[0] for t in texts]


def test_query(spark, make_docs, tmp_path):
    make_docs(ROWS).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_pii(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    assert sorted(map(str, (tuple(r)[:6] for r in got.collect()))) == sorted(str((d, *want_base(t))) for d, t in ROWS)
