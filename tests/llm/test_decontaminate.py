"""Benchmark decontamination (10) against a plain scan."""

import random
import re

import pytest

from catalog_lake.llm import decontaminate


def _words(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _brute(docs, bench):
    wins = {}
    for item, t in bench:
        w = _words(t)
        k = min(13, len(w))
        for s in range(len(w) - k + 1 if w else 0):
            wins.setdefault(tuple(w[s:s + k]), set()).add(item)
    out = []
    for d, t in docs:
        w = _words(t)
        hit, items = set(), set()
        for win, ids in wins.items():
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s:s + len(win)]) == win:
                    hit |= set(range(s, s + len(win)))
                    items |= ids
        out.append((d, len(w), len(hit), sorted(x for x in items if x is not None)))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, make_docs, clash, seed):
    rnd = random.Random(seed)
    vocab = ["the", "of", "a", "Été", "X9", "zoo", "ñu"] + [f"w{i}" for i in range(12 if seed == 1 else 200)]
    say = lambda n: " ".join(rnd.choice(vocab) + rnd.choice(["", ",", "!", "--"]) for _ in range(n))
    bench = [(i, say(rnd.choice([1, 3, 5, 12, 13, 14, 40]))) for i in range(25)] + [(90, ""), (91, None), (92, "!!"), (None, say(20))]
    bench += [bench[3], (93, bench[4][1])]
    docs = []
    for i in range(60):
        t = say(rnd.randint(0, 60))
        for _ in range(rnd.randint(0, 2)):
            t += " " + (rnd.choice(bench)[1] or "") + " " + say(rnd.randint(0, 10))
        docs.append((i, t.upper() if i % 9 == 0 else t))
    docs += [(70, None), (71, ""), (None, docs[0][1]), docs[1], docs[1], (1, "other text"), (72, say(4000))]
    b = spark.createDataFrame(bench, "item_id long, text string")
    out = decontaminate.contamination(clash(make_docs(docs)).drop("doc"), b)
    got = sorted(((r["doc"], r["n_words"], r["n_hit"], sorted(r["items"])) for r in out.collect()), key=str)
    assert got == _brute(docs, bench)


def test_drop_contaminated_and_empty_tables(spark, make_docs, clash):
    item = " ".join(f"q{i}" for i in range(15))
    docs = make_docs([(1, item), (2, "clean words only"), (3, item + " " + "pad " * 400), (None, item), (4, None), (1, item)])
    bench = spark.createDataFrame([(5, item)], "item_id long, text string")
    kept = decontaminate.drop_contaminated(clash(docs), bench)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "3", "4"] and kept.columns == clash(docs).columns
    none = decontaminate.contamination(docs, bench.limit(0))
    assert none.count() == 6 and none.where("n_hit > 0").count() == 0
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
