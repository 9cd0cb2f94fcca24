"""Quality rules (3) and cross-site line dedup (1) on edge cases."""

import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from catalog_lake.llm import line_dedup, quality
from tests.llm.conftest import PROSE

BLANKS = " \t\n\x0b\x0c\r"


def _brute(text):
    words = [w for w in "".join(" " if c in BLANKS else c for c in text or "").split(" ") if w]
    lines = [x for x in (text or "").split("\n") if x.strip(BLANKS)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def _measured(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = quality.apply_rules(df).orderBy("row.doc_id").collect()
    return [(r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in rows]


def test_measures_match_brute_force(spark):
    texts = [None, "", " \t\n\x0b\x0c\r ", "a", "a b c a b c", "a a a a a", "x\ny\nx\n\nx ", "#*$ %&|<> é é  b", "a b c\na b c\nd",
             " em  em", PROSE * 40, ("w" * 5000 + " ") * 30]
    assert _measured(spark, texts) == [_brute(t) for t in texts]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t#é", max_size=60), min_size=1, max_size=20))
def test_measures_property(spark, texts):
    assert _measured(spark, texts) == [_brute(t) for t in texts]


def test_rules_keep_prose_and_reject_junk(spark, make_docs, clash):
    docs = clash(make_docs([(1, PROSE * 2), (1, PROSE * 2), (2, "too short"), (3, "&&&% " * 80), (4, None), (None, PROSE * 2),
                            (5, " ".join(f"zq{i}xv" for i in range(90)))]))
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    # PROSE twice repeats every window, so only a varied text passes
    assert [r["doc_id"] for r in kept.collect()] == []
    varied = " ".join(f"{w}{i}" if i % 3 else w for i, w in enumerate((PROSE * 3).split()))
    docs = make_docs([(1, varied), (1, varied), (None, varied), (2, "&&&% " * 80)])
    assert sorted(str(r["doc_id"]) for r in quality.keep_good(docs).collect()) == ["1", "1", "None"]
    assert quality.keep_good(docs.limit(0)).count() == 0


def test_threshold_table_is_the_projection(spark, make_docs):
    rules = (quality.Rule("short", "n_words", None, 3.0),)
    docs = make_docs([(1, "a b"), (2, "a b c d")])
    got = {r["row"]["doc_id"]: r["passed_short"] for r in quality.apply_rules(docs, rules=rules).collect()}
    assert got == {1: True, 2: False}


def _lines_brute(rows, min_sites):
    sites, first = {}, {}
    for d, t, s in rows:
        for x in (t or "").split("\n"):
            k = x.strip(BLANKS)
            if k:
                sites.setdefault(k, set()).update([s] if s is not None else [])
                if d is not None:
                    first[k] = min(first.get(k, d), d)
    out = []
    for d, t, _ in rows:
        if t is None:
            out.append((d, None))
            continue
        keep = [x for x in t.split("\n") if not (
            (k := x.strip(BLANKS)) and len(sites[k]) >= min_sites and (d is None or k not in first or d > first[k]))]
        out.append((d, "\n".join(keep)))
    return sorted(out, key=str)


def test_lines_match_brute_force(spark, make_docs, clash):
    rows = [(i, f"All rights reserved.\nown line {i}\n\n  All rights reserved. \n", f"site{i % 14}") for i in range(60)]
    rows += [(100 + i, f"near the threshold\nx{i}", f"site{i % 10}") for i in range(20)]
    rows += [(200 + i, f"below it\ny{i}", f"site{i % 9}") for i in range(20)]
    rows += [(300, None, "site1"), (301, "", "site2"), (None, "All rights reserved.\nq", "site3"), (302, "All rights reserved.", None)]
    rows += [rows[5], rows[5]]
    docs = make_docs(rows)
    out = line_dedup.clean_lines(clash(docs))
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert got == _lines_brute(rows, 10)
    assert out.columns == clash(docs).columns
    assert line_dedup.clean_lines(docs.limit(0)).count() == 0


def test_sketch_far_from_threshold_needs_no_exact_count(spark, make_docs):
    rows = [(i, "everywhere\nz%d" % i, f"site{i}") for i in range(300)]
    lines = line_dedup.line_table(make_docs(rows))
    assert line_dedup.boilerplate(lines, min_sites=20).count() == 1
    assert line_dedup.sketch_error(10, 12) == 2.0


def test_bullets_and_ellipses_behind_many_blanks(spark):
    """Lines match whole, as in the oracle, however many blanks stand around them."""
    bullet, ellipsis = r"^[\x20\x09-\x0D]*(?:[-*+]|\u2022|\u2023|\u25CF)[\x20\x09]", r"(?:\.\.\.|\u2026)[\x20\x09-\x0D]*\Z"
    marks = ["- a", "-", "- ", "\u2022\ta", "\u25cf\x0ba", "+\ra", "*a", "-- a", "a - b", "a...", "a..", "a\u2026", "...", "....", "a... b", "\u2026", "\u00a0- a",
             "a...\u00a0", "a...\u0085", "a...\u2028", "a\u2026\u0085", "a\u2026\r", "\U0001f600...", "- \U0001f600"]
    pads = ["", " ", "\t\x0b\x0c\r", " " * 37, " " * 38, " " * 39, " " * 40, "\t " * 60]
    lines = [before + m + after for m in marks for before in pads for after in pads]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r["row"]["doc_id"]: (r["n_bullet_lines"], r["n_ellipsis_lines"]) for r in quality.measures(df).collect()}
    want = {i: (int(bool(re.search(bullet, x))), int(bool(re.search(ellipsis, x)))) for i, x in enumerate(lines)}
    assert got == want
