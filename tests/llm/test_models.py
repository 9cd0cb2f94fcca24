"""Toxicity chain (5), HTML extraction (7), token counts (6)."""

import random
import re
import time
import zlib

import numpy as np
import pytest
import public_tokenizers
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalog_lake.llm import html_extract, token_counts, toxicity


def _greedy(word, pieces):
    n = at = 0
    while at < len(word):
        end = next((j for j in range(len(word), at, -1) if word[at:j] in pieces), None)
        if end is None:
            return -1
        n, at = n + 1, end
    return n


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("ab", min_size=1, max_size=5), max_size=9), st.text("ab", max_size=14))
def test_automaton_is_the_greedy_longest_match(pieces, word):
    pieces = {p.encode() for p in pieces}
    assert token_counts.Automaton(pieces).count(word.encode()) == _greedy(word.encode(), pieces)


def test_token_counts(spark, make_docs, clash):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pieces = set(token_counts.read_vocabulary(path))
    texts = [None, "", " \n", "the theatre of undeniableness", "日本 é", "z" * 300, "a b " * 50000]
    docs = clash(make_docs([*enumerate(texts), (3, texts[3])]))
    for r in token_counts.token_counts(docs, path).collect():
        lengths = [_greedy(b" " + w, pieces) for w in (texts[r["doc"]] or "").encode().split()[:2000]]
        if r["doc"] != 6:
            assert (r["n_words"], r["n_tokens"], r["n_unknown"], r["max_word_tokens"]) == (
                len(lengths), sum(lengths), 0, max(lengths, default=0))
    assert token_counts.token_counts(docs.limit(0), path).count() == 0


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(500):
        junk, toxic = rnd.random() < 0.3, rnd.random() < 0.25
        t = [rnd.choice(words) for _ in range(rnd.randint(20, 120))]
        if junk:
            t += ["buynow"] * 2
        if toxic:
            t.insert(rnd.randrange(len(t)), rnd.choice(["vileword", "scorned", "hexxarum", "hexxadel", "hexxatop"]))
        rows.append((i, " ".join(t), int(junk), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, junk int, toxic int")


def _right(rows, chain, category):
    """Shares of the marked and of the other rows that the threshold judges right."""
    got = rows.groupBy(F.col(category) == 1).agg(F.avg((chain.flagged(category) == (F.col(category) == 1)).cast("double"))).collect()
    return {r[0]: r[1] for r in got}


def test_terms():
    words = ["unhappy", "cat", "straße", "^unh", "^unha", "^unhap", "^unhapp", "^str", "^stra", "^straß"]
    assert toxicity.terms("Unhappy, cat unhappy! straße") == {zlib.crc32(w.encode()) for w in words} and toxicity.terms(None) == set()


def test_terms_of_many_texts_at_once():
    """The CRC-32 of every word and beginning, whatever its letters, its length and the characters between words."""
    word = re.compile(r"[^\W_]+")
    plain = lambda t: {zlib.crc32(x.encode()) for w in word.findall(t.lower()) for x in [w, *[f"^{w[:n]}" for n in (3, 4, 5, 6) if len(w) > n]]}
    texts = ["", " _ ", "a ab abc abcd abcdefg ABCDEFG", "İstanbul ǅ ß ẞ Σς", "日本語のテキスト、とても長い", "𝔘𝔫𝔦𝔠𝔬𝔡𝔢abc naïve_café é", "x" * 39 + " " + "x" * 40 + "." + "y" * 41,
             "é" * 30 + " " + "z" * 70_000, "".join(map(chr, range(0x3000))), "١٢٣ ²³ a\x00b\x85c d\xa0e"]
    row, code = toxicity._word_terms(texts)
    assert [set(code[row == i].tolist()) for i in range(len(texts))] == [plain(t) for t in texts]
    assert [toxicity.terms(t) for t in texts] == [plain(t) for t in texts]


def test_texts_meet_few_labels_as_they_meet_many(spark):
    """Texts and labels are joined by the same shuffle at all sizes, so what a small run takes tells what a large one will."""
    texts = spark.createDataFrame([(1, "a b"), (2, None), (2, "c"), (None, "d")], "_doc long, _text string")
    rows = toxicity._labelled(texts, spark.createDataFrame([(1, 0.0), (2, 1.0), (3, 1.0)], "_doc long, y double"))
    assert sorted((r["_doc"], r["y"], zstandard.decompress(bytes(r["_text"]))) for r in rows.collect()) == [(1, 0.0, b"a b"), (2, 1.0, b""), (2, 1.0, b"c")]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_fit_is_the_best():
    """No small change of any weight lowers the penalised loss."""
    rnd = np.random.default_rng(6)
    n, k = 300, 40
    x = rnd.random((n, k)) < rnd.random(k) * 0.5
    before = rnd.random((n, 1))
    y = (1 / (1 + np.exp(-(3.0 * x[:, 3] - 2 * x[:, 7] + 2 * before[:, 0] - 1.5))) > rnd.random(n)).astype(float)
    codes = np.concatenate([np.flatnonzero(r) * 7 - 50 for r in x])
    b, names, w, wb = toxicity.fit_linear(codes, x.sum(axis=1), before, y, 0.004, rounds=5000, close=1e-6)
    full = np.zeros(k)
    full[(names + 50) // 7] = w

    def loss(v):
        margin = x @ v[:k] + before @ v[k:-1] + v[-1]
        return np.log1p(np.exp(-(2 * y - 1) * margin)).mean() + 0.004 * np.abs(v[:-1]).sum()

    v = np.concatenate([full, wb, [b]])
    for i in range(k + 2):
        for step in (0.05, -0.05):
            u = v.copy()
            u[i] += step
            assert loss(u) > loss(v) - 1e-6
    assert 3 * 7 - 50 in names and 0 < len(names) < k


def test_chain_on_held_out_rows(spark, labelled, clash):
    chain, held = toxicity.fit_chain(labelled.select("doc_id", "text"), labelled.select("doc_id", "junk", "toxic"), ("junk", "toxic"))
    assert held.count() == 500
    for c in ("junk", "toxic"):
        assert min(_right(held, chain, c).values()) >= 0.95
    assert [c for c, _ in chain.models] == ["junk", "toxic"]
    long = "w1 w2 " * 200_000
    docs = spark.createDataFrame([(1, "w1 w2 VILEWORD, w3"), (2, "w1 w2 w3"), (3, None), (4, ""), (1, "w1 w2 VILEWORD, w3"), (5, long), (6, long + "vileword")],
                                 "doc_id long, text string")
    for c in ("p_x", "_terms", "_bag", "_row", "_x", "_p", "_y", "p_junk"):
        docs = docs.withColumn(c, F.lit("own"))
    out = toxicity.predict_chain(clash(docs), chain)
    got = out.withColumn("t", chain.flagged("toxic")).collect()
    assert sorted((r["doc_id"], r["t"]) for r in got) == [(1, True), (1, True), (2, False), (3, False), (4, False), (5, False), (6, True)]
    assert {r[c] for r in got for c in ("p_x", "_terms", "_bag", "_row", "_x", "_p", "_y")} == {"own"} and 0 <= got[0]["p_junk"] <= 1
    # repeated rows, constant, missing and no labels
    twice = labelled.unionByName(labelled.limit(50))
    chain, held = toxicity.fit_chain(twice.select("doc_id", "text"), labelled.select("doc_id", "toxic"), ("toxic",))
    assert held.count() == 550
    one = labelled.select("doc_id", F.lit(0).alias("never"), F.lit(None).cast("int").alias("unknown"))
    chain, _ = toxicity.fit_chain(labelled.select("doc_id", "text"), one, ("never",))
    assert toxicity.predict_chain(docs, chain).agg(F.max("p_never")).first()[0] < 1e-9
    chain, _ = toxicity.fit_chain(labelled.select("doc_id", "text"), one, ("unknown",))
    assert toxicity.predict_chain(docs.limit(0), chain).count() == 0


def test_more_rows_than_a_task_takes_are_all_fitted(spark, labelled):
    """Blocks of at most 200 rows: every row is in one of them, and constant, repeated and missing labels are taken."""
    docs, labels = labelled.select("doc_id", "text"), labelled.select("doc_id", "junk", "toxic", F.lit(0).alias("never"))
    chain, held = toxicity.fit_chain(docs.unionByName(docs.where("doc_id < 50")), labels, ("never", "junk", "toxic"), "doc_id", "text", 200)
    assert held.count() == 550 and held.select("doc_id").distinct().count() == 500
    assert min(_right(held, chain, "junk").values()) >= 0.95 and held.agg(F.max("p_never")).first()[0] < 1e-9
    # So are the rows themselves judged.
    told = _right(toxicity.predict_chain(labelled, chain), chain, "junk")
    assert min(told.values()) >= 0.95 and zlib.crc32(b"buynow") in dict(chain.models)["junk"].terms
    n = [0]
    for fold in range(3):
        part = docs.select(F.pmod("doc_id", F.lit(3)).alias("_fold"), F.col("doc_id").cast("double").alias("y"), F.array(F.col("doc_id")).alias("_hashes"))
        fits = toxicity._fit_blocks(part.where(F.col("_fold") == fold).withColumn("y", F.pmod("y", F.lit(2.0))), 167, "y", [], 50, 0.001)
        sizes = [r["n"] for r in fits.where("kind = 'intercept'").collect()]
        assert max(sizes) <= 200
        n.append(sum(sizes))
    assert sum(n) == 500


def test_chain_on_the_given_labels(spark):
    """Labelled rows of the given tables that the chain is not fitted on are judged right."""
    at = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{at}/{t}.parquet") for t in ("documents", "labels"))
    labels = labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    apart = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(4)) == 0
    chain, held = toxicity.fit_chain(docs, labels.where(~apart), ("low_quality", "toxic"))
    rows = docs.select("doc_id", "text").join(labels.where(apart), "doc_id")
    right = _right(toxicity.predict_chain(rows, chain), chain, "toxic")
    assert right[True] >= 0.88 and right[False] >= 0.97
    assert min(_right(held, chain, "toxic").values()) >= 0.85


LAYOUTS = {
    "semantic": "<header><h2>Site</h2><nav><ul><li><a href=/a>Home</a></li><li><a href=/b>About us</a></li></ul></nav></header>"
                "<main><article><h1>{t}</h1>{b}</article></main><aside class=sidebar><p>Popular posts this week</p></aside>"
                "<footer><p>&copy; Example. All rights reserved.</p></footer>",
    "classes": "<div id=\"top-nav\" class=menu><a href=/a>Home</a> | <a href=/b>Shop</a></div><div class=\"cookie-notice\"><p>We use "
               "cookies to make the site work for you. Accept them all.</p><button>OK</button></div><div class=\"post-content\">"
               "<h1>{t}</h1>{b}</div><div id=comments><div class=comment><p>What a long and thoughtful reply, thanks for it, really."
               "</p></div><div class=comment><p>I do not agree with any of this at all, sorry to say.</p></div></div>"
               "<div class=\"site-footer\">Imprint and contact</div>",
    "ad in the text": "<nav><a href=/a>Home</a></nav><article><h1>{t}</h1>{b}<div class=ad>Buy one now and get one free</div>"
                      "<form class=newsletter><label>Your mail</label><input><button>Subscribe</button></form></article>",
}


@pytest.fixture(scope="module")
def trees(spark):
    from tests.conftest import SF_SMALL
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    return html_extract.fit(html_extract.training_rows(pages))


def _find_by_walk(page, tag, until):
    """The innermost open tag, found by going down the stack."""
    for depth in range(len(page.stack) - 1, 0, -1):
        name = page.tag[page.stack[depth]]
        if name == tag:
            return depth
        if name in until:
            return 0
    return 0


def test_open_tags_are_found_without_a_walk(monkeypatch):
    rnd, find, seen = random.Random(5), html_extract.Page._find, []

    def both(page, tag, until):
        seen.append(find(page, tag, until))
        assert seen[-1] == _find_by_walk(page, tag, until)
        return seen[-1]
    with monkeypatch.context() as m:
        m.setattr(html_extract.Page, "_find", both)
        tags = ["div", "p", "li", "ul", "td", "tr", "table", "b", "a", "article", "dt", "dd", "h1", "body", "option", "select"]
        for _ in range(300):
            html_extract.Page("".join(rnd.choice(["<", "</"]) + rnd.choice(tags) + ">" + rnd.choice(["", "x"]) for _ in range(rnd.randint(0, 40))))
    assert sum(map(bool, seen)) > 300
    start = time.time()
    page = html_extract.Page("<div>" * 200_000 + "deep" + "</div>" * 100_000 + "<p>end")
    assert len(page.tag) == 200_002 and time.time() - start < 20


def test_extraction(spark, trees):
    from tests.conftest import SF_SMALL
    pars = ["First part, with a <b>bold</b>&nbsp;word &amp; more than\n a line of text in it.", "Second part of the story: it goes on for a while, "
            "until everybody knows how it ends.", "Third and last part, shorter."]
    plain = ["First part, with a bold word & more than a line of text in it.", *pars[1:]]
    body = "".join(f"<p>{p}" for p in pars)
    rows = [(i, "u", f"<html><head><title>x</title><script>var a='<p>';</script></head><body>{h.format(t='The title', b=body)}</body></html>")
            for i, h in enumerate(LAYOUTS.values())]
    rows += [(10, "u", None), (11, None, ""), (12, "u", "<<<>>> & &bogus; <p"), (0, "u", rows[0][2]), (None, "u", rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("own"))
    got = {}
    for r in html_extract.extract(pages, trees).collect():
        got.setdefault(r["page"], []).append(r["text"])
        assert r["n_chars"] == len(r["text"])
    want = "\n".join(["The title", *plain])
    assert [got[i][0] for i in range(3)] == [want] * 3
    assert got[0] == [want] * 2 and got[None] == [want] and got[10] == got[11] == [""]
    assert html_extract.extract(pages.limit(0), trees).count() == 0
    # Every given page keeps its article and nothing else.
    real = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    bad = 0
    for r in html_extract.extract(real, trees).join(real.select(F.col("page_id").alias("page"), "html"), "page").collect():
        inner = r["html"].split("<article>")[1].split("</article>")[0]
        page = html_extract.Page(inner)
        bad += html_extract.main_text(page, [True] * len(page.tag)) != r["text"]
    assert bad == 0


def test_decode_never_contradicts():
    import numpy as np
    rng = np.random.default_rng(1)
    page = html_extract.Page("<div><p>a<b>b</b></p><section><p>c</p><p>d</p></section></div>" * 3)
    for _ in range(50):
        p = rng.random(len(page.tag))
        kept = html_extract.decode(page, p)
        assert all(kept[page.parent[v]] for v in range(len(kept)) if kept[v])
        best = html_extract.decode(page, p)
        score = lambda k: sum(np.log(p[v] if k[v] else 1 - p[v]) for v in range(1, len(k)))
        for v in range(1, len(kept)):  # no single change that is consistent scores better
            other = best.copy()
            other[v] = ~other[v]
            if all(other[page.parent[u]] for u in range(len(other)) if other[u]):
                assert score(other) <= score(best) + 1e-9


def test_trees_score_like_spark(spark):
    import numpy as np
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    rnd = random.Random(1)
    data = [([rnd.random(), rnd.random()], float(rnd.random() < 0.5)) for _ in range(200)]
    rows = spark.createDataFrame(data, "x array<double>, label double").select("x", array_to_vector("x").alias("features"), "label")
    model = GBTClassifier(maxIter=4, maxDepth=3, seed=1).fit(rows)
    out = model.transform(rows).select("x", vector_to_array("probability")[1].alias("p")).collect()
    mine = html_extract.Trees(model.toDebugString, list(model.treeWeights)).probability(np.array([r["x"] for r in out]))
    assert np.allclose(mine, [r["p"] for r in out])


def test_skipped_elements_end():
    """Heads and skipped elements without an end tag cost no text after them; those with one are skipped whole."""
    def text(html):
        page = html_extract.Page(html)
        return html_extract.main_text(page, [True] * len(page.tag))
    assert text("<html><head><title>t</title><meta charset=x><body><p>One</p><p>Two</p></body></html>") == "One\nTwo"
    assert text("<html><head><title>t</title><script>var a='<p>'</script><noscript><img></noscript><div>One</div><p>Two") == "One\nTwo"
    assert text("<head><style>p{}</style>bare text<p>Two") == "bare text\nTwo"
    assert text("<head><noscript><img><body><p>One</p>") == "One"
    for tag in ("select", "object", "video", "audio", "canvas", "noscript", "svg", "datalist", "template"):
        opened, fallback = f"<p>One <{tag}>", f"<{tag}><div><p>no <b>support</b></div><ul><li>x</ul></{tag}>"
        assert text(f"<body><div>{opened}gone</p><p>Two</p></div><p>Three</p></body>") == "One\nTwo\nThree", tag
        assert text(f"<div>{opened}gone</div>Two<p>Three") == "One\nTwo\nThree", tag
        assert text(f"{opened}gone<h2>Two</h2>{fallback}<p>Three") == "One\nTwo\nThree", tag
        assert text(f"<div>{opened}gone{fallback}<h2>Two</h2></div>") == "One\nTwo", tag
        assert text(f"<div><p>One</p>{fallback}<p>Two</p>{fallback}</div>") == "One\nTwo", tag
    assert text("<p>so <math><semantics><mrow><mi>a</mi><mo>=</mo><msup><mi>b</mi><mn>2</mn></msup></mrow><annotation>a=b^2</annotation>"
                "</semantics></math> holds<p>Two <math><mi>x</mi>") == "so a=b2 holds\nTwo x"


def test_whole_article_without_head_end_and_with_formulas(spark, trees):
    pars = ["First part, with a formula <math><mi>E</mi><mo>=</mo><mi>m</mi></math> and more than a line of text in it.",
            "Second part of the story: it goes on for a while, until everybody knows how it ends."]
    plain = ["First part, with a formula E=m and more than a line of text in it.", pars[1]]
    body = "".join(f"<p>{p}</p>" for p in pars)
    page = "<html><head><title>x</title>" + LAYOUTS["semantic"].format(t="The title", b=body + "<video src=a>") + "</html>"
    pages = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    assert [r["text"] for r in html_extract.extract(pages, trees).collect()] == ["\n".join(["The title", *plain])]
