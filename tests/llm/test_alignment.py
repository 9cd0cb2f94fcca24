"""Alignment (11) against a brute-force version over the libraries' own ids and offsets."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from catalog_lake.llm import alignment, queries
from tests.llm.conftest import PROSE

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", "a", PROSE * 3, "日本語のテキスト 😀 mixed", "tabs\t\n\n  and   runs \r\n", "x" * 3000, "<|endoftext|> is <s> text </s> <unk> <0x41>", "ß  é 12.5%",
         "a▁b is not spelled", " ", "\x00 null byte", "  leading", "the the the the", PROSE * 400, "ﬁ ｆｕｌｌ　width", "é́ combining"]


def brute(rows):
    """Columns per row, all pairs compared within a document."""
    t, s = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    t.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    marks = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(x for x in range(256) if x not in plain)}
    tokens, links = [], []
    for _, x in rows:
        a, b, found = [], [], []
        if x:
            ids = t.encode(" " + x, add_special_tokens=False).ids
            a = [(i, bytes(marks[c] for c in t.id_to_token(i))) for i in ids]
            for i in s.encode(x):
                p = s.id_to_piece(i)
                b.append((i, bytes([int(p[3:5], 16)]) if s.is_byte(i) else p.replace("▁", " ").encode()))
            if not b"".join(w for _, w in a) == b"".join(w for _, w in b) == (" " + x).encode():
                a, b = [], []
        ranges = []
        for side in (a, b):
            at, out = 0, []
            for i, w in side:
                out.append((i, at, at + len(w)))
                at += len(w)
            ranges.append(out)
        first = 0
        for i, s0, e0 in ranges[0]:
            while first < len(ranges[1]) and ranges[1][first][2] <= s0:
                first += 1
            for j, s1, _ in ranges[1][first:]:
                if s1 >= e0:
                    break
                found.append((i, j))
        tokens.append(ranges)
        links.append(found)
    count = Counter(p for found in links for p in found)
    highest = {}
    for (_, j), n in count.items():
        highest[j] = max(highest.get(j, 0), n)
    out = []
    for (d, _), (ra, rb), found in zip(rows, tokens, links, strict=True):
        cuts = sorted({e for *_, e in ra} & {e for *_, e in rb})
        groups, s0 = [], 0
        for e in cuts:
            groups.append("|".join(",".join(str(i) for i, s, _ in r if s0 <= s < e) for r in (ra, rb)) if len(cuts) < 3000 else "")
            s0 = e
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if ra else ""
        out.append((d, len(ra), len(rb), len(cuts), len(found), sum(count[p] == highest[p[1]] for p in found), sum(count[p] for p in found), sha))
    return out


def sort(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("block_links", [1, 500, 3_000_000])
def test_against_brute_force(spark, make_docs, clash, block_links):
    rows = [*enumerate(TEXTS), (3, TEXTS[3]), (None, "no id"), (9, TEXTS[13])]
    docs = clash(make_docs(rows)).drop("doc").repartition(3)
    got = alignment.align_tokens(docs, A, B, block_links=block_links).select(
        "doc", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    want = brute(rows)
    long = [14]  # the brute version writes no groups of texts as long as this
    assert sort([tuple(r)[:7] for r in got]) == sort([r[:7] for r in want])
    assert sort([tuple(r) for r in got if r[0] not in long]) == sort([r for r in want if r[0] not in long])
    zero = {r[0]: tuple(r)[1:] for r in got}
    assert all(zero[i] == (0, 0, 0, 0, 0, 0, "") for i in (0, 1)) and any(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "") for r in got if r[0] == 9)


def test_long_groups(make_docs):
    """The groups of a long text as written by hand, one group at a time."""
    a, b = alignment.sides(A, B)
    ids = alignment.tokens(TEXTS[14], a, b)
    (_, _, n_groups, _), digests, _, _ = alignment.align([ids, alignment.tokens("", a, b)], a, b)
    groups, own, at = [], ([], []), [0, 0]
    i = j = 0
    while i < len(ids[0]) or j < len(ids[1]):
        side = 0 if at[0] <= at[1] and i < len(ids[0]) else 1
        k = i if side == 0 else j
        own[side].append(str(ids[side][k]))
        at[side] += int((a, b)[side].length[ids[side][k]])
        i, j = i + (side == 0), j + (side == 1)
        if at[0] == at[1] and own[0] and own[1]:
            groups.append("|".join(",".join(x) for x in own))
            own = ([], [])
    assert n_groups.tolist() == [len(groups), 0] and digests == [hashlib.sha256(";".join(groups).encode()).hexdigest(), ""]


def test_empty_table(spark, make_docs):
    assert alignment.align_tokens(make_docs([(1, "x")]).limit(0), A, B).count() == 0


def test_query(spark, make_docs, tmp_path):
    make_docs(list(enumerate(TEXTS[:9]))).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_alignment(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sort([tuple(r) for r in got.collect()]) == sort(brute(list(enumerate(TEXTS[:9]))))
