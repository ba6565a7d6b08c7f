"""Alignments against documents taken one by one: all overlaps by comparing byte ranges."""

import bisect
import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from conceptmerge.llm.alignment import PairEncoder, alignments, token_groups

from .conftest import ODD

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DATA = "/root/testdata/sf0.001"
TEXTS = [
    "x▁y", "a  b", " lead", "trail ", "\n", "a\nb", "\nb", "a\n\nb", "tab\tx", "<|endoftext|> and <s> or <0x0A>", "é😀 日本語", "a\r\nb", "fiﬁ Ａ　b", "x᠎y", "nb\xa0sp", "of the of the"
]


@pytest.fixture(scope="module")
def plain():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in printable} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in printable)}

    def of_a(i):
        return bytes(letters[c] for c in a.id_to_token(i))

    def of_b(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def spans(ids, said):
        out, at = [], 0
        for i in ids:
            out.append((i, at, at := at + len(said(i))))
        return out

    def align(text):
        if not text:
            return None
        body = (" " + text).encode()
        x, y = spans(a.encode(" " + text, add_special_tokens=False).ids, of_a), spans(b.encode(text), of_b)
        if b"".join(of_a(i) for i, *_ in x) != body or b"".join(of_b(i) for i, *_ in y) != body:
            return None
        cuts = sorted({e for *_, e in x} & {e for *_, e in y})
        held = [{}, {}]
        for side, group in zip((x, y), held):
            for i, _, e in side:
                group.setdefault(bisect.bisect_left(cuts, e), []).append(str(i))
        groups = [",".join(held[0][g]) + "|" + ",".join(held[1][g]) for g in range(len(cuts))]
        links, k = [], 0
        for i, s, e in x:
            while k and y[k][1] > s:
                k -= 1
            while k < len(y) and y[k][2] <= s:
                k += 1
            j = k
            while j < len(y) and y[j][1] < e:
                links.append((i, y[j][0]))
                j += 1
        return len(x), len(y), ";".join(groups), len(groups), links

    return align


def expected(rows, align):
    got = [(i, align(t)) for i, t in rows]
    count = Counter(pair for _, g in got if g for pair in g[4])
    best = Counter()
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    out = []
    for i, g in got:
        if g is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            sha = hashlib.sha256(g[2].encode()).hexdigest()
            out.append((i, g[0], g[1], g[3], len(g[4]), sum(count[p] == best[p[1]] for p in g[4]), sum(count[p] for p in g[4]), sha))
    return sorted(out, key=str)


def actual(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("direct", [500_000, 40, 0])
def test_against_brute_force(docs, plain, direct):
    rows = [(i, t) for i, t in ODD if t is None or len(t) < 100_000] + list(enumerate(TEXTS, 20))
    assert actual(alignments(docs(rows), A, B, direct=direct)) == expected(rows, plain)


def test_documents_of_the_test_tables(spark, plain):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert actual(alignments(docs, A, B, direct=1000)) == expected(rows, plain)


def test_long_text_and_empty_table(docs):
    r = alignments(docs([(1, "tick tock " * 300_000)]), A, B).collect()[0]
    assert r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"] and r["n_groups"] > 300_000
    assert alignments(docs([]), A, B).collect() == []


def test_token_groups_hold_all_ids(docs, plain):
    rows = list(enumerate(TEXTS)) + [(None, None), (99, "")]
    for r in token_groups(docs(rows), A, B).collect():
        want = plain(TEXTS[r["doc_id"]]) if r["doc_id"] is not None and r["doc_id"] < len(TEXTS) else None
        parts = [
            f"{','.join(map(str, r['a'][i:j]))}|{','.join(map(str, r['b'][k:m]))}"
            for i, j, k, m in zip([0, *r["a_until"]], r["a_until"], [0, *r["b_until"]], r["b_until"])
        ]
        assert ";".join(parts) == (want[2] if want else "")


def test_words_kept_do_not_change_ids():
    small, large = PairEncoder(A, B, kept=3), PairEncoder(A, B)
    texts = ["one two\nthree four", "two three one", None, "\nx", "four two"]
    assert small.encode(texts) == large.encode(texts) == [large.encode([t])[0] for t in texts]
