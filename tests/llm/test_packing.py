import zlib
from collections import defaultdict

import numpy as np
import pytest

from conceptmerge.llm import packing

from .conftest import ODD

tokenizers_files = pytest.importorskip("public_tokenizers")
PATH = tokenizers_files.path("byte_bpe_50k.json")


def whole_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


TEXTS = [
    "", " ", "  two  blanks ", "plain words, and more.", "line\nbreaks\n\nand\n  blanks\n", "tab\tand\rreturn", "nbsp\xa0here \xa0 x", "<|endoftext|> in text", "don't we'll I'd 12345 ***", "Ünïcödé 汉字 emoji 👍🏽 words",
    "trailing ", "\nleading", " leading", "a  b", "x y", "It's\n'tis the　end", " ", "a​b c", "mixed12ab ''s 's",
]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_equal_the_tokenizer(text):
    assert np.frombuffer(packing.encoder(PATH).encode(text), dtype="<u4").tolist() == whole_ids(text)


def check(rows, got, size, end_id=1):
    docs = defaultdict(list)
    for i, t in rows:
        docs[i].append([*whole_ids(t or ""), end_id])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    want = defaultdict(list)
    for i, held in docs.items():
        for ids in held:
            for s in range(0, len(ids), size):
                part = ids[s : s + size]
                want[i].append((s, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes()), len(ids)))
    assert {i: sorted(p) for i, p in pieces.items()} == {i: sorted(p) for i, p in want.items()}
    assert sorted(sequences) == list(range(len(sequences)))
    for members in sequences.values():
        at = 0
        for offset, n in sorted(members):
            assert offset == at
            at += n
        assert at <= size


@pytest.mark.parametrize("size", [32, 2048])
def test_pieces_and_places(docs, size):
    rows = [(i, f"document {i} says " + "something more " * (i * 7 % 60)) for i in range(80)] + [r for r in ODD if len(r[1] or "") < 10_000]
    check(rows, packing.packed(docs(rows), PATH, size=size, rows_a_task=20).collect(), size)
    assert packing.packed(docs([]), PATH).count() == 0


def slow_best_fit(lengths, size):
    """Best fit decreasing, one piece at a time."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= n]
        if fits:
            room[room.index(min(fits))] -= n
        else:
            room.append(size - n)
    return sorted(room)


@pytest.mark.parametrize("seed", range(6))
def test_same_windows_as_one_by_one(seed):
    rng = np.random.default_rng(seed)
    size = int(rng.integers(8, 70))
    lengths = rng.integers(1, size + 1, int(rng.integers(1, 300))).tolist()
    plan, windows = packing.best_fit({n: lengths.count(n) for n in set(lengths)}, size)
    fill = [0] * windows
    for length, rank, n, first, each, offset in plan.tolist():
        for k in range(n):
            w = first + k // each
            assert fill[w] == offset + k % each * length
            fill[w] += length
    assert sorted(size - f for f in fill) == slow_best_fit(lengths, size)
