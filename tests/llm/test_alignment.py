"""Alignment of two tokenizers against plain loops over the libraries' tokens."""

import random
from collections import Counter

import brute
import numpy as np
import pytest

from tallyline.llm import token_alignment
from tallyline.llm.queries import byte_model, piece_model

FRAGMENTS = [
    "a", "the ", " of", "  ", "\n", "\t", "▁", "é", "ßen", "漢字", "😀", "\x00", "don't", "1234", "<s>", "<|endoftext|>", "<0x41>",
    "http://x.y", "....", "    ", "\r\n", "ĸ", "ȵ", "Ω", "٣", "\x85", "\xa0", " ", "ing", "A1b2",
]


@pytest.fixture(scope="module")
def plain():
    """A text's tokens of both libraries and their bytes, by the libraries' own tables."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(byte_model())
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    shown = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or c >= 174]
    of = {chr(c): c for c in shown}
    of |= {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in shown)}

    def cut(text):
        one = a.encode(" " + text, add_special_tokens=False).ids
        other = b.encode(text)
        return (
            [(i, bytes(of[c] for c in a.id_to_token(i))) for i in one],
            [(i, bytes([b.id_to_piece(i) and int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
              else b.id_to_piece(i).replace("▁", " ").encode()) for i in other],
        )

    return cut


def aligned(text, cut):
    """Tokens, groups (lists of places on both sides) and links (place, place, shared bytes)."""
    a, b = cut(text) if text else ([], [])
    wanted = (" " + (text or "")).encode()
    if b"".join(x for _, x in a) != wanted or b"".join(x for _, x in b) != wanted:
        return [], [], [], []
    spans = []
    for tokens in (a, b):
        at, own = 0, []
        for _, x in tokens:
            own.append((at, at + len(x)))
            at += len(x)
        spans.append(own)
    links = [
        (i, j, min(e, f) - max(s, t))
        for i, (s, e) in enumerate(spans[0]) for j, (t, f) in enumerate(spans[1]) if s < f and t < e
    ]
    ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups, before = [], 0
    for end in ends:
        groups.append(tuple([k for k, (s, e) in enumerate(own) if before <= s and e <= end] for own in spans))
        before = end
    return [i for i, _ in a], [i for i, _ in b], groups, links


def summaries(texts, cut):
    made = [aligned(text, cut) for text in texts]
    linked = [Counter((a[i], b[j]) for i, j, _ in links) for a, b, _, links in made]
    count = Counter(pair for pairs in linked for pair in pairs)
    most = {}
    for (one, _), n in count.items():
        most[one] = max(n, most.get(one, 0))
    for (a, b, groups, links), pairs in zip(made, linked):
        written = ";".join(
            ",".join(str(a[k]) for k in left) + "|" + ",".join(str(b[k]) for k in right) for left, right in groups
        )
        yield (
            len(a), len(b), len(groups), len(links), sum(n for p, n in pairs.items() if count[p] == most[p[0]]),
            sum(n * count[p] for p, n in pairs.items()), brute.sha(written) if a else "",
        )


def sample():
    random.seed(4)
    texts = [None, "", " ", "\n", "  a", "▁x", "x▁▁", "\x00", "abcd " * 50, "a" * 1500, " " * 1200, "same text here"]
    texts += ["".join(random.choices(FRAGMENTS, k=random.randint(1, 40))) for _ in range(150)]
    return texts + ["same text here", "same text here"]


def found_rows(found):
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted(((r.doc_id, *(r[n] for n in names)) for r in found.collect()), key=str)


@pytest.mark.parametrize("pairs", [2_000_000, 300])
def test_summaries_equal_plain_loops(spark, plain, monkeypatch, pairs):
    monkeypatch.setattr(token_alignment, "PAIRS", pairs)
    monkeypatch.setattr(token_alignment, "TOGETHER", 400)
    monkeypatch.setattr(token_alignment, "PARTIALS", 300)
    monkeypatch.setattr(token_alignment, "COUNTED", 500)
    texts = sample()
    rows = [(None if i == 5 else 7 if i in (8, 9) else i, t, "x") for i, t in enumerate(texts)]
    made = spark.createDataFrame(rows, "doc_id long, text string, n_a string")
    want = sorted(((i, *s) for (i, _, _), s in zip(rows, summaries(texts, plain))), key=str)
    found = found_rows(token_alignment.summarize(made, byte_model(), piece_model()))
    assert found == want
    empty = token_alignment.summarize(made.limit(0), byte_model(), piece_model())
    assert found_rows(empty) == []


def test_links_and_groups(spark, plain):
    texts = sample()[:60]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in token_alignment.align(made, byte_model(), piece_model()).collect()}
    shared = {}
    for r in token_alignment.group_links(made, byte_model(), piece_model()).collect():
        shared.setdefault(r.doc_id, set()).add((r.a_at, r.b_at, r.group))
    for i, text in enumerate(texts):
        a, b, groups, links = aligned(text, plain)
        row = rows[i]
        assert (row.a_ids, row.b_ids) == (a, b)
        assert list(zip(row.link_a, row.link_b, row.link_bytes)) == links
        assert row.a_groups == [g for g, (left, _) in enumerate(groups) for _ in left]
        assert shared.get(i, set()) == {(x, y, g) for g, (left, right) in enumerate(groups) for x in left for y in right}


def test_both_libraries_cut_latin_texts_alike():
    with open(byte_model(), "rb") as file:
        a = token_alignment.ByteTokenizer(file.read())
    assert a.fast is not None
    for code in range(0x250):
        text = f" x{chr(code)}y {chr(code)}{chr(code)} 1{chr(code)}2 \n{chr(code)}\n'{chr(code)}s  {chr(code)}  z"
        assert a.fast.encode_ordinary(text) == a.own.encode(text, add_special_tokens=False).ids, code


def test_products_of_sparse_matrices(monkeypatch):
    random.seed(2)
    monkeypatch.setattr(token_alignment, "PARTIALS", 40)
    for _ in range(20):
        left, right = (np.random.default_rng(random.randint(0, 99)).integers(0, 3, shape) for shape in ((9, 14), (14, 11)))
        a, b = (
            token_alignment.Csr(
                np.concatenate([[0], np.cumsum((m > 0).sum(axis=1))]), np.nonzero(m)[1], m[np.nonzero(m)], m.shape[1]
            ) for m in (left, right)
        )
        made = np.zeros((9, 11), dtype=int)
        for row, column, value in token_alignment.product(a, b):
            made[row, column] += value
        assert (made == left @ right).all()
        back = b.transposed().transposed()
        assert (back.starts == b.starts).all() and (back.columns == b.columns).all() and (back.values == b.values).all()
