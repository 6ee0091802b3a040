import hashlib
import json
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T
from tokenizers import Tokenizer

from helpers import SF, documents, texts
from mishap.llm import sentencepieces, token_alignment
from mishap.llm.token_alignment import Aligned, align, alignment_figures, op13_token_alignment

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(A_PATH)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
with open(A_PATH, encoding="utf-8") as file:
    ENTRY = {i: t for t, i in json.load(file)["model"]["vocab"].items()}
SEEN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE = {chr(b): b for b in SEEN} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in SEEN)}


def tokens(text):
    """(id, bytes) of both tokenizers, or none."""
    if not text:
        return [], []
    a = [(i, bytes(BYTE[c] for c in ENTRY[i])) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in B.encode(text):
        piece = B.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def spans(found):
    ends = np.cumsum([len(x) for _, x in found]).tolist()
    return [(e - len(x), e, i) for e, (i, x) in zip(ends, found, strict=True)]


def groups(a, b):
    a, b = spans(a), spans(b)
    cuts = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
    return [([i for _, e, i in a if low < e <= high], [i for _, e, i in b if low < e <= high])
            for low, high in zip([0, *cuts], cuts, strict=False)]


def brute(docs):
    links, out = [], []
    for _, text in docs:
        a, b = map(spans, tokens(text))
        links.append([(i, j) for s, e, i in a for t, f, j in b if s < f and t < e])
    count = Counter(p for own in links for p in own)
    most = {}
    for (_, j), n in count.items():
        most[j] = max(most.get(j, 0), n)
    for (key, text), own in zip(docs, links, strict=True):
        a, b = tokens(text)
        found = groups(a, b)
        joined = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in found)
        out.append((key, len(a), len(b), len(found), len(own), sum(count[p] == most[p[1]] for p in own),
                    sum(count[p] for p in own), hashlib.sha256(joined.encode()).hexdigest() if a else ""))
    return out


def rows(frame):
    return [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in frame.collect()]


ODD = [(1, "one two three"), (1, "one two three"), (None, "no key"), (2, None), (3, ""), (4, "▁mark"), (5, " "), (6, "x<|endoftext|> y"),
       (7, "é漢字🙂　é"), (8, "a\n\n  b\t  c" * 30), (9, "don't I'LL 1234567"), (10, "</s><s><0x41>"), (11, "ab" * 300),
       (12, "\x1c\x85 \xa0x"), (13, "   lead and trail   ")]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=12), min_size=1, max_size=4))
def test_components_by_pointer_jumping(parts):
    a_length, b_length = np.arange(5), np.arange(5)
    a = np.concatenate([[*p, 1] for p in parts])
    b = np.concatenate([[1, *p] for p in parts])
    found = Aligned.of(a, b, a_length, b_length)
    a_end, b_end = np.cumsum(a), np.cumsum(b)
    cuts = sorted(set(a_end.tolist()) & set(b_end.tolist()))
    assert found.a_group.tolist() == np.searchsorted(cuts, a_end).tolist()
    assert found.b_group.tolist() == np.searchsorted(cuts, b_end).tolist()
    want = [(i, j) for j in range(len(b)) for i in range(len(a)) if a_end[i] - a[i] < b_end[j] and b_end[j] - b[j] < a_end[i]]
    assert list(zip(*[x.tolist() for x in found.links()], strict=True)) == want


def test_brute_force(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "BLOCK_DOCS", 4)
    assert sorted(map(repr, rows(alignment_figures(texts(spark, ODD))))) == sorted(map(repr, brute(ODD)))


def test_query(spark):
    got = {r[0]: r for r in rows(op13_token_alignment(spark, SF))}
    docs = documents()
    assert len(got) == len(docs)
    want = {r[0]: r for r in brute_fast(docs)}
    assert got == want


def brute_fast(docs):
    """As ``brute``, with the overlapping pairs by a merge of the two lists."""
    links, out, found = [], [], []
    for _, text in docs:
        both = tokens(text)
        a, b = map(spans, both)
        own, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            own.append((a[i][2], b[j][2]))
            if a[i][1] == b[j][1]:
                i, j = i + 1, j + 1
            elif a[i][1] < b[j][1]:
                i += 1
            else:
                j += 1
        links.append(own)
        parts, at, to = [], [[], []], 0
        cuts = {e for _, e, _ in a} & {e for _, e, _ in b}
        for k, side in ((0, a), (1, b)):
            groups_ = [[]]
            for _, e, t in side:
                groups_[-1].append(t)
                if e in cuts:
                    groups_.append([])
            at[k] = groups_[:-1]
        parts = [",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in zip(*at, strict=True)]
        found.append((len(a), len(b), len(parts), hashlib.sha256(";".join(parts).encode()).hexdigest() if a else ""))
    count = Counter(p for own in links for p in own)
    most = {}
    for (_, j), n in count.items():
        most[j] = max(most.get(j, 0), n)
    for (key, _), own, (n_a, n_b, n_groups, digest) in zip(docs, links, found, strict=True):
        out.append((key, n_a, n_b, n_groups, len(own), sum(count[p] == most[p[1]] for p in own), sum(count[p] for p in own), digest))
    return out


def test_both_brute_forces_agree():
    assert brute(ODD) == brute_fast(ODD)


def test_parts_of_long_texts(monkeypatch):
    pair = token_alignment.pair_of(A_PATH, B_PATH)
    text = "Some words here, 12 of them.\n  More don't  spaces 字字 " * 60 + "end of it all " * 40
    data = np.frombuffer(text.encode(), np.uint8)
    whole, = pair.tokens(data)
    assert list(pair.tokens(np.frombuffer((text + "▁").encode(), np.uint8))) == []
    monkeypatch.setattr(sentencepieces, "PART_BYTES", 100)
    parts = list(pair.tokens(data))
    assert len(parts) > 10
    assert list(pair.tokens(np.frombuffer((text + "▁").encode(), np.uint8))) == []
    for k in (0, 1):
        assert np.concatenate([p[k] for p in parts]).tolist() == whole[k].tolist()


@pytest.mark.parametrize("text", [" " * 60000, "ab" * 20000, "\n" * 30000 + "x"])
def test_odd_long_texts(text):
    (a, b), = token_alignment.pair_of(A_PATH, B_PATH).tokens(np.frombuffer(text.encode(), np.uint8))
    assert a.tolist() == A.encode(" " + text, add_special_tokens=False).ids and b.tolist() == B.encode(text)


def test_texts_in_many_pieces(monkeypatch):
    """The same figures and groups whatever the pieces (run in this process, so that the sizes hold)."""
    docs = [(1, "Some words here, 12 of them.\n  More don't  spaces 字字 " * 20 + "end of it all " * 20), (2, None), (3, "short one"),
            (4, "x▁y"), (5, "another one of some words here " * 30)]
    batch = pa.RecordBatch.from_arrays([pa.array([k for k, _ in docs]), pa.array([t for _, t in docs])], names=["doc_id", "text"])
    monkeypatch.setattr(token_alignment, "map_batches", lambda df, fn, schema: [b for b in fn(iter([batch]))])

    monkeypatch.setattr(token_alignment, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))

    class Frame:
        schema = {"doc_id": T.StructField("doc_id", T.LongType())}

        def select(self, *names):
            return self

    def found():
        blocks_, = token_alignment.blocks(Frame(), A_PATH, B_PATH)
        aligned, = align(Frame())
        return blocks_.to_pylist(), aligned.to_pylist()

    whole = found()
    monkeypatch.setattr(sentencepieces, "PART_BYTES", 100)
    monkeypatch.setattr(token_alignment, "PIECE_TOKENS", 60)
    assert found() == whole
    assert [r["a_groups"] for r in whole[1]] == [[n for n, g in enumerate(groups(*tokens(t))) for _ in g[0]] for _, t in docs]


def test_groups_of_tokens(spark):
    got = sorted((repr(r.doc_id), r.a_ids, r.a_groups, r.b_ids, r.b_groups) for r in align(texts(spark, ODD)).collect())
    want = []
    for key, text in ODD:
        found = groups(*tokens(text))
        want.append((repr(key), *[x for k in (0, 1) for x in ([i for g in found for i in g[k]],
                                                              [n for n, g in enumerate(found) for _ in g[k]])]))
    assert got == sorted(want)


def test_other_columns_and_empty_table(spark):
    frame = texts(spark, [(1, "a b", 5, "x"), (2, "c", 6, "y")], ", block long, pairs string")
    assert sorted(rows(alignment_figures(frame))) == sorted(brute([(1, "a b"), (2, "c")]))
    assert alignment_figures(texts(spark, [])).count() == 0
    assert alignment_figures(texts(spark, [(1, None), (2, "")])).count() == 2
    assert align(texts(spark, [])).count() == 0
