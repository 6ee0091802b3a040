import bisect
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import SF, documents, texts
from mishap.llm.packing import Capacities, Ids, op3_packing, pack, plan, sequences, tokenize

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


def best_fit(lengths, window):
    """Plain best-fit decreasing, piece by piece: the windows' remaining rooms."""
    rooms, count = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, n)
        room = rooms.pop(at) if at < len(rooms) else window
        count += room == window and at >= len(rooms)
        bisect.insort(rooms, room - n)
    return sorted(rooms)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=120))
def test_plan_equals_piecewise_best_fit(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    used = {}
    for length, _, n, first, offset, each in plan(counts, 32).tolist():
        for k in range(n):
            used.setdefault(first + k // each, []).append((offset + k % each * length, length))
    for spans in used.values():
        ends = 0
        for offset, length in sorted(spans):
            assert offset == ends
            ends += length
    assert sorted(used) == list(range(len(used)))
    assert sorted(32 - sum(n for _, n in spans) for spans in used.values()) == best_fit(lengths, 32)


def test_segment_tree():
    tree = Capacities(10)
    for c in (3, 7, 10):
        tree.set(c, True)
    assert [tree.tightest(k) for k in (1, 3, 4, 7, 8, 10)] == [3, 3, 7, 7, 10, 10]
    tree.set(10, False)
    assert tree.tightest(8) is None


@pytest.mark.parametrize("text", ["", " ", "a  b   c\n\n d", "don't I'LL", "x<|endoftext|> y", "漢字 🙂\u3000é", " " * 60000,
                                  "\x1c\x85 \xa0x", "ab" * 30000])
def test_ids_are_the_tokenizers(text):
    assert Ids(public_tokenizers.path("byte_bpe_50k.json")).of(text).tolist() == ids(text)[:-1]


def test_query_keeps_every_id_once(spark):
    got = {}
    rows = op3_packing(spark, SF).collect()
    for r in rows:
        got.setdefault(r.doc_id, []).append(r)
    for i, text in documents():
        want, at = ids(text), 0
        for r in sorted(got[i], key=lambda r: r.start):
            piece = np.array(want[at:at + r.length], "<u4").tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(want), zlib.crc32(piece))
            at += r.length
        assert at == len(want)
    fill = {}
    for r in sorted(rows, key=lambda r: r.offset):
        assert fill.get(r.sequence_id, 0) == r.offset
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 2048 and len(fill) == len(best_fit([r.length for r in rows], 2048))


def test_sequences_give_the_documents_back(spark):
    docs = [(1, "one two"), (2, None), (3, ""), (1, "one two"), (None, "no key"), (4, "long " * 5000)]
    frame = texts(spark, [(*d, 9) for d in docs], ", offset long")
    packed = pack(tokenize(frame, window=64), 64)
    flat = {r.sequence_id: np.frombuffer(bytes(r.ids), "<u4") for r in sequences(packed, 64).collect()}
    assert all(len(x) == 64 or (len(x) & (len(x) - 1)) == 0 for x in flat.values())
    back = {}
    for r in packed.collect():
        part = flat[r.sequence_id][r.offset:r.offset + r.length]
        assert part.tobytes() == bytes(r.ids)
        back.setdefault((r.doc_id, r.start), []).append(part.tolist())
    for i, text in docs:
        want = ids(text)
        for at in range(0, len(want), 64):
            assert want[at:at + 64] in back[i, at]
    assert len(back[1, 0]) == 2


def test_empty_table(spark):
    assert pack(tokenize(texts(spark, []))).count() == 0
    assert sequences(pack(tokenize(texts(spark, [])))).agg(F.count("*")).first()[0] == 0
