import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2 as messages

from helpers import SF, documents, texts
from mishap.llm import sentencepieces
from mishap.llm.sentencepieces import Pieces, decode, encode, op11_sentencepiece

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
PIECES = Pieces(PATH)
ODD = ["", " ", "  a  b ", "\n\t x", "▁a ▁", "é漢字🙂　é", "<s> </s><unk><0x41>", "a\0b", " " * 500, "ab" * 3000, "ﬁ Ａ　x",
       "éa ́", "x    y     z\n\n   q ", "字" * 500 + " ab", "🙂\U0001f9ff" * 3, "one two"]
LETTERS = st.text(st.sampled_from("abcthe   \n\té漢字🙂Жﬁ①Å　­​㍿한글"), max_size=40)


def library(processor, text):
    return [(p.id, p.begin, p.end) for p in processor.encode(text, out_type="proto").pieces]


def own(pieces, text):
    return [tuple(map(int, row)) for row in zip(*pieces.encode(np.frombuffer(text.encode(), np.uint8)), strict=True)]


def model(rule, prefix=True, trim=False, suffix=False, symbols=()):
    """The given model under another of the library's compiled character maps."""
    with open(PATH, "rb") as file:
        found = messages.ModelProto.FromString(file.read())
    spec = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec()
    found.normalizer_spec.precompiled_charsmap = messages.NormalizerSpec.FromString(spec).precompiled_charsmap
    found.normalizer_spec.add_dummy_prefix, found.normalizer_spec.remove_extra_whitespaces = prefix, trim
    found.trainer_spec.treat_whitespace_as_suffix = suffix
    for symbol in symbols:
        found.pieces.add(piece=symbol, score=0, type=messages.ModelProto.SentencePiece.USER_DEFINED)
    return found.SerializeToString()


@pytest.mark.parametrize("text", ODD)
def test_ids_and_spans_are_the_librarys(text):
    assert own(PIECES, text) == library(LIBRARY, text)
    ids = LIBRARY.encode(text)
    assert PIECES.decode(np.array(ids, np.int64)) == LIBRARY.decode(ids)


@settings(max_examples=400, deadline=None)
@given(LETTERS)
def test_any_text(text):
    assert own(PIECES, text) == library(LIBRARY, text)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 258), st.integers(0, 31999)), max_size=9))
def test_any_ids(ids):
    assert PIECES.decode(np.array(ids, np.int64)) == LIBRARY.decode(ids)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "nfkc_cf"])
@pytest.mark.parametrize("options", [{}, {"trim": True}, {"prefix": False}, {"suffix": True, "trim": True},
                                     {"symbols": ("①x", "字 a")}])
def test_compiled_character_maps(rule, options):
    raw = model(rule, **options)
    processor, pieces = sentencepiece.SentencePieceProcessor(model_proto=raw), Pieces(model=raw)

    @settings(max_examples=50, deadline=None)
    @given(st.one_of(LETTERS, st.text(max_size=12).filter(lambda t: "▁" not in t), st.sampled_from([*ODD, "①xab 字 a字 a"])))
    def check(text):
        assert own(pieces, text) == library(processor, text)
        ids = processor.encode(text)
        assert pieces.decode(np.array(ids, np.int64)) == processor.decode(ids)
    check()


@pytest.mark.parametrize("rule", ["identity", "nmt_nfkc"])
def test_parts_of_long_texts(rule, monkeypatch):
    monkeypatch.setattr(sentencepieces, "PART_BYTES", 64)
    raw = model(rule)
    processor, pieces = sentencepiece.SentencePieceProcessor(model_proto=raw), Pieces(model=raw)
    text = ("Some words ﬁne and plain, 12 of them.\n  More  字字字 spaces " * 40) + "x" * 400 + " the end of it " * 30
    data = np.frombuffer(text.encode(), np.uint8)
    parts = list(pieces.parts(data))
    assert len(parts) > 20 and [p[1] for p in parts[:-1]] == [p[0] for p in parts[1:]] and parts[-1][1] == len(data)
    assert own(pieces, text) == library(processor, text)


def test_query(spark):
    got = {r.doc_id: r for r in op11_sentencepiece(spark, SF).collect()}
    rows = documents()
    assert len(got) == len(rows)
    for i, text in rows:
        ids = LIBRARY.encode(text or "")
        r = got[i]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
        assert r.covered_bytes == len((text or "").encode())


def test_nulls_repeats_and_other_columns(spark):
    rows = [(1, "one two", "a"), (1, "one two", "a"), (None, "no key", "b"), (2, None, "c"), (3, "", "d"), (4, " x" * 300000, "e")]
    got = encode(texts(spark, rows, ", ids string")).collect()
    assert sorted(map(repr, [(r.doc_id, r.ids, r.decoded) for r in got])) == sorted(map(repr, [
        (i, LIBRARY.encode(t or ""), LIBRARY.decode(LIBRARY.encode(t or ""))) for i, t, _ in rows]))
    back = decode(spark.createDataFrame([(LIBRARY.encode("a b"), "x"), (None, "y"), ([], "z")], "ids array<int>, decoded string"))
    assert [r.decoded for r in back.collect()] == ["a b", "", ""]


def test_empty_table(spark):
    assert encode(texts(spark, [])).count() == 0
    assert decode(encode(texts(spark, []))).count() == 0
