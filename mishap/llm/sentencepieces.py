"""Operator 11: SentencePiece encoding with byte offsets in the source, and decoding."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as messages

from mishap.llm.common import Batches, chunks, map_batches, table, text_buffers

MODEL = "piece_bpe_32k.model"
CHUNK_BYTES = 1024 * 1024
PART_BYTES = 4 * 1024 * 1024
"""A text over this size is encoded in parts, cut where no piece and no rule of the map can span."""
LONG_WORD = 200
MARK = "▁"
_MARK = np.frombuffer(MARK.encode(), np.uint8)
SPACE = 32


class CharacterMap:
    """A compiled character map: a double-array trie over UTF-8 keys, then the
    replacements, each closed by a zero byte.  An empty blob maps nothing."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4) if size else np.zeros(0, np.uint32)
        self.texts = np.frombuffer(blob, np.uint8, -1, 4 + size) if size else np.zeros(0, np.uint8)
        self.closed = np.append(np.flatnonzero(self.texts == 0), len(self.texts))
        self.opens = np.zeros(256, bool)
        if size:
            self.opens[self._step(np.full(256, self._child(np.zeros(1, np.int64))[0]), np.arange(256))[0]] = True

    def _child(self, node: np.ndarray) -> np.ndarray:
        unit = self.units[node].astype(np.int64)
        return node ^ ((unit >> 10) << ((unit & 512) >> 6))

    def _step(self, base: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the edges exist, the bases below them, and the values there (-1: none)."""
        node = base ^ label
        there = np.flatnonzero(node < len(self.units))
        there = there[(self.units[node[there]] & np.uint32(0x800000FF)) == label[there]]
        node = node[there]
        below = self._child(node)
        leaf = (self.units[node] >> 8 & 1).astype(bool)
        return there, below, np.where(leaf, self.units[np.where(leaf, below, 0)].astype(np.int64) & 0x7FFFFFFF, -1)

    def longest(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of every start: the length of the longest key found there (0: none) and its value."""
        length, value = np.zeros(len(starts), np.int64), np.full(len(starts), -1, np.int64)
        if not len(self.units):
            return length, value
        alive = np.flatnonzero(self.opens[data[starts]])
        base, depth = np.full(len(alive), self._child(np.zeros(1, np.int64))[0]), 0
        while len(alive):
            inside = starts[alive] + depth < len(data)
            alive, base = alive[inside], base[inside]
            there, base, found = self._step(base, data[starts[alive] + depth].astype(np.int64))
            alive, depth = alive[there], depth + 1
            length[alive[found >= 0]], value[alive[found >= 0]] = depth, found[found >= 0]
        return length, value

    def replacement(self, value: np.ndarray) -> np.ndarray:
        """Lengths of the replacements that start at the values."""
        return self.closed[np.searchsorted(self.closed, value)] - value

    def joins_words(self) -> bool:
        """Whether a key holds a space behind a letter or digit, so that texts can't be cut there."""
        if not len(self.units):
            return False
        base, last = self._child(np.zeros(1, np.int64)), np.zeros(1, np.int64)
        labels = np.arange(1, 256)
        while len(base):
            there, below, _ = self._step(np.repeat(base, 255), np.tile(labels, len(base)))
            label, before = np.tile(labels, len(base))[there], np.repeat(last, 255)[there]
            if (_ALNUM[before] & (label == SPACE)).any():
                return True
            base, last = below, label
        return False


_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


@dataclass
class Normal:
    """Normalised bytes and, for each of them and their end, the byte of the source it stands for."""
    data: np.ndarray
    source: np.ndarray


class Pieces:
    """A SentencePiece model that keeps source offsets.

    Normalisation is done here, by the longest key of the model's compiled
    character map at each place, with the source byte of every normalised
    byte; the normalised text is merged (by the library, under the same model
    with its own normaliser switched off); lengths of the pieces then project
    each to its bytes of the source.  Where the model allows it (``_ranked``),
    tiktoken merges all but odd words, to the same ids in half the time.
    """

    def __init__(self, path: str | None = None, model: bytes | None = None):
        if model is None:
            with open(path or public_tokenizers.path(MODEL), "rb") as file:
                model = file.read()
        self.spec = messages.ModelProto.FromString(model)
        self.rules, self.suffix = self.spec.normalizer_spec, self.spec.trainer_spec.treat_whitespace_as_suffix
        self.map = CharacterMap(self.rules.precompiled_charsmap)
        bare = messages.ModelProto.FromString(model)
        rules = bare.normalizer_spec
        rules.name, rules.precompiled_charsmap = "identity", b""
        rules.add_dummy_prefix, rules.remove_extra_whitespaces = False, False
        bare.trainer_spec.treat_whitespace_as_suffix = False
        self.merger = sentencepiece.SentencePieceProcessor(model_proto=bare.SerializeToString())
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=model)
        kinds = np.array([p.type for p in self.spec.pieces])
        kind = messages.ModelProto.SentencePiece
        self.is_unknown, self.is_control, self.is_byte = kinds == kind.UNKNOWN, kinds == kind.CONTROL, kinds == kind.BYTE
        self.has_unknown = not self.spec.trainer_spec.byte_fallback
        self.surface = np.array([self._surface(p) for p in self.spec.pieces], object)
        self.length = np.array([1 if b else len(p.piece.encode()) for p, b in zip(self.spec.pieces, self.is_byte, strict=True)])
        own = [p.piece for p, k in zip(self.spec.pieces, kinds, strict=True) if k in (kind.NORMAL, kind.USER_DEFINED)]
        symbols = sorted((p.piece.encode() for p, k in zip(self.spec.pieces, kinds, strict=True) if k == kind.USER_DEFINED),
                         key=len, reverse=True)
        self.symbols = re.compile(b"(?=(" + b"|".join(map(re.escape, symbols)) + b"))") if symbols else None
        self.by_word = self.rules.escape_whitespaces and not any(MARK in p.lstrip(MARK) for p in own)
        self.cuttable = self.by_word and not self.suffix and not symbols and not self.map.joins_words()
        self.ranked = self._ranked()

    def _ranked(self) -> tiktoken.Encoding | None:
        """The model's merges as byte ranks: bytes, beginnings of its characters, characters, pieces by score.

        Only if no piece has the mark behind another character, scores differ
        but for runs of marks, unknown characters fall back to bytes and every
        piece by itself merges to itself; None otherwise.
        """
        kind = messages.ModelProto.SentencePiece.NORMAL
        own = [(p.piece.encode(), p.score, k) for k, p in enumerate(self.spec.pieces) if p.type == kind]
        scores = [score for piece, score, _ in own if piece.strip(_MARK.tobytes())]
        if (not self.by_word or self.has_unknown or self.symbols or len(set(scores)) < len(scores)
                or self.spec.trainer_spec.model_type != messages.TrainerSpec.BPE
                or any(found != [k] for found, k in zip(self.merger.encode([p.decode() for p, _, _ in own], num_threads=1),
                                                        [k for _, _, k in own], strict=True))):
            return None
        ranks = {bytes([b]): b for b in range(256)}
        chars = [p for p, _, _ in own if len(p) > 1 and len(p.decode()) == 1]
        begun = sorted({c[:k] for c in chars for k in range(2, len(c))}, key=lambda c: (len(c), c))
        for piece in [*begun, *chars, *[p for p, _, _ in sorted(own, key=lambda o: -o[1])]]:
            ranks.setdefault(piece, len(ranks))
        by_bytes = {p: [k] for p, _, k in own}
        single = {self.surface[k]: k for k in np.flatnonzero(self.is_byte)}
        found = [by_bytes.get(piece) or [single[bytes([b])] for b in piece] for piece in ranks]
        self.spread = np.array([len(f) for f in found])
        self.first = np.cumsum(self.spread) - self.spread
        self.of_rank = np.concatenate(found).astype(np.int32)
        self.odd = re.compile(f"({MARK}{{2,}}[^{MARK}]*|{MARK}?[^{MARK}]{{{LONG_WORD},}})")
        return tiktoken.Encoding("pieces", pat_str=f"{MARK}?[^{MARK}]+|{MARK}", mergeable_ranks=ranks, special_tokens={})

    def _surface(self, piece) -> bytes:
        kind = type(piece)
        if piece.type == kind.CONTROL:
            return b""
        if piece.type == kind.UNKNOWN:
            return self.spec.trainer_spec.unk_surface.encode()
        if piece.type == kind.BYTE:
            return bytes([int(piece.piece[3:5], 16)])
        return piece.piece.replace(MARK, " ").encode()

    # normalisation

    def _matches(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, lengths and map values (-1: kept as it is) that a scan from the left replaces."""
        starts = np.flatnonzero(((data & 0xC0) != 0x80) & self.map.opens[data])
        length, value = self.map.longest(data, starts)
        starts, length, value = starts[length > 0], length[length > 0], value[length > 0]
        if self.symbols:                             # symbols of the model's own go before the map and stay as they are
            found = np.array([m.span(1) for m in self.symbols.finditer(data.tobytes())], np.int64).reshape(-1, 2)
            other = ~np.isin(starts, found[:, 0])
            starts = np.concatenate([found[:, 0], starts[other]])
            length = np.concatenate([found[:, 1] - found[:, 0], length[other]])
            value = np.concatenate([np.full(len(found), -1), value[other]])
            order = np.argsort(starts)
            starts, length, value = starts[order], length[order], value[order]
        if (starts[1:] < (starts + length)[:-1]).any():
            kept, end = [], 0
            for k, (at, n) in enumerate(zip(starts.tolist(), length.tolist(), strict=True)):
                if at >= end:
                    kept.append(k)
                    end = at + n
            starts, length, value = starts[kept], length[kept], value[kept]
        return starts, length, value

    def _leading(self, data: np.ndarray, starts: np.ndarray, length: np.ndarray, value: np.ndarray) -> int:
        """Bytes at the source's start that become single spaces."""
        at, k = 0, 0
        while at < len(data):
            if k < len(starts) and starts[k] == at:
                if self.map.texts[value[k]:value[k] + 2].tobytes() != b" \0":
                    break
                at, k = at + int(length[k]), k + 1
            elif data[at] == SPACE:
                at += 1
            else:
                break
        return at

    def normalise(self, data: np.ndarray, first: bool = True, last: bool = True) -> Normal:
        """Normalised bytes of a source text, or of its first, middle or last part."""
        empty = Normal(data[:0], np.zeros(1, np.int64))
        if not len(data):
            return empty
        lead = (data & 0xC0) != 0x80
        place = np.arange(len(data), dtype=np.int32)
        if not lead.all():
            place = np.maximum.accumulate(np.where(lead, place, 0))
        starts, length, value = self._matches(data) if len(self.map.units) or self.symbols else (np.zeros(0, np.int64),) * 3
        if len(starts):
            mapped = value >= 0
            for at, n in zip(starts[~mapped].tolist(), length[~mapped].tolist(), strict=True):
                place[at:at + n] = at
            starts, length, value = starts[mapped], length[mapped], value[mapped]
            n_out = self.map.replacement(value)
            size = np.ones(len(data), np.int64)
            covered = np.repeat(starts, length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            size[covered] = 0
            size[starts] = n_out
            ends = np.cumsum(size)
            out = np.repeat(data, size)
            at = np.arange(n_out.sum()) - np.repeat(np.cumsum(n_out) - n_out, n_out)
            out[np.repeat(ends[starts] - n_out, n_out) + at] = self.map.texts[np.repeat(value, n_out) + at]
            place = np.repeat(place, size)
            data_out = out
        else:
            data_out = data
        end = len(data)
        begin = self._leading(data, starts, length, value) if first and self.rules.remove_extra_whitespaces else 0
        if self.rules.remove_extra_whitespaces:
            space = data_out == SPACE
            keep = ~(space & np.concatenate([[first], space[:-1]]))
            data_out, place = data_out[keep], place[keep]
            if first and begin == end:
                return empty
        if self.rules.add_dummy_prefix and first and not self.suffix:
            data_out, place = np.concatenate([[np.uint8(SPACE)], data_out]), np.concatenate([[begin], place], dtype=np.int32)
        mark = np.array([SPACE], np.uint8)
        if self.rules.escape_whitespaces:
            mark, space = _MARK, data_out == SPACE
            if space.any():
                size = np.where(space, 3, 1)
                where = (np.cumsum(size) - size)[space]
                data_out, place = np.repeat(data_out, size), np.repeat(place, size)
                for k in range(3):
                    data_out[where + k] = mark[k]
        if self.rules.remove_extra_whitespaces and last:
            while len(data_out) >= len(mark) and (data_out[-len(mark):] == mark).all():
                end, data_out, place = int(place[-len(mark)]), data_out[:-len(mark)], place[:-len(mark)]
        if self.rules.add_dummy_prefix and last and self.suffix:
            data_out, place = np.concatenate([data_out, mark]), np.append(place, np.full(len(mark), end, np.int32))
        return Normal(data_out, np.append(place, np.int32(end)))

    # encoding

    def _by_ranks(self, normal: str) -> np.ndarray:
        ranks = np.array(self.ranked.encode_ordinary(normal), np.int64)
        n = self.spread[ranks]
        if len(n) and n.max() > 1:                   # a character of no piece: its bytes
            at = np.repeat(self.first[ranks] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            return self.of_rank[at]
        return self.of_rank[self.first[ranks]]

    def ids(self, normal: str) -> np.ndarray:
        """Token ids of a normalised text."""
        if not self.ranked:
            return np.array(self.merger.encode(normal), np.int32)
        if 2 * MARK not in normal and max(map(len, normal.split(MARK))) < LONG_WORD:
            return self._by_ranks(normal)
        parts = self.odd.split(normal)               # at odd places: runs of marks (equal scores) and very long words
        return np.concatenate([np.array(self.merger.encode(p), np.int32) if k % 2 else self._by_ranks(p)
                               for k, p in enumerate(parts)])

    def _lengths(self, ids: np.ndarray, normal: str) -> np.ndarray:
        """Bytes of the normalised text that each token stands for."""
        if not self.has_unknown:
            return self.length[ids]
        own = self.merger.encode(normal, out_type=str)
        return np.where(self.is_byte[ids], 1, np.array([len(p.encode()) for p in own], np.int64))

    def parts(self, data: np.ndarray) -> Iterator[tuple[int, int]]:
        """Ranges of the source that are encoded by themselves: whole texts, and parts of very long ones."""
        at = 0
        while len(data) - at > PART_BYTES and self.cuttable:
            to, width = at + PART_BYTES, 4096
            cut = None
            while cut is None and to - width // 2 < len(data):
                window = data[to - 1:to + width]     # look ahead for a single space between letters or digits
                good = np.flatnonzero((window[1:-1] == SPACE) & _ALNUM[window[:-2]] & _ALNUM[window[2:]])
                cut = to + int(good[0]) if len(good) else None
                to, width = to + width - 2, width
            if cut is None:
                break
            yield at, cut
            at = cut
        yield at, len(data)

    def encode(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a source text's UTF-8 bytes, and the first byte and the end of each piece there."""
        found = []
        for at, to in self.parts(data):
            normal = self.normalise(data[at:to], at == 0, to == len(data))
            text = normal.data.tobytes().decode("utf-8", "replace")
            ids = self.ids(text)
            ends = np.cumsum(self._lengths(ids, text)) if len(ids) else np.zeros(0, np.int64)
            edges = normal.source[np.concatenate([[0], ends])].astype(np.int64) + at
            found.append((ids, edges[:-1], edges[1:]))
        if len(found) == 1:
            return found[0]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    # decoding

    def decode(self, ids: np.ndarray) -> str:
        """The text of token ids, as the library's ``decode`` gives it."""
        if self.spec.HasField("denormalizer_spec") and self.spec.denormalizer_spec.precompiled_charsmap:
            return self.whole.decode(ids.tolist())
        parts = self.surface[ids].tolist()
        if self.rules.add_dummy_prefix or self.rules.remove_extra_whitespaces:
            for k in np.flatnonzero(~self.is_control[ids]).tolist() if self.rules.remove_extra_whitespaces else \
                    np.flatnonzero(~self.is_control[ids])[:1].tolist():
                if self.is_byte[ids[k]] or self.is_unknown[ids[k]]:
                    break
                parts[k] = parts[k].removeprefix(b" ")
                if parts[k]:
                    break
        if not (self.is_byte[ids].any() and self.is_control[ids].any()):
            try:
                return b"".join(parts).decode()
            except UnicodeDecodeError:
                pass
        text, run = [], b""                          # byte tokens that make no character: each counts by itself
        for part, byte in zip([*parts, b""], [*self.is_byte[ids].tolist(), False], strict=True):
            if byte:
                run += part
            else:
                text.append(_by_byte(run) + part.decode())
                run = b""
        return "".join(text)


def _by_byte(run: bytes) -> str:
    """UTF-8 text of a run of bytes; a byte that starts no character becomes U+FFFD."""
    out, at = [], 0
    while at < len(run):
        for n in (1, 2, 3, 4):
            try:
                out.append(run[at:at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                pass
        else:
            out.append("�")
            at += 1
    return "".join(out)


_PIECES: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    """The model at ``path``, loaded once in a process."""
    return _PIECES.get(path) or _PIECES.setdefault(path, Pieces(path))


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32), pa.int32()))


def encode(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every whole text's ``ids`` with the source bytes ``begins`` to ``ends`` of each piece, and ``decoded``.

    One row per row of ``docs`` (only key and text are read): repeated rows
    stay, null keys stay, a null or empty text has empty lists and the empty
    text.  A character that falls back to bytes belongs to its last byte's
    piece, the others being empty there; what the map drops belongs to no piece.
    """
    path = path or public_tokenizers.path(MODEL)
    whole = T.ArrayType(T.IntegerType())
    schema = T.StructType([docs.schema[key], *[T.StructField(n, whole) for n in ("ids", "begins", "ends")],
                           T.StructField("decoded", T.StringType())])

    def run(batches: Batches) -> Batches:
        pieces = pieces_of(path)
        for b in chunks(batches, text, CHUNK_BYTES):
            data, offsets = text_buffers(b.column(1))
            found = [pieces.encode(data[i:k]) for i, k in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[_lists([f[k] for f in found]) for k in range(3)],
                 pa.array([pieces.decode(f[0]) for f in found], pa.string())], names=schema.names)

    return map_batches(docs.select(key, text), run, schema)


def decode(encoded: DataFrame, path: str | None = None, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """The rows with the text of their ``ids`` (null lists and null ids in them: nothing) as ``decoded``."""
    path = path or public_tokenizers.path(MODEL)
    kept = [c for c in encoded.columns if c != decoded]
    at = kept.index(ids)
    schema = T.StructType([*encoded.select(*kept).schema.fields, T.StructField(decoded, T.StringType())])

    def run(batches: Batches) -> Batches:
        pieces = pieces_of(path)
        for b in batches:
            texts = [pieces.decode(np.array([i for i in row or () if i is not None], np.int64)) for row in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=schema.names)

    return map_batches(encoded.select(*kept), run, schema)


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long").alias("covered_bytes"))
