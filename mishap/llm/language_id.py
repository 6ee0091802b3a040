"""Operator 6: language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mishap.llm.common import Batches, chunks, free_name, map_batches, store, table

SAMPLE_DOCS = 400
"""Training documents of a language at most: different ones, chosen by the hash of id and text."""
SAMPLE_WORDS = 150
"""Words of a training document at most, evenly spaced."""
SAMPLE_ALL = 80_000
"""Training documents of all languages together; of more than 200 languages each has fewer, but one at least."""
LONGEST = 32
"""Bytes that the network reads in one go; longer words are read in parts."""
HIDDEN = 12
STEPS = 500
BATCH = 256
CHUNK_BYTES = 1024 * 1024
KEPT_WORDS = 200_000


def held_out(key: Column) -> Column:
    """crc32 of the id as text leaves 2 by 4 (a null id is not held out)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def words_of(text: str) -> list[bytes]:
    """Lower-cased words between white space, as byte strings of at most ``LONGEST``."""
    found = text.lower().encode("utf-8", "replace").split()
    if any(len(w) > LONGEST for w in found):
        found = [w[i:i + LONGEST] for w in found for i in range(0, len(w), LONGEST)]
    return found


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Network:
    """Two gated recurrent layers, one reading each way, and a softmax at every byte.

    The state starts afresh at every word.  ``weights`` holds, for both
    directions, the byte table (256 x 3H) and the recurrent matrix (H x 3H), then
    the output layer.
    """
    languages: list[str]
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, languages: list[str], hidden: int, rng: np.random.Generator) -> Network:
        draw = lambda *shape: (rng.standard_normal(shape) * 0.2).astype(np.float32)
        return cls(languages, {
            "bytes0": draw(256, 3 * hidden), "state0": draw(hidden, 3 * hidden),
            "bytes1": draw(256, 3 * hidden), "state1": draw(hidden, 3 * hidden),
            "out": draw(2 * hidden, len(languages)), "bias": np.zeros(len(languages), np.float32)})

    def read(self, data: np.ndarray, way: int) -> tuple[np.ndarray, list]:
        """States (position, word, H) of words of equal length, and what training needs of each step."""
        x, u = self.weights[f"bytes{way}"], self.weights[f"state{way}"]
        hidden, steps = u.shape[0], data.shape[1]
        h = np.zeros((len(data), hidden), np.float32)
        states, kept = np.empty((steps, len(data), hidden), np.float32), []
        for t in (range(steps) if way == 0 else range(steps - 1, -1, -1)):
            a, g = x[data[:, t]], h @ u
            zr = _sigmoid(a[:, :2 * hidden] + g[:, :2 * hidden])
            z, r = zr[:, :hidden], zr[:, hidden:]
            n = np.tanh(a[:, 2 * hidden:] + r * g[:, 2 * hidden:])
            kept.append((t, h, z, r, n, g[:, 2 * hidden:]))
            h = n + z * (h - n)
            states[t] = h
        return states, kept

    def probabilities(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
        """Of every language at every byte: (position, word, language)."""
        ways = [self.read(data, way) for way in (0, 1)]
        both = np.concatenate([s for s, _ in ways], axis=2)
        logits = both @ self.weights["out"] + self.weights["bias"]
        p = np.exp(logits - logits.max(axis=2, keepdims=True))
        return p / p.sum(axis=2, keepdims=True), both, [k for _, k in ways]

    def gradients(self, data: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over all bytes, by backpropagation through time."""
        p, both, kept = self.probabilities(data)
        p[:, np.arange(len(labels)), labels] -= 1
        d = p / (p.shape[0] * p.shape[1])
        flat = d.reshape(-1, d.shape[2])
        out = {"out": both.reshape(-1, both.shape[2]).T @ flat, "bias": flat.sum(axis=0)}
        back = d @ self.weights["out"].T
        hidden = back.shape[2] // 2
        for way in (0, 1):
            u = self.weights[f"state{way}"]
            du, dh = np.zeros_like(u), np.zeros((len(data), hidden), np.float32)
            inputs = np.empty((data.shape[1], len(data), 3 * hidden), np.float32)
            for t, h, z, r, n, g in reversed(kept[way]):
                dh = dh + back[t, :, way * hidden:(way + 1) * hidden]
                dn = dh * (1 - z) * (1 - n * n)
                dz, dr = dh * (h - n) * z * (1 - z), dn * g * r * (1 - r)
                inputs[t] = np.concatenate([dz, dr, dn], axis=1)
                dg = np.concatenate([dz, dr, dn * r], axis=1)
                du += h.T @ dg
                dh = dh * z + dg @ u.T
            one = np.zeros((data.size, 256), np.float32)
            one[np.arange(data.size), data.T.reshape(-1)] = 1
            out[f"bytes{way}"], out[f"state{way}"] = one.T @ inputs.reshape(-1, 3 * hidden), du
        return out

    def pooled(self, words: list[bytes]) -> np.ndarray:
        """Per word: the sum of its bytes' probabilities, and their number in the last column."""
        out = np.zeros((len(words), len(self.languages) + 1), np.float32)
        size = np.fromiter(map(len, words), np.int64, len(words))
        for length in np.unique(size):
            rows = np.flatnonzero(size == length)
            for part in np.array_split(rows, max(1, len(rows) * int(length) // 65536)):
                data = np.frombuffer(b"".join([words[i] for i in part]), np.uint8).reshape(-1, length)
                out[part, :-1] = self.probabilities(data)[0].sum(axis=0)
        out[:, -1] = size
        return out


def train(sample: list[tuple[str, list[bytes]]], hidden: int = HIDDEN, steps: int = STEPS, batch: int = BATCH,
          seed: int = 7) -> Network | None:
    """Fit the network to (language, words) rows by Adam; languages count alike."""
    languages = sorted({lang for lang, words in sample if words})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    net = Network.fresh(languages, hidden, rng)
    words = [w for _, ws in sample for w in ws]
    label = np.array([languages.index(lang) for lang, ws in sample for _ in ws])
    size = np.fromiter(map(len, words), np.int64, len(words))
    weight = (1 / np.bincount(label, minlength=len(languages)))[label] * size
    lengths = np.unique(size)
    rows = {n: np.flatnonzero(size == n) for n in lengths}
    share = np.array([weight[rows[n]].sum() for n in lengths])
    inside = {n: weight[rows[n]] / weight[rows[n]].sum() for n in lengths}
    mean = {k: np.zeros_like(v) for k, v in net.weights.items()}
    square = {k: np.zeros_like(v) for k, v in net.weights.items()}
    for step in range(1, steps + 1):
        n = lengths[rng.choice(len(lengths), p=share / share.sum())]
        pick = rng.choice(rows[n], size=batch, p=inside[n])
        data = np.frombuffer(b"".join([words[i] for i in pick]), np.uint8).reshape(-1, n)
        rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in net.gradients(data, label[pick]).items():
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            move = mean[k] / (1 - 0.9 ** step) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-8)
            net.weights[k] = net.weights[k] - np.float32(rate) * move.astype(np.float32)
    return net


def training_sample(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame | None:
    """(key, lang, text) of a bounded sample of the rows with a language that are not held out.

    Of each language at most ``SAMPLE_DOCS`` different pairs of id and text are
    taken, by the order of their hashes, so neither a repeated id nor a repeated
    row makes the sample larger or empty.  Estimated numbers of pairs, over all
    rows, only thin out what they are taken from.  None without such rows.
    """
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull()
                        & ~held_out(F.col(key))).select(
        F.col(key).cast("string").alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    known = known.withColumn("order", F.xxhash64("key", "text"))
    counts = store(known.groupBy(F.col("lang").alias("of")).agg(F.approx_count_distinct("order").alias("pairs")), "language-counts")
    languages = counts.count()
    if not languages:
        return None
    most = min(SAMPLE_DOCS, max(1, SAMPLE_ALL // languages))
    chance = F.pmod("order", F.lit(1_000_003)) / F.lit(1_000_003)
    few = (known.join(counts, F.col("lang") == F.col("of")).filter(chance <= F.lit(2 * most) / F.greatest("pairs", F.lit(1)))
           .select("key", "lang", "text", "order").dropDuplicates(["lang", "key", "order"]))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("order", "key"))
    return few.withColumn("place", place).filter(F.col("place") <= most).select("key", "lang", "text")


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    """Train on ``training_sample``; of each document at most ``SAMPLE_WORDS`` words reach the driver."""
    chosen = training_sample(docs, key, text, lang)
    if chosen is None:
        return None
    schema = "key string, lang string, words array<binary>"

    def take(batches: Batches) -> Batches:
        for b in chunks(batches, text, CHUNK_BYTES):
            some = []
            for t in b.column(2).to_pylist():
                w = words_of(t)
                some.append([w[i] for i in np.unique(np.linspace(0, len(w) - 1, min(len(w), SAMPLE_WORDS)).astype(int))]
                            if w else [])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(some, pa.list_(pa.binary()))],
                                             names=["key", "lang", "words"])

    rows = map_batches(chosen, take, schema).collect()
    return train([(lg, [bytes(w) for w in ws]) for _, lg, ws in sorted(rows, key=lambda r: (r[1], r[0], r[2]))])


_MEMORY: dict[str, tuple[dict[bytes, int], np.ndarray]] = {}


def _has_letter(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, net: Network | None, text: str = "text") -> tuple[DataFrame, str, str]:
    """Add the predicted language and its score to every row (column names come back too).

    Every byte of the whole text gets probabilities and a document the mean over
    its bytes; words are read once while they are remembered.  ``und`` with
    score 0 where the text is null or has no letter, or nothing was learned.
    """
    label, score = free_name("lang_pred", docs.columns), free_name("score", docs.columns)
    if net is None:
        return docs.withColumns({label: F.lit("und"), score: F.lit(0.0)}), label, score
    flag = free_name("has_letter", docs.columns)
    marked = docs.withColumn(flag, _has_letter(text))
    schema = T.StructType([*docs.schema.fields, T.StructField(label, T.StringType()), T.StructField(score, T.DoubleType())])
    spot, width = docs.columns.index(text), len(docs.columns)
    version = f"{hash(tuple(net.weights['out'].ravel().tolist()))}"

    def run(batches: Batches) -> Batches:
        for b in chunks(batches, text, CHUNK_BYTES):
            known, rows = _MEMORY.get(version, ({}, np.zeros((0, len(net.languages) + 1), np.float32)))
            if len(known) > KEPT_WORDS:
                known, rows = {}, rows[:0]
            cut = [words_of(t) if t else [] for t in b.column(spot).to_pylist()]
            new = list(set().union(*cut) - known.keys())
            known.update(zip(new, range(len(rows), len(rows) + len(new)), strict=True))
            rows = np.concatenate([rows, net.pooled(new)])
            _MEMORY.clear()
            _MEMORY[version] = known, rows
            sums = np.zeros((len(cut), rows.shape[1]))
            for i, w in enumerate(cut):
                if w:
                    sums[i] = rows[np.fromiter(map(known.__getitem__, w), np.int64, len(w))].sum(axis=0, dtype=np.float64)
            mean = sums[:, :-1] / np.maximum(sums[:, -1:], 1)
            letters = b.column(width).to_numpy(zero_copy_only=False).astype(bool) & (sums[:, -1] > 0)
            best = mean.argmax(axis=1)
            names = [net.languages[k] if ok else "und" for k, ok in zip(best, letters, strict=True)]
            value = np.where(letters, np.clip(mean[np.arange(len(best)), best], 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([*b.columns[:width], pa.array(names, pa.string()), pa.array(value)],
                                             names=schema.names)

    return map_batches(marked, run, schema), label, score


def keep_identified(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language is identified; ``und`` goes.

    Columns stay as they are; a null language becomes the predicted one.  Where
    nothing was learned only null texts and texts without a letter go.
    """
    net = fit(docs, key, text, lang)
    if net is None:
        return docs.filter(_has_letter(text))
    found, label, _ = predict(docs, net, text)
    filled = F.coalesce(F.col(lang), F.col(label)).alias(lang)
    return found.filter(F.col(label) != "und").select(*[filled if c == lang else F.col(c) for c in docs.columns])


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found, _, _ = predict(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
