"""Language identification by error-correcting output codes.

Each language has a codeword of +1 and -1; for each of its bits a binary
classifier over hashed byte n-grams tells the languages of one sign from those
of the other. Decoding takes the codeword of least loss, each bit weighted by
how often its classifier is right on that language's labelled rows.
A text whose two nearest codewords lie close together is flagged as ambiguous.

The classifiers are fitted on all labelled rows, off the driver: tasks sum the n-gram
vectors and their squares by the signs of the codewords, each language counting alike, and
these sums give for each bit the means and variances of its two sides, hence a Fisher
discriminant with a variance of its own for each feature. A second pass counts how often
each bit is right on each language. What reaches the driver are four vectors of ``FEATURES``
numbers a bit (some 10 log2 k bits for k languages) and one count per language and bit;
neither grows with the corpus. Very long texts: hashed in runs.

Null text, or one without a letter: ``und``, score 0. No labelled row at
all: every prediction is ``und``. A single learned language: all texts with
letters are of it, score 1. Null doc_id: hashed like an empty id, not held out.
Repeated rows: each counts, and gets its own prediction. Empty table: no rows.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailytally.llm.common import runs, utf8

#: Buckets of hashed n-grams.
FEATURES = 1 << 13
#: Added to each feature's variance, as a share of the mean variance.
RIDGE = 0.1
#: Rows whose vectors a task holds at a time, and features in a row of sums.
HELD, SLICE = 128, 1 << 10
#: Scores below this are flagged as ambiguous.
CLEAR = 0.6
#: Bytes of text that are hashed at a time.
RUN_BYTES = 1 << 20
WORDLIKE = re.compile(r"[^\W\d_]")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 3 == 1


def has_letter(text: str | None) -> bool:
    return bool(text) and any(m[0].isalpha() for m in WORDLIKE.finditer(text))


def _lowered(data: np.ndarray) -> np.ndarray:
    """ASCII letters lower-cased, other ASCII taken as a space."""
    table = np.arange(256, dtype=np.uint8)
    table[:128] = 32
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    return table[data]


def grams(data: np.ndarray) -> list[np.ndarray]:
    """The feature of the 1-, 2-, 3- and 4-gram that starts at each byte."""
    x = _lowered(data).astype(np.uint32)
    out, code = [], np.zeros(len(x), np.uint32)
    for n in range(1, 5):
        code = code[: len(x) - n + 1] * np.uint32(257) + x[n - 1 :] if len(x) >= n else np.zeros(0, np.uint32)
        mixed = (code + np.uint32(n)) * np.uint32(2654435761)
        out.append((mixed >> np.uint32(32 - FEATURES.bit_length() + 1)).astype(np.int32))
    return out


def vector(data: np.ndarray) -> np.ndarray:
    """Square roots of the n-grams' shares: a vector of length one."""
    v = np.zeros(FEATURES, np.float64)
    for a in range(0, len(data), RUN_BYTES):
        part = data[max(0, a - 3) : a + RUN_BYTES]
        for n, g in enumerate(grams(part), 1):
            v += np.bincount(g[max(0, min(3, a) - n + 1) :], minlength=FEATURES)
    return np.sqrt(v / max(1.0, v.sum()))


def codewords(k: int) -> np.ndarray:
    """k rows of signs. Few languages: every split in two. More: of seeded random
    codes of 10 log2 k bits, the one whose nearest rows lie farthest apart."""
    if k <= 7:
        cols = [c for c in itertools.product((1, -1), repeat=k) if c[0] == 1 and -1 in c]
        return np.array(cols, float).T if cols else np.ones((k, 1))
    rng, best, far = np.random.default_rng(k), None, -1.0
    bits = int(np.ceil(10 * np.log2(k)))
    for _ in range(200):
        m = rng.choice((1.0, -1.0), (k, bits))
        agree = m @ m.T
        np.fill_diagonal(agree, -bits)
        if (d := (bits - agree.max()) / 2) > far and (np.abs(m.sum(0)) < k).all():
            best, far = m, d
    return best


@dataclass(frozen=True)
class Model:
    langs: list[str]
    code: np.ndarray  # languages x bits
    bit_weight: np.ndarray  # languages x bits, rows sum to 1
    weights: np.ndarray  # features + 1 x bits; the last row is the bias

    def decode(self, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest codeword's number and a score, for rows of bit outputs."""
        loss = np.einsum("ij,nij->ni", self.bit_weight, np.exp(-np.clip(2 * self.code[None] * f[:, None, :], -20, 20)))
        near = loss.argmin(1)
        share = np.exp(-4 * (loss - loss.min(1, keepdims=True)))
        return near, 1 / share.sum(1)


def sums(x: np.ndarray, sign: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Vectors (rows) and their squares, summed by the bits' signs and in all: 2 (bits + 1) rows."""
    by = np.column_stack([sign, np.ones(len(sign))]) * share[:, None]
    return np.vstack([by.T @ x, by.T @ (x * x)])


def fit(total: np.ndarray, code: np.ndarray) -> np.ndarray:
    """The bits' weights and bias, from sums in which each language has the weight 1."""
    k, bits = code.shape
    first, square = total[: bits + 1], total[bits + 1 :]
    weights = np.zeros((FEATURES + 1, bits))
    for j in range(bits):
        n = [(code[:, j] == s).sum() for s in (1, -1)]
        if not min(n):  # a single language
            weights[-1, j] = 1 if n[0] else -1
            continue
        mean = [(first[-1] + s * first[j]) / 2 / m for s, m in zip((1, -1), n, strict=True)]
        spread = [(square[-1] + s * square[j]) / 2 / m - v**2 for s, m, v in zip((1, -1), n, mean, strict=True)]
        spread = np.maximum(0, (spread[0] + spread[1]) / 2)
        w = (mean[0] - mean[1]) / (spread + RIDGE * spread.mean() + 1e-12)
        # The output is 1 at the mean of one side and -1 at that of the other.
        w *= 2 / max(float(w @ (mean[0] - mean[1])), 1e-12)
        weights[:-1, j], weights[-1, j] = w, -float(w @ (mean[0] + mean[1])) / 2
    return weights


def _vectors(batches: Iterator[pa.RecordBatch], number: dict[str, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Label numbers and vectors of labelled rows (lang, text), some at a time."""
    for b in batches:
        data, off = utf8(b.column(1))
        labels = np.array([number[v] for v in b.column(0).to_pylist()])
        for a in range(0, b.num_rows, HELD):
            rows = range(a, min(a + HELD, b.num_rows))
            yield labels[rows], np.stack([vector(data[off[i] : off[i + 1]]) for i in rows])


def train(docs: DataFrame) -> Model | None:
    """Fits on all labelled rows that aren't held out, from sums made in tasks."""
    own = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    own = own.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = {r.lang: r.n for r in own.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    langs = sorted(counts)
    number, code = {v: i for i, v in enumerate(langs)}, codewords(len(langs))
    share = np.array([1 / counts[v] for v in langs])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2 * code.shape[1] + 2, FEATURES))
        for labels, x in _vectors(batches, number):
            total += sums(x, code[labels], share[labels])
        if total.any():
            parts = total.reshape(-1, SLICE)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts))), pa.array([p.tobytes() for p in parts], pa.binary())], names=["part", "v"])

    def merge(key: tuple, found: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v.as_py()) for v in found.column("v"))
        return pa.table({"part": [key[0].as_py()], "v": pa.array([total.tobytes()], pa.binary())})

    schema = "part long, v binary"
    parts = own.mapInArrow(add, schema).groupBy("part").applyInArrow(merge, schema).collect()
    total = np.vstack([np.frombuffer(r.v) for r in sorted(parts, key=lambda r: r.part)]).reshape(-1, FEATURES)
    weights = fit(total, code)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right = np.zeros(code.shape, np.int64)
        for labels, x in _vectors(batches, number):
            np.add.at(right, labels, (x @ weights[:-1] + weights[-1]) * code[labels] > 0)
        lang, bit = np.nonzero(right)
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(bit), pa.array(right[lang, bit])], names=["lang", "bit", "n"])

    right = np.zeros(code.shape)
    for r in own.mapInArrow(judge, "lang long, bit long, n long").groupBy("lang", "bit").agg(F.sum("n").alias("n")).collect():
        right[r.lang, r.bit] = r.n
    acc = right * share[:, None] + 1e-3
    return Model(langs, code, acc / acc.sum(1, keepdims=True), weights)


ADDED = ("lang_pred", "score", "ambiguous")


def predict(docs: DataFrame, model: Model | None, added: tuple[str, ...] = ADDED) -> DataFrame:
    """All columns of docs, and lang_pred, score, ambiguous (or the names given; a fourth
    tells whether the text has a letter, with a model or without). Only the text is read."""
    schema = docs.schema
    names = [f.name for f in schema.fields]
    for n in added:
        if n in names:
            raise ValueError(f"column {n} exists already")

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            col = b.column(names.index("text"))
            n = b.num_rows
            lang, score, unclear = np.full(n, "und", object), np.zeros(n), np.ones(n, bool)
            known = np.array([has_letter(t.as_py()) for t in col], bool)
            if model is not None and known.any():
                data, off = utf8(col)
                bits = model.weights.shape[1]
                for at, to in runs(off, RUN_BYTES):
                    near, s = model.decode(_outputs(data, off[at : to + 1], model.weights, bits))
                    rows = np.arange(at, to)[known[at:to]]
                    lang[rows] = np.array(model.langs, object)[near[known[at:to]]]
                    score[rows], unclear[rows] = s[known[at:to]], s[known[at:to]] < CLEAR
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *[pa.array(lang.tolist(), pa.string()), pa.array(score), pa.array(unclear), pa.array(known)][: len(added)]],
                names=[*names, *added])

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    kinds = ("string", "double", "boolean", "boolean")
    return docs.mapInArrow(batches, ", ".join([out, *[f"`{n}` {k}" for n, k in zip(added, kinds, strict=False)]]))


def _outputs(data: np.ndarray, off: np.ndarray, weights: np.ndarray, bits: int) -> np.ndarray:
    """The classifiers' outputs for each text of a run: counts by text and feature,
    their square roots, times the weights."""
    n = len(off) - 1
    out = np.empty((n, bits))
    for i in range(n):
        out[i] = vector(data[off[i] : off[i + 1]]) @ weights[:-1] + weights[-1]
    return out


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return predict(own, train(docs)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")
