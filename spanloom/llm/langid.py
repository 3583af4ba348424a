"""Language identification with error-correcting output codes.

Each language has a codeword; a binary n-gram classifier predicts each bit. A
text goes to the language whose codeword costs least, bits weighted by their
logistic loss, and is ambiguous where the best two are close.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


UNDETERMINED = "und"
#: Training texts of a language at most: the bound of the sample that the classifiers are fitted on.
PER_LANGUAGE = 400
#: Shares that a language's rows are ranked in.
DEALS = 64
#: Hashed n-gram features.
FEATURES = 4096
#: A best score under this is ambiguous, and one that leads the second by less.
LEAST_SCORE, LEAST_LEAD = 0.4, 0.01

#: Letters, and numbers that aren't decimal digits (a half, a superscript).
_WORDLIKE = re.compile(r"[^\W\d_]")
_SPACED = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
_WEIGHT = float(0.5)


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``."""
    return F.pmod(F.crc32(key.cast("string")), F.lit(folds))


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in _WORDLIKE.finditer(text))


def ngram_features(text: str) -> np.ndarray:
    """Square roots of the frequencies of hashed byte 1- to 4-grams of the lower-cased letters."""
    raw = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "surrogatepass").translate(_SPACED), np.uint8).astype(np.uint32)
    counts = np.zeros(FEATURES)
    gram = raw
    for size in range(1, 5):
        if size > 1:
            gram = gram[:-1] * np.uint32(257) + raw[size - 1 :]
            if not len(gram):
                break
        h = (gram * np.uint32(2654435761) + np.uint32(size * 40503)) >> np.uint32(20)
        counts += np.bincount(h[gram != 32] if size == 1 else h, minlength=FEATURES)
    return np.sqrt(counts / max(1.0, counts.sum())).astype(np.float32)


def codewords(classes: int) -> np.ndarray:
    """+1/-1 codewords, a row for each class.

    Up to 6 classes all splits in two; beyond it seeded random splits, of which
    those sets are kept whose closest rows are farthest apart.
    """
    if classes <= 1:
        return np.ones((classes, 1))
    if classes <= 6:
        splits = np.arange(1, 1 << (classes - 1))
        return np.where((splits[None, :] >> np.arange(classes)[:, None]) & 1, 1.0, -1.0)
    bits, rng, best, far = 4 * int(np.ceil(np.log2(classes))) + 7, np.random.default_rng(17), None, -1
    for _ in range(200):
        code = np.where(rng.random((classes, bits)) < 0.5, -1.0, 1.0)
        distance = (bits - code @ code.T) / 2
        np.fill_diagonal(distance, bits)
        if (np.abs(code.sum(0)) < classes).all() and distance.min() > far:
            best, far = code, distance.min()
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def decide(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, its score in 0..1 and whether it is ambiguous, for each row."""
        margin = features @ self.weights + self.bias
        loss = np.logaddexp(0, -margin[:, None, :] * self.code[None]).sum(2)
        p = np.exp(_WEIGHT * (loss.min(1, keepdims=True) - loss))
        p /= p.sum(1, keepdims=True)
        best = p.max(1)
        second = np.sort(p, axis=1)[:, -2] if p.shape[1] > 1 else np.zeros(len(p))
        return p.argmax(1), best, (best < LEAST_SCORE) | (best - second < LEAST_LEAD)


def fit_bits(x: np.ndarray, y: np.ndarray, steps: int = 300, rate: float = 6.0, decay: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """Logistic classifiers for the +1/-1 columns of ``y``, by gradient steps with momentum."""
    w, b = np.zeros((x.shape[1], y.shape[1]), x.dtype), np.zeros(y.shape[1], x.dtype)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(steps):
        g = -y / (1 + np.exp(np.clip(y * (x @ w + b), -30, 30)))
        vw = 0.9 * vw - rate * (x.T @ g / len(x) + decay * w)
        vb = 0.9 * vb - rate * g.mean(0)
        w, b = w + vw, b + vb
    return w, b


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Fit on rows (doc_id, text, lang): ``per_language`` of each language at most, those of the smallest hash.

    Rows of null text or lang are left out. Without rows, no language is known.
    A language may hold most rows: they are ranked in ``DEALS`` shares first, and
    then only the first ``per_language`` of each share.
    """
    named = labelled.filter("text is not null and lang is not null and doc_id is not null")
    picked = named.select("doc_id", "lang", F.xxhash64("doc_id", F.lit(8)).alias("h"), F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(DEALS)).alias("deal"))
    for keys in ("lang, deal", "lang"):
        picked = picked.withColumn("k", F.expr(f"row_number() over (partition by {keys} order by h, doc_id)")).filter(F.col("k") <= per_language).drop("k")
    picked = picked.select("doc_id").distinct()
    sample = named.join(F.broadcast(picked), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [ngram_features(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.binary()), batch.column(2)], names=["doc_id", "x", "lang"])

    kind = labelled.schema["doc_id"].dataType.simpleString()
    rows = sample.select("doc_id", "text", "lang").mapInArrow(run, f"doc_id {kind}, x binary, lang string").orderBy("doc_id", "lang", "x").toArrow()
    named = rows["lang"].to_pylist()
    languages = sorted(set(named))
    code = codewords(len(languages))
    if not named:
        return LanguageModel([], code, np.zeros((FEATURES, 1)), np.zeros(1))
    x = np.concatenate([np.frombuffer(v.as_buffer(), np.float32) for v in rows["x"]]).reshape(-1, FEATURES)
    del rows
    weights, bias = fit_bits(x, code[[languages.index(n) for n in named]].astype(np.float32))
    return LanguageModel(languages, code, weights.astype(np.float32), bias)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with lang_pred string, score double and ambiguous boolean, from the whole text.

    Null text or one without a letter: ``und``, score 0, not ambiguous. Equal
    scores: the first language in order, and ambiguous. All
    columns are kept; those that bear a name of the new ones are replaced.
    """
    added = ["lang_pred", "score", "ambiguous"]
    kept = [c for c in docs.columns if c not in added]
    at = kept.index("text")
    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            lang, score, doubt = [UNDETERMINED] * n, np.zeros(n), np.zeros(n, bool)
            for i, value in enumerate(batch.column(at)):
                text = value.as_py()
                if text and model.languages and has_letter(text):
                    k, p, a = model.decide(ngram_features(text)[None])
                    lang[i], score[i], doubt[i] = model.languages[k[0]], p[0], a[0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score), pa.array(doubt)], names=[*kept, *added])

    return docs.select(*kept).mapInArrow(run, schema)


def identify(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """Fit on all folds of ``docs`` but one and predict every row: doc_id, held_out, lang_pred, score, ambiguous.

    Null texts and languages teach nothing; a null doc_id isn't held out; null
    texts are ``und``. Repeated rows are kept, an empty table gives no rows,
    further columns are dropped.
    """
    mine = F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False))
    model = fit(docs.select("doc_id", "text", "lang").filter(~mine))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", mine.alias("held_out"), "lang_pred", "score", "ambiguous")
