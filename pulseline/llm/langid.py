"""Language identification: multinomial naive Bayes over hashed character n-grams.

Characters are lower-cased, everything that is no letter is one space, and the
n-grams of one to three characters are hashed into 2^15 buckets.  Counts per
language and bucket are gathered from all training rows by an aggregation; the
matrix of log-probabilities (languages x buckets, both bounded) is broadcast,
and batches are scored by gathering its columns in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulseline.llm.common import by_place, table
from pulseline.session import materialize

BUCKET_BITS = 15
ORDERS = (1, 2, 3)
ALPHA = 0.1
MAX_LANGUAGES = 1000
SLICE_CHARS = 1 << 20
UNKNOWN = "und"
_PRIMES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
_FOLD: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """Code point -> lower-cased letter, or a space; made once per process."""
    if not _FOLD:
        t = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                t[c] = ord(low) if len(low) == 1 else c
        _FOLD.append(t)
    return _FOLD[0]


def buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams, the text each belongs to, and which texts have
    a letter.  A text stands between two spaces."""
    size = np.array([len(t) + 2 for t in texts], np.int64)
    chars = np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le", "surrogatepass"),
                          np.uint32)
    chars = _fold()[chars]
    doc = np.repeat(np.arange(len(texts)), size)
    space = chars == 32
    again = np.r_[False, space[1:] & space[:-1] & (doc[1:] == doc[:-1])]
    chars, doc, space = chars[~again], doc[~again], space[~again]
    letters = np.zeros(len(texts), bool)
    letters[doc[~space]] = True
    out, of = [], []
    h = np.zeros(len(chars), np.uint32)
    for n in ORDERS:
        h = (h[:len(chars) - n + 1] + chars[n - 1:]) * _PRIMES[n - 1]
        h ^= h >> np.uint32(15)
        same = doc[n - 1:] == doc[:len(doc) - n + 1]
        if n == 1:
            same &= ~space
        out.append(((h * _PRIMES[0]) >> np.uint32(32 - BUCKET_BITS))[same])
        of.append(doc[n - 1:][same])
    return np.concatenate(out), np.concatenate(of), letters


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    first = n = 0
    for i, t in enumerate(texts):
        if i > first and n + len(t) > SLICE_CHARS:
            yield first, i
            first, n = i, 0
        n += len(t) + 2
    if first < len(texts):
        yield first, len(texts)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n) of a task's rows; bucket -1 counts the texts."""
    total: dict[str, np.ndarray] = {}
    for b in batches:
        langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
        for first, last in _slices(texts):
            bucket, doc, letters = buckets(texts[first:last])
            some = langs[first:last]
            for lang in set(some):
                own = np.array([x == lang for x in some]) & letters
                n = total.setdefault(lang, np.zeros((1 << BUCKET_BITS) + 1, np.int64))
                n[:-1] += np.bincount(bucket[own[doc]], minlength=1 << BUCKET_BITS)
                n[-1] += int(own.sum())
    for lang, n in total.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()),
             pa.array(np.where(at == 1 << BUCKET_BITS, -1, at).astype(np.int32)), pa.array(n[at])],
            ["lang", "bucket", "n"])


class Model:
    def __init__(self, langs: list[str], counts: np.ndarray, texts: np.ndarray):
        smooth = counts + ALPHA
        self.langs = langs
        self.log = np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)
        self.prior = np.log(np.maximum(texts, 1) / max(1, texts.sum()))

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and posterior of each text; the first language wins a tie."""
        bucket, doc, letters = buckets(texts)
        if not self.langs:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        score = np.stack([np.bincount(doc, weights=row[bucket], minlength=len(texts))
                          for row in self.log]) + self.prior[:, None]
        best = score.argmax(axis=0)
        sure = 1 / np.exp(score - score.max(axis=0)).sum(axis=0)
        return ([self.langs[k] if ok else UNKNOWN for k, ok in zip(best, letters)],
                np.where(letters, sure, 0.0).tolist())


def fit(rows: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Model of all rows with a text and a language.  More than
    ``MAX_LANGUAGES`` languages are refused: the model is broadcast."""
    d = rows.select(rows[lang_col].cast("string").alias("lang"),
                    rows[text_col].cast("string").alias("text")).dropna()
    n = materialize(d.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")), "buckets")
    found = sorted(r.lang for r in n.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts, texts = np.zeros((len(found), 1 << BUCKET_BITS)), np.zeros(len(found))
    for k, lang in enumerate(found):  # a language has at most 2^BUCKET_BITS + 1 rows
        bucket, c = (x.to_numpy() for x in n.where(F.col("lang") == lang).select("bucket", "n").toArrow().columns)
        texts[k] = c[bucket < 0].sum()
        counts[k, bucket[bucket >= 0]] = c[bucket >= 0]
    return Model(found, counts, texts)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (posterior probability).

    A text that is null or has no letter, or a model without languages, gives
    ``und`` and 0.  Texts are scored whole.  Repeated rows each give their
    row, an empty table gives none; other columns pass through unread,
    those with one of the two names are replaced.
    """
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names, at = docs.columns, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            texts = [t or "" for t in b.column(at).to_pylist()]
            lang: list[str] = []
            score: list[float] = []
            for first, last in _slices(texts):
                a, p = m.predict(texts[first:last])
                lang += a
                score += p
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                [*names, "lang_pred", "score"])

    schema = StructType(docs.schema.fields
                        + StructType.fromDDL("lang_pred string, score double").fields)
    return by_place(docs).mapInArrow(run, schema)


def op6_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = fit(docs.where(~held).select("text", "lang"))
    return identify(docs.select("doc_id", held.alias("held_out"), "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score")
