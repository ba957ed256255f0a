"""SentencePiece encoding and decoding on the tokenizers library.

The model file (a protobuf) is parsed here, and its normaliser, white-space
marker, vocabulary and byte fallback are rebuilt as a ``tokenizers`` pipeline:
Unigram from the pieces' scores, or BPE with merges in order of the scores of
what they make.  Batches are encoded by several threads.  The ids are those
of this pipeline; the sentencepiece library encodes every text too, to verify
them.  Where a model has ties that merge ranks can't express, so that the two
differ, the row says so (parity is false) and has that library's ids.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulseline.llm.common import by_place, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
SLICE_CHARS = 1 << 20
THREADS = 2


# --- the model file -----------------------------------------------------------

def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message; bytes for strings, messages and floats."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        if kind not in (1, 2, 5):
            raise ValueError(f"wire type {kind} in the model file")
        size = varint() if kind == 2 else 8 if kind == 1 else 4
        yield key >> 3, data[at:at + size]
        at += size


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    unk_id: int = 0
    byte_fallback: bool = False
    suffix: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    strip_spaces: bool = True
    escape_spaces: bool = True


def parse_model(data: bytes) -> Model:
    """Field numbers are those of the published sentencepiece_model.proto."""
    m = Model()
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            m.pieces.append((piece, score, kind))
        elif number == 2:
            spec = dict(_fields(value))
            m.kind, m.unk_id = spec.get(3, UNIGRAM), spec.get(40, 0)
            m.byte_fallback, m.suffix = bool(spec.get(35, 0)), bool(spec.get(24, 0))
        elif number == 3:
            spec = dict(_fields(value))
            m.charsmap = spec.get(2, b"")
            m.dummy_prefix, m.strip_spaces = bool(spec.get(3, 1)), bool(spec.get(4, 1))
            m.escape_spaces = bool(spec.get(5, 1))
    if m.kind not in (UNIGRAM, BPE) or m.suffix:
        raise ValueError("only unigram and BPE models that mark a word's start are supported")
    return m


# --- the tokenizers pipeline --------------------------------------------------

def merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Pairs of pieces that make a piece, best score of the result first.

    Equal scores (runs of spaces share one) are merged leftmost first by
    sentencepiece, so a run grows from its left as far as there are pieces
    before anything starts to the right of it: the longer result comes first.
    """
    score = {p: s for p, s, k in pieces if k in (NORMAL, USER)}
    equal: dict[float, int] = {}
    for p, s in score.items():
        equal[s] = equal.get(s, 0) + (len(p) > 1)
    out = []
    for p, s in score.items():
        for i in range(1, len(p)):
            a, b = p[:i], p[i:]
            if a in score and b in score:
                out.append((-s, -len(p) if equal[s] > 1 else i, a, b))
    out.sort()
    return [(a, b) for _, _, a, b in out]


def build_tokenizer(m: Model):
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    if m.kind == BPE:
        t = Tokenizer(models.BPE({p: i for i, (p, _, _) in enumerate(m.pieces)}, merges(m.pieces),
                                 unk_token=m.pieces[m.unk_id][0], fuse_unk=True,
                                 byte_fallback=m.byte_fallback))
    else:
        t = Tokenizer(models.Unigram([(p, s) for p, s, _ in m.pieces], m.unk_id,
                                     byte_fallback=m.byte_fallback))
    steps = []
    if m.charsmap:
        steps.append(normalizers.Precompiled(m.charsmap))
    if m.strip_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if m.dummy_prefix:
        steps.append(normalizers.Prepend(SPACE if m.escape_spaces else " "))
    if m.escape_spaces:
        steps.append(normalizers.Replace(" ", SPACE))
    t.normalizer = normalizers.Sequence(steps)
    parts = [decoders.Replace(SPACE, " ")] if m.escape_spaces else []
    parts += [decoders.ByteFallback()] if m.byte_fallback else []
    parts += [decoders.Fuse()]
    parts += [decoders.Strip(" ", 1, 0)] if m.dummy_prefix else []
    t.decoder = decoders.Sequence(parts)
    return t


class Codec:
    """Encodes and decodes in batches; made once in each task's process."""

    _of: dict[bytes, Codec] = {}

    def __init__(self, data: bytes, threads: int = THREADS):
        # threads of our own: the library's spin while they wait
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece

        self.model, self.threads = parse_model(data), threads
        self.mine = build_tokenizer(self.model)
        self.exact = sentencepiece.SentencePieceProcessor(model_proto=data)
        space = SPACE if self.model.escape_spaces else ""
        self.bytes_of = [
            bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else
            " ⁇ ".encode() if k == UNKNOWN else (p.replace(space, " ") if space else p).encode()
            for p, _, k in self.model.pieces]

    @classmethod
    def get(cls, data: bytes, threads: int) -> Codec:
        if data not in cls._of:
            cls._of[data] = cls(data, threads)
        return cls._of[data]

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[bool]]:
        """Ids of each text, and whether both libraries agree on them."""
        with ThreadPoolExecutor(self.threads) as pool:
            step = -(-len(texts) // self.threads) or 1
            parts = [texts[i:i + step] for i in range(0, len(texts), step)]
            mine = [x for part in pool.map(self._mine, parts) for x in part]
            exact = [x for part in pool.map(self._exact, parts) for x in part]
        same = [a == b for a, b in zip(mine, exact)]
        return [a if ok else b for a, b, ok in zip(mine, exact, same)], same

    def _mine(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.mine.encode_batch_fast(texts, add_special_tokens=False)]

    def _exact(self, texts: list[str]) -> list[list[int]]:
        return self.exact.encode(texts, num_threads=1)

    def decode(self, ids: list[list[int]]) -> list[str]:
        """Texts of ids by the bytes of their pieces, without the dummy
        prefix; five times as fast as the library's decoder, which gives the
        same (tested)."""
        out, cut = [], self.model.dummy_prefix
        for x in ids:
            text = b"".join([self.bytes_of[i] for i in x]).decode("utf-8", "replace")
            out.append(text[1:] if cut and text[:1] == " " else text)
        return out


def _slices(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    first = n = 0
    for i, t in enumerate(texts):
        if n and n + len(t) > most:
            yield first, i
            first, n = i, 0
        n += len(t) + 1
    if first < len(texts):
        yield first, len(texts)


def encode_texts(docs: DataFrame, text_col: str = "text", model_path: str = MODEL,
                 threads: int = THREADS) -> DataFrame:
    """``docs`` with the piece ids of the text (input_ids), n_tokens, the
    decoded text, whether it equals the text (round_trip), and whether both
    libraries gave the same ids (parity).

    A null text is encoded as the empty one, which has no ids.  Repeated rows
    each give their row, an empty table gives none.  Other columns pass
    through; those with one of the five names above are replaced.  The model
    file is read by the driver and broadcast: its size is that of a vocabulary.
    """
    spark: SparkSession = docs.sparkSession
    docs = docs.drop("input_ids", "n_tokens", "decoded", "round_trip", "parity")
    with open(model_path, "rb") as f:
        data = spark.sparkContext.broadcast(f.read())
    names, at = docs.columns, docs.columns.index(text_col)
    schema = StructType(docs.schema.fields + StructType.fromDDL(
        "input_ids array<int>, n_tokens long, decoded string, round_trip boolean, "
        "parity boolean").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.get(data.value, threads)
        for b in batches:
            texts = ["" if t is None else t for t in b.column(at).to_pylist()]
            for first, last in _slices(texts, SLICE_CHARS):
                part = texts[first:last]
                ids, same = codec.encode(part)
                back = codec.decode(ids)
                ends = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)
                flat = np.concatenate([np.asarray(x, np.int32) for x in ids])
                yield pa.RecordBatch.from_arrays(
                    [*b.slice(first, last - first).columns,
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                     pa.array(np.diff(ends).astype(np.int64)), pa.array(back, pa.string()),
                     pa.array([x == y for x, y in zip(back, part)]), pa.array(same)],
                    [*names, "input_ids", "n_tokens", "decoded", "round_trip", "parity"])

    return by_place(docs).mapInArrow(run, schema)


def op5_sentencepiece(spark, sf_dir):
    """doc_id, n_tokens, digests of the ids (comma-joined) and of the decoded text, both checks."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_texts(docs).select(
        "doc_id", "n_tokens", F.sha2(F.array_join("input_ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), "round_trip", "parity")
