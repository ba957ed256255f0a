"""Tokens on their way to the state of their words, packed.

A row for each token costs a shuffle many times the texts.  Here a task packs
the tokens that some MB of its texts have in one bucket of words into one row:
each word once, and for each text its id, how many tokens it has there, their
positions and the numbers of their words, all as differences in the narrowest
integers, compressed.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pulseline.operators.words import WORDS

BUCKET, TEXTS, TOKENS, BUCKETS = "bucket", "texts", "tokens", "_buckets"
PACKED_SCHEMA = f"{BUCKET} INT, {TEXTS} BINARY, {TOKENS} BINARY"
# of texts, about, that are packed together: enough for each bucket, few enough for a task
LEAST_BYTES, BYTES_A_BUCKET, MOST_BYTES = 4 << 20, 16 << 10, 32 << 20
CODEC, LEVEL = "zstd", 3


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of integers, each in the narrowest type (negative ones as they are)."""
    arrays = [a.astype(np.min_scalar_type(int(a.max()))) if len(a) and a.dtype != np.int64 else a for a in arrays]
    head = b"".join(struct.pack("<2sq", a.dtype.str[1:].encode(), len(a)) for a in arrays)
    raw = b"".join((struct.pack("<q", len(arrays)), head, *(a.tobytes() for a in arrays)))
    return struct.pack("<q", len(raw)) + pa.Codec(CODEC, compression_level=LEVEL).compress(raw, asbytes=True)


def _unpacked(data: bytes) -> list[np.ndarray]:
    size, = struct.unpack_from("<q", data)
    raw = pa.Codec(CODEC).decompress(memoryview(data)[8:], size, asbytes=True)
    n, = struct.unpack_from("<q", raw)
    at, out = 8 + 10 * n, []
    for i in range(n):
        kind, length = struct.unpack_from("<2sq", raw, 8 + 10 * i)
        out.append(np.frombuffer(raw, kind.decode(), length, at))
        at += out[-1].nbytes
    return out


def pack_texts(texts: pa.Table, id_col: str) -> pa.RecordBatch:
    """A row for each bucket that words of the texts have (``PACKED_SCHEMA``).
    Texts come in order of their ids there, those without one first."""
    texts = texts.take(pc.sort_indices(texts, sort_keys=[(id_col, "ascending")], null_placement="at_start"))
    ids, lists = texts[id_col].combine_chunks(), texts[WORDS].combine_chunks()
    missing = ids.is_null().to_numpy(zero_copy_only=False)
    ids = ids.fill_null(0).to_numpy()
    coded = lists.flatten().dictionary_encode()
    code, bucket = coded.indices.to_numpy(), texts[BUCKETS].combine_chunks().flatten().to_numpy()
    if not len(code):
        return pa.RecordBatch.from_arrays([pa.array([], t) for t in (pa.int32(), pa.binary(), pa.binary())],
                                          names=[BUCKET, TEXTS, TOKENS])
    lengths = lists.value_lengths().to_numpy()
    text = np.repeat(np.arange(len(ids), dtype=np.int32), lengths)
    pos = np.arange(len(code)) - np.repeat(np.cumsum(lengths, dtype=np.int64) - lengths, lengths)

    # words and tokens by bucket; a word is numbered within its bucket
    of_word = np.empty(len(coded.dictionary), bucket.dtype)
    of_word[code] = bucket
    order = np.argsort(of_word, kind="stable")
    some, first_word = np.unique(of_word[order], return_index=True)
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order)) - np.repeat(first_word, np.diff(np.append(first_word, len(order))))
    words = coded.dictionary.take(pa.array(order)).cast(pa.string())
    ends = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1)
    letters = np.frombuffer(words.buffers()[2] or b"", np.uint8)

    order = np.argsort(bucket.astype(np.min_scalar_type(int(bucket.max(initial=0)))), kind="stable")
    bucket, text, pos, number = bucket[order], text[order], pos[order], number[code[order]]
    first_token = np.searchsorted(bucket, some)
    new = np.append(True, text[1:] != text[:-1])
    new[first_token] = True
    starts = np.flatnonzero(new)
    step = np.where(new, pos, pos - np.append(0, pos[:-1])).astype(np.uint64)
    counts, of_text = np.diff(np.append(starts, len(text))).astype(np.uint64), text[starts]
    first_text = np.searchsorted(starts, first_token)

    rows = {BUCKET: [], TEXTS: [], TOKENS: []}
    spans = [np.append(x, end) for x, end in
             ((first_word, len(words)), (first_text, len(starts)), (first_token, len(text)))]
    for i, b in enumerate(some.tolist()):
        (w0, w1), (t0, t1), (k0, k1) = ((s[i], s[i + 1]) for s in spans)
        none = int(missing[of_text[t0:t1]].sum())
        known = ids[of_text[t0 + none:t1]].astype(np.int64)
        rows[BUCKET].append(b)
        rows[TEXTS].append(_packed(
            np.array([none], np.uint64), known[:1], np.diff(known.view(np.uint64)), counts[t0:t1],
            np.diff(ends[w0:w1 + 1]).astype(np.uint64), letters[ends[w0]:ends[w1]]))
        rows[TOKENS].append(_packed(number[k0:k1].astype(np.uint64), step[k0:k1]))
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[BUCKET], pa.int32()), pa.array(rows[TEXTS], pa.binary()), pa.array(rows[TOKENS], pa.binary())],
        names=list(rows))


def pack_batches(id_col: str, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: texts with lists of their words and of the words' buckets."""
    most = min(MOST_BYTES, max(LEAST_BYTES, BYTES_A_BUCKET * buckets))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            # parts of a batch of about as many bytes as are packed at once
            each = max(1, batch.num_rows * most // max(1, batch.nbytes))
            for part in (batch.slice(i, each) for i in range(0, batch.num_rows, each)):
                held.append(part)
                size += part.nbytes
                if size >= most:
                    yield pack_texts(pa.Table.from_batches(held), id_col)
                    held, size = [], 0
        if held:
            yield pack_texts(pa.Table.from_batches(held), id_col)
        del held
        # the worker waits for its next task while others work
        pa.default_memory_pool().release_unused()

    return pack


@dataclass
class Piece:
    """A packed row.  Of its texts: whether they have an id, the id, how many
    tokens they have; their distinct words.  Tokens stay packed."""

    missing: np.ndarray
    ids: np.ndarray
    counts: np.ndarray
    words: pa.Array
    packed: bytes

    @classmethod
    def of(cls, texts: bytes, tokens: bytes) -> Piece:
        (none,), first, steps, counts, lengths, letters = _unpacked(texts)
        known = np.cumsum(np.concatenate((first.view(np.uint64), steps.astype(np.uint64))), dtype=np.uint64)
        ids = np.concatenate((np.zeros(int(none), np.int64), known.view(np.int64)))
        ends = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64))).astype(np.int32)
        words = pa.StringArray.from_buffers(len(lengths), pa.py_buffer(ends), pa.py_buffer(letters))
        return cls(np.arange(len(ids)) < none, ids, counts.astype(np.int64), words, tokens)

    def tokens(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each token: its text's and its word's place in the piece, its position."""
        number, step = _unpacked(self.packed)
        total = np.cumsum(step, dtype=np.int64)
        starts = np.cumsum(self.counts) - self.counts
        pos = total - np.repeat(total[starts] - step[starts].astype(np.int64), self.counts)
        return np.repeat(np.arange(len(self.ids)), self.counts), number.astype(np.int64), pos
