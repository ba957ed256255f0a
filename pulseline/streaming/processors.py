"""Stateful processors for ``transformWithStateInPandas``.

One small state row per key (counts, sums, extremes); every input record
produces one output row carrying the state after it.  Within a micro-batch
a key's rows are put in record order and folded with vectorised numpy
(cumulative sum/min/max), so no per-row Python loop runs.  A key's rows in
one batch are bounded by the trigger size (``maxFilesPerTrigger`` /
``maxBytesPerTrigger``), not by the history of the key.
"""

from __future__ import annotations

import json
import zlib
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pulseline.streaming.packed import TEXTS, TOKENS, Piece

# Fixed values of the literal fold (see operators.compat).
BLANK_MAX = 0
BLANK_MIN = 1000
RESET_MIN = 2147483647

RUNNING_SCHEMA = (
    "record_key STRING, trial_id STRING, patient_id STRING, visit_name STRING, value INT, "
    "start_ts TIMESTAMP_NTZ, seq BIGINT, run_count BIGINT, run_sum BIGINT, run_min INT, "
    "run_max INT, run_avg_int BIGINT, run_avg DOUBLE")
COMPAT_SCHEMA = (
    "record_key STRING, trial_id STRING, patient_id STRING, visit_name STRING, value INT, "
    "start_ts TIMESTAMP_NTZ, seq BIGINT, max_value INT, min_value INT, n_records BIGINT, "
    "sum_value BIGINT, avg_int BIGINT")
WORDS_SCHEMA = "doc_id BIGINT, pos INT, word STRING, n BIGINT"


def _ordered(rows: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    pdf = pd.concat(list(rows), ignore_index=True)
    return pdf.sort_values(order, kind="mergesort", na_position="first").reset_index(drop=True)


def _div_trunc(s: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer division rounding toward zero (SQL ``div``)."""
    c = np.maximum(c, 1)
    return np.sign(s) * (np.abs(s) // c)


def running_batch(v: np.ndarray, state):
    """Running count/sum/min/max of one batch given the carried state
    (count, sum, min, max) or None; returns arrays and the new state."""
    n0, s0, mn0, mx0 = state if state is not None else (0, 0, None, None)
    cnt = n0 + np.arange(1, len(v) + 1, dtype=np.int64)
    tot = s0 + np.cumsum(v)
    mn = np.minimum.accumulate(v)
    mx = np.maximum.accumulate(v)
    if mn0 is not None:
        mn = np.minimum(mn, mn0)
        mx = np.maximum(mx, mx0)
    return cnt, tot, mn, mx, (int(cnt[-1]), int(tot[-1]), int(mn[-1]), int(mx[-1]))


def running_runs(v: np.ndarray, starts: np.ndarray, states: list):
    """``running_batch`` of all runs of a batch at once: ``starts`` are their
    first rows and ``states`` what each carries (count, sum, min, max first),
    or None.  Returns the rows' columns and the list of new states."""
    ends = np.append(starts[1:], len(v))
    run = np.repeat(np.arange(len(starts)), ends - starts)
    none = (0, 0, np.iinfo(np.int64).max, np.iinfo(np.int64).min)
    old = np.array([none if s is None else s[:4] for s in states], np.int64).reshape(-1, 4)
    cnt = np.arange(1, len(v) + 1) - starts[run] + old[run, 0]
    total = np.cumsum(v)
    tot = total - (total - v)[starts][run] + old[run, 1]
    by_run = pd.Series(v).groupby(run)
    mn = np.minimum(by_run.cummin().to_numpy(), old[run, 2])
    mx = np.maximum(by_run.cummax().to_numpy(), old[run, 3])
    last = ends - 1
    return (cnt, tot, mn, mx), list(zip(*(c[last].tolist() for c in (cnt, tot, mn, mx))))


PACKETS = 16


class PacketState:
    """State entries of a bucket's keys, kept in ``PACKETS`` packets by the
    key's CRC-32.  A state call from Python costs a round trip, so a batch
    reads and writes whole packets of the keys that it has, not single keys."""

    def __init__(self, handle: StatefulProcessorHandle, name: str, packets: int = PACKETS):
        self.map = handle.getMapState(name, "packet INT", "entries STRING")
        self.packets = packets

    def _packet(self, key) -> int:
        return zlib.crc32(key.encode()) % self.packets if key is not None else 0

    def load(self, keys) -> list:
        """The entry of each key, a list, or None for a new key."""
        of = [self._packet(k) for k in keys]
        self.held = {}
        for p in set(of):
            got = self.map.getValue((p,))
            self.held[p] = {k: e for k, *e in json.loads(got[0])} if got is not None else {}
        return [self.held[p].get(k) for p, k in zip(of, keys)]

    def store(self, keys, entries) -> None:
        """Put the entries of the keys that ``load`` has just had."""
        for k, e in zip(keys, entries):
            self.held[self._packet(k)][k] = e
        for p, held in self.held.items():
            self.map.updateValue((p,), (json.dumps([(k, *e) for k, e in held.items()]),))
        self.held = {}


def run_starts(keys: np.ndarray) -> np.ndarray:
    """First row of each run of equal keys in a key-sorted array."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))


class RunningSummaryProcessor(StatefulProcessor):
    """Running count, sum, min, max and averages per key."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("summary", "n BIGINT, total BIGINT, mn INT, mx INT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _ordered(rows, ["start_ts", "seq"])
        cnt, tot, mn, mx, new_state = running_batch(
            pdf["value"].to_numpy(dtype=np.int64), self.state.get())
        self.state.update(new_state)
        yield pd.DataFrame({
            "record_key": pdf["record_key"], "trial_id": pdf["trial_id"],
            "patient_id": pdf["patient_id"], "visit_name": pdf["visit_name"],
            "value": pdf["value"].astype("int32"), "start_ts": pdf["start_ts"],
            "seq": pdf["seq"], "run_count": cnt, "run_sum": tot,
            "run_min": mn.astype("int32"), "run_max": mx.astype("int32"),
            "run_avg_int": _div_trunc(tot, cnt), "run_avg": tot / cnt,
        })

    def close(self) -> None:
        pass


def _literal_extreme(v: np.ndarray, start: int, rises, reset: int) -> np.ndarray:
    """Closed form of "value if it beats the previous state, else reset".

    A virtual row 0 holding the incoming state value counts as a rise; a row
    rises when it beats the *value* of the row before it.  Inside a run of
    non-rising rows the output alternates reset / value.
    """
    prev = np.concatenate(([start], v[:-1]))
    rise = rises(v, prev)
    idx = np.arange(1, len(v) + 1)
    last = np.maximum.accumulate(np.where(rise, idx, 0))
    r = idx - last
    return np.where(r % 2 == 1, reset, v)


def literal_fold_batch(v: np.ndarray, state):
    """Fold one batch of a key's values (in record order) the literal way.

    ``state`` is (max, min, count, sum) or None for a new key.  Returns the
    per-record (max, min, count, sum) arrays and the new state.
    """
    n = len(v)
    mx = np.zeros(n, dtype=np.int64)
    mn = np.zeros(n, dtype=np.int64)
    cnt = np.zeros(n, dtype=np.int64)
    tot = np.zeros(n, dtype=np.int64)
    if state is None:
        # the first record of a key only creates the blank state
        mx0, mn0, n0, s0 = BLANK_MAX, BLANK_MIN, 0, 0
        mx[0], mn[0] = BLANK_MAX, BLANK_MIN
        first = 1
    else:
        mx0, mn0, n0, s0 = state
        first = 0
    rest = v[first:]
    if len(rest):
        # the max state is never negative: no value at or below 0 beats it
        mx[first:] = _literal_extreme(np.maximum(rest, 0), mx0, lambda a, p: a > p, 0)
        mn[first:] = _literal_extreme(rest, mn0, lambda a, p: a < p, RESET_MIN)
        cnt[first:] = n0 + np.arange(1, len(rest) + 1)
        tot[first:] = s0 + np.cumsum(rest)
    return mx, mn, cnt, tot, (int(mx[-1]), int(mn[-1]), int(cnt[-1]), int(tot[-1]))


class LiteralFoldProcessor(StatefulProcessor):
    """The original program's per-key fold, quirks included."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("fold", "mx INT, mn INT, n BIGINT, total BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _ordered(rows, ["start_ts", "seq"])
        out = pd.DataFrame({
            "record_key": pdf["record_key"], "trial_id": pdf["trial_id"],
            "patient_id": pdf["patient_id"], "visit_name": pdf["visit_name"],
            "value": pdf["value"].astype("int32"), "start_ts": pdf["start_ts"],
            "seq": pdf["seq"]})
        state = self.state.get()         # None for a new key
        if state is None:
            for c in ("trial_id", "patient_id", "visit_name"):
                out.loc[0, c] = ""
        mx, mn, cnt, tot, new_state = literal_fold_batch(
            pdf["value"].to_numpy(dtype=np.int64), state)
        self.state.update(new_state)
        out["max_value"] = mx.astype("int32")
        out["min_value"] = mn.astype("int32")
        out["n_records"] = cnt
        out["sum_value"] = tot
        out["avg_int"] = _div_trunc(tot, cnt)
        yield out

    def close(self) -> None:
        pass


def _key_runs(keys: np.ndarray):
    """(start, end) of each run of equal keys in a key-sorted array."""
    starts = run_starts(keys)
    return zip(starts, np.append(starts[1:], len(keys)))


class _BucketedFold(StatefulProcessor):
    """Per-key folds with one Python call per *bucket* of keys.

    The stream is grouped by a hash bucket of the key, not by the key: the
    Python stateful runner costs a few ms per group, which dominates when a
    batch holds thousands of keys.  State is one small entry per key, kept in
    packets (``PacketState``), so a batch reads and writes only packets of
    keys that it contains, and a key's rows in one batch are bounded by the
    trigger size.  Subclasses fold one key's values given its state.
    """

    KEY = "record_key"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = PacketState(handle, "fold_packets")

    def fold(self, v: np.ndarray, state):
        raise NotImplementedError

    def fold_runs(self, v: np.ndarray, starts: np.ndarray, states: list):
        """Columns of all rows and the new state of each run."""
        cols, new = None, []
        for s, e, state in zip(starts, np.append(starts[1:], len(v)), states):
            *arrays, now = self.fold(v[s:e], state)
            if cols is None:
                cols = [np.empty(len(v), dtype=np.int64) for _ in arrays]
            for c, a in zip(cols, arrays):
                c[s:e] = a
            new.append(now)
        return cols, new

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _ordered(rows, [self.KEY, "start_ts", "seq"])
        keys = pdf[self.KEY].to_numpy()
        starts = run_starts(keys)
        names = keys[starts].tolist()
        states = self.state.load(names)             # None for a new key
        cols, new = self.fold_runs(pdf["value"].to_numpy(dtype=np.int64), starts, states)
        self.state.store(names, new)
        yield self.output(pdf, cols, starts[[s is None for s in states]])

    def output(self, pdf: pd.DataFrame, cols, new_rows: np.ndarray) -> pd.DataFrame:
        raise NotImplementedError

    def close(self) -> None:
        pass


def _record_columns(pdf: pd.DataFrame) -> dict:
    return {"record_key": pdf["record_key"], "trial_id": pdf["trial_id"],
            "patient_id": pdf["patient_id"], "visit_name": pdf["visit_name"],
            "value": pdf["value"].astype("int32"), "start_ts": pdf["start_ts"],
            "seq": pdf["seq"]}


class BucketedRunningSummaryProcessor(_BucketedFold):
    """``RunningSummaryProcessor``, grouped by key bucket."""

    def fold_runs(self, v, starts, states):
        return running_runs(v, starts, states)

    def output(self, pdf, cols, new_rows):
        cnt, tot, mn, mx = cols
        return pd.DataFrame({
            **_record_columns(pdf), "run_count": cnt, "run_sum": tot,
            "run_min": mn.astype("int32"), "run_max": mx.astype("int32"),
            "run_avg_int": _div_trunc(tot, cnt), "run_avg": tot / cnt})


class BucketedLiteralFoldProcessor(_BucketedFold):
    """``LiteralFoldProcessor``, grouped by key bucket."""

    def fold(self, v, state):
        return literal_fold_batch(v, state)

    def output(self, pdf, cols, new_rows):
        mx, mn, cnt, tot = cols
        out = pd.DataFrame(_record_columns(pdf))
        # the first record of a key only creates the blank state
        for c in ("trial_id", "patient_id", "visit_name"):
            out.loc[new_rows, c] = ""
        out["max_value"] = mx.astype("int32")
        out["min_value"] = mn.astype("int32")
        out["n_records"] = cnt
        out["sum_value"] = tot
        out["avg_int"] = _div_trunc(tot, cnt)
        return out


class WordCountProcessor(StatefulProcessor):
    """Cumulative count per word, starting from a seed; seed words stay
    silent until they occur."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("count", "n BIGINT")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.state.update((int(initialState["seed_n"].iloc[0]),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _ordered(rows, ["doc_id", "pos"])
        got = self.state.get()          # None before the first update
        n0 = got[0] if got is not None else 0
        n = n0 + np.arange(1, len(pdf) + 1, dtype=np.int64)
        self.state.update((int(n[-1]),))
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "pos": pdf["pos"].astype("int32"),
                            "word": pdf["word"], "n": n})

    def close(self) -> None:
        pass


class BucketedWordCountProcessor(StatefulProcessor):
    """Cumulative word counts with one Python call per *bucket* of words.

    Grouping by a hash bucket of the word instead of the word itself cuts
    the per-group overhead of the Python stateful runner (a few ms per
    group, which dominates with tens of thousands of distinct words per
    batch).  State stays one entry per word, kept in packets
    (``PacketState``), so a batch touches only packets of words it contains.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = PacketState(handle, "count_packets")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        words = initialState["word"].tolist()
        self.counts.load(words)
        self.counts.store(words, [(int(n),) for n in initialState["seed_n"]])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _ordered(rows, ["word", "doc_id", "pos"])
        words = pdf["word"].to_numpy()
        starts = run_starts(words)
        names = words[starts].tolist()
        before = np.array([0 if e is None else e[0] for e in self.counts.load(names)], np.int64)
        lengths = np.diff(np.append(starts, len(words)))
        n = np.arange(1, len(words) + 1) + np.repeat(before - starts, lengths)
        self.counts.store(names, zip((before + lengths).tolist()))
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "pos": pdf["pos"].astype("int32"),
                            "word": pdf["word"], "n": n})

    def close(self) -> None:
        pass


RANGE_TOKENS = 1 << 18  # of a bucket, counted at once
ROWS_OUT = 1 << 17  # handed over at once


def _sorted_tokens(code: np.ndarray, rank: np.ndarray, pos: np.ndarray):
    """Tokens in order of (word, text, position)."""
    bits = [max(1, int(a.max()).bit_length()) for a in (code, rank, pos)]
    if sum(bits) > 63:
        order = np.lexsort((pos, rank, code))
        return code[order], rank[order], pos[order]
    # one number for each token, so that numbers are sorted and not places
    one = np.sort((code << (bits[1] + bits[2])) | (rank << bits[2]) | pos)
    return one >> (bits[1] + bits[2]), (one >> bits[2]) & ((1 << bits[1]) - 1), one & ((1 << bits[2]) - 1)


class PackedWordCountProcessor(BucketedWordCountProcessor):
    """``BucketedWordCountProcessor`` over packed rows (``streaming.packed``).

    A bucket's tokens of a batch stay packed, some bytes each; they are
    unpacked and counted a range of ids of about ``RANGE_TOKENS`` tokens after
    the other, so that a very frequent word is not held as rows.  Only texts
    with the same id (or none) are in one range however many they are.
    """

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pieces = [Piece.of(*row) for pdf in rows for row in zip(pdf[TEXTS], pdf[TOKENS])]
        coded = pa.concat_arrays([p.words for p in pieces]).dictionary_encode()
        words, codes = coded.dictionary, np.split(
            coded.indices.to_numpy().astype(np.int64), np.cumsum([len(p.words) for p in pieces])[:-1])
        names = words.to_pylist()
        before = np.array([0 if e is None else e[0] for e in self.counts.load(names)], np.int64)

        # texts by id, those without one first, and the range that each falls into
        missing = np.concatenate([p.missing for p in pieces])
        ids, rank = np.unique(np.concatenate([p.ids for p in pieces])[~missing], return_inverse=True)
        ranks = np.zeros(len(missing), np.int64)
        ranks[~missing] = rank + 1
        size = np.bincount(ranks, np.concatenate([p.counts for p in pieces])).astype(np.int64)
        ranges = (np.cumsum(size) - size) // RANGE_TOKENS
        ranks = np.split(ranks, np.cumsum([len(p.ids) for p in pieces])[:-1])
        for r in np.unique(ranges).tolist():
            low, high = np.searchsorted(ranges, [r, r + 1])
            some = []
            for piece, code, of in zip(pieces, codes, ranks):
                if len(of) and of[0] < high and of[-1] >= low:
                    text, number, pos = piece.tokens()
                    inside = slice(*np.searchsorted(of[text], [low, high]))
                    some.append((code[number[inside]], of[text[inside]] - low, pos[inside]))
            code, rank, pos = _sorted_tokens(*(np.concatenate(x) for x in zip(*some)))
            starts = run_starts(code)
            lengths = np.diff(np.append(starts, len(code)))
            n = np.arange(1, len(code) + 1) + np.repeat(before[code[starts]] - starts, lengths)
            before[code[starts]] += lengths
            rank += low
            for i in range(0, len(n), ROWS_OUT):
                at, of = slice(i, i + ROWS_OUT), rank[i:i + ROWS_OUT]
                doc_id = pa.array(np.append(0, ids)[of], pa.int64(), mask=of == 0)
                yield pd.DataFrame({
                    "doc_id": pd.arrays.ArrowExtensionArray(doc_id), "pos": pos[at].astype("int32"),
                    "word": pd.arrays.ArrowExtensionArray(words.take(pa.array(code[at]))), "n": n[at]})
        self.counts.store(names, zip(before.tolist()))
