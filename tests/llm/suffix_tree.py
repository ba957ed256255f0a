"""The suffix tree of ``pulseline.llm.pst`` in the memory of one process, as an
automaton that reads lines byte by byte."""

import numpy as np
from pyspark.sql import functions as F

from pulseline.llm.pst import DEPTH, END, GAIN_PER_SYMBOL, MIN_COUNT, MIN_GAIN, _last, gram_counts

LANE_BYTES = 1024


def candidates(texts, min_share=0.0, min_count=MIN_COUNT):
    """(depth, gram, n) of every context that occurs ``min_count`` times and
    has a share of at least ``min_share``, and each of its next symbols, for
    a tree in memory."""
    grams = gram_counts(texts.select("text", F.lit(False).alias("held_out")))
    total = grams.agg(F.sum("n")).first()[0]
    if not total:
        return []
    depths = F.explode(F.array(*(F.struct(F.lit(d).alias("depth"), _last(F.col("gram"), d + 1).alias("gram"))
                                 for d in range(DEPTH + 1))))
    by_depth = grams.select("n", depths.alias("g")).groupBy("g.depth", "g.gram").agg(
        F.sum("n").alias("n"))
    # a context's share comes from its own grams of one symbol less, the last being the next symbol
    contexts = by_depth.groupBy("depth", F.shiftrightunsigned("gram", 8).alias("context")).agg(
        F.sum("n").alias("all"), F.collect_list(F.struct("gram", "n")).alias("next"))
    enough = (F.col("all") >= min_share * total) & (F.col("all") >= min_count) | (F.col("depth") == 0)
    rows = contexts.where(enough).select(
        "depth", F.explode("next").alias("x")).select("depth", "x.gram", "x.n")
    return [tuple(r) for r in rows.collect()]


class SuffixTree:
    """``contexts``: the retained ones, as bytes.  ``step`` and ``log10`` are
    indexed by state and symbol column (``column`` of a byte)."""

    def __init__(self, rows: list[tuple[int, int, int]]):
        counts: dict[bytes, dict[int, int]] = {}
        for depth, gram, n in rows:
            context = ((gram % (1 << 64)) >> 8).to_bytes(8, "big")[8 - depth:]
            counts.setdefault(context, {})[gram & 255] = n
        seen = sorted({b for c in counts.values() for b in c})
        self.column = np.full(256, len(seen), np.int64)  # the last column: bytes never seen
        self.column[seen] = np.arange(len(seen))
        width = len(seen) + 1
        chance: dict[bytes, np.ndarray] = {}
        kept: dict[bytes, bytes] = {}  # context -> longest retained suffix
        self.contexts: list[bytes] = []
        for context in sorted(counts, key=len):
            n = np.zeros(width)
            for b, c in counts[context].items():
                n[self.column[b]] = c
            kinds, total = np.count_nonzero(n), n.sum()
            if context:
                below = chance[context[1:]]
                kept[context] = kept[context[1:]]
                some = n > 0
                left_out = (n[some] - 1 + kinds * below[some]) / (total - 1 + kinds)
                gain = float((n[some] * np.log(left_out / below[some])).sum())
                if gain >= max(MIN_GAIN, GAIN_PER_SYMBOL * total):
                    kept[context] = context
                    self.contexts.append(context)
            else:
                below = np.full(width, 1 / 256)
                kept[context] = context
            # one unseen byte's share each; the last column stands for any one of them
            chance[context] = (n + kinds * below) / (total + kinds)
        states = {b""} | {c[:k] for c in self.contexts for k in range(1, len(c) + 1)}
        states = sorted(states, key=lambda c: (len(c), c))
        number = {c: i for i, c in enumerate(states)}

        def longest(context: bytes) -> bytes:
            while context not in number:
                context = context[1:]
            return context

        def model(context: bytes) -> np.ndarray:
            while context not in kept:
                context = context[1:]
            return chance[kept[context]]

        if not counts:
            chance[b""], kept[b""] = np.full(width, 1 / 256), b""
        self.log10 = np.log10(np.stack([model(c) for c in states])).astype(np.float32)
        self.step = np.zeros((len(states), width), np.int32)
        for i, c in enumerate(states):
            for b in seen:
                self.step[i, self.column[b]] = number[longest(c + bytes([b]))]
        # an unseen byte ends all contexts
        self.width, self.n_states = width, len(states)
        self.step = (self.step * width).reshape(-1)
        self.log10 = self.log10.reshape(-1)
        self.column = self.column.astype(np.int32)

    def score(self, lines: list[bytes]) -> np.ndarray:
        """log10 probability of each line and its end."""
        pad = bytes([END]) * DEPTH
        data = self.column[np.frombuffer(b"".join(pad + x + bytes([END]) for x in lines), np.uint8)]
        size = np.array([len(x) + 1 for x in lines], np.int64)
        if not len(size):
            return np.zeros(0)
        begin = np.r_[0, np.cumsum(size + DEPTH)[:-1]] + DEPTH
        n_lanes = -(-size // LANE_BYTES)
        lane_doc = np.repeat(np.arange(len(size)), n_lanes)
        k = np.arange(n_lanes.sum()) - np.repeat(np.r_[0, np.cumsum(n_lanes)[:-1]], n_lanes)
        start = begin[lane_doc] + k * LANE_BYTES
        length = np.minimum(LANE_BYTES, size[lane_doc] - k * LANE_BYTES)
        order = np.argsort(-length, kind="stable")
        start, length, lane_doc = start[order], length[order], lane_doc[order]
        state = np.zeros(len(start), np.int32)
        for j in range(-DEPTH, 0):  # warm-up
            state = self.step[state + data[start + j]]
        total = np.zeros(len(start))
        live = np.searchsorted(-length, -np.arange(length[0]), side="left")
        for j, n in enumerate(live.tolist()):
            at = state[:n] + data[start[:n] + j]
            total[:n] += self.log10[at]
            state[:n] = self.step[at]
        return np.bincount(lane_doc, weights=total, minlength=len(size))
