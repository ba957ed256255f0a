"""Secret scan: one deterministic automaton for all rules, one byte pass.

Each rule is a regular expression over bytes.  Its NFA is determinised by
subset construction; a state keeps the live starts of the rule in order of
age, so the automaton itself finds the leftmost, longest, non-overlapping
matches.  The product of the rules' automata is minimised and laid out as one
transition array.  A pass over the bytes marks, for every rule, the positions
where a match may end; a match's start is read off by the reversed rule.

Texts are scanned in lockstep: bytes that lead every state back to the root
("resets", such as a line feed) allow a text to be cut there, so a batch
becomes many short lanes that numpy advances together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pulseline.llm.common import byte_slices, table, text_buffer


@dataclass(frozen=True)
class Rule:
    """``min_length``: bytes of a match; ``min_tail``: bytes of its last,
    repeated part.  A match that is shorter is dropped after it has used up
    its text, as with a filter on the matches of a regex search."""

    kind: str
    pattern: str
    min_length: int = 1
    min_tail: int = 1


def any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYS = "|".join(map(any_case, ("password", "passwd", "secret", "token"))) + (
    "|" + any_case("api") + "_?" + any_case("key"))

#: The first three rules are the contract's, in its order.
BASE_RULES = (
    Rule("assign", f"({_KEYS})[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9+/_.=-]+", min_tail=6),
    Rule("access", "AKIA[A-Z0-9]+", min_length=20),
    Rule("hex", "[0-9a-f]{24,}"),
)
#: Token formats that their issuers publish.
MORE_RULES = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", min_length=40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", min_length=15),
    Rule("google", "AIza[A-Za-z0-9_-]+", min_length=39),
    Rule("jwt", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", min_length=40),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES
LANE_BYTES = 1024
SLICE_BYTES = 2 << 20
FEW_LANES = 16
MOST_RULES = 62  # one bit each of a long


# --- regular expression -> NFA ------------------------------------------------

class _Nfa:
    """Thompson automaton of one pattern (literals, classes, groups, ``|``,
    ``? * + {n} {n,} {n,m}``)."""

    def __init__(self, pattern: str):
        self.eps: list[list[int]] = []
        self.move: list[tuple[frozenset, int] | None] = []
        self.p, self.i = pattern, 0
        tree = self._either()
        if self.i != len(pattern):
            raise ValueError(f"unbalanced pattern: {pattern}")
        self.start, self.end = self._build(tree)

    def _either(self):
        options = [self._sequence()]
        while self.i < len(self.p) and self.p[self.i] == "|":
            self.i += 1
            options.append(self._sequence())
        return options[0] if len(options) == 1 else ("either", options)

    def _sequence(self):
        items = []
        while self.i < len(self.p) and self.p[self.i] not in "|)":
            items.append(self._repeat(self._atom()))
        return ("sequence", items)

    def _repeat(self, atom):
        c = self.p[self.i:self.i + 1]
        if c and c in "?*+":
            self.i += 1
            return ("repeat", atom, int(c == "+"), 1 if c == "?" else None)
        if c == "{":
            close = self.p.index("}", self.i)
            low, comma, high = self.p[self.i + 1:close].partition(",")
            self.i = close + 1
            return ("repeat", atom, int(low), int(high) if high else None if comma else int(low))
        return atom

    def _char(self) -> int:
        c = self.p[self.i]
        self.i += 1
        if c != "\\":
            return ord(c)
        c = self.p[self.i]
        self.i += 1
        if c == "x":
            self.i += 2
            return int(self.p[self.i - 2:self.i], 16)
        return {"n": 10, "t": 9, "r": 13}.get(c, ord(c))

    def _atom(self):
        c = self.p[self.i]
        if c == "(":
            self.i += 1
            inner = self._either()
            self.i += 1
            return inner
        if c != "[":
            return ("bytes", frozenset([self._char()]))
        self.i += 1
        found: set[int] = set()
        while self.p[self.i] != "]":
            low = self._char()
            if self.p[self.i] == "-" and self.p[self.i + 1] != "]":
                self.i += 1
                found.update(range(low, self._char() + 1))
            else:
                found.add(low)
        self.i += 1
        return ("bytes", frozenset(found))

    def _state(self) -> int:
        self.eps.append([])
        self.move.append(None)
        return len(self.eps) - 1

    def _build(self, tree) -> tuple[int, int]:
        a = self._state()
        if tree[0] == "bytes":
            b = self._state()
            self.move[a] = (tree[1], b)
            return a, b
        if tree[0] == "sequence":
            b = a
            for part in tree[1]:
                s, e = self._build(part)
                self.eps[b].append(s)
                b = e
            return a, b
        if tree[0] == "either":
            b = self._state()
            for part in tree[1]:
                s, e = self._build(part)
                self.eps[a].append(s)
                self.eps[e].append(b)
            return a, b
        _, inner, low, high = tree
        b = a
        for _ in range(low):
            s, e = self._build(inner)
            self.eps[b].append(s)
            b = e
        end = self._state()
        if high is None:
            s, e = self._build(inner)
            self.eps[b] += [s, end]
            self.eps[e] += [s, end]
        else:
            self.eps[b].append(end)
            for _ in range(high - low):
                s, e = self._build(inner)
                self.eps[b].append(s)
                self.eps[e].append(end)
                b = e
        return a, end

    def closure(self, states: Iterable[int]) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for x in self.eps[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(s for s in seen if self.move[s] or s == self.end)

    def step(self, states: Iterable[int], byte: int) -> frozenset:
        return self.closure([self.move[s][1] for s in states
                             if self.move[s] and byte in self.move[s][0]])


class _Reversed:
    """Longest match backwards from a match's end."""

    def __init__(self, nfa: _Nfa):
        self.goal, first = nfa.start, nfa.end
        back: dict[int, list[int]] = {}
        for s, targets in enumerate(nfa.eps):
            for x in targets:
                back.setdefault(x, []).append(s)
        self.eps, self.into = back, {}
        for s, m in enumerate(nfa.move):
            if m:
                self.into.setdefault(m[1], []).append((m[0], s))
        self.first, self.cache = self._closure([first]), {}

    def _closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for x in self.eps.get(todo.pop(), ()):
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)

    def start(self, data: np.ndarray, end: int, least: int) -> int:
        states, best, i = self.first, end, end
        while i > least and states:
            i -= 1
            key = (states, int(data[i]))
            if key not in self.cache:
                self.cache[key] = self._closure(
                    [s for x in states for chars, s in self.into.get(x, ()) if key[1] in chars])
            states = self.cache[key]
            if self.goal in states:
                best = i
        return best


# --- rules -> one minimal automaton -------------------------------------------

class _RuleDfa:
    """Leftmost-longest scan of one rule as a deterministic automaton.  A
    state is the tuple of live NFA state sets, oldest start first.  While the
    oldest one is in a match no later start is live; as it ends, a new start
    is tried at the same byte."""

    def __init__(self, rule: Rule):
        self.rule, self.nfa = rule, _Nfa(rule.pattern)
        self.fresh = self.nfa.closure([self.nfa.start])
        if self.nfa.end in self.fresh:
            raise ValueError(f"{rule.kind}: the pattern matches nothing at all")

    def accepts(self, state: tuple) -> bool:
        return bool(state) and self.nfa.end in state[0]

    def step(self, state: tuple, byte: int) -> tuple:
        if self.accepts(state):
            on = self.nfa.step(state[0], byte)
            if on:
                if self.nfa.end not in on:
                    raise ValueError(f"{self.rule.kind}: a match must not need bytes after its "
                                     "end to go on; one pass can't take them back")
                return (on,)
            state = ()
        seen: set[int] = set()
        out = []
        for group in (*state, self.fresh):
            on = self.nfa.step(group, byte) - seen
            if on:
                if self.nfa.end in on and out:
                    raise ValueError(f"{self.rule.kind}: a later start ends before an earlier one")
                if self.nfa.end in on:
                    return (on,)
                seen |= on
                out.append(on)
        return tuple(out)


@dataclass
class Automaton:
    """Bytes that no rule tells apart share a column (``column[byte]``), and
    a state is named by its row's offset: ``step[state + column[byte]]`` is
    the next state, ``ends[state // width]`` the bit mask of rules with a
    match that may end here."""

    rules: tuple[Rule, ...]
    width: int
    column: np.ndarray
    step: np.ndarray
    ends: np.ndarray
    resets: np.ndarray


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Automaton:
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    parts = [_RuleDfa(r) for r in rules]
    marks = np.zeros((0, 256), bool)
    for p in parts:
        sets = {m[0] for m in p.nfa.move if m}
        marks = np.vstack([marks, [[b in s for b in range(256)] for s in sets]])
    _, of_byte = np.unique(marks, axis=1, return_inverse=True)
    of_byte = of_byte.reshape(-1)
    sample = [int(np.flatnonzero(of_byte == c)[0]) for c in range(of_byte.max() + 1)]
    first = tuple(() for _ in parts)
    ids, todo, rows = {first: 0}, [first], []
    memo: dict = {}
    while len(rows) < len(todo):
        state, row = todo[len(rows)], []
        for byte in sample:
            after = []
            for k, p in enumerate(parts):
                key = (k, state[k], byte)
                if key not in memo:
                    memo[key] = p.step(state[k], byte)
                after.append(memo[key])
            after = tuple(after)
            if after not in ids:
                ids[after] = len(todo)
                todo.append(after)
            row.append(ids[after])
        rows.append(row)
    moves = np.array(rows)
    ends = np.array([sum(p.accepts(s[k]) << k for k, p in enumerate(parts)) for s in todo])
    # Moore's minimisation: split classes by their classes of successors until nothing changes
    _, group = np.unique(ends, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([group, group[moves]]), axis=0, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == group.max():
            break
        group = finer
    n = int(group.max()) + 1
    one = np.zeros(n, np.int64)
    one[group] = np.arange(len(group))
    order = np.r_[group[0], [g for g in range(n) if g != group[0]]]  # the root becomes 0
    new = np.empty(n, np.int64)
    new[order] = np.arange(n)
    step = new[group[moves[one[order]]]]
    width = step.shape[1]
    return Automaton(rules, width, of_byte.astype(np.int32),
                     (step * width).astype(np.int32).reshape(-1),
                     ends[one[order]].astype(np.min_scalar_type(1 << len(rules))), (step == 0).all(axis=0)[of_byte])


# --- the byte pass ------------------------------------------------------------

def _trace(a: Automaton, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The state after every byte; each text starts at the root."""
    cuts = np.flatnonzero(a.resets[data]) + 1
    if len(cuts):
        block = cuts // LANE_BYTES
        cuts = cuts[np.r_[True, block[1:] != block[:-1]]]
    edges = np.unique(np.concatenate([offsets, cuts]))
    starts, size = edges[:-1], np.diff(edges)
    order = np.argsort(-size, kind="stable")
    starts, size = starts[order], size[order]
    out = np.zeros(len(data), np.int32)
    if not len(size):
        return out
    data = a.column[data]
    state = np.zeros(len(size), np.int32)
    live = np.searchsorted(-size, -np.arange(size[0]), side="left")
    for j, k in enumerate(live.tolist()):
        if k < FEW_LANES:  # what is left are a few long lanes: byte by byte
            step = a.step.tolist()
            for lane in range(k):
                s, at = int(state[lane]), int(starts[lane])
                states = []
                for b in data[at + j:at + int(size[lane])].tolist():
                    s = step[s + b]
                    states.append(s)
                out[at + j:at + int(size[lane])] = states
            break
        at = starts[:k] + j
        now = a.step[state[:k] + data[at]]
        state[:k] = now
        out[at] = now
    return out


def find_spans(a: Automaton, data: np.ndarray, offsets: np.ndarray,
               back: list[_Reversed]) -> list[list[tuple[int, int, int]]]:
    """Per text its (start, rule, end) in code points, sorted; all rules."""
    ends = a.ends[_trace(a, data, offsets) // a.width]
    hits = np.flatnonzero(ends)
    found: list[list] = [[] for _ in range(len(offsets) - 1)]
    if not len(hits):
        return found
    chars = np.cumsum((data & 0xC0) != 0x80)  # code points up to and with a byte
    masks = ends[hits]
    for k, rule in enumerate(a.rules):
        at = hits[(masks >> k) & 1 == 1]
        if not len(at):
            continue
        gap = np.flatnonzero(np.diff(at) != 1)
        first, last = at[np.r_[0, gap + 1]], at[np.r_[gap, len(at) - 1]]
        doc = np.searchsorted(offsets, first, side="right") - 1
        before, used = -1, 0
        for lo, hi, d in zip(first.tolist(), last.tolist(), doc.tolist()):
            begin = int(offsets[d])
            least = used if d == before else begin
            start, before, used = back[k].start(data, hi + 1, least), d, hi + 1
            if hi + 1 - start >= rule.min_length and hi + 1 - lo >= rule.min_tail:
                zero = int(chars[begin - 1]) if begin else 0
                s = int(chars[start - 1]) - zero if start else 0
                found[d].append((s, k, int(chars[hi]) - zero))
    for spans in found:
        spans.sort()
    return found


_SCHEMA = pa.schema([("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
                     ("base_sha256", pa.string()), ("spans", pa.string())])


def _scan(automaton, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a = automaton.value
    back = [_Reversed(_Nfa(r.pattern)) for r in a.rules]
    base = len(BASE_RULES)
    for batch in batches:
        data, offsets = text_buffer(batch.column(1))
        for first, last in byte_slices(offsets, SLICE_BYTES):
            o = offsets[first:last + 1]
            rows = []
            for spans in find_spans(a, data[o[0]:o[-1]], o - o[0], back):
                named = [f"{a.rules[k].kind}:{s}:{e}" for s, k, e in spans]
                kinds = [k for _, k, _ in spans]
                plain = ",".join(x for x, k in zip(named, kinds) if k < base)
                rows.append((kinds.count(0), kinds.count(1), kinds.count(2),
                             hashlib.sha256(plain.encode()).hexdigest(), ",".join(named)))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, last - first),
                 *(pa.array(c, t) for c, t in zip(columns, _SCHEMA.types))],
                ["doc_id", *_SCHEMA.names])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 more_rules: tuple[Rule, ...] = MORE_RULES) -> DataFrame:
    """One row per row of ``docs``: doc_id, counts of the base kinds, digest of
    the base spans, all spans as ``kind:start:end`` (code points, end
    exclusive; by start, then in order of the rules).

    Null and empty texts have no spans (digest of the empty string).  Matches
    of different kinds may overlap; those of one kind never do.  Repeated rows
    each give their row, an empty table gives none; other columns are not
    read.  The automaton's size depends on the rules only, so it is broadcast.
    """
    spark = docs.sparkSession
    automaton = spark.sparkContext.broadcast(compile_rules(BASE_RULES + tuple(more_rules)))
    source = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType
    return source.mapInArrow(
        lambda batches: _scan(automaton, batches),
        f"doc_id {kind.simpleString()}, n_assign long, n_access long, n_hex long, "
        "base_sha256 string, spans string")


def op1_secret_scan(spark, sf_dir):
    return scan_secrets(table(spark, sf_dir, "documents"))
