"""Plain Python versions of what the operators must give."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
NON_SPACE = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return (text or "").translate(LOWER)


SECRETS = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                          re.I | re.A), lambda m: len(m[2]) >= 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    ("github", re.compile("gh[pousr]_[A-Za-z0-9]+"), lambda m: len(m[0]) >= 40),
    ("slack", re.compile("xox[abprs]-[A-Za-z0-9-]+"), lambda m: len(m[0]) >= 15),
    ("google", re.compile("AIza[A-Za-z0-9_-]+"), lambda m: len(m[0]) >= 39),
    ("jwt", re.compile(r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"), lambda m: len(m[0]) >= 40),
    ("pem", re.compile("-----BEGIN [A-Z ]*PRIVATE KEY-----"), lambda m: True),
]


def secrets(text):
    found = sorted((m.start(), k, m.end(), kind) for k, (kind, rule, ok) in enumerate(SECRETS)
                   for m in rule.finditer(text or "") if ok(m))
    named = [(k, f"{kind}:{s}:{e}") for s, k, e, kind in found]
    base = ",".join(x for k, x in named if k < 3)
    n = Counter(k for k, _ in named)
    return (n[0], n[1], n[2], hashlib.sha256(base.encode()).hexdigest(), ",".join(x for _, x in named))


PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def phrases(text):
    w = WORD.findall(low(text))
    at, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)))


def base_scores(texts, held):
    """Per text: tokens, known tokens, base score; and N."""
    tokens = [NON_SPACE.findall(low(t)) + [None] for t in texts]
    c = Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return [(len(ws), sum(c[w] > 0 for w in ws),
             sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for ws in tokens], n


def simhash(text, shingle=3):
    w = NON_SPACE.findall(low(text))
    if not w:
        return 0
    parts = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or [" ".join(w)]
    votes = [0] * 64
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if votes[b] * 2 > len(parts))


def components(prints, radius=3):
    """ids -> smallest id reachable, from (id, fingerprint) pairs."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= radius:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    groups = defaultdict(list)
    for i, (doc, _) in enumerate(prints):
        groups[root(i)].append(doc)
    return {doc: min(g) for g in groups.values() for doc in g}


def quality(text):
    text = text or ""
    w = NON_SPACE.findall(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    again = len({k for i, g in enumerate(grams) if n[g] > 1 for k in (i, i + 1, i + 2)})
    lines = [x for x in text.split("\n") if NON_SPACE.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            again, len(w) < 50 or 100 * again > 50 * len(w))


def windows(items, size=13):
    out = defaultdict(set)
    for item, text in items:
        w = WORD.findall(low(text))
        for i in range(max(1, len(w) - size + 1) if w else 0):
            out[tuple(w[i:i + size])].add(str(item))
    return out


def contamination(text, known):
    w = WORD.findall(low(text))
    hit, items = set(), set()
    for size in {len(k) for k in known}:
        for i in range(len(w) - size + 1):
            if owners := known.get(tuple(w[i:i + size])):
                hit.update(range(i, i + size))
                items |= owners
    digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return (len(w), len(hit), len(items), digest, bool(hit) and 20 * len(hit) >= len(w))


def boilerplate(rows, min_sites=3, min_words=3):
    """(removed line numbers, text left) per (id, text, site) row; ids distinct."""
    def key(line):
        return re.sub(r"[\x20\x09-\x0D]+", " ", line).strip(" ")

    sites, first = defaultdict(set), {}
    for doc, text, site in sorted(rows):
        for i, line in enumerate((text or "").split("\n")):
            k = key(line)
            if len(k.split(" ")) >= min_words:
                sites[k].add(site or "")
                first.setdefault(k, (doc, i))
    out = {}
    for doc, text, _ in rows:
        lines = (text or "").split("\n")
        gone = [i for i, line in enumerate(lines) if len(sites.get(key(line), ())) >= min_sites
                and first[key(line)] != (doc, i)]
        left = "\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text
        out[doc] = (gone, left)
    return out
