import random

import numpy as np
import pytest

import brute
from pulseline.llm import secrets as S


@pytest.fixture(scope="module")
def automaton():
    return S.compile_rules()


def spans(a, texts):
    raw = [t.encode() for t in texts]
    back = [S._Reversed(S._Nfa(r.pattern)) for r in a.rules]
    return S.find_spans(a, np.frombuffer(b"".join(raw), np.uint8),
                        np.r_[0, np.cumsum([len(x) for x in raw])], back)


def test_against_regexes(automaton):
    rnd = random.Random(1)
    bits = ["password", "PassWD", "secret", "token", "api_key", "apiKEY", "ſecret", "toKen", '"', "'", " ",
            "  ", ":", "=", "==", "abc", "abcdef0", "é", "\n", "AKIA", "AKIAKIA", "ABCDEFGH12345678",
            "0123456789abcdef", "deadbeef", "ghp_", "xoxb-", "AIza", "eyJ", ".", "-----", "-----BEGIN ",
            "PRIVATE KEY-----", "x" * 30, "-", ",", ".eyJab", "Z9" * 12]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40))) for _ in range(4000)]
    texts += ["", "a" * 5000 + "secret=" + "q" * 7, "f" * 50_000, "password: token: abcdefgh"]
    kinds = [k for k, _, _ in brute.SECRETS]
    for text, got in zip(texts, spans(automaton, texts)):
        named = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in got)
        assert named == brute.secrets(text)[4], text


def test_the_automaton_is_minimal(automaton):
    n, w = len(automaton.ends), automaton.width
    step = (automaton.step // w).reshape(n, w)
    group = np.unique(automaton.ends, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([group, group[step]]), axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == group.max():
            break
        group = finer
    assert group.max() + 1 == n
    assert automaton.resets[10]  # a line feed leads back to the root


def test_rules_that_one_pass_cannot_scan_are_refused():
    with pytest.raises(ValueError, match="go on"):
        S.compile_rules((S.Rule("x", "a(bc)*"),))
    with pytest.raises(ValueError, match="nothing"):
        S.compile_rules((S.Rule("x", "a*"),))


@pytest.mark.parametrize("n", [17, 40])
def test_many_rules_are_all_found(n):
    """Matches of the last rules are as good as those of the first."""
    rules = tuple(S.Rule(f"r{i}", f"K{chr(65 + i // 10)}{i % 10}x[0-9]+") for i in range(n))
    a = S.compile_rules(rules)
    texts = [f"see K{chr(65 + i // 10)}{i % 10}x{i} and K{chr(65 + i // 10)}{i % 10}x7" for i in range(n)]
    for i, found in enumerate(spans(a, texts)):
        assert [k for _, k, _ in found] == [i, i]
    with pytest.raises(ValueError, match="more than"):
        S.compile_rules(rules * 4)


def test_query(spark):
    from pulseline.llm.common import table
    sf = "/root/testdata/sf0.01"
    want = {r.doc_id: brute.secrets(r.text) for r in table(spark, sf, "documents").collect()}
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans)
           for r in S.op1_secret_scan(spark, sf).collect()}
    assert got == want and any(x[0] for x in want.values())
