import hashlib
import random
import zlib

import numpy as np
import pytest

from lakestrata.llm import periodic
from lakestrata.llm.queries import repeat_tail


def brute_runs(words, least=6, times=4):
    """Every stretch with its smallest period that no neighbour extends, by trying all periods and starts."""
    n, best = len(words), {}
    for q in range(1, n // times + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and words[e] == words[e + q]:
                e += 1
            if e > s and e + q - s >= max(least, times * q):
                best.setdefault((s, e + q - s), q)
            s = max(e, s) + 1
    return sorted((s, m, q) for (s, m), q in best.items())


def brute_kept(words, found):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in found)]


def tricky(seed):
    rnd = random.Random(seed)
    kind = seed % 6
    if kind == 0:
        return [rnd.choice("ab") for _ in range(rnd.randint(0, 60))]
    if kind == 1:
        unit = [rnd.choice("abc") for _ in range(rnd.randint(1, 7))]
        return [rnd.choice("ab") for _ in range(rnd.randint(0, 5))] + unit * rnd.randint(2, 9) + unit[:rnd.randint(0, len(unit))] + list("xa")
    if kind == 2:
        inner = list("ab") * rnd.randint(4, 6) + list("c") * rnd.randint(0, 8)
        return inner * rnd.randint(3, 6)
    if kind == 3:
        return ["a"] * rnd.randint(0, 40)
    if kind == 4:
        a, b = ["a"], ["a", "b"]
        for _ in range(rnd.randint(1, 6)):
            a, b = b, b + a
        return b * rnd.randint(1, 4)
    return [str(rnd.randint(0, 30)) for _ in range(rnd.randint(0, 200))] + ["z"] * rnd.randint(0, 9)


@pytest.mark.parametrize("least, times", [(6, 4), (1, 2), (9, 3)])
def test_block_runs_equal_brute_force(least, times):
    lists = [tricky(seed) for seed in range(300)]
    got = periodic.block_runs([[w.encode() for w in x] for x in lists], least, times)
    for words, found in zip(lists, got):
        assert [tuple(map(int, r)) for r in found] == brute_runs(words, least, times), words
        assert [w.decode() for w in periodic.kept_words([x.encode() for x in words], found)] == brute_kept(words, [tuple(r) for r in found])


def test_extensions_equal_a_plain_comparison():
    rnd = random.Random(1)
    for size, letters in [(1, 1), (12, 1), (13, 2), (200, 2), (500, 1), (700, 3)]:
        row = np.array([rnd.randint(1, letters) for _ in range(size)] + [99])
        ext = periodic.Extensions(row)
        pairs = [(a, b) for a in range(0, size + 1, max(1, size // 40)) for b in range(a + 1, size + 1, max(1, size // 30))]
        if not pairs:
            continue
        a, b = (np.array(x) for x in zip(*pairs))

        def plain(i, j):
            k = 0
            while j + k < len(row) and row[i + k] == row[j + k]:
                k += 1
            return k
        assert ext.of(a, b).tolist() == [plain(i, j) for i, j in pairs]


def test_cover_reaches_every_difference():
    assert all((a + s) % periodic.MODULUS in periodic.COVER and (b + s) % periodic.MODULUS in periodic.COVER
               for a in range(periodic.MODULUS) for b in range(periodic.MODULUS) for s in [periodic.SHIFT[a, b]])


def plain_digests(doc_id, text):
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r " else c for c in text or "").split(" ") if w]
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    return (doc_id, len(found), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(" ".join(brute_kept(words, found)).encode()).hexdigest())


def test_query_digests_equal_brute_force(make_docs, prose):
    rows = [(i, " ".join(tricky(i))) for i in range(120)] + [(200 + i, prose(i, 60 + i)) for i in range(60)]
    rows += [(300, None), (301, ""), (302, "\t\n "), (None, "a " * 20), (303, "é É " * 9), (303, "é É " * 9), (304, "same " * 30_000), (305, "x" * 200_000)]
    found = periodic.digests(periodic.periodic_runs(make_docs(rows).repartition(4), change=repeat_tail))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    small = [r for r in rows if len(r[1] or "") < 100_000]
    got = {repr(tuple(r)) for r in found.collect()}
    assert {repr(plain_digests(*r)) for r in small} <= got
    assert len(got) == len({repr(plain_digests(*r)) for r in small}) + 2


def test_one_word_many_times():
    n = 100_000
    found = periodic.block_runs([[b"w"] * n, [b"v"]], 6, 4)
    assert found[0].tolist() == [[0, n, 1]] and not len(found[1])


def test_empty_table_and_clashing_columns(make_docs):
    assert periodic.periodic_runs(make_docs([])).count() == 0
    clash = make_docs([(1, "a " * 6)]).selectExpr("*", "1 as runs", "2 as n_words", "3 as collapsed")
    assert [tuple(r) for r in periodic.periodic_runs(clash).collect()] == [(1, 6, [(0, 6, 1)], "a")]
