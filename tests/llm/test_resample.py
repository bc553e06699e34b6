import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from lakestrata.llm import resample

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute_features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return len(words), [" ".join(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute(docs, target, least=20, percent=5, seed=42):
    def totals(rows):
        return Counter(zlib.crc32(f.encode()) % 10000 for text in rows for f in brute_features(text)[1])
    t, s = totals(target), totals([text for _, text in docs])
    t_all, s_all = sum(t.values()), sum(s.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    out = []
    for doc_id, text in docs:
        n, features = brute_features(text)
        weight = sum(gain[zlib.crc32(f.encode()) % 10000] for f in features)
        score = None
        if doc_id is not None:
            h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(features), weight, score, None, n])
    able = sorted((r for r in out if r[0] is not None and r[5] >= least), key=lambda r: (-r[3], r[0], -r[2], r[1]))
    for k, r in enumerate(able[:len(able) * percent // 100], 1):
        r[4] = k
    return sorted((tuple(r[:5]) for r in out), key=repr)


EDGES = [(1, None), (2, ""), (3, " ,.; "), (4, "One"), (5, "one two"), (6, "ONE two\nthree"), (None, "one two three " * 9), (7, "été ÉTÉ 1984 naïve " * 8),
         (8, "w" * 255 + " " + "v" * 256 + " " + "u" * 100_000 + " a b " * 20), (9, "same words here " * 700), (9, "other words there " * 9)]


@pytest.mark.parametrize("words, pairs", [(1 << 16, 1 << 16), (4, 3), (0, 0)])
def test_rows_equal_brute_force_whatever_the_head(make_docs, prose, monkeypatch, words, pairs):
    rows = EDGES + [(100 + i, prose(i, 5 + 3 * i % 90)) for i in range(140)]
    items = [prose(i, 30) for i in range(6)] + [None, "", "one two three"]
    target = make_docs(list(enumerate(items))).withColumnRenamed("text", "body")
    if words < 10:
        full = resample.Head
        monkeypatch.setattr(resample, "frequent_head", lambda docs, text_col: full([b"one", b"same", b"words", b"two"][:words], [(b"one", b"two"), (b"same", b"words"), (b"a", b"b")][:pairs]))
    got = resample.importance(make_docs(rows).repartition(5), target, target_text="body", percent=12)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, items, percent=12)


def test_state_tables_join_like_the_library():
    import numpy as np
    for size in (1, 2, 7, 64, 255, 256):
        a, b = b"some words ", bytes(range(65, 65 + size % 26 + 1)) * size
        b = b[:size]
        got = resample.joined(np.array([zlib.crc32(a)], np.uint32), np.array([zlib.crc32(b)], np.uint32), np.array([size]))
        assert int(got[0]) == zlib.crc32(a + b)


def test_summary_keeps_every_entry_over_its_share():
    counts = Counter({b"rare%d" % i: 1 + i % 3 for i in range(500)} | {b"hot": 400, b"warm": 90})
    small = resample.trimmed(counts, 10)
    assert len(small) <= 10 and {b"hot", b"warm"} <= set(small) and all(n <= counts[k] for k, n in small.items())


def test_frequent_words_and_pairs_make_the_head(make_docs, prose):
    rows = [(i, "the quick brown fox " * 30 + prose(i, 50)) for i in range(40)]
    head = resample.frequent_head(make_docs(rows).repartition(3))
    assert set(head.words[:4]) <= {b"the", b"quick", b"brown", b"fox"} | set(head.words)
    assert {b"the", b"quick", b"brown", b"fox"} <= set(head.words)
    assert (head.key >= 0).sum() > 3


def test_empty_tables_clashing_columns_and_the_drawn_rows(make_docs, prose):
    empty = make_docs([])
    assert resample.importance(empty, empty).count() == 0
    docs = make_docs([(i, prose(i, 30)) for i in range(60)]).selectExpr("*", "1 as rank", "2 as score", "3 as bucket", "'x' as own_id")
    rows = resample.importance(docs, empty).collect()
    drawn = {r["doc_id"] for r in rows if r["rank"]}
    assert sorted(r["rank"] for r in rows if r["rank"]) == [1, 2, 3]
    out = resample.resample(docs, empty)
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == drawn
