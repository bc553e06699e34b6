import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import langid, lm


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall("[^\x20\x09-\x0d]+", low), None]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def brute_weights(parts, n, v):
    """Expectation-maximisation in plain Python, on estimates rounded to half powers of two, for each power of two of the context's count."""
    def cell(share):
        return 0 if share <= 0 else 1 + min(126, math.floor(-2 * math.log2(share)))

    def value(c):
        return 0.0 if c == 0 else 2.0 ** (-(c - 0.5) / 2)
    groups = {}
    for single, pair, context in parts:
        seen = context - 1
        key = (cell((pair - 1) / seen if seen > 0 else 0), cell((single - 1) / (n - 1) if n > 1 else 0))
        groups.setdefault(brute_bucket(seen), Counter())[key] += 1
    weights = {}
    for bucket in range(16):
        w = [0.3, 0.6, 0.1]
        for _ in range(60 if bucket in groups else 0):
            gained = [0.0, 0.0, 0.0]
            for (a, b), times in groups[bucket].items():
                mixed = [w[0] * value(a), w[1] * value(b), w[2] / (v + 1)]
                for k in range(3):
                    gained[k] += times * mixed[k] / sum(mixed)
            w = [max(g / sum(groups[bucket].values()), 1e-9) for g in gained]
            w = [x / sum(w) for x in w]
        weights[bucket] = [0.0, w[1] / (w[1] + w[2]), w[2] / (w[1] + w[2])] if bucket == 0 else w
    return weights


def brute_bucket(seen):
    return min(15, 1 + math.floor(math.log2(seen))) if seen > 0 else 0


def brute(rows):
    """Everything from the definitions, with plain counters."""
    train = [tokens(t) for i, t in rows if not held(i)]
    single = Counter(w for t in train for w in t)
    pair = Counter(p for t in train for p in zip(["", *t], t))
    context = Counter(c for t in train for c in ["", *t[:-1]])
    n, v = sum(single.values()), len(single)
    parts = [(single[w], pair[c, w], context[c]) for t in train for c, w in zip(["", *t], t)]
    weights = brute_weights(parts, n, v)
    out = []
    for i, text in rows:
        t = tokens(text)
        score = 0.0
        for c, w in zip(["", *t], t):
            seen = context[c]
            a, b, z = weights[brute_bucket(seen)]
            score += math.log10(a * (pair[c, w] / seen if seen else 0) + b * (single[w] / n if n else 0) + z / (v + 1))
        out.append((i, held(i), len(t), sum(single[w] > 0 for w in t), n, sum(math.log10((single[w] + 1) / (n + v + 1)) for w in t), score))
    return out


def same(got, want):
    got, want = (sorted(map(tuple, x), key=lambda r: (repr(r[:4]), round(r[5], 6))) for x in (got, want))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)


@pytest.fixture(scope="module")
def rows(prose):
    base = [(k, prose(k, 60)) for k in range(60)]
    return base + [(100, None), (101, ""), (102, "  \t"), (None, "the and"), (103, base[0][1].upper()), (103, base[0][1]), (104, "hot pair " * 4000), (105, "end start  end"), (106, "É é\xa0x\x0by")]


def test_scores_equal_brute_force_over_many_blocks_and_buckets(make_docs, rows, monkeypatch):
    monkeypatch.setattr(lm, "BUCKET_BYTES", 5000)
    docs = make_docs(rows).repartition(6).withColumnRenamed("lang", "block").withColumnRenamed("source", "trained")
    same(lm.score_corpus(docs, langid.fold("doc_id", 7) != 2).collect(), brute(rows))


def test_one_block_one_bucket(make_docs, rows):
    same(lm.score_corpus(make_docs(rows), langid.fold("doc_id", 7) != 2).collect(), brute(rows))


def test_probabilities_after_a_context_sum_to_one():
    weights = lm.learn_weights(np.array([5 * 128 * 128 + 3 * 128 + 9, 0]), np.array([10, 3]), 100)
    assert np.allclose(weights.sum(axis=1), 1) and weights[0][0] == 0


def test_text_like_the_corpus_scores_better_than_the_base(make_docs, prose):
    text = prose(1, 400)
    rows = [(i, text) for i in range(12)]
    got = lm.score_corpus(make_docs(rows), F.lit(True)).collect()
    assert all(r["score"] > r["base_score"] and r["n_known"] == 401 for r in got)


def test_no_training_rows_and_empty_table(make_docs):
    r = lm.score_corpus(make_docs([(1, "a b")]), F.lit(False)).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (3, 0, 0, 0.0) and r["score"] <= 0
    assert lm.score_corpus(make_docs([]), F.lit(True)).collect() == []


def test_keys_travel_whole(monkeypatch):
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 1000):
        keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        assert lm.unpacked(lm.packed(keys)).tolist() == keys.tolist()
    top = np.array([0, 1, (1 << 64) - 1], np.uint64)
    assert lm.unpacked(lm.packed(top)).tolist() == top.tolist()


def test_requests_are_no_more_than_keys(make_docs, monkeypatch):
    docs = make_docs([(k, f"a b c d{k}") for k in range(30)]).repartition(3)
    narrow = docs.select(F.col("doc_id").alias("id"), F.lit(True).alias("trained"), F.col("text").cast("binary").alias("text"))
    blocks = narrow.mapInArrow(lm.pack, "block long, ids array<long>, trained array<boolean>, sizes array<long>, bytes long, body binary")
    asked = blocks.select("block", "trained", "sizes", "body").mapInArrow(
        lm.requests(1_000_000), "bucket long, block long, single binary, single_n binary, pair binary, pair_n binary").collect()
    keys = sum(len(r["single"]) // 8 + len(r["pair"]) // 8 for r in asked)
    assert len(asked) <= keys < 30 * 4 * 2 + 3 * 10 and all(r["single"] or r["pair"] for r in asked)
