import hashlib

import numpy as np
import pytest

from lakestrata.llm import decontam


def brute(rows, items, window=10):
    wins = {}
    for name, text in items:
        words = decontam.words_of((text or "").encode())
        n = min(window, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            wins.setdefault(tuple(words[k:k + n]), set()).add(name if name is None else str(name))
    sizes = {len(w) for w in wins}
    out = []
    for doc_id, text in rows:
        words, hit, names = decontam.words_of((text or "").encode()), set(), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                if got := wins.get(tuple(words[k:k + n])):
                    hit.update(range(k, k + n))
                    names |= got
        names -= {None}
        out.append((doc_id, len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def test_words_follow_the_byte_classes():
    assert decontam.words_of("Don't STOP 42".encode()) == [b"don", b"t", b"stop", b"42"]
    assert decontam.words_of("a b".encode()) == ["a b".encode()]  # only ASCII separates


def test_suffix_array_is_the_sorted_order():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 3, 200).astype(np.int32)
    order = decontam.suffix_array(words, 256)
    assert order.tolist() == sorted(range(200), key=lambda i: words[i:].tolist())


@pytest.fixture(scope="module")
def tables(spark, make_docs, prose):
    items = [(k, prose(k, 40)) for k in range(8)] + [(8, "short item here"), (9, None), (10, " .,"), (11, "solo"), (2, prose(2, 40)), (None, "nobody"), (None, prose(77, 12)), (12, "a b a b a b a b a b a b a b a b")]
    rows = [(100 + k, prose(50 + k, 300)) for k in range(30)]
    rows += [(1, prose(3, 40)), (2, prose(4, 40).upper().replace(" ", "--")), (3, " ".join(prose(5, 40).split()[5:20])), (4, " ".join(prose(5, 40).split()[5:14])),
             (5, "x short item here y"), (6, None), (7, ""), (8, "SOLO"), (9, prose(9, 200) + " " + prose(6, 40) + " " + prose(6, 40)),
             (9, prose(6, 40)), (None, prose(7, 40)), (10, "a b " * 5000), (11, "x a b a b a b a b a b y a b a b a b a b a b"),
             (12, "a passage nobody named, " + prose(77, 12)), (13, "solo and nobody")]
    return rows, items, make_docs(rows).repartition(3), spark.createDataFrame(items, "item_id long, text string")


def test_hits_equal_brute_force(tables):
    rows, items, docs, bench = tables
    got = decontam.find_leaks(docs, bench).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, items)


def test_longest_match_is_verbatim(tables):
    rows, _, docs, bench = tables
    got = {r["doc_id"]: r for r in decontam.find_leaks(docs, bench).collect()}
    assert (got[1]["longest_match"], got[1]["longest_start"]) == (40, 0)
    assert got[3]["longest_match"] == 15 and got[4]["n_hit"] == 0 and got[4]["longest_start"] == -1


def test_blocks_of_the_benchmark_give_the_same(tables, monkeypatch):
    rows, items, docs, bench = tables
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 60)
    got = decontam.find_leaks(docs, bench).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, items)


def test_decontaminate_keeps_clean_rows_and_columns(tables):
    rows, items, docs, bench = tables
    clean = decontam.decontaminate(docs.withColumnRenamed("lang", "item_id"), bench)
    want = sorted((r[0] for r in brute(rows, items) if not r[5]), key=repr)
    assert sorted((r["doc_id"] for r in clean.collect()), key=repr) == want
    assert clean.columns == ["doc_id", "text", "item_id", "source", "n_chars"]


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.find_leaks(make_docs([]), none).collect() == []
    assert [r["n_hit"] for r in decontam.find_leaks(make_docs([(1, "a b")]), none).collect()] == [0]
    assert decontam.decontaminate(make_docs([(1, "a b")]), none).count() == 1
