import random
import re

import numpy as np
import pytest

from lakestrata.llm import neardup


def shingle_set(text, words):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall("[^\x20\x09-\x0d]+", low)
    width = min(words, len(found))
    return {tuple(found[i:i + width]) for i in range(len(found) - width + 1)} if found else set()


def brute(rows, words=4, percent=80):
    """Components over all pairs."""
    sets = [(i, shingle_set(t, words)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for x, (a, s) in enumerate(sets):
        for b, t in sets[:x]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return sorted(((i, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in sets), key=repr)


def changed(text, rnd, times):
    words = text.split()
    for _ in range(times):
        words[rnd.randrange(len(words))] = f"w{rnd.randrange(10**6)}"
    return " ".join(words)


def corpus(prose):
    rnd = random.Random(5)
    rows = []
    for family in range(25):
        text = prose(family, rnd.choice([30, 80, 150, 400]))
        for _ in range(rnd.randrange(1, 9)):
            text = changed(text, rnd, rnd.randrange(0, 7)) if rnd.random() < 0.6 else text  # chains drift away from the first
            rows.append([None, text.upper() if rnd.random() < 0.2 else text])
    shared = prose(99, 60)
    rows += [[None, prose(200 + k, 40) + " " + shared] for k in range(60)]   # one passage in many texts
    rows += [[None, prose(300, 200) + f" tail{k}"] for k in range(40)]       # a large group of near copies
    rnd.shuffle(rows)
    return [(k * 3, t) for k, (_, t) in enumerate(rows)] + [(1, None), (2, ""), (4, " \n"), (5, "one"), (7, "ONE"), (8, "one two"), (10, "one two"),
                                                            (None, "one two"), (11, "a\x0bb\x0cc d"), (13, "a b c D"), (14, "a\xa0b c d")]


@pytest.fixture(scope="module")
def rows(prose):
    return corpus(prose)


def test_components_equal_brute_force(make_docs, rows):
    got = neardup.near_groups(make_docs(rows).repartition(5), words=4).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_small_blocks_give_the_same(make_docs, rows, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4)
    monkeypatch.setattr(neardup, "components", _components_of_first_links_hidden(neardup.components))
    got = neardup.near_groups(make_docs(rows), words=4).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def _components_of_first_links_hidden(real):
    """The first call sees no links, so that all work falls to the comparison across components."""
    calls = []

    def fake(links):
        calls.append(1)
        return real(links.where("false") if len(calls) == 1 else links)
    return fake


def test_links_at_the_limit(make_docs):
    base = [f"w{i}" for i in range(13)]          # ten shingles of four words
    rows = [(1, " ".join(base)), (2, " ".join(base[:11])), (3, " ".join(base[:10]) + " x"), (4, " ".join(base[3:]) + " y z")]
    got = neardup.near_groups(make_docs(rows), words=4).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
    assert {r["doc_id"]: r["component_id"] for r in got}[2] == 1


def test_deduplicate_keeps_one_row_per_component(make_docs, rows):
    docs = make_docs(rows + [(1, None)]).withColumnRenamed("lang", "key").withColumnRenamed("source", "digest")
    got = neardup.deduplicate(docs, words=4)
    assert got.columns == docs.columns
    assert sorted((r["doc_id"] for r in got.collect()), key=repr) == sorted((r[0] for r in brute(rows) if r[3]), key=repr)


def test_signature_distance_follows_similarity():
    rng = np.random.default_rng(1)
    common = rng.integers(0, 1 << 63, 800, dtype=np.uint64)
    far = []
    for k in range(40):
        a, b = (np.concatenate([common, rng.integers(0, 1 << 63, 100, dtype=np.uint64)]) for _ in range(2))
        x, y = neardup.signatures([a, b])
        far.append(np.count_nonzero(x != y))
    assert abs(np.mean(far) / neardup.PLACES - 0.2) < 0.04 and max(far) <= neardup.DISTANCE


def test_empty_table(make_docs):
    assert neardup.near_groups(make_docs([])).collect() == []
    assert neardup.deduplicate(make_docs([])).collect() == []


def test_pages_that_only_share_a_passage_leave_a_wide_group(spark, make_docs, prose, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 16)
    passage = prose(1, 120)
    dealt = []
    real = neardup.dealt

    def counted(*args):
        rows = real(*args)
        dealt.append(rows.count())
        return rows
    monkeypatch.setattr(neardup, "dealt", counted)
    family = [(5000 + k, prose(7, 200) + f" end{k}") for k in range(5)]
    for size in (60, 120, 240):
        rows = [(k, passage + " " + prose(1000 + k, 40)) for k in range(size)] + family
        got = neardup.near_groups(make_docs(rows).repartition(4), words=4).collect()
        assert sorted(map(tuple, got), key=repr) == brute(rows)
    assert sum(dealt[k] for k in range(1, len(dealt), 2)) <= 16 and len(dealt) == 6  # beside groups within one block, nearly nobody is left to compare


def test_contenders_hold_both_ends_of_every_link(spark, prose):
    rnd = random.Random(2)
    rows = []
    for family in range(12):
        text = prose(family, 40)
        rows += [(10 * family + k, shingle_set(changed(text, rnd, rnd.randrange(0, 4)) + " " + prose(50, 30), 4)) for k in range(6)]
    rows += [(1000 + k, shingle_set(prose(100 + k, 40) + " " + prose(50, 30), 4)) for k in range(20)]  # of no family
    number = {s: n for n, s in enumerate({x for _, own in rows for x in own})}
    sets = spark.createDataFrame([(i, sorted(number[x] for x in own)) for i, own in rows], "member long, set array<long>")
    members = spark.createDataFrame([(1, i, i) for i, _ in rows], "center long, member long, label long")
    left = {r["member"] for r in neardup.contenders(members, sets, 80).collect()}
    for i, a in rows:
        for j, b in rows:
            if i < j and 100 * len(a & b) >= 80 * len(a | b):
                assert {i, j} <= left
    assert not any(i >= 1000 for i in left)


def test_rows_of_one_identifier_are_one_document_and_lose_no_text(make_docs, prose):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    rows = [(7, a), (7, b), (7, b), (9, a + " more"), (12, b + " more"), (15, c), (20, c + " more"), (20, prose(4, 60))]
    got = neardup.near_groups(make_docs(rows).repartition(3), words=4).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {7: 7, 9: 7, 12: 7, 15: 15, 20: 15}
    stay = neardup.deduplicate(make_docs(rows).repartition(3), words=4).collect()
    assert sorted((r["doc_id"], r["text"]) for r in stay) == sorted([(7, a), (7, b), (15, c)])
