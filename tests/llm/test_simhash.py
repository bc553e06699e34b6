import random

import pytest
import xxhash

from lakestrata.llm import simhash


def brute_print(text, words):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r " else c for c in low).split(" ") if w]
    if not found:
        return 0
    parts = [" ".join(found[i:i + words]) for i in range(len(found) - words + 1)] or [" ".join(found)]
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """prints: (doc_id, fingerprint) rows; smallest identifier reachable by equal identifiers or close fingerprints."""
    nodes = [p for p in prints if p[0] is not None]
    label = {i: i for i, _ in nodes}
    changed = True
    while changed:
        changed = False
        for a, x in nodes:
            for b, y in nodes:
                if (x ^ y).bit_count() <= 3 and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


ROWS = [(1, None), (2, ""), (3, " \t\r\n"), (4, "One two"), (5, "one TWO"), (6, "one two"), (7, "a b c d"), (8, "É é É"), (9, "x" * 300_000),
        (None, "one two"), (10, "one two"), (10, "another text with the same number"), (11, "another text with the same number")]


def test_fingerprints_and_components_equal_brute_force(make_docs, prose):
    rows = list(ROWS)
    for k in range(12):
        base = prose(k, 40 + 30 * k).split()
        rows.append((100 * k + 100, " ".join(base)))
        for j in range(4):
            near = list(base)
            near[(7 * j) % len(near)] = "changed"
            rows.append((100 * k + 101 + j, " ".join(near[:len(near) - j])))
    prints = [(i, brute_print(t, 3)) for i, t in rows]
    label = brute_components(prints)
    want = sorted(((i, p, label.get(i)) for i, p in prints), key=repr)
    got = simhash.near_groups(make_docs(rows).repartition(5)).collect()
    assert sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got), key=repr) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def planted(seed, centers, around, flips):
    rnd = random.Random(seed)
    found = set()
    for _ in range(centers):
        center = rnd.getrandbits(64)
        for _ in range(around):
            x = center
            for b in rnd.sample(range(64), rnd.randint(0, flips)):
                x ^= 1 << b
            found.add(x)
    return sorted(found, key=lambda x: rnd.random())


@pytest.mark.parametrize("limit", [8, 16, 4096])
@pytest.mark.parametrize("centers, around, flips", [(40, 6, 5), (1, 150, 9), (3, 60, 4)])
def test_split_keys_connect_what_brute_force_connects(spark, limit, centers, around, flips):
    prints = list(enumerate(planted(limit + flips, centers, around, flips)))
    classes = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p, i) for i, p in prints], "fp long, member long")
    links = [tuple(r) for r in simhash.near_links(classes, limit).collect()]
    by = dict(prints)
    assert all((by[a] ^ by[b]).bit_count() <= 3 for a, b in links)
    own = {i: i for i in by}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if own[a] != own[b]:
                own[a] = own[b] = min(own[a], own[b])
                changed = True
    assert own == brute_components(prints)


def test_links_of_a_dense_group_are_fewer_than_entries(spark):
    prints = planted(3, 1, 700, 2)
    classes = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(prints)], "fp long, member long")
    assert simhash.near_links(classes).count() < 4 * len(prints)


def test_every_level_agrees_on_more_bits():
    path, free = 0, [64]
    while free[-1] > simhash.DISTANCE:
        assert all(simhash.agreed(4 * path + k) & simhash.agreed(path) == simhash.agreed(path) for k in range(1, 5))
        path = min(range(4 * path + 1, 4 * path + 5), key=lambda p: -simhash.free_bits(p))
        free.append(simhash.free_bits(path))
    assert free == sorted(set(free), reverse=True) and free[6] <= 12
    blocks = [simhash.agreed(k) for k in range(1, 5)]
    assert sum(b.bit_count() for b in blocks) == 64 and (blocks[0] | blocks[1] | blocks[2] | blocks[3]) == (1 << 64) - 1


def test_empty_table_repeated_rows_and_clashing_columns(spark, make_docs):
    assert simhash.near_groups(make_docs([])).count() == 0
    clash = (make_docs([(1, "a b c d e"), (1, "a b c d e"), (2, "A b c d e"), (None, "a b c d e")])
             .selectExpr("*", "1 as fp", "2 as member", "3 as path", "4 as component_id", "5 as kept"))
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in simhash.near_groups(clash).collect()) == [(0, None), (1, 1), (1, 1), (2, 1)]
    stay = simhash.deduplicate(clash)
    assert stay.columns == clash.columns and sorted(r["doc_id"] or 0 for r in stay.collect()) == [0, 1, 1]
