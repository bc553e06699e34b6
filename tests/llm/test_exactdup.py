import hashlib

from lakestrata.llm import exactdup


def brute(rows, largest=True):
    groups = {}
    for doc_id, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        groups.setdefault(hashlib.sha256(low.encode()).hexdigest(), []).append(doc_id)
    out = []
    for digest, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = (max if largest else min)(known) if known else None
        out += [(i, keep, len(ids), i == keep, digest) for i in ids]
    return sorted(out, key=repr)


ROWS = [(1, "One text"), (2, "one TEXT"), (3, None), (4, ""), (5, "ÉTÉ"), (6, "été"), (7, "x" * 200_000), (8, "X" * 200_000), (None, "one text"),
        (9, "lone"), (9, "lone"), (10, "one text ")]


def test_groups_equal_brute_force_over_many_runs(make_docs, monkeypatch):
    monkeypatch.setattr(exactdup, "RUN_ROWS", 2)
    docs = make_docs(ROWS + [(100 + i, "hot") for i in range(300)]).repartition(7)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for keep in ("largest", "smallest"):
        got = exactdup.exact_groups(docs, keep=keep, fan_in=2).collect()
        assert sorted(map(tuple, got), key=repr) == brute(rows, keep == "largest")


def test_deduplicate_returns_one_row_per_text_with_all_columns(make_docs):
    docs = make_docs(ROWS).withColumnRenamed("source", "rid_").withColumnRenamed("lang", "digest_")
    got = exactdup.deduplicate(docs, keep="largest")
    assert got.columns == docs.columns
    assert sorted((r["doc_id"] for r in got.collect())) == [2, 4, 5, 6, 8, 9, 10]


def test_rows_without_identifier_stay_only_alone(make_docs):
    got = exactdup.deduplicate(make_docs([(None, "a"), (None, "a"), (1, "b"), (None, "b")])).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got if r["doc_id"]) == [(1, "b")]
    assert [r["text"] for r in got if r["doc_id"] is None] == ["a"]


def test_empty_table(make_docs):
    assert exactdup.exact_groups(make_docs([])).collect() == []
    assert exactdup.deduplicate(make_docs([])).collect() == []
