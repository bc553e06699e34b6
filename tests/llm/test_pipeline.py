import random
import re

import corpus_pipeline
import pytest
from test_decontam import brute as leaks
from test_langid import text as spoken
from test_neardup import brute as near

from lakestrata.llm import langid


@pytest.fixture(scope="module")
def folder(spark, make_docs, prose, tmp_path_factory):
    rnd = random.Random(3)
    rows = [(k, spoken(lang, k, 60) + " " + prose(k, 20), lang) for k, lang in enumerate(["en", "de", "el"] * 20)]
    rows += [(100 + k, rows[k][1].upper(), "en") for k in range(10)]
    rows += [(200 + k, rows[k][1] + f" tail{rnd.random()}", rows[k][2]) for k in range(10)]
    rows += [(300, None, "en"), (301, "", None), (302, "12 34 !!", "en"), (303, spoken("en", 70, 50) + " " + prose(900, 30), "en"), (304, spoken("de", 71, 3000), "de")]
    path = tmp_path_factory.mktemp("sf")
    make_docs(rows).repartition(3).write.parquet(f"{path}/documents.parquet")
    items = [(1, prose(900, 30)), (2, prose(901, 30))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows, items


def decide(name, left, items):
    """What a stage keeps of ``left``, straight from the definitions."""
    if name == "language_id":
        return {i: t for i, t in left.items() if t and re.search(r"[^\W\d_]", t)}
    if name == "exact_dedup":
        first = {}
        for i in sorted(left):
            first.setdefault(re.sub("[A-Z]", lambda m: m[0].lower(), left[i]), i)
        return {i: left[i] for i in first.values()}
    if name == "near_dedup":
        return {r[0]: left[r[0]] for r in near(list(left.items()), words=5) if r[3]}
    if name == "decontamination":
        return {r[0]: left[r[0]] for r in leaks(list(left.items()), items) if not r[5]}
    return left


def test_each_stage_decides_like_brute_force(spark, folder, monkeypatch):
    monkeypatch.setattr(langid.Network.train, "__defaults__", (60, 64, 0.03, 5))
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    left = {r[0]: r[1] for r in rows}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, path)
        docs = spark.createDataFrame(out.collect(), out.schema)
        if k < 4:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        left = decide(name, left, items)
        assert sorted(r["doc_id"] for r in docs.select("doc_id").collect()) == sorted(left), name


def test_run_gives_ids_of_what_is_left(spark, folder, monkeypatch):
    monkeypatch.setattr(langid.Network.train, "__defaults__", (60, 64, 0.03, 5))
    path, rows, items = folder
    left = {r[0]: r[1] for r in rows}
    for name, _ in corpus_pipeline.STAGES:
        left = decide(name, left, items)
    got = corpus_pipeline.run(spark, path).collect()
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)
    assert {r["doc_id"] for r in got} == set(left) and 303 not in left and 304 in left
