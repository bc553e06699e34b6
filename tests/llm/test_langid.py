import zlib

import numpy as np
import pytest

from lakestrata.llm import langid

WORDS = {"en": "the and that with have this from they which would there their about could other into than then these some".split(),
         "de": "der die und nicht mit sich auch eine über können würde schön größe straße müssen zwischen während".split(),
         "el": "και το να του η με για που δεν από είναι στην αυτό".split()}


def text(lang, seed, n=40):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS[lang], n))


@pytest.fixture(scope="module")
def rows():
    out = [(k, text(lang, k), lang) for k, lang in enumerate(list(WORDS) * 60)]
    return out + [(500, None, "en"), (501, "", "de"), (502, "12 !! 34", "en"), (503, text("el", 9, 5000), "el"), (504, text("de", 1), None), (504, text("de", 1), None),
                  (None, text("en", 3), "en"), (505, "é", None)]


@pytest.fixture(autouse=True)
def short(monkeypatch):
    monkeypatch.setattr(langid.Network.train, "__defaults__", (60, 64, 0.03, 5))


def test_held_out_rows_are_recognised(make_docs, rows):
    got = langid.identify(make_docs(rows)).collect()
    assert len(got) == len(rows)
    truth = {i: lang for i, _, lang in rows}
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
        if r["doc_id"] in (500, 501, 502):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    judged = [(r["lang_pred"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] < 500]
    assert len(judged) > 20 and np.mean([a == b for a, b in judged]) > 0.95


def test_a_prediction_does_not_depend_on_language_identifier_or_batch(make_docs, rows):
    network = langid.train(make_docs(rows))
    plain = {r["doc_id"]: r["score"] for r in langid.predict(make_docs(rows), network).collect()}
    moved = langid.predict(make_docs([(i, t, None) for i, t, _ in rows[::-1]]).repartition(3), network).collect()
    assert all(abs(plain[r["doc_id"]] - r["score"]) < 1e-5 for r in moved if r["doc_id"] not in (None, 504))


def test_every_position_gets_a_label(make_docs, rows):
    network = langid.train(make_docs(rows))
    raw = (text("el", 1, 60) + " " + text("en", 2, 200)).encode()
    labels = network.label_positions(raw)
    assert len(labels) == len(raw) and labels[:100].count("el") > 80 and labels[-100:].count("en") > 80


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    way = langid.Direction(3, rng)
    way.w = {k: v.astype(np.float64) for k, v in way.w.items()}
    data, mask = rng.integers(0, 256, (5, 4)).astype(np.uint8), np.ones((5, 4))
    mask[3:, 1] = 0
    goal = rng.normal(size=(5, 3, 4))

    def loss():
        return float(sum((s * g).sum() for s, g in zip(way.forward(data, mask), goal)))
    kept = []
    list(way.forward(data, mask, kept))
    grads = way.backward(data, mask, kept, goal)
    for name, at in (("h", (4, 1)), ("h", (7, 2)), ("b", (1, 0)), ("b", (8, 0)), ("x", (2, int(data[1, 0]))), ("x", (6, int(data[0, 2])))):
        keep = way.w[name][at]
        way.w[name][at] = keep + 1e-5
        up = loss()
        way.w[name][at] = keep - 1e-5
        down = loss()
        way.w[name][at] = keep
        assert abs((up - down) / 2e-5 - grads[name][at]) < 2e-2 * max(1, abs(grads[name][at]))


def test_rejecting_stage_and_clashing_columns(make_docs, rows):
    docs = make_docs(rows).withColumnRenamed("source", "lang_pred").withColumnRenamed("n_chars", "score")
    network = langid.train(docs)
    kept = langid.predict(docs, network, least_score=0.3)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect() if r["doc_id"] in (500, 501, 502)) == []


def test_nothing_to_learn_and_empty_table(make_docs):
    assert [r["lang_pred"] for r in langid.identify(make_docs([(1, "abc", None)])).collect()] == ["und"]
    assert langid.identify(make_docs([])).collect() == []


def test_numerals_that_are_no_letters_are_undetermined(make_docs, rows):
    signs = ["10 \u00bd", "\u00b2", "\u2460 \u2461", "\u2167.", "_ 7 \u00b9"]
    got = langid.predict(make_docs([(k, t, None) for k, t in enumerate([*signs, "x\u00bd", "\u00e9"])]), langid.train(make_docs(rows))).collect()
    assert [(r["lang_pred"], r["score"]) for r in sorted(got)[:5]] == [("und", 0.0)] * 5
    assert all(r["lang_pred"] in WORDS for r in sorted(got)[5:])


def test_bytes_that_are_no_text_end_no_job(spark):
    docs = spark.sql("SELECT 1L AS doc_id, cast(unhex('FFFE') AS string) AS text, 'en' AS lang UNION ALL SELECT 2L, cast(unhex('616263FF') AS string), 'en'")
    assert sorted((r["doc_id"], r["lang_pred"]) for r in langid.predict(docs, langid.Network(["en"])).collect()) == [(1, "und"), (2, "en")]
