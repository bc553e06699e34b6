import re

from lakestrata.llm import licenses


def brute(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(i, t.label) for t in licenses.TEMPLATES if t.base for i in range(len(words)) if words[i:i + len(t.words)] == t.words]
    return (len(words), len(places), min((p for p, _ in places), default=None), max((p for p, _ in places), default=None), ",".join(sorted({x for _, x in places})))


MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\")")
TEXTS = [None, "", " .,", "Released under the MIT License.", "under-the/mit_license", "under the mit licenses", "x under the mit license under the mit license",
         "Apache License, Version 2.0", "CC BY-NC 4.0; cc by nc cc by nc", "Mit der Lizenz mit mit mit license", "intro " + MIT, MIT.replace("hereby", "thereby"),
         "permission free charge hereby granted", "cc " * 3000 + "by nc", "été under the mit license", "under the mit\nlicense apache license version 2 cc by nc"]


def test_base_places_equal_brute_force(make_docs):
    got = {r["doc_id"]: r for r in licenses.scan(make_docs(list(enumerate(TEXTS)))).collect()}
    for k, text in enumerate(TEXTS):
        r = got[k]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(text), text
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1


def test_notices_are_found_at_their_place(make_docs):
    got = {r["doc_id"]: r for r in licenses.scan(make_docs(list(enumerate(TEXTS)))).collect()}
    assert got[10]["labels"] == "mit" and got[10]["score"] == 1.0 and got[10]["matches"][0]["start"] == 1 and got[10]["base_labels"] == ""
    assert got[11]["labels"] == ""  # its mandatory phrase is broken
    assert got[12]["labels"] == "" and got[0]["labels"] == "" and got[0]["score"] == 0.0


def test_repeated_rows_clashing_columns_and_empty_table(make_docs):
    docs = make_docs([(1, "cc by nc"), (1, "cc by nc"), (None, None)]).withColumnRenamed("lang", "words").withColumnRenamed("source", "templates")
    assert sorted((r["doc_id"] or 0, r["n_base"]) for r in licenses.scan(docs).collect()) == [(0, 0), (1, 1), (1, 1)]
    assert licenses.scan(make_docs([])).collect() == []
