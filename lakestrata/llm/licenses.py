"""License scan by a positional index of rare words; DataFrame functions only.

The templates are word lists. Document frequencies of all their words are counted over the whole corpus, and each template is
indexed under its ``INDEXED`` rarest words with their positions (that table is as small as the list of templates). In a document, the
words that the index knows are looked up, rarest first; each posting proposes a start (place in the document minus place in the template).
A start survives if the other indexed words stand at their relative places too, enough of them to make ``VOTES``. Then the template's
mandatory key phrases are compared word by word, and the share of all template words at their places is the score.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. The three base phrases are templates of their own whose key phrase is
the whole phrase, so every place of them is found.

Defined results: null or wordless text has no words and no labels (empty strings, null places, score 0); every row is scanned for
itself, so repeated rows and identifiers need no rule; other columns do not matter. On an empty table all frequencies are 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import ascii_lower

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
INDEXED = 4
VOTES = 3
LEAST_SHARE = 0.6


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...]  # phrases that must stand in a match, at their places
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()


# The base phrases, and the opening sentences or notices by which public licences are known.
TEMPLATES = (
    Template("mit", "under the mit license", ("under the mit license",), base=True),
    Template("apache-2", "apache license version 2", ("apache license version 2",), base=True),
    Template("cc-by-nc", "cc by nc", ("cc by nc",), base=True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
             ("permission is hereby granted free of charge", "copy of this software")),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
             ("apache license", "except in compliance")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
             ("redistribution and use in source and binary forms", "conditions are met")),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
             ("free software", "gnu general public license")),
    Template("gpl-3", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("agpl", "under the terms of the gnu affero general public license", ("gnu affero general public license",)),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license", ("subject to the terms", "mozilla public license")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             ("permission to use copy modify", "with or without fee")),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software", "public domain")),
    Template("cc-by", "licensed under a creative commons attribution", ("creative commons attribution",)),
    Template("cc-by-nc", "creative commons attribution noncommercial", ("creative commons attribution noncommercial",)),
    Template("cc0", "dedicated to the public domain under cc0", ("public domain", "cc0")),
)


def place(phrase: list[str], words: list[str]) -> int:
    return next(i for i in range(len(words)) if words[i:i + len(phrase)] == phrase)


def strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def normal(text: Column) -> Column:
    """Lower-cased words with one space between."""
    return F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS, " "))


def word_list(norm: Column) -> Column:
    return F.when(norm == "", F.array().cast("array<string>")).otherwise(F.split(norm, " "))


def frequencies(docs: DataFrame, text_col: str, templates=TEMPLATES) -> dict[str, int]:
    """In how many documents each template word occurs; as many rows as the templates have words."""
    known = sorted({w for t in templates for w in t.words})
    present = F.array_intersect(strings(known), word_list(normal(F.col(text_col))))
    counted = docs.select(F.explode(present).alias("word")).groupBy("word").count().collect()
    return {w: 0 for w in known} | {r["word"]: r["count"] for r in counted}


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, indexed: int = INDEXED) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches`` for every row.

    ``matches`` lists label, start, number of words, share of the template and whether it is a base phrase. Counts frequencies when called.
    """
    df = frequencies(docs, text_col, templates)
    index: dict[str, list[tuple[int, int]]] = {}
    entries = []
    for k, t in enumerate(templates):
        rarest = sorted(set(t.words), key=lambda w: (df[w], w))[:indexed]
        entries.append([(w, t.words.index(w)) for w in rarest])
        index.setdefault(rarest[0], []).append((k, t.words.index(rarest[0])))
        for w in rarest[1:]:  # in place of the rarest, should a changed word stand there
            if not t.base:
                index.setdefault(w, []).append((k, t.words.index(w)))
    terms = sorted(index, key=lambda w: (df[w], w))  # rarest first

    def literal(t: Template, k: int) -> Column:
        keys = [F.struct(F.lit(place(p.split(), t.words)).alias("at"), strings(p.split()).alias("words")) for p in t.keys]
        return F.struct(F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), strings(t.words).alias("words"), F.array(*keys).alias("keys"),
                        F.array(*(F.struct(F.lit(w).alias("word"), F.lit(q).alias("at")) for w, q in entries[k])).alias("index"),
                        F.lit(min(VOTES, len(entries[k]))).alias("votes"))

    table = F.array(*(literal(t, k) for k, t in enumerate(templates)))
    postings = F.create_map(*(x for w in terms for x in (F.lit(w), F.array(*(F.struct(F.lit(k).alias("t"), F.lit(q).alias("at")) for k, q in index[w])))))
    words = F.col("words")

    spots = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("i"))), lambda s: F.array_contains(strings(terms), s["word"]))
    starts = F.array_distinct(F.flatten(F.transform(spots, lambda s: F.transform(
        F.element_at(postings, s["word"]), lambda p: F.struct(p["t"].alias("t"), (s["i"] - p["at"]).alias("start"))))))
    inside = F.filter(starts, lambda c: (c["start"] >= 0))

    def survives(c):
        t = F.get(F.col("templates"), c["t"])
        votes = F.size(F.filter(t["index"], lambda e: F.get(words, c["start"] + e["at"]) == e["word"]))
        keys = F.forall(t["keys"], lambda k: F.slice(words, c["start"] + k["at"] + 1, F.size(k["words"])) == k["words"])
        return (votes >= t["votes"]) & keys

    def described(c):
        t = F.get(F.col("templates"), c["t"])
        same = F.size(F.filter(F.transform(t["words"], lambda w, i: F.get(words, c["start"] + i) == w), lambda x: x))
        return F.struct(t["label"].alias("label"), c["start"].alias("start"), F.size(t["words"]).alias("n"),
                        (same / F.size(t["words"])).alias("share"), t["base"].alias("base"))

    kind = "array<struct<label:string,start:int,n:int,share:double,base:boolean>>"
    found = F.filter(F.transform(F.filter(inside, survives), described), lambda m: m["share"] >= LEAST_SHARE)
    matches = F.when(F.arrays_overlap(words, strings(terms)), found.cast(kind)).otherwise(F.array().cast(kind))
    base = F.transform(F.filter("matches", lambda m: m["base"]), lambda m: m["start"])

    def label_list(which):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(which, lambda m: m["label"]))), ",")

    return (docs.select(F.col(id_col).alias("doc_id"), normal(F.col(text_col)).alias("norm"), table.alias("templates"))
            .select("doc_id", word_list(F.col("norm")).alias("words"), "templates")
            .select("doc_id", F.size("words").cast("long").alias("n_words"), matches.alias("matches"))
            .select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(base).cast("long").alias("first_word"),
                    F.array_max(base).cast("long").alias("last_word"), label_list(F.filter("matches", lambda m: m["base"])).alias("base_labels"),
                    label_list(F.col("matches")).alias("labels"),
                    F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)).alias("score"), "matches"))
