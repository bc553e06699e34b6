import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

from lakestrata.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Library.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.tokenizer(PATH)


def ids_of(own, text):
    return np.frombuffer(b"".join(p[0] for p in own.pieces(text)), "<u4").tolist()


def test_ids_and_text_equal_the_library_on_random_strings(own, library):
    rnd = random.Random(7)
    alphabet = ("abcdefghinorstABÉÀßΣσςİIıſ'\"#<|>_-.,!0123٣²½ \t\n\x1c\x1f\x85\xa0   　​"
                "̧́漢字한글😀‍")
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(50))) for _ in range(4000)]
    names = list(library.get_vocab())
    texts += ["".join(rnd.choice(names).replace("</w>", "") for _ in range(3)) for _ in range(4000)]
    texts += ["a" * n for n in range(1, 40)] + ["aba" * n for n in range(1, 20)]
    texts += ["<|endoftext|>Hello <|startoftext|>World's<|endoftext|>", "they'll've 'sam DON'T 's"]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert ids_of(own, text) == want.ids, text
        assert " ".join(p[2] for p in own.pieces(text)) == library.decode(want.ids, skip_special_tokens=False), text


def test_encode_gives_digests_for_nulls_empty_and_long_texts(make_docs, prose, own, library):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "The Theatre's 12 acts"), (4, "The Theatre's 12 acts"), (None, "x"), (6, prose(1, 20_000))]
    docs = make_docs(rows).withColumnRenamed("source", "ids").withColumnRenamed("lang", "n_tokens")
    got = {(r["doc_id"], r["n_tokens"]): r for r in bpe.encode(docs, PATH).collect()}
    assert sum(1 for _ in bpe.encode(docs, PATH).collect()) == len(rows)
    for doc_id, text in rows:
        want = library.encode(text or "", add_special_tokens=False)
        r = got[doc_id, len(want.ids)]
        assert r["ids"] == want.ids
        assert r["ids_sha256"] == hashlib.sha256(np.array(want.ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(want.ids, skip_special_tokens=False).encode()).hexdigest()


def test_decode_restores_the_text_and_accepts_null(spark, make_docs, library):
    back = bpe.decode(bpe.encode(make_docs([(1, "A lazy dog, isn't it?"), (2, None)]), PATH), PATH)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {
        1: library.decode(library.encode("A lazy dog, isn't it?", add_special_tokens=False).ids, skip_special_tokens=False), 2: ""}
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bpe.decode(none, PATH).first()["text"] == ""


def test_empty_table(make_docs):
    assert bpe.encode(make_docs([]), PATH).collect() == []


def test_bytes_that_are_no_text_count_as_replacement_characters(spark):
    docs = spark.sql("SELECT 1L AS doc_id, cast(unhex('6162FF2063C3') AS string) AS text UNION ALL SELECT 2L, 'ab\ufffd c\ufffd'")
    got = [r["ids_sha256"] for r in bpe.encode(docs, PATH).collect()]
    assert len(got) == 2 and got[0] == got[1]


def test_every_code_point_is_cut_as_the_library_does(library, own):
    texts = [f"a{chr(c)}b {chr(c)}1" for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    wrong = []
    for text, ids in zip(texts, want):
        got = b"".join(p[0] for p in own.pieces(text))
        if np.frombuffer(got, "<u4").tolist() != ids:
            wrong.append(text)
    assert wrong == []
