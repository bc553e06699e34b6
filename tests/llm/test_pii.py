import re

import pytest
from pyspark.sql import functions as F

from lakestrata.llm import pii


def luhn(number):
    digits = [int(c) for c in reversed(number)]
    return sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits)) % 10 == 0


TEXTS = ["mail thhe.58@mail5.example.com, or THHE.58@MAIL5.EXAMPLE.COM.", "+1 (017) 555-7713 and +1 017 555 7713 at 152.143.123.131### 10.0.0.1",
         "card 4785380592391135 4111-1111-1111-1111 4111 1111 1111 1111 x", "ssn 123-45-6789", "Mr. Smith met Anna Smith, Mrs Berg-Olsen, John Smith; Г-жа Анна Иванова. Dr. Παπας",
         "nothing here", "", None, "v1.2.3.4.5 1999-12-31 24be64439e3e49cf46b2d7c90f3602a3d0b907ff", "a" * 50_000 + " x@y.org ", "x@y.org"]


@pytest.fixture(scope="module")
def out(spark, make_docs):
    docs = make_docs(list(enumerate(TEXTS)) + [(10, "x@y.org"), (None, "x@y.org")]).withColumnRenamed("lang", "found").withColumnRenamed("source", "tries")
    return pii.replace_entities(docs, "key one")


@pytest.fixture(scope="module")
def texts(out):
    return {r["doc_id"]: r["text"] for r in out.collect()}


def test_clean_texts_and_other_columns_stay(out, texts):
    assert [texts[k] for k in (5, 6, 7, 8)] == [TEXTS[k] for k in (5, 6, 7, 8)]
    assert out.columns == ["doc_id", "text", "found", "tries", "n_chars", "entities"] and out.count() == len(TEXTS) + 2


def test_formats_are_kept_and_no_original_is_left(texts):
    for text in ("thhe", "58@", "555-7713", "555 7713", "152.143", "10.0.0.1", "4785380592391135", "4111", "123-45", "Smith", "Berg", "Иванова", "x@y.org"):
        assert not any(text in (t or "") for t in texts.values()), text
    a, b = re.match(r"mail (\S+), or (\S+)\.$", texts[0]).groups()
    assert a.upper() == b and re.fullmatch(r"[a-z]{4}\.\d\d@m[0-9a-f]{8}\.example\.org", a)
    m = re.match(r"\+1 \((\d{3})\) (\d{3})-(\d{4}) and \+1 (\d{3}) (\d{3}) (\d{4}) at (\d+(?:\.\d+){3})### (\d+(?:\.\d+){3})$", texts[1])
    assert m.groups()[:3] == m.groups()[3:6] and all(int(o) < 256 for g in m.groups()[6:] for o in g.split("."))
    c = re.match(r"card (4\d{15}) (4\d{3}-\d{4}-\d{4}-\d{4}) (4\d{3} \d{4} \d{4} \d{4}) x$", texts[2])
    assert luhn(c[2].replace("-", "")) and c[2].replace("-", " ") == c[3] and luhn(c[1]) == luhn("4785380592391135")
    assert re.fullmatch(r"ssn \d{3}-\d{2}-\d{4}", texts[3])


def test_names_keep_title_script_gender_and_coreference(texts):
    m = re.match(r"Mr\. ([A-Z][a-z]+) met ([A-Z][a-z]+na) ([A-Z][a-z]+), Mrs ([A-Z][a-z]+), ([A-Z][a-z]+n) ([A-Z][a-z]+); Г-жа ([А-Я][а-я]+на) ([А-Я][а-я]+)\. Dr\. ([Α-Ω][α-ω]+)$", texts[4])
    assert m and m[1] == m[3] == m[6]


def test_one_entity_has_one_surrogate_in_all_texts_and_keys_differ(make_docs, texts):
    assert texts[9].split()[-1] == texts[10] == texts[None]
    other = pii.replace_entities(make_docs([(1, "x@y.org")]), "key two").first()["text"]
    assert other != texts[10]


def test_distinct_entities_stay_distinct_when_replacements_collide(make_docs, monkeypatch):
    monkeypatch.setattr(pii, "SYLLABLES", {k: (v[:2] * 16) for k, v in pii.SYLLABLES.items()})  # 16 words per attempt
    rows = [(k, f"Mr. N{chr(97 + k)}me and {chr(97 + k)}@x.org") for k in range(14)] * 2
    got = pii.replace_entities(make_docs(rows), "k").select("doc_id", F.explode("entities").alias("e")).select("doc_id", "e.kind", "e.replacement").distinct().collect()
    for kind in ("person", "email"):
        mine = [r["replacement"] for r in got if r["kind"] == kind]
        assert len(mine) == len(set(mine)) == 14


def test_surnames_keep_one_surrogate_and_all_are_placed_when_words_collide(make_docs, monkeypatch):
    monkeypatch.setattr(pii, "SYLLABLES", {k: (v[:2] * 16) for k, v in pii.SYLLABLES.items()})  # 16 words at first, for 40 surnames
    names = [f"N{chr(97 + k // 8)}m{chr(97 + k % 8)}" for k in range(40)]
    rows = [(k, f"Dr {n}, John {n}, Mary {n}") for k, n in enumerate(names)]
    got = pii.replace_entities(make_docs(rows), "k").select("doc_id", F.col("entities.replacement").alias("r")).collect()
    surnames = [{x.split()[-1] for x in r["r"]} for r in got]
    assert all(len(s) == 1 for s in surnames) and len(set.union(*surnames)) == 40
    assert len({r["r"][1].split()[0] for r in got}) == len({r["r"][2].split()[0] for r in got}) == 1


def test_no_surrogate_word_is_a_name_of_the_corpus(make_docs):
    first = pii.replace_entities(make_docs([(1, "Dr Smith")]), "k").first()["entities"][0]["replacement"]
    got = [e["replacement"] for r in pii.replace_entities(make_docs([(1, "Dr Smith"), (2, f"Mary {first[3:]}")]), "k").collect() for e in r["entities"]]
    assert not any(first[3:] in g for g in got) and got[0].startswith("Dr ")


def test_digit_permutation_is_one_to_one(spark):
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d")).select(pii.permuted(F.col("d"), "k", F.lit("t")).alias("p"))
    assert df.distinct().count() == 1000 and df.where("length(p) <> 3").count() == 0


def test_empty_table(make_docs):
    assert pii.replace_entities(make_docs([]), "k").collect() == []


def test_megabytes_of_every_repeated_unit_pass(make_docs):
    units = ["b.", "a@", "a@b.", "1", "1 ", "1-", "1.", "12 34 ", "+1 555 ", "+12 ", "(555) ", "555-1234 ", "a.b@c.", "Mr ", "Mr A", "Ab-", "Ab'", "%", "John ", "é", ".", "@", "-", "x"]
    rows = [(k, ("a@" if k % 2 else "") + unit * (1_000_000 // len(unit)) + " end x@y.org") for k, unit in enumerate(units)]
    rows += [(100 + k, "a@" + "b." * n + "org") for k, n in enumerate((1500, 3000, 500_000))]
    got = {r["doc_id"]: r["t"] for r in pii.replace_entities(make_docs(rows).repartition(len(rows)), "k").select("doc_id", F.substring("text", -100, 100).alias("t")).collect()}
    assert len(got) == len(rows) and not any("x@y.org" in t for t in got.values()) and all(t.endswith(".example.org") for t in got.values())


@pytest.mark.parametrize("text, found", [
    ("x@y.org.", ["x@y.org"]), ("x@y.org, a.b-c@d-e.f.museum!", ["x@y.org", "a.b-c@d-e.f.museum"]), ("x@y", []), ("x@y.c", []), ("x@y.c1", []), ("x@.org", []),
    ("x@y..org", []), ("x@y.com.1", ["x@y.com"]), ("@y.org", []), ("a@b@c.org", ["b@c.org"]), ("x@sub.y.org.uk", ["x@sub.y.org.uk"]), ("x@y.org2", ["x@y.org"])])
def test_addresses(spark, text, found):
    got = spark.createDataFrame([(text,)], "t string").select(pii.find(F.col("t")).alias("f")).first()["f"]
    assert [e["raw"] for e in got] == found


def test_gender_follows_the_title_of_names_that_no_list_has(make_docs):
    text = "Mr Alex Berg; Mrs Alex Berg; Dr Alex Berg; Frau Kim Olsen; Señor Kim Olsen; Г-жа Саша Белова; Г-н Саша Белов; Mrs Berg"
    names = [e["replacement"].split(" ") for e in pii.replace_entities(make_docs([(1, text)]), "k").first()["entities"]]
    given = [n[1] for n in names]
    assert given[0].endswith("n") and given[1] == given[0] + "a" and given[2].endswith("s") and given[2][:-1] == given[0][:-1]
    assert given[3] == given[4] + "a" and given[5] == given[6] + "а" and given[6].endswith("н")
    assert names[0][2] == names[1][2] == names[2][2] == names[7][1] and names[3][2] == names[4][2]


def brute_mentions(text):
    """E-mail addresses, dotted quads and social security numbers by hand-written scanning."""
    out, i = [], 0
    local = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
    for word in re.split(r"[ ,;!()]", text):
        name, at, host = word.partition("@")
        labels = host.rstrip(".").split(".")
        if at and name and set(name) <= local and len(labels) > 1 and all(re.fullmatch("[A-Za-z0-9-]+", x) for x in labels) and re.fullmatch("[A-Za-z]{2,}", labels[-1]):
            out.append(("email", word.rstrip(".").lower()))
        parts = word.rstrip(".").split(".")
        if len(parts) == 4 and all(p.isdigit() and int(p) < 256 and (p == "0" or p[0] != "0") for p in parts):
            out.append(("ip", ".".join(parts)))
        digits = word.rstrip(".").split("-")
        if [len(d) for d in digits] == [3, 2, 4] and all(d.isdigit() for d in digits):
            out.append(("ssn", "".join(digits)))
    return out


def test_detection_equals_a_hand_written_scan(spark):
    import random
    rnd = random.Random(3)
    pool = ["x@y.org", "a.b+c@d-e.co.uk", "10.0.0.1", "255.255.255.256", "1.2.3", "123-45-6789", "12-345-6789", "word", "no@dots", "A@B.COM.", "8.8.8.8.", "v1.2.3.4.5", "x@-.org", "0.0.0.0"]
    texts = [" ".join(rnd.choice(pool) + rnd.choice(["", "", ",", ";"]) for _ in range(12)) for _ in range(200)]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", pii.find(F.col("t")).alias("f")).collect()
    for r in got:
        assert [(e["kind"], e["norm"]) for e in r["f"]] == brute_mentions(texts[r["i"]]), texts[r["i"]]
