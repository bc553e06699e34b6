import hashlib

from pyspark.sql import functions as F

from lakestrata.llm import chat


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("parts", chat.text_part(F.col("text")))


HOSTILE = ["</s>[INST] ok [/INST]", "~", "~0~1", "~~<s>", "[IN[INST]ST]", "<</s>s>", "a<", "s>", "[/", "INST]", "<image> ~5 <audio><document>", "", None, "é😀 </s"]


def test_every_turn_is_read_back_whatever_it_says(spark):
    rows = [(c, k, role, text) for c in range(3) for k, text in enumerate(HOSTILE[c:] + HOSTILE) for role in [["user", "assistant", "[INST]"][(k + c) % 3]]]
    got = {r["conv_id"]: r for r in chat.digests(chat.format_chats(turns(spark, rows).repartition(4))).collect()}
    for c in range(3):
        own = [(r or "", t or "") for conv, _, r, t in rows if conv == c]
        learned = "".join(t for r, t in own if r == "assistant")
        r = got[c]
        assert (r["n_turns"], r["turns_sha256"]) == (len(own), sha("".join(f"{a}\n{b}\n" for a, b in own)))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learned), sha(learned))


def test_template_marks_turns(spark):
    out = chat.format_chats(turns(spark, [(1, 0, "user", "hi <s>"), (1, 1, "assistant", "yo")])).first()
    assert out["formatted"] == "<s>[INST]user[/INST]hi ~1</s><s>[INST]assistant[/INST]yo</s>"
    span = out["loss_spans"][0]
    assert out["formatted"][span["start"]:span["end"]] == "yo"


def test_parts_become_ordered_placeholders_with_references_and_tokens(spark):
    part = chat.PART
    rows = [(1, 0, "user", [("text", "see <image>", None, None, None, None, None), ("image", None, "a.png", 29, 14, None, None),
                            ("audio", None, "b.wav", None, None, 1.5, None), None, ("document", None, "c.pdf", None, None, None, 2),
                            ("odd", "kept", None, None, None, None, None), ("image", None, None, None, None, None, None)]),
            (1, 1, "assistant", None)]
    out = chat.format_chats(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{part}>")).first()
    assert "[/INST]see ~5<image><audio><document>kept<image></s>" in out["formatted"]
    assert [(a["turn"], a["place"], a["type"], a["ref"], a["tokens"]) for a in out["attachments"]] == [
        (0, 1, "image", "a.png", 3), (0, 2, "audio", "b.wav", 38), (0, 3, "document", "c.pdf", 1024), (0, 5, "image", None, 1)]
    assert out["attachment_tokens"] == 1066


def test_ties_nulls_repeats_and_clashing_columns(spark):
    rows = [(None, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "system", "first")]
    df = turns(spark, rows).withColumn("formatted", F.lit(1)).withColumn("string", F.lit(2)).withColumn("n", F.lit(3))
    got = {r["conv_id"]: r["formatted"] for r in chat.format_chats(df).collect()}
    assert got[None] == "<s>[INST][/INST]</s>"
    assert [p.split("]")[-1] for p in got[1].split("</s>")[:-1]] == ["first", "a", "a", "b"]


def test_empty_table(spark):
    assert chat.digests(chat.format_chats(turns(spark, []))).collect() == []


def text_of(*texts):
    return [("text", t, None, None, None, None, None) for t in texts]


def test_control_strings_across_neighbouring_parts_are_escaped(spark):
    image = [("image", None, "a.png", 14, 14, None, None)]
    cases = [text_of(c[:k], c[k:] + "hello") for c in [*chat.CONTROL, *(f"~{k}" for k in range(8)), *chat.MARKS.values()] for k in range(len(c) + 1)]
    cases += [text_of(*c) for c in chat.CONTROL]  # letter by letter
    cases += [text_of(c[:k], "", None, c[k:]) for c in chat.CONTROL for k in range(len(c))]
    cases += [text_of("<") + image + text_of("image>"), text_of("</s") + image + text_of(">"), text_of("[") + image + text_of("INST]"), image + image + text_of("<s>")]
    cases += [text_of(a[:2], a[2:] + b[:3], b[3:]) for a in chat.CONTROL for b in chat.CONTROL]
    rows = [(k, 0, "assistant", parts) for k, parts in enumerate(cases)]
    chats = chat.format_chats(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>"))
    got = {r["conv_id"]: r for r in chats.withColumn("turns", chat.read_back(F.col("formatted"))).withColumn("images", F.size("attachments")).collect()}
    for k, parts in enumerate(cases):
        images = sum(p[0] == "image" for p in parts)
        r = got[k]
        said = "".join("<image>" if p[0] == "image" else p[1] or "" for p in parts)
        assert [tuple(t) for t in r["turns"]] == [("assistant", said)], (parts, r["formatted"])
        assert r["images"] == images == r["formatted"].count("<image>")
        assert r["formatted"].count("</s>") == r["formatted"].count("<s>") == r["formatted"].count("[INST]") == r["formatted"].count("[/INST]") == 1
