"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm import bpe, chat, decontam, exactdup, langid, licenses, lm, neardup, periodic, pii, resample, secrets, simhash
from lakestrata.llm.common import prepare, table
from lakestrata.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(prepare(configure(spark)), sf_dir)
        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        if sql:
            SQL[name] = sql.strip()
        return build
    return register


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op1_bpe")
def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), ids=False)


SURROGATE_KEY = "corpus-surrogates-1"  # of the registered query only; callers bring their own


@query("op2_pii")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates in place of personal data."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pii.replace_entities(docs, SURROGATE_KEY)

    def n(kind):
        return F.size(F.filter("entities", lambda e: e["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", F.size("entities").cast("long").alias("n_entities"), *map(n, pii.KINDS), "text")


@query("op3_near_dedup")
def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its group of near duplicates."""
    return neardup.near_groups(table(spark, sf_dir, "documents"), words=4, percent=80)


@query("op4_licenses")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices in every document."""
    return licenses.scan(table(spark, sf_dir, "documents")).drop("matches")


@query("op5_secrets")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets.scan(table(spark, sf_dir, "documents"))


@query("op6_langid")
def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op7_lm_score")
def lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document."""
    return lm.score_corpus(table(spark, sf_dir, "documents"), langid.fold("doc_id", 7) != 2)


@query("op8_exact_dedup", f"""
    WITH t AS (SELECT doc_id, sha256({LOWER}) AS text_sha256 FROM documents),
    g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)""")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row of its group that stays."""
    return exactdup.exact_groups(table(spark, sf_dir, "documents"), keep="largest")


@query("op9_decontamination")
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def escaped_sql(column: str) -> str:
    text = f"replace({column}, '~', '~0')"
    for k, control in enumerate(chat.CONTROL, 1):
        text = f"replace({text}, '{control}', '~{k}')"
    return text


@query("op10_chat_format", f"""
    WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
    g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
                 coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS learned,
                 sum(length('<s>[INST][/INST]</s>') + length({escaped_sql('role')}) + length({escaped_sql('text')})) AS formatted_chars
          FROM r GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
           CAST(formatted_chars AS BIGINT) AS formatted_chars FROM g""")
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, and read back from the output."""
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], said.schema)
    turns = said.unionAll(probe).withColumn("parts", chat.text_part(F.col("text")))
    return chat.digests(chat.format_chats(turns))


@query("chat_parts", f"""
    WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n,
                      ['image', 'audio', 'document'][1 + turn % 3] AS kind FROM conversations),
    p AS (SELECT *, text || '<' || kind || '>' AS content, CASE kind WHEN 'image' THEN ceil((turn + 20) / 14.0) * ceil(length(text) / 14.0)
                 WHEN 'audio' THEN length(text) * 25 ELSE (turn + 1) * 512 END AS tokens FROM r)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || content || chr(10), '' ORDER BY n)) AS turns_sha256,
           CAST(sum(length('<s>[INST][/INST]</s>') + length({escaped_sql('role')}) + length({escaped_sql('text')}) + length(kind) + 2) AS BIGINT) AS formatted_chars,
           CAST(sum(greatest(1, tokens)) AS BIGINT) AS attachment_tokens, sha256(string_agg(kind || ':' || turn || ';', '' ORDER BY n)) AS refs_sha256
    FROM p GROUP BY conv_id""")
def chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations with their texts cut into two parts and an image, a sound or a document after them."""
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    half, size = F.floor(F.length("text") / 2).cast("int"), F.length("text").cast("int")
    kind = F.element_at(F.array(*map(F.lit, ("image", "audio", "document"))), (F.col("turn") % 3 + 1).cast("int"))

    def part(kind, text=None, **values):
        rest = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
        return F.struct(kind.alias("type"), F.lit(text).cast("string").alias("text"), *(F.lit(values.get(n)).cast(t).alias(n) for n, t in rest.items()))
    attached = part(kind, ref=F.concat(kind, F.lit(":"), F.col("turn"), F.lit(";")), width=F.col("turn") + 20, height=size, seconds=size, pages=F.col("turn") + 1)
    parts = F.array(part(F.lit("text"), F.substr("text", F.lit(1), half)), part(F.lit("text"), F.substr("text", half + 1, size)), attached)
    chats = chat.format_chats(said.withColumn("parts", parts))
    turns = F.transform(chat.read_back(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    refs = F.array_join(F.transform("attachments", lambda a: a["ref"]), "")
    return chats.select("conv_id", "n_turns", F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
                        "attachment_tokens", F.sha2(refs, 256).alias("refs_sha256"))


@query("op11_simhash")
def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its SimHash fingerprint and group."""
    found = simhash.near_groups(table(spark, sf_dir, "documents"), words=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "kept")


@query("op12_resample")
def importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its weight towards the benchmark, its score, and its rank if drawn."""
    return resample.importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def repeat_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """One document in ten goes on from some place by repeating the words from there: what the query's contract plants."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


@query("op13_periodic_runs")
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, and the text without their repetitions, as digests."""
    return periodic.digests(periodic.periodic_runs(table(spark, sf_dir, "documents"), change=repeat_tail))
