"""Language-model scores by deleted interpolation.

P(w | h) mixes three estimates: the share of w after h, the share of w among all tokens, and 1 / (V + 1). The weights depend on how
often h was seen (a bucket for each power of two) and are learned by expectation-maximisation on held-out counts: every training token is
predicted from the counts without itself. h is the word before, or the start of the text; a text ends with an end token.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. All counts cover the whole corpus, so no table of them travels to all tasks:

1. Texts are packed into blocks of a few MB, written once, so that a block means the same rows in every pass.
2. A block asks for the corpus counts of its distinct tokens and pairs. The 64-bit keys are split by value into buckets, whose number
   follows the corpus, and each block brings its own counts along: one row for each bucket that it asks, so never more rows than it has keys.
3. A bucket adds up what the blocks bring and answers each of them in the order it asked. A frequent pair is one entry of a block, however
   many documents hold it, so no key is hot.
4. The answers return to their block, which is written again with them and with a histogram of the deleted estimates of its training
   tokens (cells of half a power of two). The summed histogram is all that the driver learns the weights from.
5. Each block scores its documents.

Defined results: null and empty texts are one end token; rows without identifier belong to fold 0; every row counts and is scored for itself,
so repeated rows count repeatedly. Without training tokens the estimate is 1 / (V + 1) = 1 throughout. Other columns do not matter.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import WordHashes, hash64, mix, prepare, texts
from lakestrata.session import materialize

PACK_BYTES = 4 << 20      # text of a block
BUCKET_BYTES = 8 << 20    # text for each bucket of keys
END, START = np.uint64(hash64(b" end")), np.uint64(hash64(b" start"))  # no word holds a space
PAIR = np.uint64(0x9E3779B97F4A7C15)
CONTEXT_BUCKETS = 16
CELLS = 128               # of the histogram, for each of two estimates: 0, and half a power of two each
EM_ROUNDS = 60


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, trained, text) as blocks."""
    ids, trained, held, size = [], [], [], 0

    def block():
        body = zstandard.ZstdCompressor(level=3).compress(b"".join(held))
        return pa.record_batch({
            "block": pa.array([int.from_bytes(os.urandom(8), "little") >> 1], pa.int64()), "ids": pa.array([ids], pa.list_(pa.int64())),
            "trained": pa.array([trained], pa.list_(pa.bool_())), "sizes": pa.array([[len(t) for t in held]], pa.list_(pa.int64())),
            "bytes": pa.array([size], pa.int64()), "body": pa.array([body], pa.binary())})

    for batch in batches:
        for doc_id, train, text in zip(batch.column("id").to_pylist(), batch.column("trained").to_pylist(), texts(batch, "text")):
            ids.append(doc_id)
            trained.append(bool(train))
            held.append(text)
            size += len(text)
            if size >= PACK_BYTES:
                yield block()
                ids, trained, held, size = [], [], [], 0
    if ids:
        yield block()


class Tokens:
    """The tokens of a block: keys of its distinct tokens and pairs, and the place of each token among them."""

    def __init__(self, body: bytes, sizes: list[int], trained: list[bool], known: WordHashes):
        raw = memoryview(zstandard.ZstdDecompressor().decompress(body))
        hashes, counts, at = [], [], 0
        for size in sizes:
            words = bytes(raw[at:at + size]).lower().split()
            at += size
            counts.append(len(words))
            hashes.append(known.of(words))
        self.lengths = np.array(counts, np.int64) + 1
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        token = np.full(int(self.lengths.sum()), END, np.uint64)
        inner = np.ones(len(token), bool)
        inner[self.starts + self.lengths - 1] = False
        token[inner] = np.concatenate(hashes)
        context = np.empty_like(token)
        context[1:] = token[:-1]
        context[self.starts] = START
        self.trained = np.repeat(np.array(trained, bool), self.lengths)
        self.single, self.of_single = np.unique(token, return_inverse=True)
        self.pair, self.of_pair = np.unique(mix(context * PAIR + token), return_inverse=True)

    def own_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """How often each token and pair occurs in the training rows of this block."""
        return (np.bincount(self.of_single, self.trained, len(self.single)).astype("<u4"),
                np.bincount(self.of_pair, self.trained, len(self.pair)).astype("<u4"))

    def spread(self, single: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Corpus counts of each token, its pair and its context, from those of the distinct ones."""
        token = single[self.of_single]
        context = np.empty_like(token)
        context[1:] = token[:-1]
        context[self.starts] = token[self.starts + self.lengths - 1]  # a text starts as often as one ends
        return token, pair[self.of_pair], context


def edges(buckets: int) -> np.ndarray:
    """The smallest key of each bucket."""
    return np.array([-(-(b << 64) // buckets) for b in range(buckets)], np.uint64)


def packed(keys: np.ndarray) -> bytes:
    """Sorted keys as the steps between them, byte by byte over all steps: the upper bytes of small steps are zeros, which compress."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, len(data) // 8).T).view("<u8").reshape(-1)
    return np.cumsum(steps, dtype=np.uint64)


def requests(buckets: int):
    bounds = edges(buckets)

    def run(batches):
        known = WordHashes()
        for batch in batches:
            for row in batch.to_pylist():
                tokens = Tokens(row["body"], row["sizes"], row["trained"], known)
                single_n, pair_n = tokens.own_counts()
                single_at, pair_at = (np.searchsorted(bounds, keys, side="right") - 1 for keys in (tokens.single, tokens.pair))
                asked = np.union1d(single_at, pair_at)
                cut, pair_cut = ([slice(a, b) for a, b in zip(np.searchsorted(own, asked), np.searchsorted(own, asked, side="right"))]
                                 for own in (single_at, pair_at))
                yield pa.record_batch({
                    "bucket": pa.array(asked), "block": pa.array(np.full(len(asked), row["block"])),
                    "single": pa.array([tokens.single[c].tobytes() for c in cut], pa.binary()),
                    "single_n": pa.array([single_n[c].tobytes() for c in cut], pa.binary()),
                    "pair": pa.array([packed(tokens.pair[c]) for c in pair_cut], pa.binary()),
                    "pair_n": pa.array([pair_n[c].tobytes() for c in pair_cut], pa.binary())})
    return run


def summed(keys: list[np.ndarray], counts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The total of each key, in the order of each list, and the totals of the distinct keys."""
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, np.frombuffer(b"".join(counts), "<u4"), len(distinct)).astype("<u8")
    ends = np.cumsum([len(k) for k in keys])[:-1]
    return [p.tobytes() for p in np.split(total[place], ends)], total


def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up each bucket; its rows come one after the other."""
    held: list[dict] = []

    def bucket():
        single, total = summed([np.frombuffer(r["single"], "<u8") for r in held], [r["single_n"] for r in held])
        pair, _ = summed([unpacked(r["pair"]) for r in held], [r["pair_n"] for r in held])
        rest = [0] * (len(held) - 1)
        return pa.record_batch({
            "block": pa.array([r["block"] for r in held], pa.int64()), "bucket": pa.array([r["bucket"] for r in held], pa.int64()),
            "single_n": pa.array(single, pa.binary()), "pair_n": pa.array(pair, pa.binary()),
            "tokens": pa.array([int(total.sum()), *rest], pa.int64()), "distinct": pa.array([int((total > 0).sum()), *rest], pa.int64())})

    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["bucket"] != row["bucket"]:
                yield bucket()
                held = []
            held.append(row)
    if held:
        yield bucket()


def context_bucket(seen: np.ndarray) -> np.ndarray:
    return np.where(seen > 0, np.minimum(CONTEXT_BUCKETS - 1, 1 + np.floor(np.log2(np.maximum(seen, 1)))), 0).astype(np.int64)


def cell(share: np.ndarray) -> np.ndarray:
    """0 for nothing, else half powers of two downwards from 1."""
    return np.where(share > 0, 1 + np.minimum(CELLS - 2, np.floor(-2 * np.log2(np.where(share > 0, share, 1)))), 0).astype(np.int64)


def ratio(a: np.ndarray, b) -> np.ndarray:
    b = np.broadcast_to(b, a.shape)
    return np.divide(a, b, out=np.zeros(len(a)), where=b > 0)


def histogram(token, pair, context, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of (context bucket, pair share, token share) of training tokens, each predicted without itself, and their counts."""
    token, pair, context = (x.astype(np.float64) - 1 for x in (token, pair, context))
    code = (context_bucket(context) * CELLS + cell(ratio(pair, context))) * CELLS + cell(ratio(token, total - 1))
    return np.unique(code, return_counts=True)


def learn_weights(codes: np.ndarray, counts: np.ndarray, distinct: int) -> np.ndarray:
    """A row of three weights for each context bucket."""
    weights = np.tile([0.3, 0.6, 0.1], (CONTEXT_BUCKETS, 1))
    middle = np.concatenate(([0.0], 2.0 ** -((np.arange(CELLS - 1) + 0.5) / 2)))
    parts = np.stack([middle[codes // CELLS % CELLS], middle[codes % CELLS], np.full(len(codes), 1 / (distinct + 1))], axis=1)
    which = codes // (CELLS * CELLS)
    for b in np.unique(which):
        own, n = parts[which == b], counts[which == b].astype(np.float64)
        for _ in range(EM_ROUNDS):
            share = own * weights[b]
            share /= share.sum(axis=1, keepdims=True)
            weights[b] = np.maximum((share * n[:, None]).sum(axis=0) / n.sum(), 1e-9)
            weights[b] /= weights[b].sum()
    weights[0] = [0, *(weights[0][1:] / weights[0][1:].sum())]  # nothing was seen after an unseen context
    return weights


def score_corpus(docs: DataFrame, trained: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row; counts from rows where ``trained``.

    Passes 1 to 4 run when called and write to the work folder; pass 5 is the returned DataFrame.
    """
    spark = prepare(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(trained, F.lit(False)).alias("trained"),
                         F.col(text_col).cast("binary").alias("text"))
    blocks = materialize(narrow.mapInArrow(pack, "block long, ids array<long>, trained array<boolean>, sizes array<long>, bytes long, body binary"),
                         "blocks")
    size = blocks.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    asked = blocks.select("block", "trained", "sizes", "body").mapInArrow(
        requests(buckets), "bucket long, block long, single binary, single_n binary, pair binary, pair_n binary")
    replies = materialize(asked.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(
        answers, "block long, bucket long, single_n binary, pair_n binary, tokens long, distinct long"), "answers")
    total, distinct = (int(x or 0) for x in replies.agg(F.sum("tokens"), F.sum("distinct")).first())

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        back = sorted(right.to_pylist(), key=lambda r: r["bucket"])
        single, pair = (np.frombuffer(b"".join([r[c] for r in back]), "<u8") for c in ("single_n", "pair_n"))
        tokens = Tokens(row["body"], row["sizes"], row["trained"], WordHashes())
        codes, counts = histogram(*(x[tokens.trained] for x in tokens.spread(single, pair)), total)
        press = zstandard.ZstdCompressor(level=1).compress
        return pa.table({"ids": pa.array([row["ids"]], pa.list_(pa.int64())), "trained": pa.array([row["trained"]], pa.list_(pa.bool_())),
                         "sizes": pa.array([row["sizes"]], pa.list_(pa.int64())), "body": pa.array([row["body"]], pa.binary()),
                         "single_n": pa.array([press(single.tobytes())], pa.binary()), "pair_n": pa.array([press(pair.tobytes())], pa.binary()),
                         "codes": pa.array([codes], pa.list_(pa.int64())), "counts": pa.array([counts], pa.list_(pa.int64()))})

    known = materialize(blocks.drop("bytes").groupBy("block").cogroup(replies.drop("tokens", "distinct").groupBy("block")).applyInArrow(
        meet, "ids array<long>, trained array<boolean>, sizes array<long>, body binary, single_n binary, pair_n binary, codes array<long>, "
              "counts array<long>"), "counted-blocks")
    cells = (known.select(F.explode(F.arrays_zip("codes", "counts")).alias("c")).groupBy("c.codes").agg(F.sum("c.counts").alias("n")).collect())
    weights = learn_weights(np.array([c[0] for c in cells], np.int64), np.array([c[1] for c in cells], np.int64), distinct)

    def score(batches):
        hashes = WordHashes()
        for batch in batches:
            for row in batch.to_pylist():
                tokens = Tokens(row["body"], row["sizes"], row["trained"], hashes)
                single, pair = (np.frombuffer(zstandard.ZstdDecompressor().decompress(row[c]), "<u8") for c in ("single_n", "pair_n"))
                token, pair, context = (x.astype(np.float64) for x in tokens.spread(single, pair))
                w = weights[context_bucket(context)]
                mixed = w[:, 0] * ratio(pair, context) + w[:, 1] * ratio(token, total) + w[:, 2] / (distinct + 1)

                def per_text(x):
                    return np.add.reduceat(x, tokens.starts)

                yield pa.record_batch({
                    "doc_id": pa.array(row["ids"], pa.int64()), "held_out": pa.array([not t for t in row["trained"]], pa.bool_()),
                    "n_tokens": pa.array(tokens.lengths), "n_known": pa.array(per_text((token > 0).astype(np.int64))),
                    "train_tokens": pa.array(np.full(len(tokens.lengths), total, np.int64)),
                    "base_score": pa.array(per_text(np.log10((token + 1) / (total + distinct + 1)))),
                    "score": pa.array(per_text(np.log10(mixed)))})

    return known.select("ids", "trained", "sizes", "body", "single_n", "pair_n").mapInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
