"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained here, in numpy, by backpropagation through time, on a bounded sample: ``per_language`` pieces of
``STEPS`` bytes for each language, drawn by a hash of identifier and text and cut from any place of a text. Prediction reads whole texts: they are
cut into segments of ``STEPS`` bytes which run through the network side by side, one direction each way. Every position gets a
probability of each language; a document's score is their mean over all its positions.

Defined results: bytes that are no UTF-8 count as U+FFFD; ``und`` with score 0 for null texts, texts without a letter, and if nothing could be learned; ties go to the
language first in order. Rows are predicted one by one, so repeated rows and identifiers need no rule (a repeated row counts once
in the sample). Language, source and identifier never enter a prediction.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import blocks, prepare, texts

STEPS = 128            # bytes of a segment
HIDDEN = 8            # units of each direction
PER_LANGUAGE = 400     # training pieces of a language
MAX_LANGUAGES = 1000
ROUNDS, BATCH, RATE = 260, 160, 0.02
SIDE_BY_SIDE = 2048    # segments that run together


class Direction:
    """One gated recurrent layer. Columns are sequences; rows are the update, reset and candidate gates, one below the other."""

    def __init__(self, hidden: int, rng: np.random.Generator):
        self.w = {"x": rng.normal(0, 0.3, (3 * hidden, 256)), "h": rng.normal(0, 0.4 / np.sqrt(hidden), (3 * hidden, hidden)),
                  "b": np.zeros((3 * hidden, 1))}
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}
        self.hidden = hidden

    def forward(self, data: np.ndarray, mask: np.ndarray, keep: list | None = None):
        """Yields the state after each step; with ``keep`` also stores what the way back needs."""
        n = self.hidden
        x, h_w = self.w["x"] + self.w["b"], self.w["h"]
        state = np.zeros((n, data.shape[1]), np.float32)
        for step in range(len(data)):
            from_x, from_h = np.take(x, data[step], axis=1), h_w @ state
            gates = from_x[:2 * n] + from_h[:2 * n]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            update, reset = gates[:n], gates[n:]
            candidate = np.tanh(from_x[2 * n:] + reset * from_h[2 * n:])
            before = state
            state = (candidate + update * (before - candidate)) * mask[step]
            if keep is not None:
                keep.append((update, reset, candidate, before, from_h[2 * n:]))
            yield state

    def backward(self, data: np.ndarray, mask: np.ndarray, keep: list, d_states: np.ndarray) -> dict[str, np.ndarray]:
        n = self.hidden
        grad = {k: np.zeros_like(v) for k, v in self.w.items()}
        d_next = np.zeros_like(keep[0][0])
        for step in range(len(data) - 1, -1, -1):
            update, reset, candidate, before, rest = keep[step]
            d = (d_states[step] + d_next) * mask[step]
            d_candidate = d * (1 - update) * (1 - candidate * candidate)
            d_update = d * (before - candidate) * update * (1 - update)
            d_reset = d_candidate * rest * reset * (1 - reset)
            to_x = np.concatenate([d_update, d_reset, d_candidate])
            to_h = np.concatenate([d_update, d_reset, d_candidate * reset])
            grad["h"] += to_h @ before.T
            grad["b"] += to_x.sum(axis=1, keepdims=True)
            np.add.at(grad["x"].T, data[step], to_x.T)
            d_next = d * update + self.w["h"].T @ to_h
        return grad


class Network:
    """Both directions and the probabilities they give each position."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.ways = [Direction(hidden, rng), Direction(hidden, rng)]
        self.out = rng.normal(0, 0.3, (len(languages), 2 * hidden)).astype(np.float32)
        self.bias = np.zeros((len(languages), 1), np.float32)

    def segments(self, documents: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes and mask as (step, segment), and the document of each segment."""
        sizes = np.array([len(d) for d in documents], np.int64)
        counts = -(-sizes // STEPS)
        total = int(counts.sum())
        data, mask = np.zeros((total, STEPS), np.uint8), np.zeros((total, STEPS), np.float32)
        at = 0
        for d, c in zip(documents, counts.tolist()):
            if c:
                data[at:at + c].reshape(-1)[:len(d)] = np.frombuffer(d, np.uint8)
                mask[at:at + c].reshape(-1)[:len(d)] = 1
                at += c
        return data.T, mask.T, np.repeat(np.arange(len(documents)), counts)

    def positions(self, data: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Probabilities as (step, language, segment)."""
        n = self.ways[0].hidden
        scores = np.empty((len(data), len(self.languages), data.shape[1]), np.float32)
        for step, state in enumerate(self.ways[0].forward(data, mask)):
            scores[step] = self.out[:, :n] @ state + self.bias
        for step, state in enumerate(self.ways[1].forward(data[::-1], mask[::-1])):
            scores[len(data) - 1 - step] += self.out[:, n:] @ state
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores

    def pooled(self, documents: list[bytes]) -> np.ndarray:
        """Mean probability of each language over all positions of each document; zeros for an empty one."""
        total = np.zeros((len(documents), len(self.languages)))
        data, mask, owner = self.segments(documents)
        for at in range(0, len(owner), SIDE_BY_SIDE):
            part = slice(at, at + SIDE_BY_SIDE)
            x, m = np.ascontiguousarray(data[:, part]), np.ascontiguousarray(mask[:, part])
            np.add.at(total, owner[part], np.einsum("tls,ts->sl", self.positions(x, m), m).astype(np.float64))
        return total / np.maximum(1, np.array([len(d) for d in documents]))[:, None]

    def label_positions(self, text: bytes) -> list[str]:
        """The most probable language of every byte."""
        if not text:
            return []
        data, mask, _ = self.segments([text])
        best = self.positions(np.ascontiguousarray(data), np.ascontiguousarray(mask)).argmax(axis=1)
        return [self.languages[k] for k in best.T.reshape(-1)[:len(text)]]

    def train(self, pieces: list[bytes], labels: np.ndarray, rounds: int = ROUNDS, batch: int = BATCH, rate: float = RATE, seed: int = 5) -> None:
        """Cross entropy of every position, gradients through time, Adam steps of falling size."""
        rng = np.random.default_rng(seed)
        n = self.ways[0].hidden
        weights = [*(w for way in self.ways for w in way.w.values()), self.out, self.bias]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        for step in range(1, rounds + 1):
            chosen = rng.choice(len(pieces), min(batch, len(pieces)), replace=False)
            data, mask, owner = self.segments([pieces[i][:STEPS] for i in chosen])
            data, mask, truth = np.ascontiguousarray(data), np.ascontiguousarray(mask), labels[chosen][owner]
            kept = [[], []]
            states = [np.stack(list(self.ways[0].forward(data, mask, kept[0]))), np.stack(list(self.ways[1].forward(data[::-1], mask[::-1], kept[1])))[::-1]]
            both = np.concatenate(states, axis=1)
            scores = np.einsum("lh,ths->tls", self.out, both) + self.bias
            scores -= scores.max(axis=1, keepdims=True)
            share = np.exp(scores)
            share /= share.sum(axis=1, keepdims=True)
            share[:, truth, np.arange(len(truth))] -= 1
            share *= mask[:, None, :] / mask.sum()
            d_both = np.einsum("lh,tls->ths", self.out, share)
            grads = [*self.ways[0].backward(data, mask, kept[0], d_both[:, :n]).values(),
                     *self.ways[1].backward(data[::-1], mask[::-1], kept[1], d_both[::-1, n:]).values(),
                     np.einsum("tls,ths->lh", share, both), share.sum(axis=(0, 2))[:, None]]
            size = np.sqrt(sum(float((g * g).sum()) for g in grads))
            pace = rate * min(1.0, 1 / max(size, 1e-9)) if size > 1 else rate
            pace *= 0.5 * (1 + np.cos(np.pi * step / rounds)) + 0.02
            for w, g, a, b in zip(weights, grads, first, second):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                w -= pace * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int) -> tuple[list[str], list[bytes], np.ndarray]:
    """Languages, and about ``per_language`` pieces of each (never more); all that training reads comes to the driver here."""
    usable = docs.where(F.col(lang_col).isNotNull() & (F.length(F.col(text_col)) > 0))
    counts = {r[0]: r[1] for r in usable.groupBy(F.col(lang_col).cast("string").alias("lang")).count().limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return [], [], np.zeros(0, np.int64)
    chance = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 2 * per_language / n))))
    lot, size = F.xxhash64(F.col(id_col), F.col(text_col)), F.length(text_col)
    start = F.pmod(F.xxhash64(F.lit(3), F.col(id_col), F.col(text_col)), F.greatest(F.lit(1), size - STEPS + 1)).cast("int") + 1
    drawn = (usable.select(F.col(lang_col).cast("string").alias("lang"), lot.alias("lot"), F.substring(F.col(text_col), start, STEPS).alias("piece"))
             .where((F.pmod("lot", F.lit(1_000_003)) / 1_000_003) < F.element_at(chance, F.col("lang"))).distinct()
             .limit(4 * per_language * len(counts)).collect())
    languages, pieces, labels = sorted(counts), [], []
    for k, lang in enumerate(languages):
        own = sorted((r["lot"], r["piece"].encode()) for r in drawn if r["lang"] == lang)[:per_language]
        pieces += [p for _, p in own]
        labels += [k] * len(own)
    return languages, pieces, np.array(labels, np.int64)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Network | None:
    """A network for the languages of ``docs``, or None if it has none."""
    languages, pieces, labels = sample(docs, id_col, text_col, lang_col, per_language)
    if not pieces:
        return None
    network = Network(languages)
    network.train(pieces, labels)
    return network


def predict(docs: DataFrame, network: Network | None, text_col: str = "text", keep: list[str] | None = None,
            least_score: float | None = None) -> DataFrame:
    """The columns ``keep`` of every row with ``lang_pred`` and ``score``; with ``least_score`` instead the full rows that reach it."""
    spark = prepare(docs.sparkSession)
    sent = spark.sparkContext.broadcast(network)
    kept = docs.columns if least_score is not None else keep or ["doc_id"]
    body = "text to read"
    narrow = docs.select(*kept, F.col(text_col).cast("binary").alias(body))

    def judge(batch):
        raw = texts(batch, body)
        model = sent.value
        able = [any(map(str.isalpha, t.decode("utf-8", "replace"))) and model is not None for t in raw]  # \w would count fractions, circled and Roman numerals
        if model is None:
            return ["und"] * len(raw), [0.0] * len(raw)
        means = model.pooled([t if ok else b"" for t, ok in zip(raw, able)])
        best = means.argmax(axis=1)
        return ([model.languages[b] if ok else "und" for b, ok in zip(best.tolist(), able)],
                [min(1.0, float(means[i, b])) if ok else 0.0 for i, (b, ok) in enumerate(zip(best.tolist(), able))])

    def run(batches):
        for batch in (b for part in batches for b in blocks([part], body)):
            langs, scores = judge(batch)
            rest = {c: batch.column(c) for c in kept}
            if least_score is not None:
                ok = pa.array([la != "und" and s >= least_score for la, s in zip(langs, scores)], pa.bool_())
                yield pa.RecordBatch.from_arrays(list(rest.values()), names=list(rest)).filter(ok)
            else:
                yield pa.RecordBatch.from_arrays([*rest.values(), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                                 names=[*rest, "lang_pred", "score"])

    if least_score is not None:
        return narrow.mapInArrow(run, docs.schema)
    return narrow.mapInArrow(run, docs.select(*kept).withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema)


def fold(id_col: str, folds: int) -> Column:
    """A document's fold: crc32 of its identifier as text; 0 for a null identifier."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_fold: int = 2, folds: int = 4) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row, learned from the rows outside the held-out fold. Trains when called."""
    held = fold(id_col, folds) == held_fold
    network = train(docs.where(~held), id_col, text_col, lang_col)
    named = docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), F.col(text_col).alias("text"))
    return predict(named, network, "text", ["doc_id", "held_out"])
