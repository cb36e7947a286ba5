"""Toxicity by multiple-instance learning: document labels train sentence scores.

A document is a bag of sentences. A sentence's probability is a logistic function of hashed features
of its words (the word and its prefixes of 4 to 8 bytes); a document is toxic if any sentence is
(noisy-or: 1 - prod(1 - p)). A sentence without evidence has p = 0 exactly, so length alone never makes
a document toxic; while training, a small leak stands for what no sentence explains. Only document labels are known, so the gradient of the document's
likelihood decides how much each sentence answers for. The model is fitted on at most ``max_train``
labelled documents of each class (an ordered, seeded choice; the documented bound), each weighted by
the share of its class that was drawn, with features made on the executors; the fitted weights (sparse by an
L1 penalty) are broadcast, and every whole text is scored. Sentences with p >= 0.5 are located.

Defined results: null or empty texts have no sentence, score 0; if the training labels hold no toxic
document every score is 0; a null label is no label, several labels of one id count as their maximum;
repeated rows are scored each; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import binary_list, fold, list_array

MASK = (1 << 31) - 1
EDGE = b".,;:!?\"'()[]{}"
PREFIXES = (4, 5, 6, 7, 8)
BASE = -3.0  # logit of a sentence without features
LEAK = 0.05  # -log(1 - p) of a document without any offending sentence, while training
SUPPORT = 2  # training documents that a feature must occur in
FOLDS = 5
TOKEN = re.compile(r"[^\x20\x09-\x0D]+|\n")
CACHE = 300_000
LIMIT = 0.5
SCORE, SPANS = "__score", "__spans"  # internal names that input columns do not clash with


def word_features(word: bytes) -> list[int]:
    w = word.strip(EDGE)
    if not w:
        return []
    return [zlib.crc32(w) & MASK, *(zlib.crc32(b"\x00%d" % n + w[:n]) & MASK for n in PREFIXES if n < len(w))]


def is_end(word: bytes) -> bool:
    return word[-1:] in (b".", b"!", b"?")


def marked_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words; a line break is a word of its own that ends a sentence."""
    return text.lower().replace(b"\n", b" . ").split() if text else []


class Memo(dict):
    """A bounded cache of a function of a word."""

    def __init__(self, f):
        self.f = f

    def __missing__(self, word: bytes):
        if len(self) > CACHE:
            self.clear()
        v = self[word] = self.f(word)
        return v


def sentence_starts(ends: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], ends[:-1])))


def featurise(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, text) to the features of all sentences: flat ids and the number of them in each sentence."""
    feats, ends = Memo(word_features), Memo(is_end)
    for b in it:
        ids, lens, labels = [], [], []
        for y, t in zip(b.column(0).to_pylist(), binary_list(b.column(1)), strict=True):
            sent: list[int] = []
            doc: list[list[int]] = []
            for w in marked_words(t):
                sent += feats[w]
                if ends[w]:
                    doc.append(sent)
                    sent = []
            doc = [s for s in [*doc, sent] if s]
            labels.append(y)
            ids.append(np.array([f for s in doc for f in s], np.int32))
            lens.append(np.array([len(s) for s in doc], np.int32))
        cat = lambda x: np.concatenate(x) if x else np.array([], np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(labels, pa.int32()), list_array(cat(ids), [len(x) for x in ids], pa.int32()),
             list_array(cat(lens), [len(x) for x in lens], pa.int32())], names=["label", "ids", "lens"])


def compact(ids: list[np.ndarray], support: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Features numbered from 1, and their hashes; those of fewer than ``support`` documents all become 0."""
    if not ids:
        return [], np.array([], np.int32)
    names, flat = np.unique(np.concatenate(ids), return_inverse=True)
    cut = np.cumsum([len(x) for x in ids])[:-1]
    parts = np.split(flat.astype(np.int32), cut)
    docs = np.zeros(len(names), np.int32)
    for x in parts:
        docs[np.unique(x)] += 1
    kept = docs >= support
    number = np.where(kept, np.cumsum(kept), 0).astype(np.int32)
    return [number[x] for x in parts], names[kept]


def evidence(z: np.ndarray) -> np.ndarray:
    """-log(1 - p) of sentences with logit z; nothing at or below the logit of a sentence without features."""
    return np.maximum(0.0, np.logaddexp(0, z) - np.logaddexp(0, BASE))


def train(labels: np.ndarray, ids: list[np.ndarray], lens: list[np.ndarray], weight: dict[int, float], n_features: int,
          epochs: int = 12, min_steps: int = 500, batch: int = 64, rate: float = 0.5, l1: float = 1e-3) -> np.ndarray:
    """Noisy-or logistic weights (feature 0 stays 0), by AdaGrad with an L1 proximal step."""
    w, g2 = np.zeros(n_features + 1), np.full(n_features + 1, 1e-4)
    rng = np.random.default_rng(7)
    rows = np.array([i for i in range(len(labels)) if len(ids[i])], int)
    epochs = max(epochs, -(-min_steps * batch // max(1, len(rows))))
    for _ in range(epochs):
        rng.shuffle(rows)
        for at in range(0, len(rows), batch):
            pick = rows[at:at + batch]
            f = np.concatenate([ids[i] for i in pick])
            ln = np.concatenate([lens[i] for i in pick])
            per_doc = np.array([len(lens[i]) for i in pick])
            z = np.clip(np.add.reduceat(w[f], np.cumsum(ln) - ln) + BASE, -30, 30)
            none = LEAK + np.add.reduceat(evidence(z), np.cumsum(per_doc) - per_doc)  # -log(1 - P)
            factor = np.where(labels[pick] == 1, np.exp(-none) / np.expm1(-none), 1.0)
            factor *= np.array([weight[y] for y in labels[pick]]) / len(pick)
            gz = np.where(z >= BASE, 1 / (1 + np.exp(-z)), 0.0) * np.repeat(factor, per_doc)
            g = np.bincount(f, np.repeat(gz, ln), n_features + 1)
            u = np.flatnonzero(g)
            u = u[u > 0]
            g2[u] += g[u] ** 2
            step = rate / np.sqrt(g2[u])
            new = w[u] - step * g[u]
            w[u] = np.sign(new) * np.maximum(0.0, np.abs(new) - step * l1)
    return w


def fit(docs: DataFrame, labels: DataFrame, max_train: int) -> dict[int, float]:
    """Weights from the labelled documents outside the held-out fold; at most max_train of each class."""
    known = (labels.where(F.col("toxic").isNotNull() & (fold(F.col("doc_id"), FOLDS) != 0))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label")))
    # One text a document, before anything is drawn: labels without a document and repeated ids take no place.
    present = docs.groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("hash"))
    known = known.join(present, "doc_id")
    total = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    if not total.get(1):
        return {}
    drawn = None
    for y in (0, 1):
        part = known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
        drawn = part if drawn is None else drawn.unionByName(part)
    one = (docs.select("doc_id", F.xxhash64("text").alias("hash"), "text").join(drawn, ["doc_id", "hash"])
           .groupBy("doc_id", "label").agg(F.min("text").alias("text")).orderBy("label", F.xxhash64("doc_id"), "doc_id"))
    rows = one.select("label", "text").mapInArrow(featurise, "label int, ids array<int>, lens array<int>").toArrow()
    y = rows.column("label").to_numpy()
    if not (y == 1).any():
        return {}
    split = lambda n: [x.values.to_numpy() for x in rows.column(n)]
    count = {k: max(1, int((y == k).sum())) for k in (0, 1)}
    share = {k: total.get(k, 0) / count[k] for k in (0, 1)}
    top = max(share.values()) or 1.0
    ids, names = compact(split("ids"), SUPPORT)
    w = train(y, ids, split("lens"), {k: v / top for k, v in share.items()}, len(names))
    return {int(names[k - 1]): float(w[k]) for k in np.flatnonzero(w)}


def spans_of(text: str, p: np.ndarray, level: float) -> str:
    """start:end of the sentences with p >= level, in code points, end exclusive."""
    out, s, first, last = [], 0, None, 0
    for m in TOKEN.finditer(text):
        w = m[0]
        if w == "\n":
            over = True
        else:
            first, last, over = (m.start() if first is None else first), m.end(), w[-1] in ".!?"
        if over:
            if first is not None and p[s] >= level:
                out.append(f"{first}:{last}")
            s, first = s + 1, None
    if first is not None and p[s] >= level:
        out.append(f"{first}:{last}")
    return ",".join(out)


def scorer(model, keep: list[str]):
    """Passes the ``keep`` columns on and adds score and spans of the text column."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        weights = Memo(lambda word: sum(w.get(f, 0.0) for f in word_features(word)))
        ends = Memo(is_end)
        for batch in it:
            scores, spans = [], []
            for text in binary_list(batch.column("text")):
                words = marked_words(text)
                if not words:
                    scores.append(0.0)
                    spans.append("")
                    continue
                x = np.fromiter(map(weights.__getitem__, words), float, len(words))
                starts = sentence_starts(np.fromiter(map(ends.__getitem__, words), bool, len(words)))
                found = evidence(np.clip(np.add.reduceat(x, starts) + BASE, -30, 30))
                score = float(-np.expm1(-found.sum()))
                scores.append(min(1.0, max(0.0, score)))
                spans.append(spans_of(text.decode("utf-8", "replace"), -np.expm1(-found), LIMIT) if score >= 0.5 else "")
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(scores, pa.float64()), pa.array(spans, pa.string())],
                names=[*keep, SCORE, SPANS])

    return run


def with_scores(docs: DataFrame, model, keep: list[str]) -> DataFrame:
    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return docs.mapInArrow(scorer(model, keep), f"{kinds}{SCORE} double, {SPANS} string")


def score_toxicity(docs: DataFrame, labels: DataFrame, max_train: int = 2000) -> DataFrame:
    """doc_id, held_out, score, predicted and the located sentences of every row."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, max_train))
    rows = docs.select("doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "text")
    return with_scores(rows, model, ["doc_id", "held_out"]).select(
        "doc_id", "held_out", F.col(SCORE).alias("score"), (F.col(SCORE) >= LIMIT).cast("int").alias("predicted"),
        F.col(SPANS).alias("spans"))


def drop_toxic(docs: DataFrame, labels: DataFrame, max_train: int = 2000) -> DataFrame:
    """The rows and columns of ``docs`` that score below the limit."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, max_train))
    return with_scores(docs, model, docs.columns).where(F.col(SCORE) < LIMIT).drop(SCORE, SPANS)
