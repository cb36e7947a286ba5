"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

1. Seeds. Every n-gram (three words, A-Z lower-cased) of every benchmark item is a seed; those that occur in
   no document hit nothing. None is left out for being common or rare, so one intact n-gram of a copy is
   enough, wherever the copy was edited.
2. The words around each diagonal that a seed hit names (with half an item as margin) are aligned with the
   item, word by word (match 2, mismatch and gap -1, local). The score is divided by that of the whole
   item; ``min_score`` of it makes a leak, so edited and paraphrased copies count by the words they keep.
   A window that shares too few words with the item to reach ``min_score`` is not aligned: the score is at
   most ``MATCH`` a shared word, so the bound loses nothing. An alignment that runs to the end of its
   window is repeated with a longer one.

What seeds cannot see: a copy that keeps no three neighbouring words of its item.

The benchmark reaches the workers in chunks of at most ``chunk_bytes`` of text (by a hash of the
item), one pass over the documents each: a larger benchmark means more passes, never a larger broadcast.

Defined results: null or empty texts and items hold nothing and match nothing; an item of fewer than
three words is one n-gram of all its words; repeated rows are reported each; a null item_id is reported as
null; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import binary_list, words_of

GRAM = 3
MATCH, MISMATCH, GAP = 2, -1, -1


class Items:
    """The words and n-grams of one chunk of the benchmark. Small: bounded by ``chunk_bytes``."""

    def __init__(self, rows: list[tuple[int | None, bytes | None]]):
        texts = [(i, words_of(t)) for i, t in rows]
        self.ids = [i for i, w in texts if w]
        self.words = [w for _, w in texts if w]
        self.vocab = {w: k for k, w in enumerate(sorted({x for w in self.words for x in w}), 1)}
        self.codes = [np.array([self.vocab[x] for x in w], np.int64) for w in self.words]
        self.base = len(self.vocab) + 1
        self.grams = [self.gram_codes(c) if len(c) >= GRAM else None for c in self.codes]
        # all n-grams sorted by code, each with its places: seed n is at item_of[first[n]:first[n + 1]]
        none = [np.array([], np.int64)]
        codes = np.concatenate([g for g in self.grams if g is not None] or none)
        order = np.argsort(codes, kind="stable")
        self.known, first = np.unique(codes[order], return_index=True)
        self.first = np.append(first, len(codes))
        self.item_of = np.concatenate([np.full(len(g), k) for k, g in enumerate(self.grams) if g is not None] or none)[order]
        self.place = np.concatenate([np.arange(len(g)) for g in self.grams if g is not None] or none)[order]
        short = defaultdict(list)
        for k, g in enumerate(self.grams):
            if g is None:
                short[tuple(self.codes[k].tolist())].append(k)
        self.short = dict(short)

    def gram_codes(self, c: np.ndarray) -> np.ndarray:
        """One number per n-gram; exact, since the vocabulary is below 2**21."""
        if self.base >= 2 ** 21:
            raise ValueError("lower chunk_bytes: the chunk has too many distinct words")
        return (c[:-2] * self.base + c[1:-1]) * self.base + c[2:]

    def encode(self, words: list[bytes]) -> np.ndarray:
        get = self.vocab.get
        return np.fromiter((get(w, 0) for w in words), np.int64, len(words))

    def doc_grams(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and codes of the n-grams that hold only known words."""
        if len(c) < GRAM:
            return np.array([], np.int64), np.array([], np.int64)
        at = np.flatnonzero((c[:-2] > 0) & (c[1:-1] > 0) & (c[2:] > 0))
        return at, (c[at] * self.base + c[at + 1]) * self.base + c[at + 2]


def seed_hits(codes: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every pair of a document n-gram and an equal item n-gram: index into ``codes``, item, position in the item."""
    if not len(items.known):
        return codes[:0], codes[:0], codes[:0]
    seed = np.minimum(np.searchsorted(items.known, codes), len(items.known) - 1)
    hit = np.flatnonzero(items.known[seed] == codes)
    seed = seed[hit]
    n = items.first[seed + 1] - items.first[seed]
    at = np.repeat(items.first[seed] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return np.repeat(hit, n), items.item_of[at], items.place[at]


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman: best local score, and where it starts and ends in ``text``."""
    n = len(text)
    score, start = np.zeros(n + 1, np.int64), np.arange(n + 1)
    idx = np.arange(n + 1)
    best = (0, 0, 0)
    for w in item:
        diag = score[:-1] + np.where(text == w, MATCH, MISMATCH)
        up = score[1:] + GAP
        new, frm = np.zeros(n + 1, np.int64), idx.copy()
        take = np.maximum(diag, up)
        good = take > 0
        new[1:][good] = take[good]
        frm[1:][good] = np.where(diag >= up, start[:-1], start[1:])[good]
        # a gap along the text: the best earlier cell of this row less its distance
        lead = new - GAP * idx
        reach = np.maximum.accumulate(lead)
        source = np.maximum.accumulate(np.where(lead == reach, idx, 0))
        chained = reach + GAP * idx
        use = (chained > new) & (chained > 0)
        new[use], frm[use] = chained[use], frm[source[use]]
        score, start = new, frm
        k = int(np.argmax(score))
        if score[k] > best[0]:
            best = (int(score[k]), int(start[k]), k)
    return best


def passage_finder(shared, min_score: float):
    """doc_id, item_id, score, and the aligned words [word_start, word_end) of every leak."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for b in it:
            out = []
            for r, t in enumerate(binary_list(b.column(2))):
                c = items.encode(words_of(t))
                if len(c) < GRAM:
                    out += [(r, k, 1.0, 0, len(c)) for k in items.short.get(tuple(c.tolist()), ()) if len(c)]
                    continue
                for n in {len(x) for x in items.short}:
                    for p in range(len(c) - n + 1):
                        out += [(r, k, 1.0, p, p + n) for k in items.short.get(tuple(c[p:p + n].tolist()), ())]
                at, codes = items.doc_grams(c)
                hit, k_hit, j_hit = seed_hits(codes, items)
                diagonals: dict[int, set[int]] = defaultdict(set)
                for k, d in zip(k_hit.tolist(), (at[hit] - j_hit).tolist(), strict=True):
                    diagonals[k].add(d)
                for k, found in diagonals.items():
                    out += [(r, k, *x) for x in passages(items.codes[k], c, found, min_score)]
            cols = list(zip(*out, strict=True)) if out else [[], [], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(cols[0], pa.int64())), b.column(1).take(pa.array(cols[0], pa.int64())),
                 pa.array([items.ids[k] for k in cols[1]], pa.int64()),
                 pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                names=["doc_id", "text_hash", "item_id", "score", "word_start", "word_end"])

    return run


def passages(item: np.ndarray, doc: np.ndarray, found: set[int], min_score: float) -> list[tuple[float, int, int]]:
    """Align the item around each diagonal with a seed hit, from left to right; passages do not overlap."""
    m, out, done = len(item), [], 0
    least = min_score * MATCH * m
    kinds, have = np.unique(item, return_counts=True)
    at = np.minimum(np.searchsorted(kinds, doc), len(kinds) - 1)
    at = np.where(kinds[at] == doc, at, len(kinds))  # each word of the text as a word of the item, or none

    def reachable(a: int, z: int) -> bool:
        shared = np.minimum(np.bincount(at[a:z], minlength=len(kinds) + 1)[:-1], have).sum()
        return MATCH * int(shared) >= least

    if not reachable(0, len(doc)):
        return out
    for d in sorted(found):
        if d + m // 2 < done:
            continue  # lies in a passage already found
        a, z = max(0, done, d - m // 2), min(len(doc), d + m + m // 2)
        if a >= z or not reachable(a, z):
            continue
        score, x, y = align(item, doc[a:z])
        while score >= least and a + y == z < len(doc):  # cut by the window: the rest of the passage may follow
            z = min(len(doc), z + m)
            score, x, y = align(item, doc[a:z])
        if score >= least:
            out.append((score / (MATCH * m), a + x, a + y))
            done = a + y
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, min_score: float = 0.5,
               chunk_bytes: int = 8 << 20) -> DataFrame:
    """doc_id, text_hash, item_id, score, word_start, word_end: one row per leaked passage of a benchmark item."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_hash long, item_id long, score double, word_start long, word_end long"
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull())
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-size // (chunk_bytes // 2)))  # chunks by hash are uneven: twice as many as would fit
    out = None
    for n in range(chunks):
        part = rows.where(F.pmod(F.xxhash64("text"), F.lit(chunks)) == n).orderBy("item_id", "text").toArrow()
        items = Items(list(zip(part.column("item_id").to_pylist(), binary_list(part.column("text").combine_chunks()), strict=True)))
        shared = spark.sparkContext.broadcast(items)
        found = texts.mapInArrow(passage_finder(shared, min_score), schema)
        out = found if out is None else out.unionByName(found)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` that hold no passage of the benchmark."""
    leaks = find_leaks(docs, benchmark).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    return docs.join(leaks, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash")), "left_anti")
