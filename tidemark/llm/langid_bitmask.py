"""Language identification by a Bloom filter of language bitmasks.

Each bucket of the filter holds two bits per language (two bit slices a language): ``seen``, the language has the
n-gram, and ``own``, it has it at least 1/``FOREIGN`` as often, by share, as the language that has it most
(documents hold stray sentences in other languages). Inserting an n-gram sets its bits in ``PROBES`` buckets; a
lookup ANDs the buckets and gets all languages that contain the n-gram at once. A text is a bag of letter n-grams;
per language the set ``own`` bits are counted, corrected for the slice's own false-positive rate, and the largest
corrected count decides; where no ``own`` bit is set, the ``seen`` bits do the same.

Every counted n-gram is in the filter, of every size of corpus. N-grams are 64-bit hashes, counted once (written to
the shared folder). The filter is built by tasks in shards of the hash, ``BUCKETS_PER_GRAM`` buckets for each n-gram
of the largest; texts are read in one pass per group of shards whose size is at most ``max_broadcast`` bytes, each
pass adding its counts to the rows'. One group holds all shards unless the corpus has millions of n-grams.

Defined results: texts that are null or have no letter are ``und`` with score 0, and so is every text
when nothing could be learned; ties go to the first language by code point; a text whose n-grams are
all unknown gets the most frequent training language and score 0; repeated rows are judged each; a null doc_id
counts as the empty text; very long texts are read whole; an empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import binary_list, fold, list_array, materialise, mix64

FOLDS = 5
SIZES = (3, 4)
PROBES = 3
BUCKETS_PER_GRAM = 16
SHARD_GRAMS = 1 << 18
FOREIGN = 8.0
MAX_BROADCAST = 128 << 20
SLICE_BYTES, SLICE_WORDS = 1 << 20, 1 << 16  # texts, and distinct words, that are worked on together
EDGE = 0  # stands for the edge of a letter run


KNOWN = np.zeros(0x110000, np.int8)  # per code point 0: not looked up yet, 1: letter, 2: other


def letters_of(points: np.ndarray) -> np.ndarray:
    """Letters (word characters but digits and underscore) as they are, everything else as ``EDGE``."""
    new = np.flatnonzero(np.bincount(points[KNOWN[points] == 0]))
    KNOWN[new] = [1 if chr(c).isalnum() and not chr(c).isdecimal() else 2 for c in new.tolist()]
    return np.where(KNOWN[points] == 1, points, EDGE)


def gram_hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of the words' letter runs (each run with an edge on both sides), and their words."""
    raw = np.frombuffer(("\n" + "\n".join(words).lower() + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    points, owner = letters_of(raw), np.cumsum(raw == 10, dtype=np.int32) - 1
    keep = (points != EDGE) | np.concatenate([[True], points[:-1] != EDGE])  # one edge between runs
    points, owner = points[keep], owner[keep]
    hashes, owners = [], []
    for n in SIZES:
        starts = len(points) - n + 1
        if starts <= 0:
            continue
        inside = np.ones(starts, bool)
        code = np.full(starts, n, np.uint64)
        for k in range(n):
            part = points[k:k + starts]
            if 0 < k < n - 1:
                inside &= part != EDGE
            code = code * np.uint64(0x9E3779B97F4A7C15) + part.astype(np.uint64)
        hashes.append(mix64(code[inside]))
        owners.append(owner[1:][:starts][inside])  # an n-gram belongs to the word of its second character
    none = np.empty(0, np.int64)
    return np.concatenate([none.astype(np.uint64), *hashes]), np.concatenate([none, *owners])


def slices(it: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Batches cut to rows of at most ``SLICE_BYTES`` of text (a longer text comes alone)."""
    for b in it:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        first = 0
        while first < b.num_rows:
            before = ends[first - 1] if first else 0
            stop = max(first + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
            yield b.slice(first, stop - first)
            first = stop


def distinct_words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """The texts' words (cut at white space) as numbers, the row of each, and the distinct words."""
    split = [t.decode("utf-8", "replace").split() if t else [] for t in texts]
    coded = pa.array([w for ws in split for w in ws], pa.string()).dictionary_encode()
    return coded.indices.to_numpy(), np.repeat(np.arange(len(split)), [len(ws) for ws in split]), coded.dictionary.to_pylist()


def counter(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to n-gram counts per language; distinct words are cut up once."""
    for b in slices(it, 1):
        by_lang = defaultdict(list)
        for lang, t in zip(b.column(0).to_pylist(), binary_list(b.column(1)), strict=True):
            by_lang[lang].append(t)
        for lang, texts in by_lang.items():
            word, _, words = distinct_words(texts)
            times = np.bincount(word, minlength=len(words))
            for i in range(0, len(words), SLICE_WORDS):
                h, owner = gram_hashes(words[i:i + SLICE_WORDS])
                gram, at = np.unique(h, return_inverse=True)
                n = np.bincount(at, weights=times[i + owner], minlength=len(gram))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64), pa.int64()),
                                                  pa.array(n.astype(np.int64), pa.int64())], names=["lang", "gram", "n"])


def buckets(gram: np.ndarray, size: int) -> np.ndarray:
    """(``PROBES``, n) buckets of n-grams in a shard of ``size`` buckets (a power of two)."""
    h = mix64(gram ^ np.uint64(0x5851F42D4C957F2D))
    step = (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([((h + np.uint64(i) * step) & np.uint64(size - 1)).astype(np.int64) for i in range(PROBES)])


def shard_of(gram: np.ndarray, shards: int) -> np.ndarray:
    return ((gram >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


class BitmaskFilter:
    """Shards of buckets. ``masks``: shard to an array (buckets, words of 64 slices); slice k is ``seen`` of language
    k, slice n + k its ``own``."""

    def __init__(self, langs: list[str], most: str | None, shards: int, size: int):
        self.langs, self.most, self.shards, self.size = langs, most, shards, size
        self.slices = 2 * len(langs)
        self.masks: dict[int, np.ndarray] = {}

    def build(self, gram: np.ndarray, slices: np.ndarray) -> np.ndarray:
        """The masks of one shard from (n-gram, slice) pairs."""
        masks = np.zeros((self.size, max(1, -(-self.slices // 64))), np.uint64)
        for at in buckets(gram, self.size):
            np.bitwise_or.at(masks, (at, slices >> 6), np.uint64(1) << (slices & 63).astype(np.uint64))
        return masks

    def answer(self, gram: np.ndarray) -> np.ndarray:
        """(n, words of 64 slices): all slices that have each n-gram; none for n-grams of shards that are not held."""
        out = np.zeros((len(gram), max(1, -(-self.slices // 64))), np.uint64)
        shard = shard_of(gram, self.shards)
        for s, masks in self.masks.items():
            own = np.flatnonzero(shard == s) if self.shards > 1 else slice(None)
            first, *others = buckets(gram[own], self.size)
            hit = masks[first]
            for p in others:
                hit &= masks[p]
            out[own] = hit
        return out


def has(answer: np.ndarray, k: int) -> np.ndarray:
    return (answer[:, k >> 6] >> np.uint64(k & 63)) & np.uint64(1)


def fit(train: DataFrame, shard_grams: int = SHARD_GRAMS) -> tuple[BitmaskFilter, DataFrame, np.ndarray]:
    """The filter of all rows of (lang, text): its frame, its written shards (shard, masks), and per slice the rate at
    which it answers for an n-gram that it does not have."""
    spark = train.sparkSession
    grams = materialise(train.mapInArrow(counter, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    total = {r.lang: r.n for r in grams.groupBy("lang").agg(F.sum("n").alias("n")).collect()}  # one row a language
    langs = sorted(total)
    n_grams = grams.select(F.count_distinct("gram").alias("n")).first().n
    shards = max(1, math.ceil(n_grams / shard_grams))
    size = 1 << math.ceil(math.log2(BUCKETS_PER_GRAM * max(1, math.ceil(n_grams / shards))))
    frame = BitmaskFilter(langs, max(langs, key=lambda k: (total[k], k), default=None), shards, size)
    numbers = spark.createDataFrame([(k, i, total[k]) for i, k in enumerate(langs)], "lang string, number int, total long")
    share = grams.join(numbers, "lang").select("gram", "number", (F.col("n") / F.col("total")).alias("share"))
    best = share.groupBy("gram").agg(F.max("share").alias("best"), F.collect_list(F.struct("number", "share")).alias("of"))
    pairs = best.select("gram", F.explode(F.expr(
        f"flatten(transform(of, x -> if(x.share * {FOREIGN} >= best, array(x.number, x.number + {len(langs)}), array(x.number))))")).alias("slice"))
    shard = F.expr(f"shiftrightunsigned(shiftrightunsigned(gram, 32) * {shards}L, 32)")

    def build(key: tuple, table: pa.Table) -> pa.Table:
        masks = frame.build(table.column("gram").to_numpy().view(np.uint64), table.column("slice").to_numpy().astype(np.int64))
        k = np.arange(frame.slices)
        filled = [int(has(masks, j).sum()) for j in k.tolist()]
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "masks": pa.array([masks.tobytes()], pa.binary()),
                         "filled": pa.array([filled], pa.list_(pa.int64()))})

    built = materialise(pairs.withColumn("shard", shard).groupBy("shard").applyInArrow(build, "shard long, masks binary, filled array<long>"))
    filled = np.zeros(frame.slices)
    for r in built.select(F.posexplode("filled").alias("k", "x")).groupBy("k").agg(
            F.sum(F.pow(F.col("x") / size, F.lit(PROBES))).alias("x")).collect():  # one row a slice
        filled[r.k] = r.x / shards
    return frame, built, filled


def hit_counter(model):
    """Adds the held shards' bits to ``hits`` (one count per slice, and at the end the number of n-grams)."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: BitmaskFilter = model.value
        for b in slices(it, 2):
            word, row, words = distinct_words(binary_list(b.column(2)))
            per_word = np.zeros((m.slices + 1, len(words)), np.int32)
            for i in range(0, len(words), SLICE_WORDS):
                gram, owner = gram_hashes(words[i:i + SLICE_WORDS])
                answer = m.answer(gram)
                part = per_word[:, i:i + SLICE_WORDS]
                part[-1] = np.bincount(owner, minlength=part.shape[1])
                for k in range(m.slices):
                    part[k] = np.bincount(owner, weights=has(answer, k), minlength=part.shape[1])
            count = np.stack([np.bincount(row, weights=x[word], minlength=b.num_rows) for x in per_word], axis=1).astype(np.int64)
            old = b.column(3).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            if old.shape[1]:
                count[:, :m.slices] += old[:, :m.slices]
            hits = list_array(count.ravel(), [m.slices + 1] * b.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), hits], names=["doc_id", "held_out", "text", "hits"])

    return run


def decide(frame: BitmaskFilter, false_rate: np.ndarray):
    langs, most = frame.langs, frame.most

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            hits = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).astype(float)
            n = hits[:, -1]
            preds, scores = ["und"] * b.num_rows, np.zeros(b.num_rows)
            if langs:
                room = np.maximum(1 - false_rate, 1e-9)
                corrected = np.maximum(0, (hits[:, :-1] - n[:, None] * false_rate) / room)
                seen, own = corrected[:, :len(langs)], corrected[:, len(langs):]
                used = np.where(own.max(axis=1, keepdims=True) > 0, own, seen)
                best = used.argmax(axis=1)  # the first of equals
                top = used[np.arange(len(best)), best]
                preds = ["und" if not m else langs[k] if t > 0 else most for m, k, t in zip(n, best, top, strict=True)]
                scores = np.minimum(1, np.divide(top, n, out=np.zeros_like(top), where=n > 0))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(preds, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, shard_grams: int = SHARD_GRAMS, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    part = fold(F.col("doc_id"), FOLDS)
    train = docs.where((part != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    frame, built, false_rate = fit(train, shard_grams)
    rows = docs.select("doc_id", (part == 0).alias("held_out"), "text", F.array().cast("array<long>").alias("hits"))
    at_once = max(1, max_broadcast // (frame.size * 8 * max(1, -(-frame.slices // 64))))
    for first in range(0, frame.shards, at_once):
        held = BitmaskFilter(frame.langs, frame.most, frame.shards, frame.size)
        for r in built.where(F.col("shard").between(first, first + at_once - 1)).select("shard", "masks").toLocalIterator():
            held.masks[r.shard] = np.frombuffer(bytes(r.masks), np.uint64).reshape(frame.size, -1)
        rows = rows.mapInArrow(hit_counter(spark.sparkContext.broadcast(held)), f"doc_id {kind}, held_out boolean, text string, hits array<long>")
        if first + at_once < frame.shards:
            rows = materialise(rows)
    return rows.select("doc_id", "held_out", "hits").mapInArrow(
        decide(frame, false_rate), f"doc_id {kind}, held_out boolean, lang_pred string, score double")
