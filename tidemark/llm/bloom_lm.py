"""Language-model scoring with a log-frequency Bloom filter.

Counting. The texts are cut into batches of word numbers. The words and word pairs of every batch, as
64-bit hashes with their counts, go as sorted runs to the region that their leading bits name; the
region adds up the counts of the training documents.

Filter. A count of 2**e or more up to 2**(e + 1) has level e. An n-gram is inserted once per level from 0
to its own; a lookup probes level by level until one is missing, so a false positive can only raise a
count by a level. Each region builds its part of the filter from its counted n-grams, at
``BITS_PER_ITEM`` bits an insertion, keeps all of them, and looks up the runs of every batch in it: the
filter is never in one place, so no part of it is dropped or broadcast, whatever the corpus. Regions
hold about 2**22 tokens each. The levels go back to their batch.

Probability. p(w | h) = l * c(h, w) / c(h) + (1 - l) * (c(w) + 1) / (N + V + 1), all counts probed; the
weight l depends on the level of c(h) and is fitted by EM on a fold of the training documents, with a
second filter that lacks the word pairs of that fold. The scores use the pairs of all training documents.
Levels stand for their mean count.

The base score needs exact counts. Words of the highest levels (at most ``max_words``) are broadcast
with their counts; the other, rare words of each document are joined with the count table: no key of
that join is frequent, by construction.

Defined results: a null text is empty and has one token, the end; with no training documents all counts
are 0 and N = V = 0; repeated rows are scored each; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, binary_list, fold, list_array, materialise, mix64, words_of

HELD_FOLDS, HELD, TUNING = 7, 2, 3  # the contract's fold, and the training fold that fits the weights
END = np.uint64(xxhash.xxh3_64_intdigest(b"\x20"))  # white space is never a word
START = np.uint64(xxhash.xxh3_64_intdigest(b"\x09"))
PROBES = 5
BITS_PER_ITEM = 10
BATCH_ROWS, BATCH_OCTETS = 4000, 16 << 20  # a batch of texts at most
CACHE = 300_000
LEVELS = 64
ZSTD = pa.Codec("zstd", compression_level=1)
LOG_BIN = 0.25  # width of a bin of log2(pair estimate / word estimate) in the EM fit
MAX_BIN = 400


class WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def token_hashes(texts: list[bytes | None], hashes: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of a batch, an end after each text, and the number of tokens per text."""
    flat: list[int] = []
    sizes = np.empty(len(texts), np.int64)
    end = int(END)
    for k, t in enumerate(texts):
        words = words_of(t)
        flat.extend(map(hashes.__getitem__, words))
        flat.append(end)
        sizes[k] = len(words) + 1
    return np.array(flat, np.uint64), sizes


def histories(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    h = np.empty_like(tokens)
    h[1:] = tokens[:-1]
    if len(sizes):
        h[np.cumsum(sizes) - sizes] = START
    return h


def pair_hash(history: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix64(history * np.uint64(0x9E3779B97F4A7C15) + token)


def packed(x: np.ndarray) -> bytes:
    """An array, byte planes apart, compressed."""
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()
    return len(planes).to_bytes(8, "little") + ZSTD.compress(planes, asbytes=True)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    n, kind = int.from_bytes(data[:8], "little"), np.dtype(kind)
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(ZSTD.decompress(data[8:], decompressed_size=n, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).view(kind).reshape(-1)


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys by their steps: these are the smaller the more keys there are."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.uint64), dtype=np.uint64)


def batcher(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, fold, text) to one row a batch of documents: the distinct words, and each token's word."""
    hashes, task, made = WordHash(), TaskContext.get().partitionId(), 0
    for whole in it:
        rows = max(1, min(BATCH_ROWS, whole.num_rows * BATCH_OCTETS // max(1, whole.nbytes)))
        for b in batches_of([whole], rows):
            tokens, sizes = token_hashes(binary_list(b.column(2)), hashes)
            words, token, n = np.unique(tokens, return_inverse=True, return_counts=True)
            by = np.argsort(-n, kind="stable")  # numbered by frequency: small numbers compress
            rank = np.empty(len(by), np.uint32)
            rank[by] = np.arange(len(by))
            ids = pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), b.column(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) + made], pa.int64()), ids,
                 pa.array([packed(b.column(1).to_numpy(zero_copy_only=False).astype(np.int8))], pa.binary()),
                 pa.array([packed(sizes)], pa.binary()), pa.array([packed(words[by])], pa.binary()),
                 pa.array([packed(rank[token])], pa.binary())],
                names=["batch", "doc_ids", "folds", "sizes", "words", "tokens"])
            made += 1


class Batch:
    """The arrays of one row of ``batcher``."""

    def __init__(self, row: dict):
        self.folds, self.sizes = unpacked(row["folds"], np.int8), unpacked(row["sizes"], np.int64)
        words = unpacked(row["words"], np.uint64)
        order = np.argsort(words)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.words, self.token = words[order], place[unpacked(row["tokens"], np.uint32)]
        self.starts = np.cumsum(self.sizes) - self.sizes

    def pairs(self) -> np.ndarray:
        tokens = self.words[self.token]
        return pair_hash(histories(tokens, self.sizes), tokens)

    def in_folds(self, keep: np.ndarray) -> np.ndarray:
        """Per token, whether its document is one of ``keep``."""
        return np.repeat(keep, self.sizes)


def rows_of(b: pa.RecordBatch | pa.Table, names: list[str]) -> Iterator[dict]:
    for k in range(b.num_rows):
        yield {c: b.column(c)[k].as_py() for c in names}


ARRAYS = ["folds", "sizes", "words", "tokens"]


def counter(bits: int):
    """Batches to sorted runs per region: words (order 1) and word pairs (2), each with its count in the
    training documents and in those outside the tuning fold."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in it:
            for name, row in zip(rows.column("batch").to_pylist(), rows_of(rows, ARRAYS), strict=True):
                b = Batch(row)
                train = b.in_folds(b.folds != HELD)
                rest = train & b.in_folds(b.folds != TUNING)
                u, inv = np.unique(b.pairs(), return_inverse=True)
                for order, keys, at in ((1, b.words, b.token), (2, u, inv)):
                    yield region_runs(order, name, keys, np.bincount(at[train], minlength=len(keys)),
                                      np.bincount(at[rest], minlength=len(keys)), bits)

    return run


def region_runs(order: int, batch: int, keys: np.ndarray, counts: np.ndarray, rest: np.ndarray, bits: int) -> pa.RecordBatch:
    region = (keys >> np.uint64(64 - bits)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate(([True], region[1:] != region[:-1], [True]))) if len(keys) else np.array([0])
    spans = list(zip(cut[:-1], cut[1:], strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array([order] * len(spans), pa.int32()), pa.array([int(region[a]) for a, _ in spans], pa.int64()),
         pa.array([batch] * len(spans), pa.int64()),
         pa.array([packed_keys(keys[a:b]) for a, b in spans], pa.binary()),
         *(pa.array([packed(x[a:b]) for a, b in spans], pa.binary()) for x in (counts.astype(np.uint32), rest.astype(np.uint32)))],
        names=["order", "region", "batch", "keys", "counts", "rest"])


def region_filter(order: int, region: int, keys: np.ndarray, counts: np.ndarray) -> LogFrequencyFilter:
    """The region's part of the filter, with every n-gram that was counted."""
    held = counts > 0
    one = pa.RecordBatch.from_arrays(
        [pa.array([order]), pa.array([region]), pa.array([keys[held].tobytes()], pa.binary()),
         pa.array([counts[held].tobytes()], pa.binary())], names=["order", "region", "keys", "counts"])
    part = next(bitmaps({order: 0})(iter([one]))).column(2)[0].as_py()
    return LogFrequencyFilter({0: part}, 0, 0)


def merger(t: pa.Table) -> pa.Table:
    """One region: the levels of every batch's n-grams (plus one; 0 is not held), in all training documents and,
    for the pairs of the tuning fold, in the others; and a row (batch -1) with what was counted."""
    order, region = t.column("order")[0].as_py(), t.column("region")[0].as_py()
    runs = [unpacked_keys(x) for x in t.column("keys").to_pylist()]
    sizes, each = [len(x) for x in runs], np.concatenate(runs)
    in_train, in_rest = (np.concatenate([unpacked(x, np.uint32) for x in t.column(c).to_pylist()]) for c in ("counts", "rest"))
    keys, at = np.unique(each, return_inverse=True)
    counts = np.bincount(at, in_train, len(keys)).astype(np.int64)
    levels = (region_filter(order, region, keys, counts).levels(keys) + 1).astype(np.uint8)[at]
    rest_levels, rest_total = np.zeros(0, np.uint8), 0
    if order == 2:
        rest = np.bincount(at, in_rest, len(keys)).astype(np.int64)
        rest_total = int(rest.sum())
        asked = in_train > in_rest
        rest_levels = np.zeros(len(each), np.uint8)
        rest_levels[asked] = region_filter(order, region, keys, rest).levels(each[asked]) + 1
    cuts = np.cumsum(sizes)[:-1]
    split = lambda x: [packed(y) for y in np.split(x, cuts)] if len(x) else [packed(x)] * len(sizes)
    held = counts > 0
    keys, counts = keys[held], counts[held]
    hist = np.bincount(np.frexp(counts.astype(float))[1] - 1, minlength=LEVELS)[:LEVELS]
    k = len(sizes)
    return pa.table({
        "order": pa.array([order] * (k + 1), pa.int32()), "region": pa.array([region] * (k + 1), pa.int64()),
        "batch": pa.array([*t.column("batch").to_pylist(), -1], pa.int64()),
        "levels": pa.array([*split(levels), None], pa.binary()), "rest_levels": pa.array([*split(rest_levels), None], pa.binary()),
        "keys": pa.array([None] * k + [keys.tobytes() if order == 1 else None], pa.binary()),
        "counts": pa.array([None] * k + [counts.tobytes() if order == 1 else None], pa.binary()),
        "items": pa.array([0] * k + [len(keys)], pa.int64()), "total": pa.array([0] * k + [int(counts.sum())], pa.int64()),
        "rest_total": pa.array([0] * k + [rest_total], pa.int64()),
        "hist": pa.array([None] * k + [hist.tolist()], pa.list_(pa.int64()))})


def resolve(batch: pa.Table, answers: pa.Table) -> pa.Table:
    """A batch with the level of each of its words, and the two pair levels of each of its tokens."""
    b = Batch(next(rows_of(batch, ARRAYS)))
    answers = answers.sort_by([("order", "ascending"), ("region", "ascending")])  # regions are leading bits: key order
    order = answers.column("order").to_numpy()
    joined = lambda c, o: np.concatenate([
        unpacked(x, np.uint8) for x, y in zip(answers.column(c).to_pylist(), order, strict=True) if y == o])
    at = np.unique(b.pairs(), return_inverse=True)[1]
    new = {"word_levels": joined("levels", 1), "pair_levels": joined("levels", 2)[at], "rest_levels": joined("rest_levels", 2)[at]}
    out = batch.select(["batch", "doc_ids", *ARRAYS])
    for c, x in new.items():
        out = out.append_column(c, pa.array([packed(x)], pa.binary()))
    return out


def lowest_level(hist: np.ndarray, most: int, per_level: bool, floor: int = 0) -> int:
    """The smallest level whose n-grams (or their insertions) number at most ``most``."""
    for t in range(floor, LEVELS):
        e = np.arange(t, LEVELS)
        if int((hist[t:] * ((e - t + 1) if per_level else 1)).sum()) <= most:
            return t
    return LEVELS


def positions(keys: np.ndarray, level: int, n_bits: np.ndarray | int, probe: int) -> np.ndarray:
    a = mix64(keys ^ np.uint64((level + 1) * 0xBF58476D1CE4E5B9 % 2 ** 64))
    step = (a >> np.uint64(32)) | np.uint64(1)
    return ((a & np.uint64(0xFFFFFFFF)) + np.uint64(probe) * step) % np.asarray(n_bits, np.uint64)


def bitmaps(lowest: dict[int, int]):
    """Each region's part of its order's filter."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            parts = []
            for order, k, c in zip(*(b.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                keys, counts = np.frombuffer(k, np.uint64), np.frombuffer(c, np.int64)
                t = lowest[order]
                level = np.frexp(counts.astype(float))[1] - 1
                keys, level = keys[level >= t], level[level >= t]
                inserted = int((level - t + 1).sum())
                n_bits = 64 * max(1, -(-inserted * BITS_PER_ITEM // 64))
                bits = np.zeros(n_bits, np.uint8)
                for e in range(t, int(level.max(initial=t - 1)) + 1):
                    at = keys[level >= e]
                    for probe in range(PROBES):
                        bits[positions(at, e, n_bits, probe).astype(np.int64)] = 1
                parts.append(np.packbits(bits, bitorder="little").tobytes() if inserted else b"")
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(parts, pa.binary())],
                                             names=["order", "region", "part"])

    return run


class LogFrequencyFilter:
    """One order's filter: the regions' bitmaps end to end."""

    def __init__(self, parts: dict[int, bytes], bits: int, lowest: int):
        self.shift, self.lowest = np.uint64(64 - bits), lowest
        size = np.zeros(1 << bits, np.int64)
        for r, p in parts.items():
            size[r] = len(p)
        self.n_bits = size * 8
        self.start = np.cumsum(self.n_bits) - self.n_bits
        self.bytes = np.frombuffer(b"".join(parts[r] for r in sorted(parts)), np.uint8)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The level of each key's count by probing upwards; lowest - 1 if it is not held."""
        out = np.full(len(keys), self.lowest - 1, np.int64)
        region = (keys >> self.shift).astype(np.int64)
        live = np.flatnonzero(self.n_bits[region] > 0)
        for e in range(self.lowest, LEVELS):
            for probe in range(PROBES):
                if not len(live):
                    return out
                r = region[live]
                at = self.start[r] + positions(keys[live], e, self.n_bits[r], probe).astype(np.int64)
                live = live[(self.bytes[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
            out[live] = e
        return out


def mean_count(level: np.ndarray, lowest: int) -> np.ndarray:
    """What a level stands for: its mean if counts are log-uniform; 1 for single ones; 0 if not held."""
    est = np.exp2(level.astype(float)) / math.log(2)
    return np.where(level < lowest, 0.0, np.where(level == 0, 1.0, est))


class Model:
    def __init__(self, n: int, v: int, rest_total: int):
        self.n, self.v = n, v
        self.rest_scale = n / rest_total if rest_total else 0.0
        self.weights = np.zeros(LEVELS)

    def estimates(self, b: Batch, word_levels: np.ndarray, pair_levels: np.ndarray, scale: float = 1.0):
        """Per token: pair estimate, word estimate, level of the history. Levels come one up, 0 is not held."""
        level = word_levels.astype(np.int64)[b.token] - 1
        p_word = (mean_count(level, 0) + 1) / (self.n + self.v + 1)
        h_level = np.empty_like(level)
        h_level[1:] = level[:-1]
        h_level[b.starts] = level[b.starts + b.sizes - 1]  # as many texts start as end
        c_h, c_pair = mean_count(h_level, 0), mean_count(pair_levels.astype(np.int64) - 1, 0)
        p_pair = np.minimum(1.0, np.divide(c_pair * scale, c_h, out=np.zeros(len(level)), where=c_h > 0))
        return p_pair, p_word, np.maximum(h_level, 0)

    def log10(self, b: Batch, word_levels: np.ndarray, pair_levels: np.ndarray) -> np.ndarray:
        """log10 probability of each text."""
        p_pair, p_word, h_level = self.estimates(b, word_levels, pair_levels)
        w = self.weights[h_level]
        return np.add.reduceat(np.log10(w * p_pair + (1 - w) * p_word), b.starts)


LEVEL_ARRAYS = ["word_levels", "pair_levels", "rest_levels"]


def ratio_histogram(shared):
    """Batches to counts, over their tuning texts, by history level and ratio of the two estimates."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for row in (x for rows in it for x in rows_of(rows, ARRAYS + LEVEL_ARRAYS)):
            b = Batch(row)
            words, _, rest = (unpacked(row[c], np.uint8) for c in LEVEL_ARRAYS)
            tuning = b.in_folds(b.folds == TUNING)
            p_pair, p_word, level = (x[tuning] for x in model.estimates(b, words, rest, model.rest_scale))
            ratio = np.full(len(level), -MAX_BIN, np.int64)
            some = p_pair > 0
            ratio[some] = np.clip(np.round(np.log2(p_pair[some] / p_word[some]) / LOG_BIN), 1 - MAX_BIN, MAX_BIN)
            u, n = np.unique(level * 4096 + ratio + MAX_BIN, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(u // 4096, pa.int64()), pa.array(u % 4096 - MAX_BIN, pa.int64()), pa.array(n, pa.int64())],
                names=["level", "ratio", "n"])

    return run


def fit_weights(rows: list[tuple[int, int, int]]) -> np.ndarray:
    """Interpolation weight per history level by EM."""
    out = np.zeros(LEVELS)
    for level in {r[0] for r in rows}:
        ratio = np.array([r[1] for r in rows if r[0] == level])
        n = np.array([r[2] for r in rows if r[0] == level], float)
        r = np.where(ratio == -MAX_BIN, 0.0, np.exp2(ratio * LOG_BIN))
        lam = 0.5
        for _ in range(200):
            lam = float((n * lam * r / (lam * r + 1 - lam)).sum() / n.sum())
        out[level] = min(lam, 0.999)
    return out


def scorer(shared, words_shared):
    """Batches to the scores of their documents; the rare words are left for the join."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, (known, logs) = shared.value, words_shared.value
        for ids, row in ((rows.column("doc_ids")[k].values, x) for rows in it
                         for k, x in enumerate(rows_of(rows, ARRAYS + LEVEL_ARRAYS))):
            b = Batch(row)
            word_levels, pair_levels, _ = (unpacked(row[c], np.uint8) for c in LEVEL_ARRAYS)
            sizes, starts, u, inv = b.sizes, b.starts, b.words, b.token
            at = np.minimum(np.searchsorted(known, u), max(0, len(known) - 1))
            held = known[at] == u if len(known) else np.zeros(len(u), bool)
            part = np.where(held, logs[at] if len(logs) else 0.0, 0.0)
            is_known = held[inv]
            doc = np.repeat(np.arange(len(sizes)), sizes)[~is_known]
            rare_doc, rare = doc, u[inv[~is_known]]
            order = np.lexsort((rare, rare_doc))
            rare_doc, rare = rare_doc[order], rare[order]
            first = np.flatnonzero(np.concatenate(([True], (rare[1:] != rare[:-1]) | (rare_doc[1:] != rare_doc[:-1])))) \
                if len(rare) else np.array([], np.int64)
            per = np.diff(np.append(first, len(rare)))
            lens = np.bincount(rare_doc[first], minlength=len(sizes)) if len(rare) else np.zeros(len(sizes), np.int64)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(b.folds == HELD), pa.array(sizes, pa.int64()),
                 pa.array(np.add.reduceat(is_known.astype(np.int64), starts), pa.int64()),
                 pa.array(np.add.reduceat(part[inv], starts), pa.float64()),
                 pa.array(model.log10(b, word_levels, pair_levels), pa.float64()),
                 list_array(rare[first].view(np.int64), lens, pa.int64()), list_array(per, lens, pa.int64())],
                names=["doc_id", "held_out", "n_tokens", "n_known", "log_counts", "score", "rare", "rare_n"])

    return run


def frequent_words(lowest: int, above: bool):
    """(key, count) rows of the words at or above (or below) a level."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                keys, counts = np.frombuffer(k, np.int64), np.frombuffer(c, np.int64)
                take = (np.frexp(counts.astype(float))[1] - 1 >= lowest) == above
                yield pa.RecordBatch.from_arrays([pa.array(keys[take], pa.int64()), pa.array(counts[take], pa.int64())],
                                                 names=["key", "count"])

    return run


def score_texts(docs: DataFrame, max_words: int = 1 << 22) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    octets = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(20, max(8, math.ceil(math.log2(max(1, octets / 6 / 2 ** 22)))))  # about 2**22 tokens a region at most
    arrays = f"batch long, doc_ids array<{kind}>, " + ", ".join(f"{c} binary" for c in ARRAYS)
    batches = materialise(docs.select("doc_id", fold(F.col("doc_id"), HELD_FOLDS).alias("fold"), "text").mapInArrow(batcher, arrays))
    merged = materialise(
        batches.mapInArrow(counter(bits), "order int, region long, batch long, keys binary, counts binary, rest binary")
        .groupBy("order", "region").applyInArrow(
            merger, "order int, region long, batch long, levels binary, rest_levels binary, keys binary, counts binary, "
            "items long, total long, rest_total long, hist array<long>"))
    counted = merged.where(F.col("batch") == -1)
    totals = {r.order: (r.items, r.total, r.rest_total) for r in counted.groupBy("order").agg(
        F.sum("items").alias("items"), F.sum("total").alias("total"), F.sum("rest_total").alias("rest_total")).collect()}
    hist = np.zeros(LEVELS, np.int64)
    for r in (counted.where(F.col("order") == 1).select(F.posexplode("hist").alias("e", "n"))
              .groupBy("e").agg(F.sum("n").alias("n")).collect()):
        hist[r.e] = r.n
    (v, n, _), (_, _, rest_total) = totals.get(1, (0, 0, 0)), totals.get(2, (0, 0, 0))

    answers = merged.where(F.col("batch") >= 0).select("batch", "order", "region", "levels", "rest_levels")
    resolved = materialise(batches.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        resolve, arrays + "".join(f", {c} binary" for c in LEVEL_ARRAYS)))
    model = Model(n, v, rest_total)
    tuning = (resolved.mapInArrow(ratio_histogram(spark.sparkContext.broadcast(model)), "level long, ratio long, n long")
              .groupBy("level", "ratio").agg(F.sum("n").alias("n")).collect())  # at most LEVELS * 2 * MAX_BIN rows
    model.weights = fit_weights([tuple(r) for r in tuning])

    level = lowest_level(hist, max_words, False)
    words = counted.where((F.col("order") == 1) & (F.col("items") > 0)).select("keys", "counts")
    top = words.mapInArrow(frequent_words(level, True), "key long, count long").toArrow()  # at most max_words rows
    keys, counts = top.column("key").to_numpy().view(np.uint64), top.column("count").to_numpy()
    by_key = np.argsort(keys)
    frequent = (keys[by_key], np.log10(counts[by_key] + 1.0))

    scored = materialise(
        resolved.mapInArrow(scorer(spark.sparkContext.broadcast(model), spark.sparkContext.broadcast(frequent)),
                    f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, log_counts double, score double, "
                    "rare array<long>, rare_n array<long>")
        .withColumn("uid", F.monotonically_increasing_id()))
    rare_words = words.mapInArrow(frequent_words(level, False), "key long, count long")
    rare = (scored.select("uid", F.explode(F.arrays_zip("rare", "rare_n")).alias("r"))
            .select("uid", F.col("r.rare").alias("key"), F.col("r.rare_n").alias("n"))
            .join(rare_words, "key").groupBy("uid")
            .agg(F.sum(F.col("n") * F.log10(F.col("count") + 1.0)).alias("more_log"), F.sum("n").alias("more_known")))
    return scored.join(rare, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("log_counts") + F.coalesce("more_log", F.lit(0.0)) - F.col("n_tokens") * math.log10(n + v + 1)).alias("base_score"),
        "score")
