"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last ``WINDOW`` bytes cuts a text wherever the hash ends in k zero bits (block size
2**k): whether a byte is a cut depends on its neighbourhood alone, so an edit moves only the cuts near it.
Each piece becomes one symbol of ``SYMBOL_BITS`` bits, two letters in the written form. The block size of a
text is the smallest that gives at most ``MAX_PIECES`` pieces, found from the cuts themselves, so a
fingerprint is short whatever the text holds. A fingerprint carries the symbols at its block size and at twice
that; two fingerprints are compared by edit distance at each block size both carry (the best counts), and have
likeness 0 if they share none.

``edited_likeness`` also compares each document with an edited copy of itself, whose tail comes from the next
document in the order of doc_id. Rows are dealt by ranges of (doc_id, hash of the text) and streamed through
their task in order; only the first and the last row of a task meet their neighbours in a second, small join.
One shuffle of the texts, nothing of them reaches the driver.

Defined results: a null text counts as empty, an empty text has fingerprint ``1::`` (likeness 1 to another
empty one, 0 to the rest); a null doc_id comes first in the order; rows of one doc_id follow each other by the
hash of their texts (repeated rows stay, each with its own result); a single row is its own next document; an
empty table gives an empty result. Very long texts are hashed whole, in segments of ``SEGMENT`` bytes. Other
columns of the table are not read, so none can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, mix64

WINDOW = 7
MAX_PIECES = 64
SYMBOL_BITS = 12
SEGMENT = 1 << 20
BASE = 0x01000193  # odd multiplier of the rolling hash, modulo 2**32
LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
TOP_LEVEL = 32


@dataclass
class Fingerprint:
    """``level``: log2 of the block size; ``fine`` and ``coarse``: the symbols at that size and at twice that."""

    level: int
    fine: np.ndarray
    coarse: np.ndarray

    def __str__(self) -> str:
        return f"{1 << self.level}:{written_symbols(self.fine)}:{written_symbols(self.coarse)}"


def written_symbols(symbols: np.ndarray) -> str:
    pair = np.stack([symbols >> 6, symbols & 63], axis=1).ravel()
    return LETTERS[pair].tobytes().decode()


def window_hashes(data: np.ndarray) -> np.ndarray:
    """The mixed hash of the ``WINDOW`` bytes that end at each byte (zeros before the first)."""
    x = np.zeros(len(data) + WINDOW - 1, np.uint32)
    x[WINDOW - 1:] = data
    x[WINDOW - 1:] += np.uint32(1)
    power = [np.uint32(pow(BASE, k, 1 << 32)) for k in range(5)]
    two = x[:-1] * power[1] + x[1:]
    three = two[:-1] * power[1] + x[2:]
    four = two[:-2] * power[2] + two[2:]
    h = four[:-3] * power[3] + three[4:]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(12)
    h *= np.uint32(0x297A2D39)
    h ^= h >> np.uint32(15)
    return h


def segments(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(offset, window hashes) of the text's segments; each reads the bytes before it for its first windows."""
    for at in range(0, len(data), SEGMENT):
        before = min(at, WINDOW - 1)
        yield at, window_hashes(data[at - before:at + SEGMENT])[before:]


def trailing_zeros(h: np.ndarray) -> np.ndarray:
    low = h & (~h + np.uint32(1))
    return np.bitwise_count(low - np.uint32(1)).astype(np.uint8)  # 32 where h is 0


def fingerprint(text: bytes) -> Fingerprint:
    data = np.frombuffer(text, np.uint8)
    n = len(data)
    none = np.empty(0, np.int64)
    if not n:
        return Fingerprint(0, none, none)
    whole = list(segments(data)) if n <= SEGMENT else None  # a long text is hashed twice instead of kept
    zeros = np.empty(n, np.uint8)
    for at, h in whole or segments(data):
        zeros[at:at + len(h)] = trailing_zeros(h)
    cuts_from = np.bincount(zeros, minlength=TOP_LEVEL + 2)[::-1].cumsum()[::-1]
    level = int(np.argmax(cuts_from < MAX_PIECES))  # at most MAX_PIECES - 1 cuts and a tail
    ends = np.flatnonzero(zeros >= level) + 1
    if not len(ends) or ends[-1] != n:
        ends = np.append(ends, n)
    sums, total = np.empty(len(ends), np.uint64), np.uint64(0)
    for at, h in whole or segments(data):
        run = np.cumsum(h, dtype=np.uint64) + total
        inside = slice(*np.searchsorted(ends, [at + 1, at + len(h) + 1]))
        sums[inside] = run[ends[inside] - at - 1]
        total = run[-1]
    wide = (zeros[ends - 1] > level) | (ends == n)
    return Fingerprint(level, symbols_of(sums), symbols_of(sums[wide]))


def symbols_of(sums: np.ndarray) -> np.ndarray:
    """One symbol per piece, from the sum of its window hashes (differences of running sums)."""
    return (mix64(np.diff(sums, prepend=np.uint64(0))) >> np.uint64(64 - SYMBOL_BITS)).astype(np.int64)


def edit_distances(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Edit distance of every pair of symbol strings, all pairs in step: one row of every table at a time."""
    la, lb = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    left, right = np.full((len(a), max(1, la.max(initial=0))), -1), np.full((len(b), max(1, lb.max(initial=0))), -2)
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        left[i, :len(x)], right[i, :len(y)] = x, y
    steps = np.arange(right.shape[1] + 1)
    row = np.broadcast_to(steps, (len(a), len(steps))).copy()
    out = np.where(la == 0, lb, 0)
    for i in range(left.shape[1]):
        new = row + 1
        new[:, 1:] = np.minimum(new[:, 1:], row[:, :-1] + (left[:, i:i + 1] != right))
        row = np.minimum.accumulate(new - steps, axis=1) + steps
        done = np.flatnonzero(la == i + 1)
        out[done] = row[done, lb[done]]
    return out


def likenesses(pairs: list[tuple[Fingerprint, Fingerprint]]) -> np.ndarray:
    """1 - edit distance / length of the longer, the best over the block sizes that both fingerprints carry."""
    owner, a, b = [], [], []
    for k, (x, y) in enumerate(pairs):
        for s, level in ((x.fine, x.level), (x.coarse, x.level + 1)):
            for t, other in ((y.fine, y.level), (y.coarse, y.level + 1)):
                if level == other:
                    owner.append(k)
                    a.append(s)
                    b.append(t)
    out = np.zeros(len(pairs))
    if owner:
        longest = np.array([max(len(s), len(t), 1) for s, t in zip(a, b, strict=True)])
        np.maximum.at(out, owner, 1 - edit_distances(a, b) / longest)
    return out


def edited_text(text: str, following: str) -> str:
    """The last quarter (floor, in code points) replaced by the first as many of the next document, or all it has."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def result_columns(rows: list[tuple[str, Fingerprint]], following: list[tuple[str, Fingerprint]]) -> list[pa.Array]:
    """The result columns of texts, each with the document that follows it."""
    edited = [edited_text(t, u).encode() for (t, _), (u, _) in zip(rows, following, strict=True)]
    prints = [fingerprint(e) for e in edited]
    own, after = [f for _, f in rows], [f for _, f in following]
    near = likenesses(list(zip(own + own, prints + after, strict=True)))
    return [
        pa.array([len(t) for t, _ in rows], pa.int64()),
        pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
        pa.array([str(f) for f in own], pa.string()), pa.array([str(f) for f in prints], pa.string()),
        pa.array(near[:len(rows)], pa.float64()), pa.array(near[len(rows):], pa.float64()),
    ]


NAMES = [c.split()[0] for c in RESULT.split(", ")]
FIRST, LAST = "first", "last"


def neighbours(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one task in order: each is finished when the next one is read. The first row is also handed on as
    ``first`` and the last as ``last``, with their texts, to be joined with those of the other tasks."""
    part = TaskContext.get().partitionId()
    held: list[tuple[object, str, Fingerprint]] = []

    def batch(ids, kind, columns, role=None, texts=None) -> pa.RecordBatch:
        n = len(ids)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, kind), pa.array([part] * n, pa.int32()), pa.array([role] * n, pa.string()),
             pa.array(texts or [None] * n, pa.string()), *columns], names=["doc_id", "part", "role", "text", *NAMES])

    def bare(ids, kind, texts, role) -> pa.RecordBatch:
        return batch(ids, kind, [pa.nulls(len(ids), t) for t in (pa.int64(), pa.string(), pa.string(), pa.string(),
                                                                   pa.float64(), pa.float64())], role, texts)

    kind = None
    for b in it:
        kind = b.column(0).type
        for i in range(0, b.num_rows, 512):
            ids = b.column(0).slice(i, 512).to_pylist()
            texts = [t or "" for t in b.column(1).slice(i, 512).to_pylist()]
            if not held:
                yield bare(ids[:1], kind, texts[:1], FIRST)
            rows = held + [(d, t, fingerprint(t.encode())) for d, t in zip(ids, texts, strict=True)]
            held = rows[-1:]
            if len(rows) > 1:
                pairs = [(t, f) for _, t, f in rows]
                yield batch([d for d, _, _ in rows[:-1]], kind, result_columns(pairs[:-1], pairs[1:]))
    if held:
        yield bare([held[0][0]], kind, [held[0][1]], LAST)


def finish(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, text of the next document), for the last rows of the tasks."""
    for b in it:
        def side(k, b=b):
            texts = b.column(k).to_pylist()
            return [(t, fingerprint(t.encode())) for t in texts]
        yield pa.RecordBatch.from_arrays([b.column(0), *result_columns(side(1), side(2))], names=["doc_id", *NAMES])


def edited_likeness(docs: DataFrame) -> DataFrame:
    """doc_id, the fingerprints of the text and of its edited copy, and their likeness (see above), for every row."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"))
    order = ["doc_id", "h", "row"]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    out = materialise(ranges.mapInArrow(neighbours, f"doc_id {kind}, part int, role string, text string, {RESULT}"))
    # one number per task, at most as many as the shuffle has partitions
    parts = sorted(r.part for r in out.where(F.col("role") == FIRST).select("part").collect())
    after = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1], strict=True)), "part int, following int")
    firsts = out.where(F.col("role") == FIRST).select(F.col("part").alias("following"), F.col("text").alias("next_text"))
    lasts = out.where(F.col("role") == LAST).select("doc_id", "text", "part").join(after, "part").join(firsts, "following")
    ends = lasts.select("doc_id", "text", "next_text").mapInArrow(finish, f"doc_id {kind}, {RESULT}")
    return out.where(F.col("role").isNull()).select("doc_id", *NAMES).unionByName(ends)
