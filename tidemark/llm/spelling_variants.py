"""Spelling variant grouping by a bit-sliced position index.

The vocabulary (counted words of at least ``MIN_LETTERS`` code points) is kept as bitsets: for every
(position, letter) one bit per word that has the letter there, for every length one bit per word of it. A query
runs over its letters once and carries four sets of words in whole machine words: those that match without an
error so far, and those that match with one letter replaced (positions aligned), one letter too many in the query
(positions shifted back) or one too few (positions shifted on). At the end the sets are cut to their lengths. All
queries of one length advance together. Words are numbered by falling count and then by code points, so a
query's best neighbour is the first bit of its set and the number of neighbours is the set's popcount: pairs of
words are never listed.

One error leaves the first three or the last three code points of both words as they are (they have at least
six), so a word enters the index of its first three and that of its last three: two rows a word, whatever the
vocabulary. Pairs that share both ends count in the first index only. An index of more than ``BLOCK`` words is
split into blocks that meet each other one by one: every task's work is bounded, no pair is lost.

Defined results: a null text has no words, a null doc_id counts as the empty text in the hash; repeated rows
count each; ties of count go to the first word in code-point order; a word without near words has form NULL,
n_near 0 and itself as root; a table without words gives an empty result. Texts are read whole. Other columns are
not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import binary_list, materialise

# The contract's letters (A-Z are lower-cased before), shortest word, fewest occurrences, share of
# runs that lose a letter, and how many times as frequent a form is as its variant.
MIN_LETTERS, MIN_COUNT, DROP_EVERY, TIMES = 6, 5, 199, 5
RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % MIN_LETTERS)
END = 3  # letters of the two partial keys; 2 * END <= MIN_LETTERS
BLOCK = 8192
QUERIES = 512  # queries that advance together
FLUSH = 500_000


def run_counts(doc_id, text: bytes) -> Iterator[tuple[str, int]]:
    """Results of a text's runs that are long enough, with their occurrences. Shorter runs cannot become longer."""
    for run, n in Counter(RUN.findall(text.lower().decode("utf-8", "replace"))).items():  # bytes.lower(): A-Z only
        h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
        if h % DROP_EVERY == 0:
            p = h % len(run)
            run = run[:p] + run[p + 1:]
            if len(run) < MIN_LETTERS:
                continue
        yield run, n


def counter(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
        counts.clear()
        return out

    for b in it:
        for d, t in zip(b.column(0).to_pylist(), binary_list(b.column(1)), strict=True):
            if t:
                for w, n in run_counts(d, t):
                    counts[w] += n
            if len(counts) > FLUSH:
                yield flush()
    yield flush()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all rows, n at least ``MIN_COUNT``."""
    parts = docs.select("doc_id", "text").mapInArrow(counter, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


class PositionIndex:
    """Bitsets over words, given best first."""

    def __init__(self, words: list[str]):
        self.size = len(words)
        self.width = -(-len(words) // 64) or 1
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.positions = int(self.lengths.max(initial=0))
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.alphabet = np.unique(points)
        bit = np.repeat(np.arange(self.size), self.lengths)
        place = np.arange(len(points)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        # the last letter row stays empty: letters that no word has; two more positions for the shifts
        self.sets = np.zeros((self.positions + 2, len(self.alphabet) + 1, self.width), np.uint64)
        np.bitwise_or.at(self.sets, (place, np.searchsorted(self.alphabet, points), bit >> 6), one_bit(bit))
        self.of_length = np.zeros((self.positions + 3, self.width), np.uint64)
        np.bitwise_or.at(self.of_length, (self.lengths, np.arange(self.size) >> 6), one_bit(np.arange(self.size)))

    def letters(self, queries: list[str]) -> np.ndarray:
        """Queries of one length as rows of letter numbers."""
        points = np.frombuffer("".join(queries).encode("utf-32-le"), np.uint32).reshape(len(queries), -1)
        at = np.searchsorted(self.alphabet, points)
        at[at == len(self.alphabet)] = 0
        return np.where(self.alphabet[at] == points, at, len(self.alphabet)) if len(self.alphabet) else np.zeros(points.shape, np.int64)

    def length_set(self, n: int) -> np.ndarray:
        return self.of_length[n] if 0 <= n <= self.positions else np.zeros(self.width, np.uint64)

    def at(self, place: int, letters: np.ndarray) -> np.ndarray:
        """Per query the words that have its letter at this position; none outside the index."""
        if not 0 <= place < len(self.sets):
            return np.zeros((len(letters), self.width), np.uint64)
        return self.sets[place, letters]

    def one_error(self, queries: list[str]) -> np.ndarray:
        """Per query (all of one length) the set of words at exactly one error."""
        q = self.letters(queries)
        m = q.shape[1]
        exact = np.full((len(queries), self.width), ~np.uint64(0))
        replaced, longer, shorter = (np.zeros_like(exact) for _ in range(3))
        for i in range(m):
            here = self.at(i, q[:, i])
            back = self.at(i - 1, q[:, i]) if i else np.zeros_like(here)
            on = self.at(i + 1, q[:, i])
            replaced = (replaced & here) | (exact & ~here)
            longer = (longer & back) | exact          # the query's letter i is the one too many
            shorter = (shorter | exact) & on          # the word has one more before the query's letter i
            exact = exact & here
        shorter |= exact                              # or after the last one
        return (replaced & self.length_set(m)) | (longer & self.length_set(m - 1)) | (shorter & self.length_set(m + 1))

    def sharing(self, queries: list[str], n: int) -> np.ndarray:
        """Per query the words that begin with its first ``n`` letters."""
        q = self.letters(queries)
        out = np.full((len(queries), self.width), ~np.uint64(0))
        for i in range(n):
            out &= self.at(i, q[:, i])
        return out


def one_bit(k: np.ndarray) -> np.ndarray:
    return np.uint64(1) << (k & 63).astype(np.uint64)


def first_bit(sets: np.ndarray) -> np.ndarray:
    """Number of the lowest bit of each row; rows must not be empty."""
    word = (sets != 0).argmax(axis=1)
    w = sets[np.arange(len(sets)), word]
    return word * 64 + np.bitwise_count((w & (~w + np.uint64(1))) - np.uint64(1)).astype(np.int64)


def near_words(queries: list[str], words: list[str], skip_same_start: bool) -> Iterator[tuple[int, int, int]]:
    """(query number, near words, best near word's number) of the queries that have any; ``words`` best first."""
    index = PositionIndex(words)
    by_length: dict[int, list[int]] = {}
    for k, q in enumerate(queries):
        by_length.setdefault(len(q), []).append(k)
    for ks in by_length.values():
        for i in range(0, len(ks), QUERIES):
            some = ks[i:i + QUERIES]
            texts = [queries[k] for k in some]
            found = index.one_error(texts)
            if skip_same_start:
                found &= ~index.sharing(texts, END)
            hit = np.flatnonzero(found.any(axis=1))
            if len(hit):
                n = np.bitwise_count(found[hit]).sum(axis=1)
                for h, c, b in zip(hit.tolist(), n.tolist(), first_bit(found[hit]).tolist(), strict=True):
                    yield some[h], c, b


def search(key: tuple, table: pa.Table) -> pa.Table:
    """One index and its queries: per query the number of near words and the best of them."""
    n = table.column("n").to_numpy()
    words = table.column("word").to_pylist()
    is_word, is_query = (table.column(c).to_numpy(zero_copy_only=False) for c in ("is_word", "is_query"))
    order = sorted(np.flatnonzero(is_word).tolist(), key=lambda k: (-n[k], words[k]))
    queries = [words[k] for k in np.flatnonzero(is_query)]
    rows = [(queries[q], c, int(n[order[b]]), words[order[b]])
            for q, c, b in near_words(queries, [words[k] for k in order], key[0].as_py() == "last")]
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.table([pa.array(x, k) for x, k in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                    names=["word", "n_near", "form_n", "form"])


def index_rows(words: DataFrame, block: int) -> DataFrame:
    """Rows (side, letters, query block, word block, word, n, is_word, is_query): in an index of one block each word
    once, as both; in a larger one each word of a block meets the queries of every block and the other way round."""
    # built-in functions count UTF-8 characters: code points
    ends = words.select("word", "n", F.explode(F.array(
        F.struct(F.lit("first").alias("side"), F.substring("word", 1, END).alias("letters")),
        F.struct(F.lit("last").alias("side"), F.substring("word", -END, END).alias("letters")))).alias("e")).select("word", "n", "e.*")
    sizes = ends.groupBy("side", "letters").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    keyed = ends.join(sizes, ["side", "letters"]).withColumn("own", F.pmod(F.xxhash64("word"), "blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    base = ["side", "letters", "word", "n"]
    one = keyed.where("blocks = 1").select(*base, F.lit(0).cast("long").alias("qb"), F.lit(0).cast("long").alias("wb"),
                                           F.lit(True).alias("is_word"), F.lit(True).alias("is_query"))
    large = keyed.where("blocks > 1")
    as_query = large.select(*base, F.col("own").alias("qb"), other.alias("wb"), F.lit(False).alias("is_word"), F.lit(True).alias("is_query"))
    as_word = large.select(*base, other.alias("qb"), F.col("own").alias("wb"), F.lit(True).alias("is_word"), F.lit(False).alias("is_query"))
    return one.unionByName(as_query).unionByName(as_word)


def forms(words: DataFrame, block: int = BLOCK, times: int = TIMES) -> DataFrame:
    """word, n, n_near, form and form_n of every row of (word, n)."""
    found = (index_rows(words, block).groupBy("side", "letters", "qb", "wb")
             .applyInArrow(search, "word string, n_near long, form_n long, form string"))
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                     F.min_by(F.struct("form", "form_n"), F.struct(-F.col("form_n"), F.col("form"))).alias("b"))
    kept = F.col("b.form_n") >= times * F.col("n")
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(kept, F.col("b.form")).alias("form"), F.when(kept, F.col("b.form_n")).alias("form_n"))


def with_roots(rows: DataFrame) -> DataFrame:
    """``root``: from word, forms are followed to the last one. Each round replaces the end reached by that end's
    own end, so a chain of k forms takes log2(k) rounds (a form is ``TIMES`` as frequent: chains are short)."""
    ends = materialise(rows.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    while True:
        on = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ends = materialise(ends.select("word", "root").join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if ends.where("moved").isEmpty():
            return rows.join(ends.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def group_variants(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word."""
    rows = materialise(forms(materialise(word_counts(docs)), block))
    return with_roots(rows).select("word", "form", "root", "n", "n_near", "form_n")
