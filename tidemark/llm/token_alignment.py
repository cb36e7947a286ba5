"""Cross-tokenizer alignment by lockstep vectorised merging.

Every text is encoded by two tokenizers. Where a token of A and a token of B end at the same byte, the tokens are
linked and the text is cut into groups. ``merge`` finds these places for all documents of a batch at once: one
NumPy state vector holds a pointer into A's and one into B's tokens per lane; in each step every lane compares the
byte ends under its pointers, emits a link and a cut where they agree, and moves the pointer that lags (or both);
finished lanes are compacted away. A document is one lane, or several where it is long: it is cut at word starts,
where both tokenizers always start a token, so the number of steps is bounded by ``LANE_BYTES``.

Encoding: neither tokenizer has a token that goes on over a single space between two non-space characters (tokens
hold spaces in front of a word only: ``Tokenizers`` checks the vocabulary of B, the split pattern of A ensures
it). So texts are cut there, each distinct piece of a batch is encoded once, and recent pieces are remembered.

Counts: two linked tokens end together, so the bytes of one end with the bytes of the other. The pairs of ids for
which this holds are counted from the vocabularies (``Tokenizers.possible_pairs``): that is the proven bound of
the table of link counts, whatever the corpus. The table is built by a partial aggregate, checked against the
bound and broadcast; above ``max_broadcast_pairs`` possible pairs the counts are joined by shuffle instead.

Defined results: a text that is null or empty, or that either tokenizer does not give back byte by byte, has no
tokens (zeros, ``groups_sha256`` ''). Repeated rows count each; tied counts all count as highest; an empty table
gives an empty result. Very long texts are encoded and merged in stretches of ``STRETCH`` characters (to the next
place where texts may be cut) and never held as one list of tokens. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, materialise

TOKENIZER_DIR = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
STRETCH = 1 << 18  # characters of one text that are encoded at a time
BATCH_CHARS = 1 << 18  # characters that are encoded and merged together
LANE_BYTES = 1024
CACHE = 160_000
ROWS = 512  # rows that are worked on together
AT_ONCE = 4096  # pieces that are encoded together
MAX_BROADCAST_PAIRS = 8_000_000
CUT = re.compile(r"(?<=\S) (?=\S)")
SPACE = "▁"


def byte_decoder() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies: printable bytes for themselves,
    the others in order from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers and the bytes of all their tokens."""

    def __init__(self, folder: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core a task
        import sentencepiece
        from tokenizers import Tokenizer

        path = os.path.join(folder, A_FILE)
        self.a = Tokenizer.from_file(path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, B_FILE))
        decode = byte_decoder()
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, k in vocab.items():
            if all(c in decode for c in token):
                self.a_bytes[k] = bytes(decode[c] for c in token)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        assert not any(SPACE in p.lstrip(SPACE) for p in pieces), "a piece goes on over a space"
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(SPACE, " ").encode()
                        for k, p in enumerate(pieces)]
        self.a_len, self.b_len = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        self.b_flat = np.frombuffer(b"".join(self.b_bytes), np.uint8)
        self.b_at = np.cumsum(self.b_len) - self.b_len
        self.a_text, self.b_text = (number_table(len(x)) for x in (self.a_bytes, self.b_bytes))
        self.forget()

    def forget(self) -> None:
        """The remembered pieces: their numbers, the ids of all of them one after the other, and where each starts."""
        self.known: dict[str, int] = {}
        self.ids = [np.empty(0, np.int32), np.empty(0, np.int32)]
        self.at = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.valid = np.empty(0, bool)

    def encode(self, pieces: list[str]) -> np.ndarray:
        """The numbers of distinct pieces; ``ids``, ``at`` and ``valid`` hold what is known of them."""
        if len(self.known) > CACHE:
            self.forget()
        new = [p for p in pieces if p not in self.known]
        for i in range(0, len(new), AT_ONCE):
            self.learn(new[i:i + AT_ONCE])
        return np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))

    def learn(self, new: list[str]) -> None:
        want = (" " + " ".join(new)).encode()
        size = np.array([len(p.encode()) + 1 for p in new], np.int64)
        # A gives every byte back, so the joined pieces are encoded at once and told apart by their byte ends
        ids_a = np.array(self.a.encode_batch_fast([want.decode()], add_special_tokens=False)[0].ids, np.int32)
        ends = np.cumsum(self.a_len[ids_a])
        stop_a = np.searchsorted(ends, np.cumsum(size)) + 1
        coded = self.b.encode(new, num_threads=1)
        n_b = np.fromiter(map(len, coded), np.int64, len(coded))
        ids_b = np.fromiter(chain.from_iterable(coded), np.int32, int(n_b.sum()))
        stop_b = np.cumsum(n_b)
        # B does not: its bytes are compared with the piece's
        per_token = self.b_len[ids_b]
        got_size = np.diff(np.concatenate([[0], np.cumsum(per_token)])[np.concatenate([[0], stop_b])])
        ok = got_size == size
        token_ok = np.repeat(ok, n_b)
        some, length = ids_b[token_ok], per_token[token_ok]
        got = self.b_flat[np.repeat(self.b_at[some] - (np.cumsum(length) - length), length) + np.arange(length.sum())]
        expected = np.frombuffer(want, np.uint8)[np.repeat(ok, size)]
        owner = np.repeat(np.flatnonzero(ok), size[ok])
        ok[owner[got != expected]] = False
        first = len(self.valid)
        self.known.update(zip(new, range(first, first + len(new)), strict=True))
        self.valid = np.concatenate([self.valid, ok])
        for side, ids, stop in ((0, ids_a, stop_a), (1, ids_b, stop_b)):
            self.at[side] = np.concatenate([self.at[side], stop + len(self.ids[side])])
            self.ids[side] = np.concatenate([self.ids[side], ids])

    def possible_pairs(self) -> int:
        """How many (A id, B id) exist of which one's bytes end with the other's."""
        total = 0
        for long_side, short_side, equal in ((self.a_bytes, self.b_bytes, True), (self.b_bytes, self.a_bytes, False)):
            ids: dict[bytes, int] = {}
            for x in short_side:
                ids[x] = ids.get(x, 0) + 1
            for x in long_side:
                total += sum(ids.get(x[i:], 0) for i in range(0 if equal else 1, len(x)))
        return total


_LOADED: dict[str, Tokenizers] = {}


def load(folder: str) -> Tokenizers:
    """One copy a process."""
    if folder not in _LOADED:
        _LOADED[folder] = Tokenizers(folder)
    return _LOADED[folder]


def number_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0..n-1, left-aligned, with one free byte after them, and their lengths."""
    length = np.array([len(str(k)) for k in range(n)], np.int64)
    out = np.zeros((n, int(length.max(initial=1)) + 1), np.uint8)
    for k in range(n):
        out[k, :length[k]] = np.frombuffer(str(k).encode(), np.uint8)
    return out, length


@dataclass
class Tokens:
    """Tokens of all lanes one after the other: ids, byte ends within the lane, and each lane's first token."""

    ids: np.ndarray
    ends: np.ndarray
    starts: np.ndarray


def merge(a: Tokens, b: Tokens) -> np.ndarray:
    """For every token of A the token of B that ends at the same byte of its lane, else -1.

    In both sequences the ends grow strictly within a lane and every lane's last ends agree.
    """
    partner = np.full(len(a.ids), -1, np.int64)
    i, j = a.starts[:-1].copy(), b.starts[:-1].copy()
    stop = a.starts[1:]
    live = np.flatnonzero(i < stop)
    i, j, stop = i[live], j[live], stop[live]
    while len(i):
        x, y = a.ends[i], b.ends[j]
        met = x == y
        partner[i[met]] = j[met]  # a link, and a cut
        i += x <= y
        j += y <= x
        open_lanes = i < stop
        if not open_lanes.all():
            i, j, stop = i[open_lanes], j[open_lanes], stop[open_lanes]
    return partner


def written_groups(t: Tokenizers, a: Tokens, b: Tokens, partner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of ``a1,a2|b1;...;`` for all tokens in order, and the place after each link's group."""
    linked = np.flatnonzero(partner >= 0)
    to = partner[linked]
    last_a, last_b = np.zeros(len(a.ids), bool), np.zeros(len(b.ids), bool)
    last_a[linked], last_b[to] = True, True
    group_a = np.cumsum(last_a) - last_a  # number of groups that ended before the token
    group_b = np.cumsum(last_b) - last_b
    ends_b = np.concatenate([[0], to + 1])
    place_a = np.arange(len(a.ids)) + ends_b[group_a]
    place_b = np.arange(len(b.ids)) + (linked + 1)[group_b]
    table_a, len_a = t.a_text
    table_b, len_b = t.b_text
    width = max(table_a.shape[1], table_b.shape[1])
    cells = np.zeros((len(a.ids) + len(b.ids), width), np.uint8)
    sizes = np.empty(len(cells), np.int64)
    for tok, place, table, length, last, mark in ((a, place_a, table_a, len_a, last_a, b"|"), (b, place_b, table_b, len_b, last_b, b";")):
        cells[place, :table.shape[1]] = table[tok.ids]
        n = length[tok.ids]
        cells[place, n] = np.where(last, mark[0], ord(","))
        sizes[place] = n + 1
    flat = cells[np.arange(width) < sizes[:, None]]
    after = np.cumsum(sizes)[place_b[to]]
    return flat, after


@dataclass
class Stretch:
    """Part of a document: its pieces; ``last`` marks the document's end."""

    doc: int
    pieces: list[str]
    last: bool


def stretches(texts: list[str | None]) -> Iterator[Stretch]:
    for d, t in enumerate(texts):
        if not t:
            continue
        at = 0
        while len(t) - at > 2 * STRETCH:
            cut = CUT.search(t, at + STRETCH)
            if cut is None:
                break
            yield Stretch(d, CUT.split(t[at:cut.start()]), False)
            at = cut.end()
        yield Stretch(d, CUT.split(t[at:] if at else t), True)


class Document:
    """What is known of a document after its stretches."""

    def __init__(self):
        self.n_a = self.n_b = 0
        self.sha = hashlib.sha256()
        self.links: list[np.ndarray] = []
        self.valid = True

    def add(self, n_a: int, n_b: int, groups: memoryview, links: np.ndarray, last: bool) -> None:
        self.n_a += n_a
        self.n_b += n_b
        self.sha.update(groups[:-1] if last else groups)
        self.links.append(links)


def align(t: Tokenizers, parts: list[Stretch], docs: dict[int, Document]) -> None:
    """Encode and merge stretches together and add them to their documents."""
    flat = [p for s in parts for p in s.pieces]
    coded = pa.array(flat, pa.string()).dictionary_encode()
    word = coded.indices.to_numpy()
    number = t.encode(coded.dictionary.to_pylist())[word]
    part_of = np.repeat(np.arange(len(parts)), np.array([len(s.pieces) for s in parts], np.int64))
    broken = np.zeros(len(parts), bool)
    broken[part_of[~t.valid[number]]] = True
    for k in np.flatnonzero(broken):
        docs[parts[k].doc].valid = False
    keep = ~broken[part_of]
    number, part_of = number[keep], part_of[keep]
    if not len(number):
        return
    sides = []
    for side, length in ((0, t.a_len), (1, t.b_len)):
        first = t.at[side][number]
        n = t.at[side][number + 1] - first
        start = np.concatenate([[0], np.cumsum(n)])
        tokens = t.ids[side][np.repeat(first - start[:-1], n) + np.arange(start[-1])]
        sides.append((tokens, start, np.concatenate([[0], np.cumsum(length[tokens])])))
    # a new lane at each part and wherever LANE_BYTES more bytes of a part have passed; piece starts are cuts of both
    byte_at = sides[0][2][sides[0][1][:-1]]
    part_start = np.searchsorted(part_of, np.arange(len(parts)))
    within = byte_at - byte_at[np.minimum(part_start, len(part_of) - 1)][part_of]
    lane_key = np.stack([part_of, within // LANE_BYTES])
    new_lane = np.concatenate([[0], np.flatnonzero((lane_key[:, 1:] != lane_key[:, :-1]).any(axis=0)) + 1])
    tok = []
    for tokens, start, ends in sides:
        starts = np.concatenate([start[new_lane], [start[-1]]])
        tok.append(Tokens(tokens, ends[1:] - np.repeat(ends[starts[:-1]], np.diff(starts)), starts))
    a, b = tok
    partner = merge(a, b)
    text, after = written_groups(t, a, b, partner)
    linked = np.flatnonzero(partner >= 0)
    codes = a.ids[linked].astype(np.int64) * len(t.b_bytes) + b.ids[partner[linked]]
    bounds = np.searchsorted(part_of, np.arange(len(parts) + 1))  # pieces of each part
    at_a, at_b = sides[0][1][bounds], sides[1][1][bounds]
    at_link = np.searchsorted(linked, at_a)
    at_text = np.concatenate([[0], after])[at_link]
    view = memoryview(text)
    for k, s in enumerate(parts):
        if not broken[k]:
            docs[s.doc].add(int(at_a[k + 1] - at_a[k]), int(at_b[k + 1] - at_b[k]),
                            view[at_text[k]:at_text[k + 1]], codes[at_link[k]:at_link[k + 1]], s.last)


def aligner(folder: str):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = load(folder)
        for whole in it:
            for i in range(0, whole.num_rows, ROWS):
                b = whole.slice(i, ROWS)
                texts = b.column(1).to_pylist()
                docs = {d: Document() for d, x in enumerate(texts) if x}
                held: list[Stretch] = []
                chars = 0
                for s in stretches(texts):
                    held.append(s)
                    chars += sum(map(len, s.pieces))
                    if chars > BATCH_CHARS:
                        align(t, held, docs)
                        held, chars = [], 0
                if held:
                    align(t, held, docs)
                done = [docs[d] if d in docs and docs[d].valid else None for d in range(b.num_rows)]
                links = [np.concatenate(x.links) if x else np.empty(0, np.int64) for x in done]
                off = np.concatenate([[0], np.cumsum([len(x) for x in links])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([x.n_a if x else 0 for x in done], pa.int64()),
                     pa.array([x.n_b if x else 0 for x in done], pa.int64()),
                     pa.array([x.sha.hexdigest() if x else "" for x in done], pa.string()),
                     pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate([*links, np.empty(0, np.int64)]), pa.int64()))],
                    names=["doc_id", "n_a", "n_b", "groups_sha256", "links"])

    return run


def encode_and_align(docs: DataFrame, folder: str = TOKENIZER_DIR) -> DataFrame:
    """doc_id, n_a, n_b, groups_sha256 and the links (A id x number of B ids + B id) in order, of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        aligner(folder), f"doc_id {kind}, n_a long, n_b long, groups_sha256 string, links array<long>")


def pair_counter(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches_of(it, 8 * ROWS):
        pair, n = np.unique(b.column(0).flatten().to_numpy(zero_copy_only=False), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(n, pa.int64())], names=["pair", "n"])


def link_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n): how many links hold each pair of ids, over all rows."""
    return aligned.select("links").mapInArrow(pair_counter, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def summer(table):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = table.value
        for b in batches_of(it, ROWS):
            links = b.column(4)
            n = pc.list_value_length(links).to_numpy().astype(np.int64)
            at = np.searchsorted(pairs, links.flatten().to_numpy(zero_copy_only=False))
            ends = np.concatenate([[0], np.cumsum(n)])
            sums = [np.concatenate([[0], np.cumsum(x[at], dtype=np.int64)]) for x in (best, counts)]
            n_best, total = (s[ends[1:]] - s[ends[:-1]] for s in sums)
            n = pa.array(n, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), n, n, pa.array(n_best, pa.int64()), pa.array(total, pa.int64()), b.column(3)],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return run


def compare_tokenizers(docs: DataFrame, folder: str = TOKENIZER_DIR, max_broadcast_pairs: int = MAX_BROADCAST_PAIRS) -> DataFrame:
    """Per row the numbers of tokens, groups and links, and how its links fare in the whole corpus."""
    t = load(folder)
    kind, n_b = docs.schema["doc_id"].dataType.simpleString(), len(t.b_bytes)
    aligned = materialise(encode_and_align(docs, folder))
    counts = materialise(link_counts(aligned))
    if t.possible_pairs() > max_broadcast_pairs:
        return joined_counts(aligned, counts, n_b)
    found = counts.toArrow()  # at most possible_pairs() rows
    if found.num_rows > t.possible_pairs():
        raise RuntimeError("more linked pairs than the vocabularies allow")
    pairs, n = (found.column(c).to_numpy() for c in ("pair", "n"))
    order = np.argsort(pairs)
    pairs, n = pairs[order], n[order]
    highest = np.zeros(n_b, np.int64)
    np.maximum.at(highest, pairs % n_b, n)
    table = docs.sparkSession.sparkContext.broadcast((pairs, n, n == highest[pairs % n_b]))
    return aligned.mapInArrow(summer(table), f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, "
                                             "n_best long, count_sum long, groups_sha256 string")


def joined_counts(aligned: DataFrame, counts: DataFrame, n_b: int) -> DataFrame:
    """The same by joins: each row's distinct pairs meet their counts, sums go back to the row."""
    rows = materialise(aligned.withColumn("row", F.monotonically_increasing_id()))
    highest = counts.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("n").alias("highest"))
    rated = counts.withColumn("b", F.col("pair") % n_b).join(highest, "b").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))
    held = rows.select("row", F.explode("links").alias("pair")).groupBy("row", "pair").agg(F.count(F.lit(1)).alias("k"))
    sums = held.join(rated, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("n_best"), F.sum(F.col("k") * F.col("n")).alias("count_sum"))
    n = F.size("links").cast("long")
    return rows.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", n.alias("n_groups"), n.alias("n_links"), F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
