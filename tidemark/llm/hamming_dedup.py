"""Near-duplicate documents by a multi-index Hamming join of MinHash signatures.

1. Sets. Words are cut at white space and lower-cased (A-Z); a document's set holds its distinct
   5-word shingles as 64-bit hashes. Documents of equal sets are one class (exact copies).
2. Signatures. ``HASHES`` minima, each reduced to 16 bits, per class representative.
3. Multi-index. Signatures within ``RADIUS`` differing symbols are split into ``CHUNKS`` chunks. By
   the pigeonhole principle one chunk differs in at most RADIUS // CHUNKS = 1 symbol, so a key per
   chunk and per allowed error position (that symbol left out) brings every such pair together.
   RADIUS is 3.2 standard deviations above the expected distance of a pair of similarity 0.75.
4. Links without all pairs. Each signature meets the smallest member of each of its keys. Round one
   confirms the nearest of them that is within the radius; copies of a text thereby fall into one
   component with a linear number of checks. Round two looks for links between components: signatures
   that such meetings connect form a cluster, whose members meet in blocks that count all intersections
   by matrix products and return one link per joining; members of one key in different clusters are
   compared by signature. No pair within the radius is skipped, and no group is expanded into rows of pairs.
5. Confirmation. Every candidate is confirmed on the full sets (100 * intersection >= 75 * union),
   and confirmed links make the components.

Defined results: fewer than five words are one shingle; null, empty or blank texts have no set, are
linked with nothing and are kept; repeated ids with equal sets share a class and are all kept
(callers that want one row drop the repeats); a null doc_id is in its class but never names a
component unless it is alone (then component_id is null and the row is kept). Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import binary_list, list_array, materialise, mix64, words_of
from tidemark.llm.components import connected_components

SHINGLE = 5
HASHES = 64
RADIUS = 27
CHUNKS = 14
PERCENT = 75
PAIRS_PER_GROUP = 64  # candidate partners that are confirmed together
CACHE = 300_000
BLOCK = 512  # members of a cluster that are compared at once
COLUMNS = 8192  # shingles of an incidence matrix that are multiplied at once


class WordHash(dict):
    """64-bit hashes of words, kept for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(words: list[bytes], hashes: WordHash) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles."""
    if not words:
        return np.array([], np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - SHINGLE + 1)
    acc = np.full(n, len(h) if len(h) < SHINGLE else SHINGLE, np.uint64)
    for i in range(min(SHINGLE, len(h))):
        acc = mix64(acc ^ h[i:i + n]) + np.uint64(i + 1)
    return np.unique(acc)


def minhash(s: np.ndarray) -> np.ndarray:
    """``HASHES`` minima over the set, reduced to 16 bits."""
    with np.errstate(over="ignore"):
        odd = mix64(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
        low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(s), 512):  # in blocks that stay in the cache
            np.minimum(low, (s[i:i + 512, None] * odd).min(axis=0), out=low)
        return (mix64(low) & np.uint64(0xFFFF)).astype(np.int32)


def sign(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text_hash, text) to the set's size, a 128-bit name of the set, and the signature."""
    hashes = WordHash()
    for b in it:
        sizes, names, sigs = [], [], []
        for text in binary_list(b.column(2)):
            s = shingle_set(words_of(text), hashes)
            sizes.append(len(s))
            names.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            sigs.append(minhash(s) if len(s) else np.array([], np.int32))
        flat = np.concatenate(sigs) if sigs else np.array([], np.int32)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()),
             list_array(flat, [len(x) for x in sigs], pa.int32())], names=["doc_id", "text_hash", "n_shingles", "name", "sig"])


def shingles(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text to the name of its set and the full set."""
    hashes = WordHash()
    for b in it:
        sets = [shingle_set(words_of(t), hashes) for t in binary_list(b.column(0))]
        flat = np.concatenate(sets).view(np.int64) if sets else np.array([], np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in sets], pa.binary()),
             list_array(flat, [len(x) for x in sets], pa.int64())], names=["name", "shingles"])


def chunk_bounds() -> list[tuple[int, int]]:
    edges = [round(i * HASHES / CHUNKS) for i in range(CHUNKS + 1)]
    return list(zip(edges, edges[1:], strict=False))


def key_array(sig: Column) -> Column:
    """One key per chunk and left-out symbol; the key hashes the chunk, the position and the other symbols."""
    keys = []
    for c, (lo, hi) in enumerate(chunk_bounds()):
        for skip in range(lo, hi):
            rest = [sig[i] for i in range(lo, hi) if i != skip]
            keys.append(F.xxhash64(F.lit(c), F.lit(skip), *rest))
    return F.array(*keys)


def differing(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x != y).cast("int")), F.lit(0), lambda acc, v: acc + v)


def size_fits(a: Column, b: Column) -> Column:
    """Sets of similarity 0.75 differ in size by at most a quarter."""
    return (F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT)


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar. The set of ``a`` is sent once per group of partners."""
    dealt = pairs.withColumn("part", F.pmod(F.xxhash64("b"), F.greatest(F.lit(1), F.ceil(F.col("n") / PAIRS_PER_GROUP))))
    partners = dealt.join(sets.withColumnRenamed("rep", "b"), "b").select("a", "part", "b", "shingles").toDF("a", "part", "b", "shingles")
    hubs = (dealt.select("a", "part").distinct().join(sets.withColumnRenamed("rep", "a"), "a")
            .select("a", "part", "shingles").toDF("a", "part", "shingles"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        hub = left.column("shingles").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        a, found = left.column("a")[0].as_py(), []
        for b, s in zip(right.column("b").to_pylist(), right.column("shingles"), strict=True):
            other = s.values.to_numpy(zero_copy_only=False)
            both = len(np.intersect1d(hub, other, assume_unique=True))
            if 100 * both >= PERCENT * (len(hub) + len(other) - both):
                found.append(b)
        return pa.table({"a": pa.array([a] * len(found), pa.int64()), "b": pa.array(found, pa.int64())})

    return (hubs.groupBy("a", "part").cogroup(partners.groupBy("a", "part"))
            .applyInArrow(lambda left, right: run(left, right) if left.num_rows and right.num_rows
                          else pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())}),
                          "a long, b long"))


def intersections(a: pa.Table, b: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of the sets of two blocks and of all their intersections, by products of incidence matrices."""
    flat, lens = [], []
    for t in (a, b):
        col = t.column("shingles").combine_chunks()
        flat.append(col.flatten().to_numpy(zero_copy_only=False))
        lens.append(col.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    common = np.intersect1d(np.unique(flat[0]), np.unique(flat[1]), assume_unique=True)
    row, col = [], []
    for f, n in zip(flat, lens, strict=True):
        k = np.minimum(np.searchsorted(common, f), max(0, len(common) - 1))
        hit = common[k] == f if len(common) else np.zeros(len(f), bool)
        row.append(np.repeat(np.arange(len(n)), n)[hit])
        col.append(k[hit])
    both = np.zeros((len(lens[0]), len(lens[1])), np.float32)  # exact: counts stay below 2**24
    for lo in range(0, len(common), COLUMNS):
        m = []
        for r, c, n in zip(row, col, lens, strict=True):
            here = (c >= lo) & (c < lo + COLUMNS)
            x = np.zeros((len(n), min(COLUMNS, len(common) - lo)), np.float32)
            x[r[here], c[here] - lo] = 1
            m.append(x)
        both += m[0] @ m[1].T
    return lens[0], lens[1], both.astype(np.int64)


def block_links(key: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
    """Links between two blocks of a cluster that join components; one link for each joining suffices."""
    found: list[tuple[int, int]] = []
    if a.num_rows and b.num_rows:
        size_a, size_b, both = intersections(a, b)
        ca, cb = a.column("component").to_numpy(), b.column("component").to_numpy()
        link = 100 * both >= PERCENT * (size_a[:, None] + size_b[None, :] - both)
        link &= ca[:, None] != cb[None, :]
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while up.get(x, x) != x:
                x = up[x]
            return x

        ra, rb = a.column("rep").to_numpy(), b.column("rep").to_numpy()
        for i, j in zip(*np.nonzero(link), strict=True):
            x, y = root(int(ca[i])), root(int(cb[j]))
            if x != y:
                up[x] = y
                found.append((int(ra[i]), int(rb[j])))
    cols = list(zip(*found, strict=True)) or [[], []]
    return pa.table({"a": pa.array(cols[0], pa.int64()), "b": pa.array(cols[1], pa.int64())})


def within_clusters(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between the components of each cluster (rep, cluster, component), from all its pairs.

    A cluster is cut into blocks of about BLOCK members: large components have blocks of their own, small
    ones share. Blocks meet in pairs, but for two blocks of one component, so a set is sent once per block.
    """
    sizes = members.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    small = sizes.groupBy("cluster").agg(F.sum(F.when(F.col("n") < BLOCK, F.col("n")).otherwise(0)).alias("rest"))
    plan = sizes.join(small, "cluster")
    cut = lambda n: F.greatest(F.lit(1), F.ceil(n / BLOCK))
    large = F.col("n") >= BLOCK
    block = F.when(large, F.concat_ws("-", F.col("component"), F.pmod(F.xxhash64("rep"), cut(F.col("n"))))).otherwise(
        F.concat_ws("-", F.lit("rest"), F.pmod(F.xxhash64("component"), cut(F.col("rest")))))
    rows = materialise(members.join(plan, ["cluster", "component"]).select(
        "cluster", "rep", "component", block.alias("block"), F.when(large, F.col("component")).alias("own"))
        .join(sets, "rep"))
    blocks = rows.select("cluster", "block", "own").distinct()
    x, y = blocks.alias("x"), blocks.alias("y")
    meets = x.join(y, (F.col("x.cluster") == F.col("y.cluster")) & (F.col("x.block") <= F.col("y.block"))
                   & ~F.coalesce(F.col("x.own") == F.col("y.own"), F.lit(False)))
    meets = materialise(meets.select(F.col("x.cluster").alias("cluster"), F.col("x.block").alias("p"), F.col("y.block").alias("q")))
    names = ["cluster", "p", "q", "rep", "component", "shingles"]
    left = rows.withColumnRenamed("block", "p").join(meets, ["cluster", "p"]).select(names).toDF(*names)
    right = rows.withColumnRenamed("block", "q").join(meets, ["cluster", "q"]).select(names).toDF(*names)
    return left.groupBy("cluster", "p", "q").cogroup(right.groupBy("cluster", "p", "q")).applyInArrow(block_links, "a long, b long")


def with_partner_count(pairs: DataFrame) -> DataFrame:
    return pairs.join(pairs.groupBy("a").agg(F.count("*").alias("n")), "a")


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, class_id, least_id and component (an internal number) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = materialise(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        sign, f"doc_id {kind}, text_hash long, n_shingles long, name binary, sig array<int>"))
    # Classes of equal sets; a class is named by a number of its own, since ids may be null.
    classes = materialise(
        signed.where(F.col("name").isNotNull()).groupBy("name")
        .agg(F.min("doc_id").alias("class_id"), F.first("n_shingles").alias("size"), F.first("sig").alias("sig"))
        .withColumn("rep", F.xxhash64("name", F.lit(7))))

    # Spark sizes exploded keys like the rows they come from (HASHES times too low), a signature like one number, and
    # copies of one signature by their compressed file: without the hints it would send these through the driver.
    keys = classes.select("rep", F.explode(key_array(F.col("sig"))).alias("key")).hint("merge")
    shared = materialise(
        keys.join(keys.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("top"))
                  .where(F.col("hub") != F.col("top")).select("key", "hub"), "key"))
    side = lambda n: classes.select(F.col("rep").alias(n), F.col("size").alias(f"size_{n}"), F.col("sig").alias(f"sig_{n}")).hint("merge")
    star = shared.where(F.col("rep") != F.col("hub")).select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    near = materialise(
        star.join(side("a"), "a").join(side("b"), "b").where(size_fits(F.col("size_a"), F.col("size_b")))
        .withColumn("far", differing(F.col("sig_a"), F.col("sig_b"))).where(F.col("far") <= RADIUS).select("a", "b", "far"))
    best = near.groupBy("b").agg(F.min(F.struct("far", "a")).alias("m")).select(F.col("m.a").alias("a"), "b")
    first = materialise(best)

    links = materialise(confirm(with_partner_count(first), set_table(docs, classes, ends(first))))
    labels = connected_components(links)

    # Round two, within clusters of near signatures: all members meet in blocks, on their full sets.
    clusters = connected_components(near.select("a", "b"))
    members = (clusters.withColumnRenamed("component", "cluster").join(labels, "node", "left")
               .select(F.col("node").alias("rep"), "cluster", F.coalesce("component", "node").alias("component")))
    split = members.groupBy("cluster").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi")
    unsettled = materialise(members.join(split.select("cluster"), "cluster"))
    inside = within_clusters(unsettled, set_table(docs, classes, unsettled.select("rep")))

    # Round two, between clusters: members of one key whose signatures are near.
    part = (shared.join(clusters.withColumnRenamed("node", "rep"), "rep", "left")
            .select("key", "rep", F.coalesce("component", "rep").alias("cluster")))
    mixed = part.groupBy("key").agg(F.min("cluster").alias("lo"), F.max("cluster").alias("hi")).where("lo != hi").select("key")
    open_rows = materialise(part.join(mixed, "key").join(classes.select("rep", "size", "sig").hint("merge"), "rep"))
    x, y = open_rows.alias("x").hint("merge"), open_rows.alias("y")
    between = materialise(
        x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.cluster") != F.col("y.cluster"))
               & (F.col("x.rep") < F.col("y.rep")) & size_fits(F.col("x.size"), F.col("y.size"))
               & (differing(F.col("x.sig"), F.col("y.sig")) <= RADIUS))
        .select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct())
    across = confirm(with_partner_count(between), set_table(docs, classes, ends(between)))
    labels = connected_components(links.unionByName(inside).unionByName(across))

    # The component's name is the smallest id of its classes.
    named = (classes.select("name", "rep", "class_id").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
             .withColumn("component", F.coalesce("component", "rep")))
    least = named.groupBy("component").agg(F.min("class_id").alias("least_id"))
    final = named.join(least, "component").select("name", "class_id", "least_id", "component")
    return signed.select("doc_id", "text_hash", "n_shingles", "name").join(final, "name", "left").drop("name")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and class_id (the smallest id with the same set) of every row."""
    component = F.coalesce("least_id", "doc_id")
    return grouped(docs).select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"),
        F.coalesce("class_id", "doc_id").alias("class_id"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows and columns of ``docs``, one row of each group: that of the smallest id (null last), then text hash."""
    found = materialise(grouped(docs).where(F.col("component").isNotNull()).select("doc_id", "text_hash", "component"))
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    first = found.groupBy("component").agg(F.min(key).alias("first"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    keys = [F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")]
    losers = found.join(first, "component").where(key != F.col("first")).select(*keys).distinct()
    rest = docs.join(losers, same, "left_anti")
    repeated = materialise(found.groupBy("doc_id", "text_hash").count().where("count > 1").select(*keys))
    if not repeated.limit(1).count():
        return rest
    once = rest.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return rest.join(repeated, same, "left_anti").unionByName(once)


def ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct()


def set_table(docs: DataFrame, classes: DataFrame, reps: DataFrame) -> DataFrame:
    """(rep, shingles) of the classes in ``reps``, made again from one document of each class."""
    wanted = materialise(classes.join(reps, "rep").select("rep", "name", F.col("class_id").alias("doc_id")))
    rows = docs.select("doc_id", "text")
    texts = rows.join(wanted.select("doc_id").where("doc_id is not null").distinct(), "doc_id", "left_semi").select("text")
    if wanted.where("doc_id is null").limit(1).count():  # classes of documents without ids
        texts = texts.unionByName(rows.where("doc_id is null").select("text"))
    # Ids may repeat with other texts: the name of the set decides.
    made = texts.mapInArrow(shingles, "name binary, shingles array<long>").join(wanted.select("rep", "name"), "name")
    return materialise(made.select("rep", "shingles").dropDuplicates(["rep"]))
