"""URL filter by a ratio of two character language models.

Rules (host, path) judge first; the longest fitting rule wins. What no rule fits is judged by two
variable-order Markov models over the URL's characters, one of accepted and one of rejected URLs.
Both are learned from every URL that a rule decides. A context of up to ``order`` characters is kept
when it holds at least 1/``max_contexts`` of all positions, so at most ``max_contexts`` contexts per
order can exist whatever the corpus (their counts sum to the positions): that bounds the broadcast.
Probabilities interpolate a context with its suffixes (Witten-Bell). The score is the difference of
log-likelihoods divided by the number of characters; the threshold maximises balanced accuracy on
the fifth of the labelled URLs that the models have not seen.

Defined results: a null URL or one without ``://`` has empty host and path, no rule, score 0; with
no labelled URL of one kind the threshold is 0. Repeated rows are judged each; an empty table gives
no rows; other columns of the input are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, binary_list, fold

# The rules of the contract (verdict, host, path).
CONTRACT_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
START, END = b"\x02", b"\x03"
CALIBRATION_FOLDS = 5
BIN = 1e-3  # width of a score bin when the threshold is calibrated
CLIP = 8.0


def url_parts(url: Column) -> dict[str, Column]:
    """rest (after the first ``://``), host and path; empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    return {
        "host": ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)),
        "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
        "rest": ascii_lower(rest),
    }


def rule_column(rules: list[tuple[str, str, str]], host: Column, path: Column, of: str) -> Column:
    """The longest fitting rule's text (``of='rule'``) or verdict; null where none fits."""
    out = F.lit(None).cast("string")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.lit(h + p if of == "rule" else verdict)).otherwise(out)
    return out


def gram_counter(order: int):
    """Batches of (url bytes, label) to counts of each character with each of its contexts."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            counts: dict[bytes, list[int]] = defaultdict(lambda: [0, 0])
            for u, y in zip(binary_list(b.column(0)), b.column(1).to_pylist(), strict=True):
                s = START * order + u + END
                for i in range(order, len(s)):
                    for o in range(order + 1):
                        counts[s[i - o:i + 1]][y] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array([c[1] for c in counts.values()], pa.int64()),
                 pa.array([c[0] for c in counts.values()], pa.int64())], names=["gram", "acc", "rej"])

    return run


class RatioModel:
    """Per context: the back-off term and each seen character's log ratio (accepted over rejected)."""

    def __init__(self, contexts: dict[bytes, dict[int, tuple[int, int]]], order: int):
        self.order = order
        self.table: dict[bytes, tuple[float, dict[int, float]]] = {}
        prob: dict[bytes, dict[int, tuple[float, float]]] = {}
        back: dict[bytes, tuple[float, float]] = {}

        def lower(ctx: bytes, c: int) -> tuple[float, float]:
            scale = [1.0, 1.0]
            while ctx:
                ctx = ctx[1:]
                if ctx not in prob:
                    continue
                if c in prob[ctx]:
                    p = prob[ctx][c]
                    return p[0] * scale[0], p[1] * scale[1]
                scale = [scale[0] * back[ctx][0], scale[1] * back[ctx][1]]
            return scale[0] / 256, scale[1] / 256

        for ctx in sorted(contexts, key=len):
            seen = contexts[ctx]
            n = [sum(v[k] for v in seen.values()) for k in (0, 1)]
            t = [sum(v[k] > 0 for v in seen.values()) for k in (0, 1)]
            back[ctx] = tuple(t[k] / (n[k] + t[k]) if n[k] else 1.0 for k in (0, 1))
            prob[ctx] = {}
            for c, v in seen.items():
                low = lower(ctx, c)
                prob[ctx][c] = tuple((v[k] + t[k] * low[k]) / (n[k] + t[k]) if n[k] else low[k] for k in (0, 1))
            self.table[ctx] = (math.log(back[ctx][0] / back[ctx][1]),
                               {c: math.log(p[0] / p[1]) for c, p in prob[ctx].items()})

    def score(self, u: bytes) -> float:
        if not u:
            return 0.0
        s, total = START * self.order + u + END, 0.0
        for i in range(self.order, len(s)):
            c = s[i]
            for o in range(self.order, -1, -1):
                if (e := self.table.get(s[i - o:i])) is not None:
                    if (d := e[1].get(c)) is not None:
                        total += d
                        break
                    total += e[0]
        return total / (len(u) + 1)


def scorer(model):
    """Scores the first column; passes the others on."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        memo: dict[bytes, float] = {}
        for b in it:
            if len(memo) > 100_000:
                memo.clear()
            scores = []
            for u in binary_list(b.column(0)):
                if u not in memo:
                    memo[u] = m.score(u)
                scores.append(memo[u])
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(scores, pa.float64())],
                                             names=[*b.schema.names[1:], "score"])

    return run


def fit(labelled: DataFrame, order: int, max_contexts: int) -> RatioModel:
    """Models of the training folds of (rest, label): all of them, counted by Spark."""
    train = labelled.where(fold(F.col("rest"), CALIBRATION_FOLDS) != 0)
    positions = train.agg(F.sum(F.octet_length("rest") + 1)).first()[0] or 0
    grams = train.mapInArrow(gram_counter(order), "gram binary, acc long, rej long")
    grams = grams.groupBy("gram").agg(F.sum("acc").alias("acc"), F.sum("rej").alias("rej"))
    split = grams.select(F.expr("substring(gram, 1, octet_length(gram) - 1)").alias("ctx"),
                         F.expr("substring(gram, octet_length(gram), 1)").alias("nxt"), "acc", "rej")
    kept = (
        split.groupBy("ctx").agg(F.sum(F.col("acc") + F.col("rej")).alias("n"),
                                 F.collect_list(F.struct("nxt", "acc", "rej")).alias("seen"))
        .where(F.col("n") * max_contexts >= positions)
        .select("ctx", "seen")
    )
    # At most (order + 1) * max_contexts rows, each with at most 256 characters.
    return RatioModel({bytes(r.ctx): {x.nxt[0]: (x.acc, x.rej) for x in r.seen} for r in kept.collect()}, order)


def calibrate(labelled: DataFrame, model) -> float:
    """The threshold of the best balanced accuracy on the unseen fold; ties nearest to 0."""
    held = labelled.where(fold(F.col("rest"), CALIBRATION_FOLDS) == 0).select("rest", "label")
    clipped = F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), F.col("score")))
    bins = (held.mapInArrow(scorer(model), "label int, score double")
            .groupBy(F.floor(clipped / BIN).alias("bin"), "label").count().collect())
    total = {y: sum(r["count"] for r in bins if r.label == y) for y in (0, 1)}
    if not total[0] or not total[1]:
        return 0.0
    by: dict[int, list[int]] = defaultdict(lambda: [0, 0])
    for r in bins:
        by[r.bin][r.label] += r["count"]
    below, best = [0, 0], (-1.0, 0.0, 0.0)
    for k in sorted({*by, 0}):
        gain = below[0] / total[0] + 1 - below[1] / total[1]
        best = max(best, (gain, -abs(k * BIN), k * BIN))
        below = [below[0] + by[k][0], below[1] + by[k][1]]
    return best[2]


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], order: int = 5,
               max_contexts: int = 20_000) -> DataFrame:
    """page_id, host, path, rule, verdict, score and threshold of every row."""
    parts = url_parts(F.col("url"))
    base = pages.select("page_id", *[c.alias(n) for n, c in parts.items()])
    base = base.select("*", rule_column(rules, F.col("host"), F.col("path"), "rule").alias("rule"),
                       rule_column(rules, F.col("host"), F.col("path"), "verdict").alias("ruled"))
    labelled = base.where(F.col("ruled").isNotNull()).select(
        "rest", (F.col("ruled") == "allow").cast("int").alias("label"))
    model = pages.sparkSession.sparkContext.broadcast(fit(labelled, order, max_contexts))
    threshold = calibrate(labelled, model)
    kinds = {f.name: f.dataType.simpleString() for f in base.schema}
    keep = ["page_id", "host", "path", "rule", "ruled"]
    scored = base.select("rest", *keep).mapInArrow(
        scorer(model), ", ".join(f"{c} {kinds[c]}" for c in keep) + ", score double")
    return scored.select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("score") >= threshold, "allow").otherwise("block")).alias("verdict"),
        "score", F.lit(threshold).alias("threshold"))
