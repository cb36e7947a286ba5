"""Secret scan with corpus-wide ownership frequency; DataFrame functions only.

Pattern matches become spans without any Python: a text split at a pattern and the pattern's matches
are aligned, and running lengths give the offsets. Every candidate's value is hashed and counted over
the whole corpus by the distinct owners (``owner``) and repositories (``repo``) it appears in. A value
of at most ``max_owners`` owners is owner-specific and looks live; one that more owners hold is a
widely copied example. The method's own candidates (long mixed-case tokens with digits that no base
pattern touches) become spans only when they are owner-specific; base spans always stay. A text's spans are put together in blocks, so a text of very many
matches costs little more a match than a short one.

Frequencies are two partial aggregates, so a value that a third of all documents hold is summed before
it is shuffled; only spans, never texts, are written and joined.

Defined results: null texts are empty; a document without spans has an empty span list; a null owner or
repo is one owner or repo of its own; repeated rows are reported each and count once as a repo; other
columns are not read by ``scan`` and pass through ``redact``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

# The base patterns of the contract. A hex run of 24+ and an access key of 20+ characters are
# matched by length at once, since a shorter match never hides a longer one; an assignment has to be matched
# whole and its value's length tested, since a failing match hides what it covers.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
GENERIC = r"[A-Za-z0-9+/_=-]{32,}"
LEAST_ASSIGN = 6
KINDS = ["assign", "access", "hex", "generic"]  # by rank
MARK = "[SECRET]"
BLOCK = 256  # spans of one text that are put together at a time


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def blocks(items: Column) -> Column:
    """``items`` cut into arrays of ``BLOCK``, so that appending copies a block and not all of a long text's spans."""
    def cut(xs: Column) -> Column:
        firsts = F.filter(F.sequence(F.lit(1), F.size(xs) + 1, F.lit(BLOCK)), lambda i: i <= F.size(xs))
        return F.transform(firsts, lambda i: F.slice(xs, i, F.lit(BLOCK)))

    return let(items, cut)


def matches(text: Column, pattern: str, value_group: int, rank: int) -> Column:
    """array<struct<start, rank, end, value>> of a pattern's non-overlapping matches, in order."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else whole
    between = F.transform(F.split(text, pattern, -1), F.length)
    steps = F.arrays_zip(whole.alias("w"), value.alias("v"), F.slice(between, 1, F.size(whole)).alias("b"))
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,value:string>>")

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["b"]
        end = begin + F.length(x["w"])
        one = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), x["v"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    def block(acc: Column, xs: Column) -> Column:
        """One block after the others: its spans grow an array of their own, kept as one element."""
        inner = F.aggregate(xs, F.struct(acc["at"].alias("at"), empty.alias("out")), step)
        return let(inner, lambda done: F.struct(
            done["at"].alias("at"), F.concat(acc["out"], F.array(done["out"])).alias("out")))

    start = F.struct(F.lit(0).alias("at"), F.array(empty).alias("out"))
    found = F.aggregate(blocks(steps), start, block, lambda acc: F.flatten(acc["out"]))
    return F.when(text.rlike(pattern), found).otherwise(empty)


def base_spans(text: Column) -> Column:
    assign = F.filter(matches(text, ASSIGN, 2, 0), lambda s: F.length(s["value"]) >= LEAST_ASSIGN)
    return F.array_sort(F.concat(assign, matches(text, ACCESS, 0, 1), matches(text, HEX, 0, 2)))


def extra_candidates(text: Column, base: Column) -> Column:
    """Long tokens with a small and a capital letter and a digit that touch no base span. ``base`` is sorted by
    start; its blocks are left out by their bounds before their spans are compared."""
    bounds = F.transform(blocks(base), lambda b: F.struct(
        F.element_at(b, 1)["start"].alias("start"), F.array_max(F.transform(b, lambda s: s["end"])).alias("end"), b.alias("spans")))

    def touches(s: Column, other: Column) -> Column:
        return (other["start"] < s["end"]) & (s["start"] < other["end"])

    return let(bounds, lambda held: F.filter(matches(text, GENERIC, 0, 3), lambda s: (
        s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]") & s["value"].rlike("[0-9]")
        & ~F.exists(held, lambda r: touches(s, r) & F.exists(r["spans"], lambda b: touches(s, b))))))


def hashed(spans: Column) -> Column:
    """Spans with the hash of their value in place of the value: secrets are not written anywhere."""
    return F.transform(spans, lambda s: F.struct(
        s["start"], s["rank"], s["end"], F.sha2(s["value"], 256).alias("hash")))


def candidates(docs: DataFrame, repo: str, owner: str) -> DataFrame:
    """doc_id, key, base and extra spans of every row, written once to the shared folder."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(
        F.col("doc_id"), F.col(repo).cast("string").alias("repo"), F.col(owner).cast("string").alias("owner"),
        F.xxhash64(text).alias("text_hash"), text.alias("t")).withColumn("base_raw", base_spans(F.col("t")))
    found = found.select("doc_id", "repo", "owner", "text_hash", hashed(F.col("base_raw")).alias("base"),
                         hashed(extra_candidates(F.col("t"), F.col("base_raw"))).alias("extra"))
    return materialise(found.withColumn("uid", F.monotonically_increasing_id()))


def ownership(found: DataFrame) -> DataFrame:
    """hash, n_owners, n_repos over the whole corpus."""
    each = found.select("repo", "owner", F.explode(F.array_distinct(F.transform(
        F.concat("base", "extra"), lambda s: s["hash"]))).alias("hash"))
    per_repo = each.groupBy("hash", "owner", "repo").agg(F.lit(1).alias("one"))
    per_owner = per_repo.groupBy("hash", "owner").agg(F.sum("one").alias("repos"))
    return per_owner.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"))


def judged(docs: DataFrame, repo: str, owner: str, max_owners: int) -> DataFrame:
    """Every row's base spans, its owner-specific extra spans and all its owner-specific spans (live)."""
    found = candidates(docs, repo, owner)
    own = ownership(found).where(F.col("n_owners") <= max_owners).select("hash")
    spans = found.select("uid", F.explode(F.concat("base", "extra")).alias("s")).select("uid", "s", F.col("s.hash").alias("hash"))
    live = spans.join(own, "hash").groupBy("uid").agg(F.array_sort(F.collect_list("s")).alias("live"))
    none = F.array().cast(found.schema["base"].dataType)
    return (found.join(live, "uid", "left").withColumn("live", F.coalesce("live", none))
            .withColumn("all", F.array_sort(F.concat("base", F.filter("live", lambda s: s["rank"] == 3)))))


def joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["rank"] + 1), s["start"], s["end"])), ",")


def scan(docs: DataFrame, repo: str = "doc_id", owner: str = "source", max_owners: int = 2) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live and n_copied of every row."""
    rows = judged(docs, repo, owner, max_owners)
    count = lambda r: F.size(F.filter("base", lambda s: s["rank"] == r)).cast("long")
    return rows.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("all")).alias("spans"),
        F.size("live").cast("long").alias("n_live"), (F.size("all") - F.size("live")).cast("long").alias("n_copied"))


def redact(docs: DataFrame, repo: str = "doc_id", owner: str = "source", max_owners: int = 2) -> DataFrame:
    """All rows and columns of ``docs``; owner-specific spans are replaced in the text, widely copied ones stay.

    Rows without any candidate pass straight through; only the others meet their spans in a join.
    """
    decided = (judged(docs, repo, owner, max_owners).where(F.size("live") > 0)
               .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("live").alias("__live"))
               .dropDuplicates(["__id", "__hash"]))
    text = F.coalesce(F.col("text"), F.lit(""))
    may = text.rlike(ASSIGN) | text.rlike(ACCESS) | text.rlike(HEX) | text.rlike(GENERIC)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        ahead = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        new = F.struct(s["end"].alias("at"), F.concat(acc["out"], ahead, F.lit(MARK)).alias("out"))
        longer = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        return F.when(s["start"] >= acc["at"], new).otherwise(longer)

    rest = lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text")))
    clean = F.when(F.col("__live").isNotNull(), F.aggregate("__live", start, step, rest)).otherwise(F.col("text"))
    met = docs.where(may).join(decided, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__hash")), "left")
    met = met.withColumn("__text", clean)
    out = []
    for c in docs.columns:
        if c == "text":
            out.append(F.col("__text").alias(c))
        elif c == "n_chars":
            out.append(F.when(F.col("__live").isNotNull(), F.length("__text").cast(docs.schema[c].dataType))
                       .otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return docs.where(~may).unionByName(met.select(*out))


def _sql_spans(kind: str, rank: int, pattern: str, group: int, keep: str) -> str:
    p = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, source, '{kind}' AS kind, {rank} AS rank, v[i] AS value,
         CAST(list_sum(list_transform(b[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(w[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS s,
         length(w[i]) AS n
  FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM (
    SELECT doc_id, source, regexp_extract_all(t, '{p}', 0) AS w, regexp_extract_all(t, '{p}', {group}) AS v,
           string_split_regex(t, '{p}') AS b FROM d))
  WHERE {keep}"""


_ASSIGN_SQL = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
_ASSIGN_SQL = f"""({_ASSIGN_SQL})["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
base AS ({_sql_spans('assign', 0, _ASSIGN_SQL, 2, f'length(v[i]) >= {LEAST_ASSIGN}')}
  UNION ALL {_sql_spans('access', 1, ACCESS, 0, 'true')}
  UNION ALL {_sql_spans('hex', 2, HEX, 0, 'true')}),
gen AS ({_sql_spans('generic', 3, GENERIC, 0, "regexp_matches(v[i], '[a-z]') AND regexp_matches(v[i], '[A-Z]') AND regexp_matches(v[i], '[0-9]')")}),
cand AS (
  SELECT * FROM base UNION ALL
  SELECT * FROM gen g WHERE NOT EXISTS (
    SELECT 1 FROM base b WHERE b.doc_id = g.doc_id AND b.s < g.s + g.n AND g.s < b.s + b.n)),
own AS (SELECT value FROM cand GROUP BY value HAVING count(DISTINCT coalesce(source, chr(1))) <= 2),
judged AS (SELECT c.*, o.value IS NOT NULL AS live FROM cand c LEFT JOIN own o ON c.value = o.value),
per AS (
  SELECT doc_id,
         count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access,
         count(*) FILTER (WHERE rank = 2) AS n_hex,
         string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, rank) FILTER (WHERE rank < 3) AS base_spans,
         string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, rank) FILTER (WHERE rank < 3 OR live) AS spans,
         count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE rank < 3 AND NOT live) AS n_copied
  FROM judged GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN per ON d.doc_id = per.doc_id
"""
