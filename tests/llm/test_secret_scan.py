import hashlib
import re

from tidemark.llm import secret_scan as ss

SCHEMA = "doc_id long, text string, source string, n_chars long, hash string, spans string"
KEY = "Zx9" + "aB3dE6gH" * 5
TEXTS = [
    None, "", "nothing here", "password=hunter2secret", "PassWord : 'abcdef'", "token=abc", "password=token:abcdefgh",
    "api_key=\"x1y2z3\" apikey: 123456 token==abcdef", "AKIA" + "A1" * 8 + " AKIA123 AKIAAKIA" + "B" * 12,
    "x" + "0123456789abcdef" * 2 + "y DEADBEEF" + "a" * 24, "é😀 secret=äöü secret=abc123😀", "secret=" + "f" * 30,
    "a" * 24 + "\n" + "b" * 23, "token: token: token: abcdef", f"look {KEY} here", "\x01\x02 passwd=\"abcdef", "key " + "ab" * 40_000,
]


def brute(t):
    t = t or ""
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


def df(spark, texts, sources=None):
    rows = [(i, t, (sources or ["s"] * len(texts))[i], len(t or ""), "h", "z") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def test_base_spans_against_re(spark):
    got = {r.doc_id: r for r in ss.scan(df(spark, TEXTS)).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        want = brute(t)
        joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in want)
        r = got[i]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x[1] == k for x in want) for k in range(3)], t
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), t
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))


def test_very_many_matches_in_one_text(spark):
    """More matches than a block holds, generic tokens apart from and inside base spans."""
    parts = []
    for i in range(6000):
        own = f"{i:05d}aB" + "Q" * 30
        parts.append([f"{i * 7919:032x}", own, f"token={own}", f"AKIA{i:020d}"][i % 4])
    text = "\n".join(parts)
    base = brute(text)
    free = []
    taken = [(a, b) for a, _, _, b in base]
    at = 0
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{32,}", text):
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        if re.search("[a-z]", m[0]) and re.search("[A-Z]", m[0]) and re.search("[0-9]", m[0]) and not (
                at < len(taken) and taken[at][0] < m.end()):
            free.append((m.start(), 3, "generic", m.end()))
    assert len(base) == 4500 and len(free) == 1500
    rows = ss.scan(df(spark, [text])).collect()
    assert rows[0].spans == ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(base + free))
    for n in (1, ss.BLOCK - 1, ss.BLOCK, ss.BLOCK + 1, 2 * ss.BLOCK):
        short = "x".join(["AKIA" + "A1" * 8 + "."] * n)
        want = ",".join(f"{k}:{a}:{b}" for a, _, k, b in brute(short))
        assert ss.scan(df(spark, [short])).collect()[0].spans == want


def test_owner_specific_and_widely_copied(spark):
    texts = [f"own {KEY}q"] + [f"sample {KEY} and token=examplekey"] * 4
    got = {r.doc_id: r for r in ss.scan(df(spark, texts, ["a", "a", "b", "c", None])).collect()}
    assert got[0].spans == f"generic:4:{4 + len(KEY) + 1}" and got[0].n_live == 1
    for i in range(1, 5):
        assert "generic" not in got[i].spans and "assign" in got[i].spans and (got[i].n_live, got[i].n_copied) == (0, 1)


def test_redaction_keeps_rows_columns_and_examples(spark):
    texts = ["a password=hunter2secret b", "token=examplekey", "token=examplekey", "token=examplekey", None, "plain",
             "secret=" + "e" * 30 + " tail", "é😀 secret=abc123 z", "a password=hunter2secret b"]
    out = ss.redact(df(spark, texts, ["a", "a", "b", "c", "a", "a", "a", "a", "a"]))
    assert out.columns == ["doc_id", "text", "source", "n_chars", "hash", "spans"]
    got = {r.doc_id: r for r in out.collect()}
    assert [got[i].text for i in range(9)] == [
        "a [SECRET] b", "token=examplekey", "token=examplekey", "token=examplekey", None, "plain", "[SECRET] tail",
        "é😀 [SECRET] z", "a [SECRET] b"]
    assert got[0].n_chars == len("a [SECRET] b") and got[5].n_chars == 5


def test_repeated_rows_empty_table_and_null_ids(spark):
    rows = [(1, "token=abcdef", "s", 1, "", ""), (1, "token=abcdef", "s", 1, "", ""), (None, "token=abcdef", None, 1, "", "")]
    d = spark.createDataFrame(rows, SCHEMA)
    assert [r.spans for r in ss.scan(d).collect()] == ["assign:0:12"] * 3
    assert [r.text for r in ss.redact(d).collect()] == ["[SECRET]"] * 3
    assert ss.scan(spark.createDataFrame([], SCHEMA)).collect() == [] == ss.redact(spark.createDataFrame([], SCHEMA)).collect()


def test_plan_is_native(spark):
    plan = ss.scan(df(spark, TEXTS[:3]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
