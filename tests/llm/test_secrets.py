import re
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from satlake.llm import secrets
from satlake.llm.queries import op2_secret_scan
from tests.llm.helpers import clashing, no_docs, odd_docs, rows
from tests.oracle import both, connect


def brute(text, rules=secrets.RULES):
    out = []
    for k, r in enumerate(rules):
        out += [(m.start(), k, r.kind, m.end()) for m in re.finditer(r.pattern, text) if len(m[r.group]) >= r.least]
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


def spans(r):
    return [(s["kind"], s["start"], s["end"]) for s in r.secrets]


def test_queries_of_rules():
    q = {r.kind: secrets.trigram_query(r.pattern) for r in secrets.RULES}
    assert q["hex"] == secrets.ALWAYS
    assert q["access"] == frozenset([frozenset(["aki", "kia"])])
    assert frozenset(["tok", "oke", "ken"]) in q["assign"] and len(q["assign"]) == 6
    assert len(q["chat"]) == 5 and all(len(q[k]) == 1 for k in ("pem", "cloud", "payment", "jwt")) and all(frozenset() not in x for k, x in q.items() if k != "hex")


@pytest.mark.parametrize("pattern, strings", [("abc(de|fg)?h", ["abch", "abcdeh"]), ("(ab|cd)+xyz", ["ababxyz"]), ("a[bc]d+e", ["abde", "acdde"]), ("(?i:Foo|bar)baz", ["fOObaz", "BARbaz"]), ("x*", [""]), ("^abc$", ["abc"])])
def test_queries_hold_for_matches(pattern, strings):
    for s in strings:
        assert re.search(pattern, s)
        low = s.lower()
        assert any(all(g in low for g in branch) for branch in secrets.trigram_query(pattern))


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(secrets.RULES), st.data())
def test_queries_never_lose_a_match(rule, data):
    s = data.draw(st.from_regex(rule.pattern))
    low = s.lower()
    if re.search(rule.pattern, s):
        assert any(all(g in low for g in branch) for branch in secrets.trigram_query(rule.pattern)) or not s.isascii()


CASES = [
    'token = "abcdef" token=abc token=short1 PassWord : x password="é" secret:"aaaaaa"bbb', "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + " AKIAAKIA" + "C" * 30, "f" * 23 + " " + "0" * 24 + "g" + "a1" * 20,
    "api_key=api_key=abcdefgh apikey:abcdef API-KEY=abcdef", "tokens=abcdef", "🎉🎉 secret = 'xxxxxxx' 🎉 " + "ab" * 20, "token=\ntoken= =abcdef", "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a" * 40 + " sk_live_" + "1" * 20, "", "password",
]


def test_spans(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "doc_id bigint, text string")
    for r in secrets.scan(df).collect():
        assert spans(r) == brute(r.text), r.text


@pytest.mark.parametrize("make", [odd_docs, no_docs])
def test_odd_tables(spark, make):
    df = clashing(make(spark))
    out = secrets.scan(df)
    assert set(out.columns) == {*df.columns, "secrets"}
    got = out.collect()
    assert len(got) == df.count()
    for r in got:
        assert spans(r) == brute(r.text or "")


LONG = "".join(chr(97 + (i * i + i // 26) % 26) for i in range(100))


def test_kept_index_and_long_rules(spark):
    """One index of all trigrams serves rules that come later, one of them with about a hundred mandatory trigrams."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*CASES, f"x {LONG} y", LONG[:99], None, "zzz" * 10])], "doc_id bigint, text string")
    kept = secrets.index(df).cache()
    assert kept.where("gram = 'zzz'").selectExpr("sum(size(postings))").first()[0] == 1
    later = (secrets.Rule("long", LONG), secrets.Rule("z", "z{5}"), secrets.Rule("zz", "zzzzzz"))
    assert len(next(iter(secrets.trigram_query(LONG)))) > 90
    for rules in (later, secrets.RULES):
        with_, without = (secrets.scan(df, rules, postings=p).collect() for p in (kept, None))
        for a, b in zip(sorted(with_, key=lambda r: r.doc_id), sorted(without, key=lambda r: r.doc_id), strict=True):
            assert spans(a) == spans(b) == brute(a.text or "", rules)
    found = {r.key: r.rules for r in secrets.candidates(kept, later).collect()}
    assert sorted(found.values()) == [[0], [2]]  # LONG[:99] isn't a candidate, and z{5} has no mandatory trigram


def test_candidates_are_broadcast_only_if_few(spark, monkeypatch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(CASES * 3)], "doc_id bigint, text string")
    want = sorted((r.doc_id, spans(r)) for r in secrets.scan(df).collect())
    monkeypatch.setattr(secrets, "MOST_SENT", 1)
    monkeypatch.setattr(secrets, "BLOCK", 2)
    out = secrets.scan(df)
    assert sorted((r.doc_id, spans(r)) for r in out.collect()) == want


def test_many_matches(spark):
    text = " ".join(f"token={'a' * 6}{i}" for i in range(1500)) + " " + "é " + "f" * 24
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert spans(secrets.scan(df).first()) == brute(text)


def test_native(spark, sf):
    plan = op2_secret_scan(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_query(spark, sf):
    ours, theirs = both(op2_secret_scan(spark, sf), connect(sf), __import__("satlake.llm.oracles", fromlist=["x"]).secret_scan())
    assert ours == theirs
    base = {r.doc_id: r for r in op2_secret_scan(spark, sf).collect()}
    for d in spark.read.parquet(f"{sf}/documents.parquet").collect():
        own = [s for s in brute(d.text or "") if s[0] in ("assign", "access", "hex")]
        assert base[d.doc_id].base_sha256 == sha256(",".join(f"{k}:{a}:{b}" for k, a, b in own).encode()).hexdigest()
    assert rows(op2_secret_scan(spark, sf), "doc_id")
