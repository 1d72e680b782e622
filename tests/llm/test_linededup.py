import random
from hashlib import sha256

import pytest
import xxhash

from satlake.llm import linededup
from satlake.llm.queries import op10_line_dedup
from tests.llm.helpers import clashing, no_docs, odd_docs

P = linededup.Winnow()


def brute(docs, p=P):
    """The definition: every run of lines of RUN words and more, whatever its length, that stands earlier too. docs (id, text) to the lines deleted
    of each distinct (id, text)."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    key = lambda d: (d[0] is None, d[0] or 0, signed(xxhash.xxh64_intdigest(d[1].encode(), 42)))
    out, first = {}, {}
    for d in sorted({(i, t or "") for i, t in docs}, key=key):
        lines, at, words = linededup.worded(d[1])
        texts = [lines[i] for i in at]
        total = [0]
        for n in words:
            total.append(total[-1] + n)
        gone = set()
        for a in range(len(at)):
            for b in range(a + 1, min(len(at), a + LONGEST) + 1):
                if total[b] - total[a] >= p.run and first.setdefault(tuple(texts[a:b]), (d, a)) != (d, a):
                    gone |= set(range(at[a], at[b - 1] + 1))
        out[d] = gone
    return out


LONGEST = 60  # lines of a run that brute() looks at; longer ones are unions of these in the tests' tables


def check(spark, docs):
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = brute(docs)
    got = linededup.dedup(df).collect()
    assert len(got) == len(docs)
    for r in got:
        lines = (r.row.text or "").split("\n")
        gone = want[r.row.doc_id, r.row.text or ""]
        assert r.n_lines == len(lines) and r.n_removed == len(gone)
        assert {i for s in r.removed for i in range(s["first"], s["end"])} == gone
        assert r.kept_text == (None if r.row.text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return got


def line(r, n):
    return " ".join("".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(n))


def test_random_documents(spark):
    r = random.Random(8)
    pool = [line(r, r.choice([1, 3, 8, 20, 45, 60])) for _ in range(25)]
    docs = [(k, "\n".join(r.choice([*pool, line(r, 9), ""]) for _ in range(r.randrange(14)))) for k in range(120)]
    docs += [(k, "\n".join(pool[a : a + 9])) for k, a in enumerate(range(0, 16, 2), 200)] + [(300, docs[5][1]), (301, docs[5][1])]
    got = check(spark, docs)
    assert sum(r.n_removed for r in got) > 100
    kept = {x for r in got for x in (r.kept_text or "").split("\n")}
    assert {x for _, t in docs for x in t.split("\n")} - kept == set()  # one of equal lines always stays


def test_windows():
    assert linededup.least_runs([30, 10, 25, 60, 5], 50) == [3, 4, 4, 4, 0]
    r = random.Random(2)
    for _ in range(300):
        words = [r.choice([1, 5, 24, 25, 49, 50, 70]) for _ in range(r.randrange(1, 12))]
        digests = [r.randbytes(16) for _ in words]
        got = linededup.windows(digests, words, P)
        spans = {w for _, ws in got.values() for w in ws}
        every = {(a, b) for a in range(len(words)) for b in range(a + 1, len(words) + 1) if sum(words[a:b]) >= 50}
        least = {(a, b) for a, b in every if (a, b - 1) not in every or (a + 1, b) not in every}
        assert spans == {(a, b) for a, b in least if (a, b - 1) not in every} | {(a, b) for a, b in least if (a + 1, b) not in every}
        for g, (_, ws) in got.items():
            end = linededup.least_runs(words, P.gram)[g]
            assert all(a <= g and end <= b for a, b in ws)  # the gram lies in its windows


def test_selection_is_local():
    """Whatever stands before and after a window, the same gram of it is selected."""
    r = random.Random(4)
    for _ in range(200):
        words, digests = [30, 9, 12, 26], [r.randbytes(16) for _ in range(4)]
        pad = [r.choice([3, 20, 55]) for _ in range(3)]
        more = [r.randbytes(16) for _ in pad]
        alone = {fp for fp, ws in linededup.windows(digests, words, P).values() if (0, 3) in ws}
        inside = {fp for fp, ws in linededup.windows(more + digests + more, pad + words + pad, P).values() if (3, 6) in ws}
        assert alone == inside and len(alone) == 1


def test_passages(spark):
    """A passage of over 50 words stays once, whatever stands about it; a shorter one stays everywhere."""
    r = random.Random(9)
    long, short = "\n".join(line(r, 13) for _ in range(4)), "\n".join(line(r, 12) for _ in range(4))
    docs = [(k, "\n".join([line(r, 30), long, "", line(r, 7), short, line(r, 40)])) for k in range(30)]
    got = check(spark, docs)
    texts = {x.row.doc_id: x.kept_text for x in got}
    assert long in texts[0] and not any(t in texts[k] for k in range(1, 30) for t in long.split("\n"))
    assert all(short in t for t in texts.values())


def test_repeats_within_a_document(spark):
    x = "\n".join(["w " * 60] * 5)
    got = check(spark, [(1, x), (2, "a\n" + x)])
    assert [r.n_removed for r in sorted(got, key=lambda r: r.row.doc_id)] == [4, 5]


@pytest.mark.parametrize("make", [odd_docs, no_docs])
def test_odd_tables(spark, make):
    df = clashing(make(spark))
    got = linededup.dedup(df).collect()
    assert len(got) == df.count()
    want = brute([(r.doc_id, r.text) for r in df.collect()])
    for r in got:
        assert r.row.asDict().keys() == set(df.columns) and r.n_removed == len(want[r.row.doc_id, r.row.text or ""])


def test_repeated_rows_are_one_document(spark):
    x = "w " * 70
    assert [r.n_removed for r in check(spark, [(1, x), (1, x)])] == [0, 0]


def test_query(spark, sf):
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want, text = brute(docs), dict(docs)
    for r in op10_line_dedup(spark, sf).collect():
        gone = want[r.doc_id, text[r.doc_id]]
        kept = "\n".join(x for i, x in enumerate(text[r.doc_id].split("\n")) if i not in gone)
        assert r.n_removed == len(gone) and r.kept_sha256 == sha256(kept.encode()).hexdigest() and r.kept_chars == len(kept)
