"""Secret scans over a trigram inverted index, in DataFrame functions only (after Cox, "Regular Expression Matching with a Trigram Index").

From each rule's regular expression follows a Boolean query over trigrams: an OR of branches, each an AND of trigrams that any match of the branch holds. The index has a list of
postings for each trigram and block of texts. A branch's lists are intersected block by block; what is left are a rule's candidates, and only those are searched with the expression
itself. A rule without mandatory trigrams searches every text.

A posting is a text's 64-bit hash, in any case of letters; copies have one posting, and texts of one hash are candidates together, which the search then tells apart. A block has about
BLOCK texts, dealt by hash, so a list is bounded: a trigram that a third of all texts hold has many lists, not a long one. index() may hold all trigrams and be kept for rules to come;
by default a scan makes one of the trigrams that its rules ask for.

The candidates go to the texts: up to MOST_SENT of them, counted first, are broadcast, so that texts stay where they are; more meet the texts in a shuffle join.

Spans are leftmost and without overlap within a kind, in code points, end exclusive. Null and empty texts have none. Repeated rows each
have the same spans.
"""

from __future__ import annotations

import re
from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlake.llm.common import reliable

parser = re._parser  # the standard library's own parser of regular expressions

#: A class of more characters, or a set of more strings, is left open in queries.
WIDE = 4
MANY = 24


@dataclass(frozen=True)
class Rule:
    """kind; pattern (Java and RE2 read it alike); the group whose length counts, and the least length of it. `search`: a pattern with just the
    matches of `pattern` that are long enough, where there is one; it is what texts are searched with."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    search: str = ""

    @property
    def sought(self) -> str:
        return self.search or self.pattern


RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]+", 0, 24, r"[0-9a-f]{24,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"sk_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

Query = frozenset  # of branches, each a frozenset of trigrams; a branch without trigrams holds always
ALWAYS = frozenset([frozenset()])


def _and(a: Query, b: Query) -> Query:
    both = frozenset(x | y for x in a for y in b)
    return both if len(both) <= MANY else min(a, b, key=lambda q: (frozenset() in q, len(q)))


def _trigrams(s: str) -> frozenset:
    return frozenset(s[i : i + 3] for i in range(len(s) - 2))


def _of_strings(strings: frozenset[str]) -> Query:
    return frozenset(_trigrams(s) for s in strings)


def _walk(nodes) -> tuple[Query, frozenset[str] | None]:
    """The query of a sequence, and all strings it can match (None: too many)."""
    query, now = ALWAYS, frozenset([""])  # now: the strings of the run of exact parts that ends here
    exact = True
    for op, arg in nodes:
        own, strings = _node(str(op), arg)
        if strings is not None and len(now) * len(strings) <= MANY:
            now = frozenset(a + b for a in now for b in strings)
            continue
        query, exact = _and(_and(query, _of_strings(now)), own), False
        now = strings if strings is not None else frozenset([""])
    return (_of_strings(now), now) if exact else (_and(query, _of_strings(now)), None)


def _node(op: str, arg) -> tuple[Query, frozenset[str] | None]:
    if op == "LITERAL":
        return ALWAYS, frozenset([chr(arg).lower()])
    if op == "IN":
        chars: set[str] | None = set()
        for kind, x in arg:
            if str(kind) == "LITERAL":
                chars.add(chr(x).lower())
            elif str(kind) == "RANGE" and x[1] - x[0] < WIDE:
                chars |= {chr(i).lower() for i in range(x[0], x[1] + 1)}
            else:
                return ALWAYS, None
        return ALWAYS, frozenset(chars) if len(chars) <= WIDE + 1 else None
    if op == "SUBPATTERN":
        return _walk(arg[-1])
    if op == "BRANCH":
        parts = [_walk(x) for x in arg[1]]
        strings = None if any(s is None for _, s in parts) else frozenset().union(*[s for _, s in parts])
        query = frozenset().union(*[q for q, _ in parts])
        return (query, strings) if len(query) <= MANY else (ALWAYS, None)
    if op in ("MAX_REPEAT", "MIN_REPEAT"):
        least, most, inner = arg
        query, strings = _walk(inner)
        if strings is not None and int(most) <= 1:
            return (ALWAYS if least == 0 else query), strings | ({""} if least == 0 else frozenset())
        return (query if least else ALWAYS), None
    if op == "AT" or op.startswith("ASSERT"):
        return ALWAYS, frozenset([""])
    return ALWAYS, None


def trigram_query(pattern: str) -> Query:
    """Branches of lower-case trigrams; ALWAYS if the pattern has a branch without any."""
    query, _ = _walk(parser.parse(pattern))
    if frozenset() in query:
        return ALWAYS
    return frozenset(b for b in query if not any(o < b for o in query))  # a wider branch holds a narrower one's texts


SPANS = "array<struct<start:int,kind:string,end:int>>"
RUN = 256  # matches summed up at once: appending copies the list, so a text's spans are gathered by runs


def _spans(text: Column, rule: Rule) -> Column:
    """array<struct<start, kind, end>> of one rule. The text is cut at the matches, and lengths are summed up."""
    p = F.lit(rule.sought)
    whole = F.regexp_extract_all(text, p, F.lit(0))
    counted = F.regexp_extract_all(text, p, F.lit(rule.group)) if rule.group else whole
    gaps = F.split(text, rule.sought, -1)
    sizes = F.zip_with(F.zip_with(gaps, whole, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"))), counted, lambda s, c: F.struct(s["gap"].alias("gap"), s["size"].alias("size"), F.length(c).alias("n")))
    none = F.array().cast(SPANS)

    def step(acc: Column, s: Column) -> Column:
        begin, end = acc["at"] + s["gap"], acc["at"] + s["gap"] + F.coalesce(s["size"], F.lit(0))
        hit = s["size"].isNotNull() & (s["n"] >= rule.least)
        return F.struct(end.alias("at"), F.when(hit, F.array_append(acc["found"], F.struct(begin.alias("start"), F.lit(rule.kind).alias("kind"), end.alias("end")))).otherwise(acc["found"]).alias("found"))

    def run(acc: Column, part: Column) -> Column:
        own = F.aggregate(part, F.struct(acc["at"].alias("at"), none.alias("found")), step)
        # bound to a name, as a plain use would sum the run up twice
        return F.transform(F.array(own), lambda x: F.struct(x["at"].alias("at"), F.array_append(acc["runs"], x["found"]).alias("runs")))[0]

    runs = F.transform(F.array(sizes), lambda all_: F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / RUN).cast("int")), lambda i: F.slice(all_, i * RUN + 1, RUN)))[0]
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPANS}>").alias("runs"))
    return F.when(text.rlike(rule.sought), F.aggregate(runs, start, run, lambda a: F.flatten(a["runs"]))).otherwise(none)


BLOCK = 4096  # texts
MOST_SENT = 1_000_000  # candidates that are broadcast: some 50 MB


def branches_of(rules: tuple[Rule, ...]) -> list[tuple[int, frozenset]]:
    """(number of the rule, trigrams) of all branches that have any."""
    return [(i, b) for i, r in enumerate(rules) for b in sorted(trigram_query(r.pattern), key=sorted) if b]


def index(df: DataFrame, grams: Collection[str] | None = None, text: str = "text") -> DataFrame:
    """(gram, block, postings array<long>): the hashes of the texts that hold a trigram, in lower case, a list a block. grams: those to list; None: all."""
    texts = df.where(F.col(text).isNotNull())
    blocks = max(1, -(-texts.count() // BLOCK))
    low = F.lower(F.col(text))
    if grams is None:
        held = F.array_distinct(F.regexp_extract_all(low, F.lit("(?s)(?=(...))"), F.lit(1)))
    else:  # the text is bound to a name, so that it is put in lower case once
        wanted = F.array(*[F.lit(g) for g in sorted(grams)]).cast("array<string>")
        held = F.transform(F.array(low), lambda t: F.filter(wanted, lambda g: F.contains(t, g)))[0]
    places = texts.select(F.xxhash64(text).alias("key"), F.explode(held).alias("gram"))
    return places.groupBy("gram", F.pmod("key", F.lit(blocks)).cast("int").alias("block")).agg(F.array_sort(F.collect_set("key")).alias("postings"))


def candidates(postings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, rules array<int>): for each text that some branch needs searched, the numbers of its rules. postings: as index() makes them."""
    branches = branches_of(rules)
    of: dict[str, list[int]] = {}
    for k, (_, b) in enumerate(branches):
        for g in b:
            of.setdefault(g, []).append(k)
    if not of:
        return postings.select(F.lit(0).cast("bigint").alias("key"), F.array().cast("array<int>").alias("rules")).limit(0)
    # the branches are few and fixed by the rules
    asked = F.create_map(*[x for g, ks in sorted(of.items()) for x in (F.lit(g), F.array(*[F.lit(k) for k in ks]))])
    lists = postings.where(F.col("gram").isin(sorted(of))).select("block", "postings", F.explode(F.element_at(asked, F.col("gram"))).alias("branch"))
    sizes, rule = F.array(*[F.lit(len(b)) for _, b in branches]), F.array(*[F.lit(i) for i, _ in branches])
    met = lists.groupBy("block", "branch").agg(F.collect_list("postings").alias("lists")).where(F.size("lists") == F.get(sizes, F.col("branch")))
    # shortest lists first
    ordered = met.select("branch", F.transform(F.array_sort(F.transform("lists", lambda x: F.struct(F.size(x).alias("n"), x.alias("x")))), lambda s: s["x"]).alias("lists"))
    common = F.aggregate(F.slice("lists", 2, 1 << 30), F.col("lists")[0], lambda acc, x: F.array_intersect(acc, x))
    found = ordered.select(F.get(rule, F.col("branch")).alias("rule"), F.explode(common).alias("key"))
    return found.groupBy("key").agg(F.array_sort(F.collect_set("rule")).alias("rules"))


def scan(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", out: str = "secrets", postings: DataFrame | None = None) -> DataFrame:
    """Add array<struct<start, kind, end>>, by start and then by the order of the rules. postings: a kept index of all these texts that lists every trigram the rules ask for."""
    row, key, found = "__row", "__key", "__rules"
    base = df.select(F.struct("*").alias(row))
    plain = F.coalesce(F.col(f"{row}.`{text}`"), F.lit(""))
    if postings is None:
        postings = index(df, {g for _, b in branches_of(rules) for g in b}, text)
    # written first: they are counted, and both sides of a shuffle join are then plain exchanges, so that a text that a third of all rows have can be split
    chosen = reliable(candidates(postings, rules)).select(F.col("key").alias("__found"), F.col("rules").alias(found))
    chosen = F.broadcast(chosen) if chosen.count() <= MOST_SENT else chosen
    full = [i for i, r in enumerate(rules) if trigram_query(r.pattern) == ALWAYS]
    asked = base.withColumn(key, F.xxhash64(F.col(f"{row}.`{text}`"))).join(chosen, F.col(key) == F.col("__found"), "left")
    none = F.array().cast(SPANS)
    parts = [_spans(plain, r) if i in full else F.when(F.array_contains(F.col(found), i), _spans(plain, r)).otherwise(none) for i, r in enumerate(rules)]
    order = {r.kind: i for i, r in enumerate(rules)}
    rank = F.create_map(*[x for k, i in order.items() for x in (F.lit(k), F.lit(i))])
    all_spans = F.array_sort(F.transform(F.flatten(F.array(*parts)), lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end"))))
    spans = F.transform(all_spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return asked.select(*[F.col(f"{row}.`{c}`").alias(c) for c in df.columns if c != out], spans.alias(out))


def digest(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
