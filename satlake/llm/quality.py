"""Quality rules: tokeniser fertility.

A public vocabulary with byte fallback cuts each word of a text (words are what lies between ASCII white space). Three measures
follow: characters per token, the share of tokens that are fallen-back bytes, and the entropy in bits of the text's tokens. Each
language, or script where the language is unknown, has a band; a text outside it is rejected. Texts of under
`least` words are too short to measure, and get no verdict by band.

The bands of languages are fitted by fit() to all labelled clean documents that it is given: `BANDS` holds what it gives for the half `FITTED_ON` of the
labels of the sf0.1 tables, which a test fits again. Neither the other half nor any other table had a part in them. Scripts have no labelled
documents here: the Latin band is the widest of the fitted ones, and the others are wide guesses.

Base rules: a text has `few` words at least, and at most `share` per cent of its words lie in windows of `window` words that
occur twice or more in it.

Words are measured once a run of documents and by table after that, so a text costs a lookup a word. Null text: no words, rejected by
the base rules; empty text likewise. Unknown or null language: the band of the script with most letters, and "other" if no script has any.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlake.llm.common import put, reliable, small_batches, text_udf

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Band:
    """Bounds, all inclusive. Entropy grows with a text's length, and a number or address weighs more in a short text: one of n words needs
    least_bits - slack / sqrt(n) and least_chars - chars_slack / sqrt(n)."""

    least_chars: float
    most_chars: float
    most_bytes: float
    least_bits: float
    slack: float = 0.0
    chars_slack: float = 0.0


FITTED_ON = 0  # of the two halves of labelled documents, by the parity of the MD5 of their ids

BANDS = {
    # fitted
    "de": Band(2.068, 9.0, 0.02, 6.728, 9.206, 2.31),
    "en": Band(2.044, 9.0, 0.02, 6.978, 11.065, 2.31),
    "es": Band(1.768, 9.0, 0.02, 6.803, 9.296, 2.31),
    "fr": Band(1.804, 9.0, 0.02, 6.662, 8.946, 2.31),
    "latin": Band(1.768, 9.0, 0.02, 6.662, 11.065, 2.31),  # the widest of these
    # not fitted
    "cyrillic": Band(1.2, 9.0, 0.20, 3.0),
    "greek": Band(0.8, 9.0, 0.30, 3.0),
    "arabic": Band(0.8, 9.0, 0.40, 3.0),
    "han": Band(0.4, 4.0, 0.75, 3.0),
    "kana": Band(0.5, 4.0, 0.60, 3.0),
    "hangul": Band(0.4, 4.0, 0.80, 3.0),
    "other": Band(0.3, 12.0, 0.90, 2.5),
}
#: First code points and ends of the scripts told apart.
SCRIPTS = {"latin": [(0x41, 0x250)], "greek": [(0x370, 0x400)], "cyrillic": [(0x400, 0x530)], "arabic": [(0x600, 0x700), (0x750, 0x780)], "kana": [(0x3040, 0x3100)], "han": [(0x3400, 0xA000)], "hangul": [(0xAC00, 0xD7A4)]}


@dataclass(frozen=True)
class Rules:
    few: int = 20
    window: int = 8
    share: int = 30
    least: int = 20
    bands: dict[str, Band] = field(default_factory=lambda: dict(BANDS))


KIND = pa.struct([(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "n_byte_tokens")] + [("token_bits", pa.float64()), ("script", pa.string())])
NAMES = [f.name for f in KIND]
RETURNS = "struct<n_words: bigint, word_chars: bigint, n_symbols: bigint, n_dup_lines: bigint, n_repeat_words: bigint, n_tokens: bigint, n_byte_tokens: bigint, token_bits: double, script: string>"
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x94D049BB133111EB, 0xBF58476D1CE4E5B9], np.uint64)


def repeated(words: np.ndarray, start: np.ndarray, window: int) -> np.ndarray:
    """How many words of each text lie in windows that occur twice or more in it; texts one after another in `words`."""
    n, docs = len(words), len(start) - 1
    if n < window:
        return np.zeros(docs, np.int64)
    size = np.diff(start)
    doc = np.repeat(np.arange(docs), size)
    last = np.repeat(start[1:], size) - window  # of the windows that fit
    at = np.flatnonzero(np.arange(n) <= last)
    w = words.astype(np.uint64)
    mixed = np.zeros(len(at), np.uint64)
    for k in range(window):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _ODD[k % len(_ODD)] + w[at + k] * _ODD[(k + 3) % len(_ODD)] + np.uint64(k)
    mixed ^= mixed >> np.uint64(32)
    mixed = mixed * _ODD[0] + doc[at].astype(np.uint64) * _ODD[5]
    order = np.argsort(mixed)
    same = mixed[order][1:] == mixed[order][:-1]
    hits = np.flatnonzero(same)
    if not len(hits):
        return np.zeros(docs, np.int64)
    a, b = at[order[hits]], at[order[hits + 1]]
    real = doc[a] == doc[b]
    for k in range(window):
        real &= words[a + k] == words[b + k]
    if not real.all():  # two windows of one hash differ: told apart by their words
        rows = np.unique(np.stack([doc[at], *[words[at + k] for k in range(window)]], axis=1), axis=0, return_inverse=True, return_counts=True)
        found = at[rows[2][rows[1].ravel()] > 1]
    else:
        found = np.unique(np.concatenate([a, b]))
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, found, 1)
    np.add.at(step, found + window, -1)
    covered = np.cumsum(step[:-1]) > 0
    return np.bincount(doc[covered], minlength=docs).astype(np.int64)


class Words:
    """What is known of words, by number. A table of over MOST words is begun anew."""

    MOST = 150_000

    def __init__(self, model: bytes):
        import sentencepiece

        self.vocabulary = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = self.vocabulary.GetPieceSize()
        self.is_byte = np.array([self.vocabulary.IsByte(i) for i in range(self.size)])
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.facts = np.zeros((0, 4 + len(SCRIPTS)), np.int64)  # tokens, fallen-back bytes, code points, symbols, letters by script
        self.tokens, self.start = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def learn(self) -> None:
        """Take in the words numbered since the last call."""
        new = [w.decode() for w in list(self.number)[len(self.facts) :]]
        if not new:
            return
        cut = self.vocabulary.encode(new, num_threads=1)
        n = np.fromiter(map(len, cut), np.int64, len(cut))
        tokens = np.fromiter((x for c in cut for x in c), np.int32, int(n.sum()))
        byte = np.bincount(np.repeat(np.arange(len(n)), n)[self.is_byte[tokens]], minlength=len(n))
        chars = np.fromiter(map(len, new), np.int64, len(new))
        signs = np.fromiter((0 if w.isalnum() else sum(map(w.count, SYMBOLS)) for w in new), np.int64, len(new))
        letters = np.array([_letters(w) for w in new], np.int64)
        self.facts = np.concatenate([self.facts, np.concatenate([np.stack([n, byte, chars, signs], axis=1), letters], axis=1)])
        self.tokens = np.concatenate([self.tokens, tokens])
        self.start = np.append(self.start, self.start[-1] + np.cumsum(n))


def _letters(word: str) -> list[int]:
    """Letters by script."""
    counts = [0] * len(SCRIPTS)
    if max(word) < "\u0250":
        counts[0] = len(word) if word.isalpha() else sum(map(str.isalpha, word))
        return counts
    for c in word:
        if c.isalpha():
            for k, spans in enumerate(SCRIPTS.values()):
                if any(a <= ord(c) < b for a, b in spans):
                    counts[k] += 1
    return counts


def _entropy(words: np.ndarray, doc: np.ndarray, docs: int, known: Words) -> np.ndarray:
    """Bits a token of each text."""
    size = known.facts[words, 0]
    total = int(size.sum())
    place = np.arange(total) + np.repeat(known.start[words] - (np.cumsum(size) - size), size)
    keys = np.sort(np.repeat(doc, size) * known.size + known.tokens[place])
    edge = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if total else np.zeros(0, np.int64)
    often = np.diff(np.append(edge, total)).astype(np.float64)
    of = keys[edge] // known.size
    n = np.bincount(of, often, docs)
    return np.maximum(0.0, np.log2(np.maximum(n, 1)) - np.bincount(of, often * np.log2(often), docs) / np.maximum(n, 1))


def _measure(model: bytes, window: int) -> Callable[[list[str]], list]:
    known = Words(model)
    names = [*SCRIPTS, "other"]

    def measure(texts: list[str]) -> list:
        if len(known.number) > known.MOST:
            known.clear()
        number = known.number
        coded = [[number.setdefault(w, len(number)) for w in t.encode().split()] for t in texts]
        known.learn()
        docs = len(texts)
        start = np.zeros(docs + 1, np.int64)
        np.cumsum(np.fromiter(map(len, coded), np.int64, docs), out=start[1:])
        words = np.fromiter(chain.from_iterable(coded), np.int64, int(start[-1]))
        doc = np.repeat(np.arange(docs), np.diff(start))
        facts = np.stack([np.bincount(doc, known.facts[words, k], docs) for k in range(known.facts.shape[1])], axis=1).astype(np.int64)
        again, bits = repeated(words, start, window), _entropy(words, doc, docs, known)
        letters = facts[:, 4:]
        script = np.where(letters.any(axis=1), letters.argmax(axis=1), len(SCRIPTS)).tolist()
        twice = []
        for t in texts:
            lines = t.split("\n")
            twice.append(0 if len(set(lines)) == len(lines) else sum(n - 1 for x, n in Counter(lines).items() if x.encode().strip()))
        rows = zip(np.diff(start).tolist(), facts[:, 2].tolist(), facts[:, 3].tolist(), twice, again.tolist(), facts[:, 0].tolist(), facts[:, 1].tolist(), bits.tolist(), [names[k] for k in script], strict=True)
        return [dict(zip(NAMES, x, strict=True)) for x in rows]

    return measure


def judge(df: DataFrame, model: bytes, rules: Rules = Rules(), text: str = "text", lang: str = "lang", out: str = "quality") -> DataFrame:
    """Add a struct: the counts, the three measures, `base_failed`, `reason` (null if kept) and `kept`."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    window = rules.window
    work: Callable = lambda: _measure(shared.value, window)
    raw = f"{out}__raw"
    while raw in df.columns:
        raw += "_"
    df = put(df, raw, text_udf(work, RETURNS, KIND)(F.col(text)))
    m = lambda n: F.col(f"`{raw}`.{n}")
    codes = [k for k in rules.bands if k not in SCRIPTS and k != "other"]
    name = F.when(F.lower(F.col(lang)).isin(codes), F.lower(F.col(lang))).otherwise(m("script")) if lang in df.columns else m("script")
    bands = F.create_map(*[x for k, b in rules.bands.items() for x in (F.lit(k), F.struct(*[F.lit(float(getattr(b, n))).alias(n) for n in ("least_chars", "most_chars", "most_bytes", "least_bits", "slack", "chars_slack")]))])
    band = F.coalesce(F.try_element_at(bands, name), F.try_element_at(bands, F.lit("other")))
    tokens = F.greatest(m("n_tokens"), F.lit(1))
    chars, share = m("word_chars") / tokens, m("n_byte_tokens") / tokens
    failed = (m("n_words") < rules.few) | (F.lit(100) * m("n_repeat_words") > F.lit(rules.share) * m("n_words"))
    long_enough = m("n_words") >= rules.least
    root = F.sqrt(F.greatest(m("n_words"), F.lit(1)).cast("double"))
    least_bits, least_chars = band["least_bits"] - band["slack"] / root, band["least_chars"] - band["chars_slack"] / root
    reason = (
        F.when(m("n_words") < rules.few, "few words").when(failed, "repeats")
        .when(long_enough & (chars < least_chars), "few characters per token").when(long_enough & (chars > band["most_chars"]), "many characters per token")
        .when(long_enough & (share > band["most_bytes"]), "bytes").when(long_enough & (m("token_bits") < least_bits), "low entropy")
    )
    df = put(df, out, F.struct(*[m(n).alias(n) for n in NAMES], name.alias("band"), chars.alias("chars_per_token"), share.alias("byte_share"), failed.alias("base_failed"), reason.alias("reason"), reason.isNull().alias("kept")))
    return df.drop(raw)


@dataclass(frozen=True)
class Fit:
    """sample: None, or the most labelled clean documents that a caller wants fitted to instead of all; fewest: of a language with fewer no band is fitted. A bound lies beyond the farthest
    document: `offset` times as far for texts of at least median length, and `slack` times as far for what shorter ones are off beyond that."""

    sample: int | None = None
    fewest: int = 50
    offset: float = 1.25
    slack: float = 1.5
    most_chars: float = 9.0  # isn't fitted: prose outside these tables has more characters a token than their invented words, and noise has fewer


def half(id: str = "doc_id") -> Column:
    """0 or 1 by the parity of the MD5 of the id: fitting one half leaves the other to be judged."""
    return F.conv(F.substring(F.md5(F.col(id).cast("string")), 32, 1), 16, 10).cast("int") % 2


def fit(clean: DataFrame, model: bytes, p: Fit = Fit(), rules: Rules = Rules(), id: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, Band]:
    """Bands by language from clean documents, those that the base rules reject left out. All are measured and summed up by table operations; a median holds the different values of a language
    in one task.

    For each language: the median of characters per token, and a line of entropy over 1 / sqrt(words) by least squares. For all languages together, how far documents lie off these: long ones
    give the offset, short ones the slack over sqrt(words).
    """
    clean = clean.where(F.col(lang).isNotNull())
    if p.sample is not None:
        clean = clean.orderBy(F.md5(F.col(id).cast("string")), F.col(id)).limit(p.sample)
    q = F.col("quality")
    rows = judge(clean.select(F.col(text).alias("text"), F.lower(F.col(lang)).alias("lang")), model, rules).where(~q["base_failed"])
    root, bits, chars = F.sqrt(F.greatest(q["n_words"], F.lit(1)).cast("double")), q["token_bits"], q["chars_per_token"]
    rows = reliable(rows.select("lang", root.alias("root"), chars.alias("chars"), q["byte_share"].alias("bytes"), bits.alias("bits")))
    slope = F.coalesce(F.regr_slope("bits", 1 / F.col("root")), F.lit(0.0))  # none where all texts have one length
    held = rows.groupBy("lang").agg(F.count("*").alias("n"), F.median("chars").alias("middle"), F.median("root").alias("half"), slope.alias("slope"), F.avg("bits").alias("mean"), F.avg(1 / F.col("root")).alias("at"), F.max("bytes").alias("most"))
    groups = held.where(F.col("n") >= p.fewest).withColumn("level", F.col("mean") - F.col("slope") * F.col("at")).orderBy("lang").collect()
    if not groups:
        return {}
    line = rows.sparkSession.createDataFrame([(g.lang, g.middle, g.half, g.level, g.slope) for g in groups], "lang string, middle double, half double, level double, slope double")
    off = rows.join(F.broadcast(line), "lang").select("root", (F.col("root") >= F.col("half")).alias("long"), (F.col("middle") - F.col("chars")).alias("low"), (F.col("level") + F.col("slope") / F.col("root") - F.col("bits")).alias("bits"))
    offset = {k: p.offset * max(0.0, v) for k, v in off.where("long").agg(F.max("low").alias("low"), F.max("bits").alias("bits")).first().asDict().items()}
    slack = {k: p.slack * max(0.0, v) for k, v in off.agg(*[F.max((F.col(k) - v) * F.col("root")).alias(k) for k, v in offset.items()]).first().asDict().items()}
    most_bytes = max(0.02, p.offset * max(g.most for g in groups))
    near = lambda x: round(float(x), 3)
    return {g.lang: Band(near(g.middle - offset["low"]), p.most_chars, near(most_bytes), near(g.level - offset["bits"]), near(slack["bits"] - g.slope), near(slack["low"])) for g in groups}


def widest(bands: dict[str, Band]) -> Band:
    """The band that holds all of these."""
    of = lambda n, f: f(getattr(b, n) for b in bands.values())
    return Band(of("least_chars", min), of("most_chars", max), of("most_bytes", max), of("least_bits", min), of("slack", max), of("chars_slack", max))
