"""Mixing sources to target weights: iterative proportional fitting (raking), then sampling by calibrated probabilities.

Tokens (words between ASCII white space) are summed up by cell (source, language, topic); topics come from a classifier that is fitted to all of the table
(`topics`), or from the caller's column. From `budget` times all tokens, the cells' expected
tokens are scaled to the target shares of each margin in turn, never above what a cell holds, until all margins fit and
no cell's probability moves by more than `close`. A document's probability is its cell's expected tokens over the tokens it holds; a document is drawn if a uniform number hashed from its id and
the seed is below it, so a draw doesn't depend on order, partitions or retries, and rows of one id are drawn together.

Margins that contradict each other can't all be met (a topic that only one language has, with targets that part them), and raking then ends with a gap: the
largest distance of a category's expected share from its target. It stands in every row as `gap`, and one above `fits` is a warning.

Targets: for each margin a mapping from category to weight (categories that it leaves out get none), or a power: shares are the
categories' own shares to that power, made to sum to 1. A category that holds fewer tokens than its share of the budget gives all, and the others share the rest.
The cells of such a category near all they hold slowly; if the rounds end before that with a gap above `FITS`, they are given whole and as many rounds go on with the other cells, where that leaves a
smaller gap.

Null category: the empty string. Null or empty text: no tokens; its cell's probability, or the budget if the cell has no tokens. Null id: hashed as such.

Cells are few beside documents, but a table may have many sources: up to `driver_cells` cells are fitted on the driver and broadcast;
beyond that the same steps run as sums and joins over the table of cells. Sums by cell combine before they are shuffled, so a hot source is no hot task.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlake.llm import topics
from satlake.llm.common import reliable
from satlake.llm.topics import Topics

MARGINS = ("source", "lang", "topic")
ALL = 1 - 1e-12  # a category whose target is this part of what it holds gives all
FITS = 1e-7  # margins that the rounds bring so near their targets are left as they are


@dataclass(frozen=True)
class Mix:
    targets: tuple[Mapping[str, float] | float, ...] = (0.5, 0.7, 0.7)
    budget: float = 0.5
    seed: int = 17
    rounds: int = 200
    close: float = 1e-9
    driver_cells: int = 100_000
    fits: float = 1e-3
    topics: Topics = Topics()


def n_tokens(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")).cast("long")


def shares(target: Mapping[str, float] | float, held: Mapping[str, float], budget: float) -> dict[str, float]:
    """Target shares by category, none above what the category holds of the budget; what that takes away goes to the others in proportion."""
    raw = {c: float(target.get(c, 0.0)) for c in held} if isinstance(target, Mapping) else {c: v ** float(target) for c, v in held.items() if v > 0}
    raw = {c: v for c, v in raw.items() if v > 0 and held[c] > 0}
    most = {c: held[c] / (budget * sum(held.values())) for c in raw}
    full: set[str] = set()
    while True:
        free = sum(v for c, v in sorted(raw.items()) if c not in full)
        scale = max(0.0, 1 - sum(most[c] for c in sorted(full))) / free if free else 0.0
        more = {c for c, v in raw.items() if c not in full and v * scale > most[c]}
        if not more:
            return {c: (most[c] if c in full else raw[c] * scale) if c in raw else 0.0 for c in held}
        full |= more


def rake(tokens: np.ndarray, codes: list[np.ndarray], want: list[np.ndarray], budget: float, rounds: int, close: float) -> np.ndarray:
    """Expected tokens of each cell. codes: a cell's category by margin; want: target shares by category."""
    total = budget * tokens.sum()

    def steps(x: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, bool]:
        for _ in range(rounds):
            before = x
            for c, w in zip(codes, want, strict=True):
                sums, left = np.bincount(c, np.where(whole, 0, x), len(w)), np.maximum(w * total - np.bincount(c, np.where(whole, x, 0), len(w)), 0)
                x = np.where(whole, x, np.minimum(x * np.divide(left, sums, out=np.zeros(len(w)), where=sums > 0)[c], tokens))
            if (np.abs(x - before) <= close * tokens).all():
                return x, True
        return x, False

    x, settled = steps(budget * tokens.astype(np.float64), np.zeros(len(tokens), bool))
    gives_all = np.any([(w * total >= np.bincount(c, tokens, len(w)) * ALL)[c] for c, w in zip(codes, want, strict=True)], axis=0) & (x > 0)
    if not settled and gives_all.any() and gap(x, tokens, codes, want, budget) > FITS:
        y, _ = steps(np.where(gives_all, tokens, x), gives_all)
        x = min(x, y, key=lambda v: gap(v, tokens, codes, want, budget))
    return x


def gap(x: np.ndarray, tokens: np.ndarray, codes: list[np.ndarray], want: list[np.ndarray], budget: float) -> float:
    """The largest distance of a category's share of the expected tokens from its target."""
    total = max(budget * tokens.sum(), 1e-300)
    return max((float(np.abs(np.bincount(c, x, len(w)) / total - w).max(initial=0)) for c, w in zip(codes, want, strict=True)), default=0.0) if tokens.sum() else 0.0


def _told(found: float, p: Mix) -> float:
    if found > p.fits:
        warnings.warn(f"raking ended with a share {found:.4g} off its target after at most {p.rounds} rounds", stacklevel=3)
    return found


def _on_driver(cells: DataFrame, p: Mix) -> DataFrame:
    rows = cells.orderBy(*MARGINS).toPandas()
    codes, want = [], []
    for m, t in zip(MARGINS, p.targets, strict=True):
        names, c = np.unique(rows[m].to_numpy(object).astype(str), return_inverse=True)
        sums = np.bincount(c, rows["tokens"], len(names))
        by = shares(t, dict(zip(names.tolist(), sums.tolist(), strict=True)), p.budget)
        codes.append(c)
        want.append(np.array([by[n] for n in names.tolist()]))
    tokens = rows["tokens"].to_numpy(np.float64)
    x = rake(tokens, codes, want, p.budget, p.rounds, p.close)
    rows["prob"] = np.divide(x, tokens, out=np.full(len(x), p.budget), where=tokens > 0)
    rows["gap"] = _told(gap(x, tokens, codes, want, p.budget), p)
    return F.broadcast(cells.sparkSession.createDataFrame(rows[[*MARGINS, "prob", "gap"]], "source string, lang string, topic string, prob double, gap double"))


def _in_tables(cells: DataFrame, p: Mix) -> DataFrame:
    """The same steps over a table of cells of any size."""
    cells = reliable(cells)
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0) * p.budget
    x = cells.withColumn("x", F.col("tokens") * F.lit(p.budget))
    for m, t in zip(MARGINS, p.targets, strict=True):
        held = cells.groupBy(F.col(m).alias("c")).agg(F.sum("tokens").alias("held")).where("held > 0")
        if isinstance(t, Mapping):
            pairs = cells.sparkSession.createDataFrame([(k, float(v)) for k, v in t.items() if v > 0], "c string, raw double")
            raw = held.join(pairs, "c")
        else:
            raw = held.withColumn("raw", F.pow("held", F.lit(float(t))))
        raw = reliable(raw.withColumn("most", F.col("held") / F.lit(total)))
        scale, full = 0.0, -1
        while True:  # the same filling: a category is full if its share at the last scale was above what it holds
            over = F.col("raw") * F.lit(scale) > F.col("most")
            n, taken, free = raw.agg(F.count_if(over), F.coalesce(F.sum(F.when(over, F.col("most"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("raw"))), F.lit(0.0))).first()
            if n == full:
                break
            scale, full = (max(0.0, 1 - taken) / free if free else scale), n
        raw = raw.withColumn("share", F.least(F.col("raw") * F.lit(scale), F.col("most")))
        x = x.join(raw.select(F.col("c").alias(m), F.col("share").alias(f"want_{m}"), (F.col("share") >= F.col("most") * ALL).alias(f"all_{m}")), m, "left")
    x = reliable(x.fillna(0.0, [f"want_{m}" for m in MARGINS]).fillna(False, [f"all_{m}" for m in MARGINS]).withColumn("whole", F.lit(False)))

    def steps(x: DataFrame) -> tuple[DataFrame, bool]:
        for _ in range(p.rounds):
            y = x.withColumn("before", F.col("x"))
            for m in MARGINS:
                sums = y.groupBy(F.col(m).alias("c")).agg(F.sum(F.when(F.col("whole"), 0.0).otherwise(F.col("x"))).alias("s"), F.sum(F.when(F.col("whole"), F.col("x")).otherwise(0.0)).alias("w"))
                left = F.greatest(F.col(f"want_{m}") * F.lit(total) - F.col("w"), F.lit(0.0))
                free = F.when(F.col("s") > 0, F.least(F.col("x") * left / F.col("s"), F.col("tokens").cast("double"))).otherwise(0.0)
                y = y.join(sums, F.col(m) == F.col("c")).withColumn("x", F.when(F.col("whole"), F.col("x")).otherwise(free)).drop("c", "s", "w")
            y = reliable(y)
            moving = y.agg(F.count_if(F.abs(F.col("x") - F.col("before")) > F.col("tokens") * p.close)).first()[0]
            x = y.drop("before")
            if not moving:
                return x, True
        return x, False

    def off(x: DataFrame) -> float:
        return max(x.groupBy(m).agg(F.abs(F.sum("x") / F.lit(max(total, 1e-300)) - F.max(f"want_{m}")).alias("off")).agg(F.max("off")).first()[0] or 0.0 for m in MARGINS) if total else 0.0

    x, settled = steps(x)
    found = off(x)
    y = x.withColumn("whole", (F.col("x") > 0) & (F.col("all_source") | F.col("all_lang") | F.col("all_topic")))
    if not settled and found > FITS and not y.where("whole").isEmpty():
        y, _ = steps(y.withColumn("x", F.when(F.col("whole"), F.col("tokens").cast("double")).otherwise(F.col("x"))))
        x, found = min((x, found), (y, off(y)), key=lambda v: v[1])
    found = _told(found, p)
    return x.select(*MARGINS, F.when(F.col("tokens") > 0, F.col("x") / F.col("tokens")).otherwise(F.lit(p.budget)).alias("prob"), F.lit(found).alias("gap"))


def mix(df: DataFrame, p: Mix = Mix(), id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", topic: Column | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """The input's rows in a struct `row`, with source, lang, topic, n_tokens, prob, `drawn` and `gap`. keep: the columns that `row` has, None: all. Rows without
    the text are small: they are written once with their topics, which are found a second time otherwise."""
    name = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    if topic is None:
        found = topics.topic_of(df, topics.fit(df, F.col(text), F.col(lang), p.topics), F.col(text), F.col(lang))
    else:
        found = F.struct(n_tokens(F.col(text)).alias("n_tokens"), name(topic).alias("topic"))
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(p.seed)), F.col(f"`{id}`").cast("string"))), 1, 13)
    u = F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))
    row = F.struct("*" if keep is None else [F.col(f"`{c}`") for c in keep])
    docs = df.select(row.alias("row"), u.alias("u"), name(F.col(source)).alias("source"), name(F.col(lang)).alias("lang"), found.alias("found")).select("row", "u", "source", "lang", "found.topic", "found.n_tokens")
    if keep is not None and text not in keep:
        docs = reliable(docs)
    cells = reliable(docs.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")))
    few = cells.count() <= p.driver_cells
    fitted = _on_driver(cells, p) if few else _in_tables(cells, p)
    # every row has its cell; an inner join would first look for null topics, and find each text's topic twice
    return docs.join(fitted, list(MARGINS), "left").select("row", *MARGINS, "n_tokens", "prob", (F.col("u") < F.col("prob")).alias("drawn"), "gap")
