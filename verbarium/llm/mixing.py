"""Mixing sources to target weights by soft membership.

A classifier fitted on a bounded sample of labelled documents gives every document a posterior over the
sources. One pass adds up the tokens of documents alike in label and posterior, exactly, in cells of bounded number;
nonnegative document rates, one per cell and at most the source's repeat cap, are then fitted by projected gradient
least squares: the token total of each source, by label, must be its target, and the total expected under the
posteriors should be. Rates become whole copies by carrying the tokens that rounding leaves over from document to
document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbarium.lineage import cut, drop
from verbarium.llm import tokens
from verbarium.operators.lookup import spread
from verbarium.shipping import ship

#: Token ids are counted in so many buckets by the classifier.
BUCKETS = 4096
#: Documents per source that the classifier is fitted on, about.
TRAIN_PER_SOURCE = 1000
#: Sources a mixture may have; the driver holds at most MAX_SOURCES ** 2 * BINS cells of MAX_SOURCES numbers.
MAX_SOURCES = 100
#: Bins of the likeliest source's probability; documents of one label, likeliest source and bin share a rate.
BINS = 8
#: Documents per group of the rounding, about.
ROUND_GROUP = 20_000
#: Gradient steps; a fit that has not settled by then is an error.
ROUNDS = 100_000


def clean_source(source: Column) -> Column:
    return F.lower(F.regexp_replace(source, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))


def _rows(documents: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    return documents.select(documents[doc_id].alias("doc_id"), clean_source(documents[source]).alias("source"), documents[text].alias("t")).filter("doc_id is not null")


def fit_classifier(rows: DataFrame, sources: list[str], ranks: str = tokens.RANKS, per_source: int = TRAIN_PER_SOURCE) -> np.ndarray:
    """Naive Bayes log probabilities ``[source, bucket]`` from about ``per_source`` labelled documents a source.

    The sample is drawn by hash of the id, so it is the same at every run; only it is tokenised here. A source
    without documents has the same probability for every bucket.
    """
    labelled = rows.filter(F.col("source").isin(sources) & (F.col("t") != ""))
    counts = {r.source: r.n for r in labelled.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    weights = np.ones((len(sources), BUCKETS))
    if counts:
        share = F.create_map(*[x for s, n in counts.items() for x in (F.lit(s), F.lit(min(1.0, per_source / n)))])
        sample = labelled.filter(F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(1_000_000)) < F.try_element_at(share, F.col("source")) * 1_000_000)
        at = {s: i for i, s in enumerate(sources)}

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            enc, seen = tokens.encoding(ranks), {}
            for b in batches:
                for s, t in zip(b["source"], b["t"]):
                    mine = seen.setdefault(s, np.zeros(BUCKETS))
                    np.add.at(mine, np.asarray(tokens.encode(enc, t), np.int64) % BUCKETS, 1)
            for s, v in seen.items():
                k = np.flatnonzero(v)
                yield pd.DataFrame({"source": s, "b": k, "n": v[k]})

        # at most MAX_SOURCES * BUCKETS rows
        found = spread(sample).mapInPandas(count, "source string, b int, n double").groupBy("source", "b").agg(F.sum("n").alias("n")).toPandas()
        np.add.at(weights, (found["source"].map(at).to_numpy(int), found["b"].to_numpy(int)), found["n"].to_numpy(float))
    return np.log(weights / weights.sum(axis=1, keepdims=True))


def posteriors(ids: np.ndarray, log_p: np.ndarray) -> np.ndarray:
    """Tempered posteriors: the evidence grows with the root of the length, for words are not independent."""
    n = log_p.shape[0]
    if not n or not len(ids):
        return np.full(n, 1.0 / max(1, n))
    z = log_p[:, ids % log_p.shape[1]].mean(axis=1) * np.sqrt(len(ids))
    z = np.exp(z - z.max())
    return z / z.sum()


def _scored(rows: DataFrame, sources: list[str], log_p: np.ndarray, ranks: str) -> DataFrame:
    """``(doc_id, source, n_tokens, post)``; ``post`` packs one double per source. Each text is tokenised once; null texts have no tokens."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast(log_p)  # MAX_SOURCES * BUCKETS doubles at most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = tokens.encoding(ranks)
        for b in batches:
            ids = [np.asarray(tokens.encode(enc, t), np.int64) if t is not None else np.zeros(0, np.int64) for t in b["t"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"], "n_tokens": [len(i) for i in ids], "post": [posteriors(i, shared.value).tobytes() for i in ids]})

    return spread(rows).mapInPandas(run, f"doc_id {kind}, source string, n_tokens int, post binary")


def _targets(targets: DataFrame) -> pd.DataFrame:
    rows = targets.select(clean_source(F.col("source")).alias("source"), F.col("target_share").cast("double"), F.col("max_repeats").cast("int")).filter("source is not null")
    # of several rows of a source the one with the largest share, then cap, holds
    rows = rows.groupBy("source").agg(F.max(F.struct(F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.coalesce("max_repeats", F.lit(0)).alias("max_repeats"))).alias("m")).select("source", "m.*")
    rows = rows.filter("target_share > 0 and max_repeats > 0").limit(MAX_SOURCES + 1).toPandas()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    return rows.sort_values("source").reset_index(drop=True)


def membership(documents: DataFrame, targets: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", ranks: str = tokens.RANKS) -> DataFrame:
    """``(doc_id, source, n_tokens, likely, probability)``: every document's likeliest source, labelled or not."""
    names = list(_targets(targets).source)
    ship(documents.sparkSession)
    rows = _rows(documents, doc_id, text, source)
    scored = _scored(rows, names, fit_classifier(rows, names, ranks), ranks)

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            p = np.frombuffer(b"".join(b["post"]), dtype=float).reshape(len(b), -1)
            k = p.argmax(axis=1) if p.shape[1] else np.zeros(0, int)
            yield pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"], "n_tokens": b["n_tokens"], "likely": [names[i] for i in k], "probability": p[np.arange(len(b)), k]})

    kind = rows.schema["doc_id"].dataType.simpleString()
    if not names:
        return scored.selectExpr("doc_id", "source", "n_tokens", "cast(null as string) likely", "cast(null as double) probability")
    return scored.mapInPandas(best, f"doc_id {kind}, source string, n_tokens int, likely string, probability double")


class Plan:
    """The fitted mixture: a rate for each (label, likeliest source, bin), and how well the conditions hold."""

    def __init__(self, names: list[str], caps: np.ndarray, goal: np.ndarray) -> None:
        n = len(names)
        self.names, self.caps, self.goal = names, caps, goal
        self.by_cell = np.zeros((n + 1, n, BINS))
        self.got, self.rounds = np.zeros(2 * n), 0

    def cells(self, source: np.ndarray, post: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The cell of each document; label -1 is none of the sources."""
        top = post.max(axis=1, initial=0.0)
        return source, post.argmax(axis=1), np.minimum((top * BINS).astype(int), BINS - 1)

    def rates(self, source: np.ndarray, post: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rate and cap of each document; one without a label has the cap of its likeliest source."""
        s, k, b = self.cells(source, post)
        return self.by_cell[s, k, b], self.caps[np.where(s < 0, k, s)]


def _arrays(b: pd.DataFrame, at: dict[str, int], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return b["source"].map(at).fillna(-1).to_numpy(int), np.frombuffer(b"".join(b["post"]), dtype=float).reshape(len(b), n), b["n_tokens"].to_numpy(float)


def _cells(scored: DataFrame, plan: Plan) -> pd.DataFrame:
    """``(s, k, b, v)``: per cell the sum of its documents' tokens times their posteriors, in one pass."""
    n, at = len(plan.names), {s: i for i, s in enumerate(plan.names)}
    kind = "s int, k int, b int, v binary"

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((n + 1, n, BINS, n))
        for b in batches:
            s, p, tok = _arrays(b, at, n)
            np.add.at(sums, plan.cells(s, p), p * tok[:, None])
        s, k, b = np.nonzero(sums.any(axis=3))
        yield pd.DataFrame({"s": np.where(s == n, -1, s), "k": k, "b": b, "v": [x.tobytes() for x in sums[s, k, b]]})

    def add(g: pd.DataFrame) -> pd.DataFrame:  # a group has one row per partition
        return g.head(1).assign(v=[np.sum([np.frombuffer(x) for x in g["v"]], axis=0).tobytes()])

    return scored.filter("n_tokens > 0").select("source", "n_tokens", "post").mapInPandas(part, kind).groupBy("s", "k", "b").applyInPandas(add, kind).toPandas()


def fit_mixture(scored: DataFrame, targets: pd.DataFrame, total: float | None = None, rounds: int = ROUNDS, hard: float = 100.0, soft: float = 0.01, tolerance: float = 1e-6) -> Plan:
    """Rates whose token totals meet the targets.

    ``total``: tokens of the mixture; by default the most at which every source that has documents can give its
    share within its cap. Conditions, all relative to their goals and in least squares: the total of each source
    by label, or by posterior for documents without one, with weight ``hard``, as shares of sources are what is asked
    for; the total of each source by posterior, with weight 1; and, with weight ``soft``, equal rates within a source. Each step goes
    down the gradient of the rates, with momentum, and projects them into [0, cap]. The fit has settled when a
    step moves no rate by more than ``tolerance`` of its source's even rate; if it does not within ``rounds``, an
    error is raised. Last, the rates of a source are scaled to its total, within the caps.
    """
    names = list(targets.source)
    n = len(names)
    caps, share = targets.max_repeats.to_numpy(float), targets.target_share.to_numpy(float)
    plan = Plan(names, caps, np.zeros(n))
    cells = _cells(scored, plan).sort_values(["s", "k", "b"])
    if not len(cells):
        return plan
    s, k = cells["s"].to_numpy(int), cells["k"].to_numpy(int)
    soft_tokens = np.array([np.frombuffer(v) for v in cells["v"]])
    weight = soft_tokens.sum(axis=1)
    member = np.where((s < 0)[:, None], soft_tokens, np.eye(n)[s] * weight[:, None])
    have = member[s >= 0].sum(axis=0)
    share = np.where(have > 0, share, 0.0)
    if not share.sum():
        return plan
    share = share / share.sum()
    total = min(x for x in (total, ((caps * have)[share > 0] / share[share > 0]).min()) if x is not None)
    plan.goal = goal = share * total
    even = np.divide(goal, member.sum(axis=0), out=np.zeros(n), where=share > 0)
    base = np.where(s < 0, soft_tokens @ even / weight, even[s])
    live = base > 0
    # in units of the even rates; conditions without a goal are relative to the total
    scale = np.where(goal > 0, goal, total)
    a = (np.hstack([member, soft_tokens]) * base[:, None])[live] / np.tile(scale, 2)
    want = np.tile(goal / scale, 2)
    importance = np.repeat([hard, 1.0], n)
    part = (weight * base)[live] / total
    most = caps[np.where(s < 0, k, s)][live] / base[live]

    def gradient(x: np.ndarray) -> np.ndarray:
        return (a @ (importance * (x @ a - want)) + soft * part * (x - 1)) / part

    whitened = a / np.sqrt(part)[:, None] * np.sqrt(importance)
    step = 1 / (np.linalg.eigvalsh(whitened.T @ whitened)[-1] + soft)
    x = y = np.minimum(1.0, most)
    t = 1.0
    for plan.rounds in range(1, rounds + 1):
        down = gradient(y)
        new = np.clip(y - step * down, 0, most)
        if (part * down) @ (new - x) > 0:  # the momentum leads uphill
            t = 1.0
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        y = new + (before - 1) / t * (new - x)
        moved, x = np.abs(new - x).max(initial=0.0), new
        if moved < tolerance:
            break
    else:
        raise RuntimeError(f"the mixture has not settled after {rounds} steps")
    rate = np.zeros(len(s))
    rate[live] = x * base[live]
    cap = caps[np.where(s < 0, k, s)]
    for _ in range(50):
        factor = np.divide(goal, rate @ member, out=np.ones(n), where=rate @ member > 0)
        rate = np.where(s < 0, rate, np.minimum(rate * factor[s], cap))
    plan.got = rate @ np.hstack([member, soft_tokens])
    plan.by_cell[s, k, cells["b"].to_numpy(int)] = rate
    return plan


def _rounded(group: pd.DataFrame) -> pd.DataFrame:
    """Whole copies of one group's rates, so that its tokens come out as the rates have it.

    From the longest document on, each gets the whole number next above or below its rate, at most its cap,
    that comes nearest to the tokens due so far, but no more than the later ones can make up for by getting less.
    What is left over is carried on, so that short documents even out what long ones leave.
    """
    g = group.sort_values(["n_tokens", "doc_id"], ascending=[False, True])
    rate, size, cap = g["rate"].to_numpy(float), g["n_tokens"].to_numpy(float), g["cap"].to_numpy(float)
    copies, due, rest = np.zeros(len(g), np.int64), 0.0, float(rate @ size)
    for i in range(len(g)):
        if size[i] <= 0:
            continue
        due, rest = due + rate[i] * size[i], rest - rate[i] * size[i]
        low = np.floor(rate[i] + 1e-9)
        near = min(np.floor(due / size[i] + 0.5), np.floor((due + rest + 0.5 * size[-1]) / size[i]))
        copies[i] = int(min(cap[i], max(low, min(low + 1, near))))
        due -= copies[i] * size[i]
    return pd.DataFrame({"doc_id": g["doc_id"].to_numpy(), "source": g["source"].to_numpy(), "n_tokens": g["n_tokens"].to_numpy(), "rate": np.round(rate, 6), "copies": copies})


def _planned(documents: DataFrame, targets: DataFrame, doc_id: str, text: str, source: str, ranks: str, total: float | None, unlabelled: bool) -> tuple[DataFrame, Plan]:
    wanted = _targets(targets)
    names = list(wanted.source)
    ship(documents.sparkSession)
    rows = _rows(documents, doc_id, text, source)
    mine = rows if unlabelled else rows.filter(F.col("source").isin(names))
    scored = cut(_scored(mine, names, fit_classifier(rows, names, ranks), ranks))
    return scored, fit_mixture(scored, wanted, total)


def mixture(
    documents: DataFrame, targets: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", ranks: str = tokens.RANKS, total: float | None = None, unlabelled: bool = False,
) -> DataFrame:
    """``(doc_id, source, n_tokens, rate, copies)`` for the documents of the target sources.

    ``targets`` has ``source, target_share, max_repeats``; sources compare trimmed and in lower case, and of
    several rows of one source that with the largest share holds. Copies never exceed ``max_repeats``. A target
    without documents gives nothing and the others keep their proportions; targets without a positive share or
    cap are left out. With ``unlabelled``, documents with a null source or of no target take part by their
    posteriors, with the cap of their likeliest source; without, they are left out (see :func:`membership`). Null and
    empty texts have no tokens and no copies. Repeated document rows are documents of their own. With no usable
    target no rows come out.
    """
    kind = documents.schema[doc_id].dataType.simpleString()
    if not len(_targets(targets)):
        return documents.sparkSession.createDataFrame([], f"doc_id {kind}, source string, n_tokens int, rate double, copies int")
    scored, plan = _planned(documents, targets, doc_id, text, source, ranks, total, unlabelled)
    n, at = len(plan.names), {s: i for i, s in enumerate(plan.names)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s, p, tok = _arrays(b, at, n)
            rate, cap = plan.rates(s, p)
            yield pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"], "n_tokens": b["n_tokens"], "rate": np.where(tok > 0, rate, 0.0), "cap": cap})

    rated = scored.mapInPandas(run, f"doc_id {kind}, source string, n_tokens int, rate double, cap double")
    sizes = {r.source: r.n for r in scored.groupBy("source").agg(F.count(F.lit(1)).alias("n")).filter(F.col("source").isin(plan.names)).collect()}
    rest = scored.filter(~F.coalesce(F.col("source").isin(plan.names), F.lit(False))).count() if unlabelled else 0
    parts = F.create_map(*[x for s, k in ({"": rest} | sizes).items() for x in (F.lit(s), F.lit(-(-k // ROUND_GROUP) or 1))])
    label = F.when(F.col("source").isin(plan.names), F.col("source")).otherwise("")
    rated = rated.withColumn("_label", label).withColumn("_part", F.pmod(F.xxhash64("doc_id"), F.try_element_at(parts, F.col("_label"))))
    # a group holds about ROUND_GROUP documents, without their texts
    return rated.groupBy("_label", "_part").applyInPandas(_rounded, f"doc_id {kind}, source string, n_tokens int, rate double, copies int")


def fit_report(documents: DataFrame, targets: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", ranks: str = tokens.RANKS, total: float | None = None, unlabelled: bool = False) -> DataFrame:
    """``(source, condition, goal_tokens, fitted_tokens, rounds)``: how well the rates meet each condition, ``label`` or ``posterior``."""
    kind = "source string, condition string, goal_tokens double, fitted_tokens double, rounds int"
    if not len(_targets(targets)):
        return documents.sparkSession.createDataFrame([], kind)
    scored, plan = _planned(documents, targets, doc_id, text, source, ranks, total, unlabelled)
    drop(scored)
    n = len(plan.names)
    rows = [(s, c, float(plan.goal[i]), float(plan.got[k * n + i]), plan.rounds) for k, c in enumerate(("label", "posterior")) for i, s in enumerate(plan.names)]
    return documents.sparkSession.createDataFrame(rows, kind)


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target: what it has, what is used, the share asked for, the share due and the share reached.

    The share due is that asked for, rescaled to the targets that have tokens. Documents of no target count in
    no source's tokens.
    """
    goal = targets.select(clean_source(F.col("source")).alias("source"), "target_share", "max_repeats")
    per = mixed.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_documents"), F.sum("n_tokens").alias("tokens_available"), F.count_if(F.col("copies") > 0).alias("n_used"),
        F.max("copies").alias("most_copies"), F.sum(F.col("n_tokens").cast("long") * F.col("copies")).alias("tokens_used"),
    )
    joined = goal.join(per, "source", "left").na.fill(0, ["n_documents", "tokens_available", "n_used", "most_copies", "tokens_used"])
    can = F.when(F.col("tokens_available") > 0, F.col("target_share")).otherwise(0.0)
    everything = joined.agg(F.sum("tokens_used").alias("_all"), F.sum(can).alias("_can"))  # one row
    return joined.join(F.broadcast(everything)).withColumn("due_share", F.try_divide(can, F.col("_can"))).withColumn("actual_share", F.try_divide("tokens_used", "_all")).drop("_all", "_can")
