"""Mixing sources to target weights (problem 7), by entropy balancing.

Each source is to have its share of all tokens of the mixture, and no text is used more often than its source allows. The mixture is as large as these two
allow: the source that has the least, used as often as it may be, sets the total. A document's expected copies are its base rate tilted exponentially by its
length, within 0 and the cap: cap * sigmoid(base + lambda * tokens / mean). The lambdas solve the convex dual of minimising the relative entropy to the base
rates under one token constraint a source. Damped Newton steps find them; each step is a distributed sum over the histogram (source, tokens, texts).

Rates become copies without drawing: along the lengths of a source the running total of rates is rounded down, which gives each length its number of copies,
and the texts of one length share these out by rank of a hash. So the tokens of a source differ from the target by a few texts at most.

Defined results: texts that are equal count as one, that of the smallest id among the sources of the mixture; null and empty texts are left out. A source of the
targets without tokens has no share, and the others' shares are scaled up. Sources without a target are left out. Shares that are null, zero or negative count as
none; a cap that is null or under 1 as 1. Empty tables give no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import written
from .tokens import VOCABULARY, rank_within, token_sizes


def _rate(params: dict[str, tuple[int, float, float, float]]) -> Column:
    """Expected copies of a text of ``tokens`` tokens: params are (cap, base, lambda, mean length) by source."""
    pick = lambda i: F.element_at(F.create_map(*[x for s, p in params.items() for x in (F.lit(s), F.lit(float(p[i])))]), F.col("source"))
    z = pick(1) + pick(2) * F.col("tokens") / pick(3)
    return pick(0) / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), z))))


def solve_tilts(histogram: DataFrame, targets: dict[str, float], caps: dict[str, int], totals: dict[str, tuple[int, int]], *, steps: int = 60, exact: float = 1e-9) -> dict[str, tuple[int, float, float, float]]:
    """Newton iterations on the dual. A source whose target is all it has is at the bound: every text as often as it may be. Where
    ``steps`` are not enough, it is an error."""
    params = {}
    for s, t in targets.items():
        tokens, texts = totals[s]
        bound = t >= caps[s] * tokens * (1 - 1e-12)
        params[s] = (caps[s], 1e3 if bound else math.log(1 / (caps[s] - 1)) if caps[s] > 1 else 0.0, 0.0, tokens / texts)
    open_ = {s for s in targets if params[s][1] < 1e3}
    for _ in range(steps):
        if not open_:
            break
        r = _rate({s: params[s] for s in open_})
        x = F.col("tokens") / F.element_at(F.create_map(*[y for s in open_ for y in (F.lit(s), F.lit(params[s][3]))]), F.col("source"))
        cap = F.element_at(F.create_map(*[y for s in open_ for y in (F.lit(s), F.lit(float(caps[s])))]), F.col("source"))
        h = histogram.filter(F.col("source").isin(list(open_))).withColumn("r", r).withColumn("x", x).withColumn("cap", cap)
        sums = h.groupBy("source").agg(F.sum(F.col("texts") * F.col("r") * F.col("tokens")).alias("got"), F.sum(F.col("texts") * F.col("r") * (1 - F.col("r") / F.col("cap")) * F.col("tokens") * F.col("x")).alias("slope")).collect()
        for q in sums:
            s = q["source"]
            off = q["got"] - targets[s]
            if abs(off) <= exact * targets[s]:
                open_.discard(s)
                continue
            step = max(-1.5, min(1.5, off / q["slope"])) if q["slope"] > 0 else math.copysign(1.5, off)
            cap_, base, lam, mean = params[s]
            params[s] = (cap_, base, lam - step, mean)
    if open_:
        raise RuntimeError(f"no tilt within {exact} of the target after {steps} steps: {', '.join(sorted(open_))}")
    return params


def mix(df: DataFrame, text: Column, doc_id: Column, source: Column, targets: DataFrame, *, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, tokens, rate, copies): the documents of the mixture. ``targets``: source, target_share, max_repeat (a small fixed table)."""
    wanted = {r["source"]: (r["target_share"], max(1, r["max_repeat"] or 1)) for r in targets.collect() if r["source"] is not None and (r["target_share"] or 0) > 0}
    src = df.select(doc_id.alias("doc_id"), source.alias("source"), text.cast("string").alias("text")).filter(F.col("source").isin(list(wanted)) & (F.length("text") > 0))
    sized = token_sizes(src, F.col("text"), [F.col("doc_id"), F.col("source"), F.md5("text").alias("digest")], vocabulary=vocabulary)
    one = sized.groupBy("digest").agg(F.min_by(F.struct("doc_id", "source", "tokens"), F.struct("doc_id", "source")).alias("d")).select("d.*").filter("tokens > 0")
    one = written(one, "mixture-texts")
    histogram = written(one.groupBy("source", "tokens").agg(F.count("*").alias("texts")), "mixture-lengths")
    totals = {r["source"]: (r["tokens"], r["texts"]) for r in histogram.groupBy("source").agg(F.sum(F.col("tokens") * F.col("texts")).alias("tokens"), F.sum("texts").alias("texts")).collect()}
    weight = sum(wanted[s][0] for s in totals)
    shares = {s: wanted[s][0] / weight for s in totals}
    caps = {s: wanted[s][1] for s in totals}
    total = min((caps[s] * totals[s][0] / shares[s] for s in totals), default=0.0)
    if not totals:
        return one.withColumn("rate", F.lit(0.0)).withColumn("copies", F.lit(0).cast("long")).limit(0)
    params = solve_tilts(histogram, {s: total * shares[s] for s in totals}, caps, totals)
    along = Window.partitionBy("source").orderBy("tokens").rowsBetween(Window.unboundedPreceding, 0)
    cap = F.element_at(F.create_map(*[y for s in caps for y in (F.lit(s), F.lit(caps[s]))]), F.col("source"))
    plan = histogram.withColumn("rate", _rate(params)).withColumn("upto", F.floor(F.sum(F.col("rate") * F.col("texts")).over(along) + 1e-6))
    plan = plan.withColumn("copies_all", F.col("upto") - F.coalesce(F.lag("upto").over(Window.partitionBy("source").orderBy("tokens")), F.lit(0)))
    plan = plan.withColumn("copies_all", F.least("copies_all", cap * F.col("texts"))).select("source", "tokens", "texts", "rate", "copies_all")
    ranked = rank_within(one.withColumn("h", F.xxhash64("doc_id")), ["source", "tokens"], ["h", "doc_id"], sum(n for _, n in totals.values()))
    copies = F.floor(F.col("copies_all") / F.col("texts")) + F.when(F.col("rank") < F.col("copies_all") % F.col("texts"), 1).otherwise(0)
    out = ranked.join(plan, ["source", "tokens"]).withColumn("copies", copies.cast("long")).filter("copies > 0")
    return out.select("doc_id", "source", "tokens", F.round("rate", 9).alias("rate"), "copies")


def shares_reached(mixture: DataFrame, targets: DataFrame) -> DataFrame:
    """By source of the targets: texts, copies, the most copies of one text, tokens, and the share of all tokens beside the target."""
    got = mixture.groupBy("source").agg(F.count("*").alias("texts"), F.sum("copies").alias("copies"), F.max("copies").alias("most_copies"), F.sum(F.col("tokens") * F.col("copies")).alias("tokens"))
    every = targets.filter("source is not null").join(got, "source", "left").fillna(0, ["texts", "copies", "most_copies", "tokens"])
    return every.withColumn("share", F.round(F.col("tokens") / F.greatest(F.sum("tokens").over(Window.partitionBy()), F.lit(1)), 6))
