"""Mixing to target weights: soft domain memberships, then document rates by projected least squares.

DataFrame functions only. A naive Bayes classifier over hashed words gives each document
posteriors over domains. Rates r >= floor make the expected tokens of each domain,
sum of r * n * p, meet the targets T: projected gradient steps r <- max(floor, r + p.W(T - E(r)))
minimise |E(r) - T| in the metric W, the inverse of G = sum of n * p * p'. In that metric
the step length 1 is right for any corpus, and steps are large where domains are small.
"""

from __future__ import annotations

import logging
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Rounds end at this relative error, when one gains under a hundredth, or at their limit.
TOLERANCE, ROUNDS = 1e-4, 40
#: Relative error of the totals that is worth a warning.
MISSED = 0.01
#: Word buckets of the classifier, labelled documents it is fitted on (in expectation), words of evidence at most.
BUCKETS, LABELLED, EVIDENCE = 8192, 20_000, 8

logger = logging.getLogger(__name__)


def _inverse(g: list[list[float]]) -> list[list[float]]:
    """Inverse of a small positive matrix with a little ridge, by Gauss-Jordan elimination."""
    k = len(g)
    ridge = 1e-9 * max(max((g[i][i] for i in range(k)), default=0.0), 1.0)
    rows = [[*(g[i][j] + ridge * (i == j) for j in range(k)), *(float(i == j) for j in range(k))] for i in range(k)]
    for c in range(k):
        pivot = max(range(c, k), key=lambda r: abs(rows[r][c]))
        rows[c], rows[pivot] = rows[pivot], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for r in range(k):
            if r != c:
                rows[r] = [x - rows[r][c] * y for x, y in zip(rows[r], rows[c], strict=True)]
    return [row[k:] for row in rows]


def _pieces(df: DataFrame, *keep: str) -> DataFrame:
    piece = df.select(*keep, F.explode(F.split("text", r"\s+")).alias("piece"))
    return piece.withColumn("bucket", F.pmod(F.xxhash64("piece"), F.lit(BUCKETS)).cast("int"))


def _named(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("tid"), "text")


def domain_posteriors(docs: DataFrame, labelled: DataFrame, domains: list[str], sample: int = LABELLED) -> DataFrame:
    """``(doc_id, tid, n, p)``: words and posteriors over ``domains`` of every document.

    ``labelled(doc_id, domain)`` names the domain of some documents; about ``sample`` of
    them, by a hash of doc_id, train the classifier. Evidence is tempered to that of at
    most EVIDENCE words, which keeps memberships soft. Rows with equal doc_id and text
    are one document whose words add up; one without words has the prior.
    """
    spark = docs.sparkSession
    known = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), "domain").filter(F.col("domain").isin(domains))
    known = known.filter("doc_id is not null").groupBy("doc_id").agg(F.min("domain").alias("domain"))
    total = known.count()
    if total > sample:
        known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(1_000_000)) < int(1_000_000 * sample / total))
    rows = _named(docs)
    taken = rows.join(known, "doc_id")
    seen = _pieces(taken, "domain").filter("piece != ''").groupBy("bucket", "domain").agg(F.count(F.lit(1)).alias("n"))
    counts = [[0] * BUCKETS for _ in domains]
    for row in seen.collect():  # at most BUCKETS x domains rows
        counts[domains.index(row.domain)][row.bucket] = row.n
    sizes = [sum(c) for c in counts]
    pooled = [sum(c[b] for c in counts) for b in range(BUCKETS)]
    everything = sum(sizes)
    # Dirichlet smoothing towards the pooled distribution
    weights = [
        [b, *(math.log((c[b] + 1000 * (pooled[b] + 0.5) / (everything + BUCKETS / 2)) / (s + 1000)) for c, s in zip(counts, sizes, strict=True))]
        for b in range(BUCKETS)
    ]
    names = [f"w{k}" for k in range(len(domains))]
    table = spark.createDataFrame(weights, "bucket int, " + ", ".join(f"{n} double" for n in names))
    pieces = _pieces(rows, "doc_id", "tid").join(F.broadcast(table), "bucket")  # BUCKETS rows
    word = F.col("piece") != ""
    sums = pieces.groupBy("doc_id", "tid").agg(
        F.count(F.when(word, 1)).alias("n"), *(F.sum(F.when(word, F.col(n)).otherwise(0.0)).alias(n) for n in names)
    )
    priors = [math.log((s + 1) / (everything + len(domains))) for s in sizes]
    temper = F.least(F.lit(float(EVIDENCE)), F.col("n")) / F.greatest(F.col("n"), F.lit(1))
    scores = [F.col(n) * temper + prior for n, prior in zip(names, priors, strict=True)]
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    powers = F.array(*(F.exp(s - top) for s in scores))
    total_power = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    out = sums.select("doc_id", "tid", "n", powers.alias("e"))
    return written(out.select("doc_id", "tid", "n", F.transform("e", lambda x: x / total_power).alias("p")), "posteriors")


def _dot(p: Column, y: list[float]) -> Column:
    out = F.lit(0.0)
    for k, value in enumerate(y):
        out = out + F.get(p, F.lit(k)) * value
    return out


def fit_rates(members: DataFrame, targets: list[float], floor: float = 0.0) -> tuple[Column, list[float]]:
    """The rate of a document as a column over ``members(n, p)``, and the domain totals it gives: the best of all rounds.

    Targets that no rates above the floor meet are missed with a warning.
    """
    k = len(targets)
    get = [F.get("p", F.lit(i)) for i in range(k)]
    upper = [(i, j) for i in range(k) for j in range(i, k)]
    row = members.agg(*(F.sum(F.col("n") * get[i] * get[j]) for i, j in upper)).first()
    g = [[0.0] * k for _ in range(k)]
    for (i, j), value in zip(upper, row, strict=True):
        g[i][j] = g[j][i] = float(value or 0.0)
    inverse = _inverse(g)
    rate, best, found, reached = F.lit(1.0), None, F.lit(1.0), [0.0] * k
    for _ in range(ROUNDS):
        row = members.agg(*(F.sum(F.col("n") * x * rate) for x in get)).first()
        now = [float(v or 0.0) for v in row]
        gap = [t - v for t, v in zip(targets, now, strict=True)]
        error = math.sqrt(sum(x * x for x in gap)) / max(math.sqrt(sum(t * t for t in targets)), 1e-300)
        gains = best is None or error < best * 0.99
        if best is None or error < best:
            best, found, reached = error, rate, now
        if error <= TOLERANCE or not gains:
            break
        step = [round(sum(w * x for w, x in zip(row_, gap, strict=True)), 12) for row_ in inverse]
        rate = F.greatest(F.lit(float(floor)), rate + _dot(F.col("p"), step))
    if best > MISSED:
        logger.warning("domain totals %s miss the targets %s", [round(v) for v in reached], [round(v) for v in targets])
    return found, reached


def mix_domains(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], tokens: float | None = None, floor: float = 0.0,
                sample: int = LABELLED) -> DataFrame:
    """Per document: doc_id, tid, n_tokens, p_<domain>..., rate, copies.

    ``weights`` are the domains' target shares of ``tokens`` words (by default: as many
    as there are; with a ``floor`` of 1 or more, as many as let every domain keep all its words).
    ``rate`` >= ``floor`` is how often a document should occur; ``copies`` rounds it up
    or down by a hash of the document, so that the expectation is the rate. Without
    documents the result is empty; a domain that no document belongs to stays empty.
    """
    domains = sorted(weights)
    total = sum(weights.values())
    shares = [weights[d] / total for d in domains]
    members = domain_posteriors(docs, labelled, domains, sample)
    row = members.agg(*(F.sum(F.col("n") * F.get("p", F.lit(i))) for i in range(len(domains)))).first()
    held = [float(v or 0.0) for v in row]
    if tokens is None:
        tokens = max((h / s for h, s in zip(held, shares, strict=True) if s), default=0.0) * floor if floor >= 1 else sum(held)
    rate, _ = fit_rates(members, [s * tokens for s in shares], floor)
    part = F.pmod(F.xxhash64("doc_id", "tid", F.lit(22)), F.lit(1 << 20)) / float(1 << 20)
    out = members.select("doc_id", "tid", F.col("n").alias("n_tokens"), *(F.get("p", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(domains)), rate.alias("rate"))
    return out.withColumn("copies", F.floor(F.col("rate") + part).cast("int"))
