"""Quality from three levels: a document classifier, its path and its host, by hierarchical empirical Bayes."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, written

#: Labelled documents the classifier is fitted on (in expectation), words it may look at, and their least z-score.
LABELLED, WORDS, LEAST_Z = 12_000, 400, 5.0
#: The same for toxicity: words and stems, their least z-score and documents, letters of a stem, probability that rejects.
TOXIC_WORDS, TOXIC_Z, TOXIC_LEAST, STEM, TOXIC = 600, 3.0, 5, 5, 0.25
_MARKS = str.maketrans({c: " " for c in ".,;:!?\"'()[]{}<>|/\\#$%&*+-=_~`^@0123456789"})
_SYMBOLS = re.compile(r"[#$%&*]{2,}")


def _words(text: str) -> set[str]:
    return set(text.lower().translate(_MARKS).split())


def _counted(text: str) -> Counter:
    """How often a text has each word, and each stem of a longer one."""
    words = Counter(text.lower().translate(_MARKS).split())
    stems = Counter()
    for word, n in words.items():
        if len(word) > STEM:
            stems[f"{word[:STEM]}*"] += n  # no word has an asterisk
    return words + stems


def _shape(text: str) -> list[float]:
    """What a text looks like, apart from its words; all zero for a text without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * 7
    lines = text.split("\n")
    return [
        sum(map(str.isupper, words)) / n,
        min(1.0, text.count("!") / n),
        min(1.0, len(_SYMBOLS.findall(text)) / n),
        min(1.0, text.count("|") / n),
        sum(map(eq, words, words[1:])) / n,
        1 - np.log1p(len(set(words))) / np.log1p(n),
        1 - len(set(lines)) / len(lines),
    ]


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = (Counter(), Counter())
        for text, good in zip(batch.column("text").to_pylist(), batch.column("good").to_pylist(), strict=True):
            counts[good].update(_words(text))
        words = list(counts[0] | counts[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array([counts[0][w] for w in words], pa.int64()), pa.array([counts[1][w] for w in words], pa.int64())],
            names=["word", "bad", "good"],
        )


def _featurer(place: dict[str, int]):
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("good"), pa.array([_shape(t) for t in texts], pa.list_(pa.float64())),
                 pa.array([[place[w] for w in place.keys() & _words(t)] for t in texts], pa.list_(pa.int32()))],
                names=["good", "shape", "words"],
            )

    return features


def _fit(shape: np.ndarray, words: list[list[int]], y: np.ndarray, size: int, ridge: float = 1.0, values: list[list[float]] | None = None) -> np.ndarray:
    """Logistic regression by Newton's method over shapes, ``size`` words (present, or with ``values``) and, last, an intercept; rows are unfolded in parts."""
    n, k = shape.shape
    w, penalty = np.zeros(k + size + 1), np.full(k + size + 1, ridge)
    penalty[-1] = 1e-6
    for _ in range(25):
        curve, slope = np.diag(penalty), -penalty * w
        for a in range(0, n, 1000):
            x = np.zeros((min(1000, n - a), len(w)))
            x[:, :k], x[:, -1] = shape[a : a + 1000], 1
            for i, found in enumerate(words[a : a + 1000]):
                x[i, [k + j for j in found]] = 1 if values is None else values[a + i]
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            curve += (x * (p * (1 - p) + 1e-9)[:, None]).T @ x
            slope += x.T @ (y[a : a + 1000] - p)
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return w


def _toxic_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = (Counter(), Counter())
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            counts[toxic].update(_counted(text).keys())
        words = list(counts[0] | counts[1])
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array(words, pa.string()), **{k: pa.array([counts[i][w] for w in words], pa.int64()) for i, k in enumerate(("clean", "toxic"))}}
        )


def _toxic_featurer(place: dict[str, int]):
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [{place[w]: n for w, n in _counted(t).items() if w in place} for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array([list(x) for x in found], pa.list_(pa.int32())), pa.array([list(x.values()) for x in found], pa.list_(pa.int64()))],
                names=["toxic", "words", "times"],
            )

    return features


def fit_toxicity(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> tuple[dict[str, tuple[float, float]], float]:
    """``(weights, intercept)`` of a toxicity classifier: per word or stem a weight for its presence and one for the logarithm of its count.

    Fitted on about ``labelled`` documents with a toxic label, by a hash of doc_id; one labelled
    twice is toxic if any label says so. With labels of one kind no document is toxic.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    known = known.groupBy("doc_id").agg(F.when(F.max("toxic") != 0, 1).otherwise(0).alias("toxic"))
    total = known.count()
    if total > labelled:
        known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(1_000_000)) < int(1_000_000 * labelled / total))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    sample = written(texts.join(known, "doc_id").select("text", "toxic"), "labelled-toxic")
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return {}, -30.0
    n_clean, n_toxic = sizes[0], sizes[1]
    counts = map_arrow(sample, _toxic_counter, "word string, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    share = (F.col("clean") + F.col("toxic")) / (n_clean + n_toxic)
    z = (F.col("toxic") / n_toxic - F.col("clean") / n_clean) / F.sqrt(share * (1 - share + 1e-9) * (1 / n_clean + 1 / n_toxic))
    chosen = counts.withColumn("z", F.abs(z)).filter((F.col("clean") + F.col("toxic") >= TOXIC_LEAST) & (F.col("z") >= TOXIC_Z))
    place = {r.word: i for i, r in enumerate(chosen.orderBy(F.desc("z"), "word").limit(TOXIC_WORDS).collect())}
    rows = map_arrow(sample, _toxic_featurer(place), "toxic int, words array<int>, times array<long>").collect()
    n = len(place)
    both = [[*r.words, *(n + j for j in r.words)] for r in rows]
    values = [[*([1.0] * len(r.words)), *np.log(r.times).tolist()] for r in rows]
    w = _fit(np.zeros((len(rows), 0)), both, np.array([r.toxic for r in rows], float), 2 * n, values=values)
    return {word: (float(w[i]), float(w[n + i])) for word, i in place.items()}, float(w[-1])


def _scorer(weights: dict[str, float], shape: np.ndarray, intercept: float, toxic: dict[str, tuple[float, float]], toxic_intercept: float):
    def toxicity(text: str) -> float:
        return toxic_intercept + sum(toxic[w][0] + toxic[w][1] * log(n) for w, n in _counted(text).items() if w in toxic)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text")]
            logits = [intercept + float(np.dot(shape, _shape(t))) + sum(weights[w] for w in weights.keys() & _words(t)) for t in texts]
            names = [n for n in batch.schema.names if n != "text"]
            found = [*(batch.column(n) for n in names), pa.array(logits, pa.float64()), pa.array(map(toxicity, texts), pa.float64())]
            yield pa.RecordBatch.from_arrays(found, names=[*names, "logit", "toxic_logit"])

    return score


def fit_classifier(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED):
    """``(word weights, shape weights, intercept, share of good)`` from a sample of the labelled documents.

    Good is quality 1 and not toxic; a doc_id labelled twice is good if all its labels
    are. About ``labelled`` documents are taken, by a hash of doc_id. Words are chosen by
    how unevenly they occur in good and bad documents of the sample.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").filter("doc_id is not null")
    good = F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).when(F.coalesce("quality", "toxic").isNotNull(), 0)
    known = known.withColumn("good", good).filter("good is not null").groupBy("doc_id").agg(F.min("good").alias("good"))
    total = known.count()
    if total > labelled:
        known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(1_000_000)) < int(1_000_000 * labelled / total))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    sample = written(texts.join(known, "doc_id").select("text", "good"), "labelled")
    sizes = {r.good: r.n for r in sample.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:  # nothing to tell apart: every document is as likely as the sample says
        share = (sizes.get(1, 0) + 1) / (sum(sizes.values()) + 2) if sizes else 0.5
        return {}, np.zeros(7), float(np.log(share / (1 - share))), share
    n_bad, n_good = sizes[0], sizes[1]
    counts = map_arrow(sample, _counter, "word string, bad long, good long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    share = (F.col("bad") + F.col("good")) / (n_bad + n_good)
    z = (F.col("bad") / n_bad - F.col("good") / n_good) / F.sqrt(share * (1 - share + 1e-9) * (1 / n_bad + 1 / n_good))
    chosen = counts.withColumn("z", F.abs(z)).filter((F.col("bad") + F.col("good") >= 10) & (F.col("z") >= LEAST_Z))
    place = {r.word: i for i, r in enumerate(chosen.orderBy(F.desc("z"), "word").limit(WORDS).collect())}
    rows = map_arrow(sample, _featurer(place), "good int, shape array<double>, words array<int>").collect()
    shape = np.array([r.shape for r in rows])
    center, scale = shape.mean(axis=0), shape.std(axis=0) + 1e-6
    w = _fit((shape - center) / scale, [r.words for r in rows], np.array([r.good for r in rows], float), len(place))
    by_shape = w[: shape.shape[1]] / scale
    weights = {word: float(w[shape.shape[1] + i]) for word, i in place.items()}
    return weights, by_shape, float(w[-1] - by_shape @ center), n_good / (n_bad + n_good)


def _strength(between: float, mean: float) -> float:
    """Prior observations of a Beta prior with this mean whose variance is ``between``."""
    return float(np.clip(mean * (1 - mean) / max(between, 1e-9) - 1, 1.0, 1e6))


def site_quality(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None,
                 threshold: float = 0.5, labelled: int = LABELLED) -> DataFrame:
    """Per row of ``docs(doc_id, text, ...)``: doc_id, tid, evidence, host_quality, path_quality, quality, toxicity, kept.

    ``evidence`` is the classifier's log-likelihood ratio for a good document. Each host
    (by default ``source``) has the posterior mean of its share of good documents,
    counted from labels and, where there are none, from classifier probabilities, under
    a Beta prior around the corpus's share; each path (by default ``lang`` within the
    host) has the same around its host's. The priors' strengths are the moments' estimates, so
    sparse sites shrink to the level above. ``quality`` adds the evidence to the path's
    log odds. Null hosts and paths are sites of their own; null texts are empty. ``tid``
    is xxhash64 of the text and tells rows of one doc_id apart. Without labels, or
    with labels of one kind, all documents get the sample's share. ``toxicity`` is the
    probability of a classifier of its own, of which TOXIC or more rejects a document too.
    """
    weights, shape, intercept, base = fit_classifier(docs, labels, labelled)
    toxic, toxic_intercept = fit_toxicity(docs, labels, labelled)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        (F.col("source") if host is None else host).cast("string").alias("host"),
        (F.col("lang") if path is None else path).cast("string").alias("path"),
    )
    rows = rows.select("doc_id", F.xxhash64("text").alias("tid"), F.coalesce("host", F.lit("\0")).alias("host"),
                       F.coalesce("path", F.lit("\0")).alias("path"), "text")
    scored = map_arrow(rows, _scorer(weights, shape, intercept, toxic, toxic_intercept), "doc_id long, tid long, host string, path string, logit double, toxic_logit double")
    scored = written(scored, "scores")
    bad = (F.coalesce("quality", F.lit(1)) != 1) | (F.coalesce("toxic", F.lit(0)) != 0)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(bad, 0.0).otherwise(1.0).alias("label"))
    known = known.filter("doc_id is not null").groupBy("doc_id").agg(F.min("label").alias("label"))
    probability = 1 / (1 + F.exp(-F.col("logit")))
    counted = scored.join(known, "doc_id", "left").withColumn("good", F.coalesce("label", probability))
    paths = written(counted.groupBy("host", "path").agg(F.sum("good").alias("good"), F.count(F.lit(1)).alias("n")), "paths")

    def moments(table: DataFrame, mean: Column | float) -> tuple[float, float, float, float]:
        own = F.col("good") / F.col("n")
        mean = mean if isinstance(mean, Column) else F.lit(mean)
        row = table.agg(
            F.sum(F.col("n") * F.pow(own - mean, 2)), F.sum(mean * (1 - mean)), F.sum("n"), F.sum(F.pow("n", F.lit(2)))
        ).first()
        return tuple(float(x or 0) for x in row)

    hosts = paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    whole = hosts.agg(F.sum("good"), F.sum("n")).first()
    mean = float(np.clip((whole[0] or 0.0) / max(whole[1] or 0, 1), 0.01, 0.99)) if whole[1] else base
    spread, expected, n, squares = moments(hosts, mean)
    prior = _strength((spread - expected) / max(n - squares / max(n, 1), 1), mean)
    hosts = written(hosts.select("host", ((F.col("good") + prior * mean) / (F.col("n") + prior)).alias("host_quality")), "hosts")
    nested = paths.join(hosts, "host")
    spread, expected, n, squares = moments(nested, F.col("host_quality"))
    prior = _strength((spread - expected) / max(n - squares / max(n, 1), 1), mean)
    posterior = (F.col("good") + prior * F.col("host_quality")) / (F.col("n") + prior)
    nested = written(nested.select("host", "path", "host_quality", posterior.alias("path_quality")), "sites")
    evidence = F.col("logit") - float(np.log(base / (1 - base)))
    odds = evidence + F.log(F.col("path_quality") / (1 - F.col("path_quality")))
    out = scored.join(nested, ["host", "path"]).withColumn("quality", 1 / (1 + F.exp(-odds)))
    kept = (F.col("quality") >= threshold) & (F.col("toxicity") < TOXIC)
    out = out.withColumn("toxicity", 1 / (1 + F.exp(-F.col("toxic_logit"))))
    return out.select("doc_id", "tid", evidence.alias("evidence"), "host_quality", "path_quality", "quality", "toxicity", kept.alias("kept"))
