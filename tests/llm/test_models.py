"""Domain memberships and rates, and site posteriors, against plain numpy."""

import logging
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stratalake.llm import domain_mixing, site_quality
from stratalake.llm.common import table
from stratalake.llm.queries import DOMAIN_WEIGHTS, labelled_domains

SF = "/root/testdata/sf0.001"


def spark_hash(text):
    value = xxhash.xxh64(text.encode(), seed=42).intdigest()
    return value - (1 << 64) if value >= 1 << 63 else value


def words(text):
    return [w for w in re.split(r"[ \t\n\x0b\f\r]+", text or "") if w]


def posteriors(docs, known, domains):
    """Naive Bayes over hashed words with smoothing towards the pooled distribution, tempered."""
    size = domain_mixing.BUCKETS
    counts = np.zeros((len(domains), size))
    for doc_id, text in docs:
        if doc_id in known:
            for w in words(text):
                counts[domains.index(known[doc_id]), spark_hash(w) % size] += 1
    pooled, sizes = counts.sum(axis=0), counts.sum(axis=1)
    smooth = 1000 * (pooled + 0.5) / (pooled.sum() + size / 2)
    weights = np.log((counts + smooth) / (sizes + 1000)[:, None])
    prior = np.log((sizes + 1) / (sizes.sum() + len(domains)))
    merged = defaultdict(Counter)
    for doc_id, text in docs:
        merged[doc_id, spark_hash(text or "")].update(spark_hash(w) % size for w in words(text))
    out = {}
    for key, held in merged.items():
        n = sum(held.values())
        score = prior + sum((weights[:, b] * k for b, k in held.items()), np.zeros(len(domains))) * min(domain_mixing.EVIDENCE, n) / max(n, 1)
        power = np.exp(score - score.max())
        out[key] = (n, power / power.sum())
    return out


@pytest.fixture(scope="module")
def mixed(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang", "source")
    more = spark.createDataFrame([(3, None, "en", "s"), (None, "a b", "de", "s"), (None, "", None, None), (7, "x\ty\nz", "fr", "s")], docs.schema)
    docs = docs.union(more).union(docs.limit(3))
    labelled = labelled_domains(docs, table(spark, SF, "labels")).distinct()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    # a doc_id with two languages counts for the first of them
    known = {r.doc_id: r.domain for r in labelled.groupBy("doc_id").agg(F.min("domain").alias("domain")).collect()}
    domains = sorted(DOMAIN_WEIGHTS)
    known = {k: d for k, d in known.items() if d in domains and k is not None}
    return docs, labelled, posteriors(rows, known, domains)


def test_posteriors_equal_naive_bayes(mixed):
    docs, labelled, expected = mixed
    found = domain_mixing.domain_posteriors(docs, labelled, sorted(DOMAIN_WEIGHTS)).collect()
    assert len(found) == len(expected)
    for r in found:
        n, p = expected[r.doc_id, r.tid]
        assert r.n == n and np.allclose(r.p, p, atol=1e-9)


@pytest.mark.parametrize("floor", [0.0, 1.0])
def test_rates_equal_projected_gradient(mixed, floor):
    docs, labelled, expected = mixed
    keys = list(expected)
    n, p = np.array([expected[k][0] for k in keys], float), np.array([expected[k][1] for k in keys])
    domains = sorted(DOMAIN_WEIGHTS)
    share = np.array([DOMAIN_WEIGHTS[d] for d in domains]) / sum(DOMAIN_WEIGHTS.values())
    total = (n @ p / share).max() if floor else n.sum()
    target, rate = share * total, np.ones(len(keys))
    metric = np.linalg.inv((p * n[:, None]).T @ p)
    for _ in range(500):
        rate = np.maximum(floor, rate + p @ (metric @ (target - (n * rate) @ p)))
    found = {(r.doc_id, r.tid): r for r in domain_mixing.mix_domains(docs, labelled, DOMAIN_WEIGHTS, floor=floor).collect()}
    ours = np.array([found[k].rate for k in keys])
    error, best = (np.linalg.norm((n * r) @ p - target) / np.linalg.norm(target) for r in (ours, rate))
    assert (ours >= floor - 1e-12).all() and error <= best + (0.005 if floor else 1e-3)
    assert best < (0.05 if floor else 1e-6)
    if not floor:  # with a floor that binds, other rates give the same totals
        assert np.allclose(ours, rate, atol=0.02)
    assert all(r.copies in (math.floor(r.rate), math.floor(r.rate) + 1) for r in found.values())


def test_a_missed_target_is_told_and_the_best_rates_are_kept(spark, caplog):
    members = spark.createDataFrame([(10, [1.0, 0.0]), (5, [0.9, 0.1])], "n long, p array<double>")
    with caplog.at_level(logging.WARNING):
        rate, totals = domain_mixing.fit_rates(members, [1.0, 100.0], floor=0.5)
    assert "miss the targets" in caplog.text
    held = [r[0] for r in members.select(rate).collect()]
    assert min(held) >= 0.5
    assert totals == pytest.approx([10 * held[0] + 4.5 * held[1], 0.5 * held[1]])


def beta_posteriors(good, n, host_of, mean):
    """Shares of hosts, then of their paths, by moments: plain loops over dictionaries."""

    def strength(own, number, centre):
        spread = sum(number[k] * (own[k] / number[k] - centre[k]) ** 2 for k in own)
        expected = sum(centre[k] * (1 - centre[k]) for k in own)
        total, squares = sum(number.values()), sum(x * x for x in number.values())
        between = (spread - expected) / max(total - squares / max(total, 1), 1)
        return min(max(mean * (1 - mean) / max(between, 1e-9) - 1, 1.0), 1e6)

    hosts, sizes = defaultdict(float), defaultdict(int)
    for path, value in good.items():
        hosts[host_of[path]] += value
        sizes[host_of[path]] += n[path]
    prior = strength(hosts, sizes, {h: mean for h in hosts})
    by_host = {h: (hosts[h] + prior * mean) / (sizes[h] + prior) for h in hosts}
    centre = {p: by_host[host_of[p]] for p in good}
    prior = strength(good, n, centre)
    return by_host, {p: (good[p] + prior * centre[p]) / (n[p] + prior) for p in good}


def test_site_posteriors_equal_plain_moments(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang", "source")
    more = spark.createDataFrame([(900_001, "good words here", None, None), (900_002, None, "en", "lonely"), (None, "x y", "en", "lonely")], docs.schema)
    docs, labels = docs.union(more), table(spark, SF, "labels")
    weights, shape, intercept, base = site_quality.fit_classifier(docs, labels)
    toxic, toxic_intercept = site_quality.fit_toxicity(docs, labels)
    label = defaultdict(lambda: 1.0)
    for r in labels.collect():
        bad = (r.quality is not None and r.quality != 1) or (r.toxic is not None and r.toxic != 0)
        label[r.doc_id] = min(label[r.doc_id], 0.0 if bad else 1.0)
    rows, good, n, host_of = [], defaultdict(float), Counter(), {}
    for r in docs.collect():
        text = r.text or ""
        logit = intercept + float(np.dot(shape, site_quality._shape(text))) + sum(weights[w] for w in site_quality._words(text) if w in weights)
        tox = toxic_intercept + sum(toxic[w][0] + toxic[w][1] * math.log(k) for w, k in site_quality._counted(text).items() if w in toxic)
        path = (r.source, r.lang)
        host_of[path] = r.source
        good[path] += label[r.doc_id] if r.doc_id in label else 1 / (1 + math.exp(-logit))
        n[path] += 1
        rows.append((r.doc_id, spark_hash(text), path, logit, 1 / (1 + math.exp(-tox))))
    mean = min(max(sum(good.values()) / sum(n.values()), 0.01), 0.99)
    by_host, by_path = beta_posteriors(good, n, host_of, mean)
    found = {(r.doc_id, r.tid): r for r in site_quality.site_quality(docs, labels).collect()}
    assert len(found) == len(rows)
    for doc_id, tid, path, logit, toxicity in rows:
        r = found[doc_id, tid]
        evidence = logit - math.log(base / (1 - base))
        quality = 1 / (1 + math.exp(-(evidence + math.log(by_path[path] / (1 - by_path[path])))))
        assert (r.host_quality, r.path_quality) == (pytest.approx(by_host[path[0]]), pytest.approx(by_path[path]))
        assert (r.evidence, r.quality, r.toxicity) == (pytest.approx(evidence, abs=1e-6), pytest.approx(quality), pytest.approx(toxicity))
        assert r.kept == (r.quality >= 0.5 and r.toxicity < site_quality.TOXIC)
