"""Operators on vectors and pages against brute force, and the pipeline's stages."""

import random

import numpy as np
import pytest

import corpus_pipeline
from stratalake.llm.common import table
from stratalake.llm.components import components
from stratalake.llm.queries import ORACLE, QUERIES, URL_RULES
from stratalake.llm.segment_search import search_block, segment_search
from stratalake.llm.sign_dedup import sign_dedup
from stratalake.llm.url_cascade import Cascade, url_verdicts
from stratalake.llm.warc_index import loser_tree, warc_index


@pytest.fixture(scope="module")
def sf():
    return "/root/testdata/sf0.001"


def brute_cosine(rows, threshold=0.9):
    fit = [(i, np.array(v, float)) for i, (k, v) in enumerate(rows) if k is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i in range(len(rows))}
    for a, (i, v) in enumerate(fit):
        for j, w in fit[:a]:
            if len(v) == len(w) and v @ w / (np.sqrt(v @ v) * np.sqrt(w @ w)) >= threshold:
                links[i].add(j)
                links[j].add(i)
    out = []
    for i, (k, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((k, len(links[i]), least, k == least))
    return sorted(out, key=str)


def vectors(seed=1):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((40, 16))
    rows = [(i, [float(np.float32(x)) for x in base[i % 40] + rng.standard_normal(16) * 0.02 * (i % 7)]) for i in range(300)]
    rows += [(400 + i, rows[3][1]) for i in range(30)]
    rows += [(500, None), (501, []), (502, [0.0] * 16), (503, [None, *[1.0] * 15]), (504, [float("nan")] * 16), (505, [float("inf")] * 16), (506, [1.0, 2.0])]
    return rows + [(None, rows[0][1]), (507, [x * 2 for x in rows[5][1]])]


def test_sign_hashing_finds_all_links(spark, monkeypatch):
    from stratalake.llm import sign_dedup as module

    rows = vectors()
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, bucket string")
    found = sorted(map(tuple, sign_dedup(frame, recall=0.999999).collect()), key=str)
    expected = [r if r[0] is not None else (None, 0, None, True) for r in brute_cosine([(k, v) if k is not None else (None, None) for k, v in rows])]
    assert found == sorted(expected, key=str)
    monkeypatch.setattr(module, "BLOCK", 5)
    assert sorted(map(tuple, sign_dedup(frame, recall=0.999999).collect()), key=str) == found
    assert sign_dedup(frame.limit(0)).count() == 0


def test_sign_hashing_on_the_embeddings(spark, sf):
    rows = [(r.vec_id, list(r.embedding)) for r in table(spark, sf, "embeddings").collect()]
    expected = brute_cosine(rows)
    found = sorted(map(tuple, QUERIES["op9_sign_dedup"](spark, sf).collect()), key=str)
    total = sum(r[1] for r in expected)
    assert sum(r[1] for r in found) >= 0.99 * total
    if sum(r[1] for r in found) == total:
        assert found == expected


def test_components_of_paths_hubs_and_loops(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, i) for i in range(2000, 2100)] + [(5000, 5000), (None, 3)]
    random.Random(2).shuffle(edges)
    found = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(101)}, 1000: 1000, **{i: 1000 for i in range(2000, 2100)}, 5000: 5000}


def test_search_prunes_without_loss():
    rng = np.random.default_rng(3)
    for scale in (8, 3e8):
        x = np.floor(rng.standard_normal((500, 24)) * scale)
        x[100:140] = x[0]
        ids = np.arange(500)
        q, v, s = search_block(ids[::20], x[::20], ids, x, 7)
        exact = x.astype(np.int64)
        expected = []
        for i in ids[::20]:
            score = exact @ exact[i]
            best = sorted((int(-score[j]), int(j)) for j in ids if j != i)[:7]
            expected += [(int(i), j, -n) for n, j in best]
        assert list(zip(q.tolist(), v.tolist(), s.tolist(), strict=True)) == expected


def test_search_of_awkward_vectors(spark):
    frame = spark.createDataFrame([(k, v, 1) for k, v in vectors()], "vec_id long, embedding array<float>, rank int")
    fit = [(k, np.floor(64 * np.array(v))) for k, v in vectors() if k is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    expected = []
    for k, v in fit:
        if k % 20 == 0:
            best = sorted((-int(v @ w), j) for j, w in fit if j != k and len(w) == len(v))[:20]
            expected += [(k, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    assert sorted(map(tuple, segment_search(frame).collect())) == sorted(expected)
    assert segment_search(frame.limit(0)).count() == 0


def test_loser_tree_merges_runs():
    rng = random.Random(4)
    for k in range(9):
        for _ in range(30):
            runs = [sorted(rng.choices(range(20), k=rng.randint(0, 6))) for _ in range(k)]
            assert list(loser_tree(runs)) == sorted(x for r in runs for x in r)


def test_archives_of_awkward_pages(spark):
    body = "<p>" + "é" * 60
    rows = [(3, "http://A.com/x?q#f", body), (1, "http://b.com/\r\nx y", body), (2, None, body), (4, "nothing", None), (5, "http://c.com", ""), (6, "", "short"), (7, "http://d.com", "short"), (None, "http://e.com", body)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    found = {r.page_id: r for r in warc_index(pages).collect()}
    assert {k: (r.record_type, r.refers_to) for k, r in found.items()} == {
        1: ("response", None), 2: ("revisit", 1), 3: ("revisit", 1), None: ("revisit", 1), 4: ("response", None),
        5: ("response", None), 6: ("response", None), 7: ("response", None),
    }
    assert found[3].payload_bytes == len(body.encode()) and found[4].payload_bytes == 0
    ordered = sorted(found.values(), key=lambda r: r.position)
    assert [r.position for r in ordered] == list(range(8))
    assert [r.url_key for r in ordered] == sorted(r.url_key for r in ordered)
    assert warc_index(pages.limit(0)).count() == 0


def test_cascade_is_exact_on_its_universe(spark):
    keys = [f"host{i}.example" for i in range(3000)]
    universe = spark.createDataFrame([(k,) for k in keys], "key string")
    for listed in ([], keys[:1], keys[::7], keys):
        cascade = Cascade(spark.createDataFrame([(k,) for k in listed], "key string"), universe)
        found = {r.key for r in universe.filter(cascade.contains(universe.key)).collect()}
        assert found == set(listed)


def test_verdicts_of_awkward_urls(spark):
    urls = ["http://www.Example.com/en/x", "http://example.com/en/", "http://example.com/EN/", "http://a.net/es/1", "http://net/fr/", "http://bad.org/x",
            "http://sub.bad.org", "http://notbad.org/", "http://x.com", "x.com/", None, "", "://", "http://a.com?x://b.net/es/", "ftp://É.net/es/"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    listed = spark.createDataFrame([("bad.org",)], "key string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_verdicts(pages, URL_RULES, listed).collect()}
    assert found == {
        0: ("www.example.com", "/en/x", "www.example.com/en/", "allow"), 1: ("example.com", "/en/", "example.com/en/", "block"),
        2: ("example.com", "/EN/", "com/", "allow"), 3: ("a.net", "/es/1", "net/es/", "block"), 4: ("net", "/fr/", "net/fr/", "block"),
        5: ("bad.org", "/x", None, "block"), 6: ("sub.bad.org", "", None, "block"), 7: ("notbad.org", "/", None, "allow"),
        8: ("x.com", "", None, "allow"), 9: ("", "", None, "allow"), 10: ("", "", None, "allow"), 11: ("", "", None, "allow"),
        12: ("", "", None, "allow"), 13: ("a.com", "", None, "allow"), 14: ("É.net", "/es/", "net/es/", "block"),
    }
    assert url_verdicts(pages.limit(0), URL_RULES, listed.limit(0)).count() == 0


def test_queries_equal_their_sql(spark, sf):
    import duckdb

    base = duckdb.connect()
    for name in ("pages", "embeddings", "documents", "benchmark"):
        base.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    for name, sql in ORACLE.items():
        found = QUERIES[name](spark, sf)
        expected = base.sql(sql)
        order = sorted(found.columns)
        assert sorted(expected.columns) == order
        rows = base.sql(f"SELECT {', '.join(order)} FROM ({sql})").fetchall()
        assert sorted(map(str, rows)) == sorted(str(tuple(r)) for r in found.select(*order).collect()), name


def test_pipeline_stages_keep_the_columns(spark, sf):
    docs = table(spark, sf, "documents")
    before, kept = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes, name
        before = after
        kept.append(after.count())
    assert kept[0] > kept[1] > kept[2] >= kept[3] and kept[4] >= kept[3]
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, sf).collect()
    assert len({(p.doc_id, p.start) for p in pieces}) <= len(pieces)
    assert {p.doc_id for p in pieces} == {r.doc_id for r in before.select("doc_id").collect()}
