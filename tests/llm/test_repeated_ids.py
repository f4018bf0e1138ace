"""Repeated, missing and very large ids; columns whose names clash; copies in the pipeline's windows."""

import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from test_table_operators import brute_cosine, vectors

import corpus_pipeline
from stratalake.llm import retrieval_packing, warc_index
from stratalake.llm.retrieval_packing import pack, walk
from stratalake.llm.segment_search import segment_search
from stratalake.llm.sign_dedup import sign_dedup

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def repeated_vectors():
    rng = np.random.default_rng(8)
    rows = vectors() + [(7, [1.0, 0.0, 0.0, 0.0]), (7, [0.0, 1.0, 0.0, 0.0]), (8, [1.0, 0.1, 0.0, 0.0]), (9, [0.1, 1.0, 0.0, 0.0])]
    rows += [(20, rows[40][1]), (20, rows[20][1]), (20, rows[60][1]), (40, [float(x) for x in rng.standard_normal(16).astype(np.float32)])]
    return rows + rows[60:64]


def test_links_of_repeated_ids(spark):
    rows = [r for r in repeated_vectors() if r[0] is not None]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rep int")
    found = sorted(map(tuple, sign_dedup(frame, recall=0.999999).collect()), key=str)
    assert found == sorted(brute_cosine(rows), key=str)


def test_search_of_repeated_ids(spark):
    rows = repeated_vectors()
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, h int")
    fit = [(k, np.floor(64 * np.array(v))) for k, v in rows if k is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    expected, asked = [], set()
    for k, v in fit:
        if k % 20 == 0 and (k, v.tobytes()) not in asked:
            asked.add((k, v.tobytes()))
            best = sorted((-int(v @ w), j) for j, w in fit if j != k and len(w) == len(v))[:20]
            expected += [(k, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    found = segment_search(frame).collect()
    assert sorted(map(tuple, found)) == sorted(expected)
    assert max(Counter((r.query_id, r["rank"]) for r in found).values()) > 1


def test_archives_of_large_and_repeated_page_ids(spark, monkeypatch):
    monkeypatch.setattr(warc_index, "RANGE_CAPTURES", 3)
    body = "<p>" + "x" * 120
    ids = [10**12, 2**63 - 1, -(2**63), 0, None, 5, 5, 5, None, -1]
    rows = [(i, f"http://h{n % 3}.org/{n}", body if n % 2 else f"{n}" + body) for n, i in enumerate(ids)]
    found = warc_index.warc_index(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert Counter(r.page_id for r in found) == Counter(ids)
    shared = [r for r in found if r.payload_bytes == len(body)]
    least = min(i for n, i in enumerate(ids) if n % 2 and i is not None)
    assert {(r.page_id, r.record_type, r.refers_to) for r in shared} == {
        (i, "response", None) if i == least else (i, "revisit", least) for n, i in enumerate(ids) if n % 2
    }
    ordered = sorted(found, key=lambda r: r.position)
    assert [r.position for r in ordered] == list(range(len(ids)))
    assert [(r.url_key, r.captured) for r in ordered] == sorted((r.url_key, r.captured) for r in ordered)
    far = warc_index.write_archives(
        spark.createDataFrame(rows, "page_id long, url string, html string"), warc_index.scratch_dir(spark, "far"), F.lit(2**62)
    )
    assert {r.captured for r in far.collect()} == {"1970-01-01T00:00:00Z"}


def documents(spark):
    rng = random.Random(21)
    words = [f"w{i}" for i in range(400)]
    rows = [(i if i % 9 else None, " ".join(rng.choices(words, k=rng.randint(60, 200))), "en") for i in range(60)]
    rows += [(100, rows[3][1], "en"), (None, None, "de"), (101, "", None), rows[5], rows[5]]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, lang string, n long")
    extra = {"__row": "n", "__tid": "n * 2", "__note": "n + 1", "a.b": "cast(n as string)", "__text": "'x'", "__copies": "n"}
    df = df.select("*", *(F.expr(e).alias(c) for c, e in extra.items()), F.create_map(F.lit("k"), F.col("n")).alias("m"))
    return df.withColumn("source", F.lit("s"))


def test_stages_keep_columns_whatever_their_names(spark):
    docs = documents(spark)
    before = {r.n: str(r) for r in docs.drop("text").collect()}
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.repeats):
        after = stage(spark, docs, "")
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        assert {r.n: str(r) for r in after.drop("text").collect()}.items() <= before.items()
    for stage in (corpus_pipeline.quality, corpus_pipeline.mixing):
        after = stage(spark, docs, "/root/testdata/sf0.001")
        assert after.columns == docs.columns
        assert {r.n: str(r) for r in after.drop("text").collect()}.items() <= before.items()
    pieces = corpus_pipeline.packing(spark, docs, "")
    assert sum(r.length for r in pieces.collect()) > 0


def covered(pieces, copies):
    """Whether the pieces of each document cover it as often as it occurs, without holes or overlaps."""
    by = defaultdict(Counter)
    for p in pieces:
        by[p.doc_id, p.doc_tokens][p.start, p.length] += 1
    for (doc_id, size), found in by.items():
        depth = np.zeros(size, int)
        for (start, length), n in found.items():
            depth[start : start + length] += n
        if not (depth == copies[doc_id, size]).all():
            return False
    return True


def test_pieces_cover_each_document_once(spark):
    rng = random.Random(22)
    words = [f"w{i}" for i in range(900)]
    rows = [(i, " ".join(rng.choices(words, k=rng.choice([0, 3, 200, 900, 4000])))) for i in range(120)]
    rows += [(500, None), (501, ""), (None, "a b"), *rows[3:6], *rows[3:6]]
    tokenizer = retrieval_packing.column_encoder(BYTES).texts.tokenizer
    copies = Counter((d, len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1) for d, t in rows)
    pieces = pack(spark.createDataFrame(rows, "doc_id long, text string"), BYTES).collect()
    assert covered(pieces, copies)
    assert {(p.doc_id, p.doc_tokens) for p in pieces} == set(copies)


def test_copies_come_into_different_windows(spark):
    rng = random.Random(23)
    words = [f"w{i}" for i in range(500)]
    rows = [(i, " ".join(rng.choices(words, k=150))) for i in range(200)]
    rows += rows[:60] + rows[:30]
    pieces = pack(spark.createDataFrame(rows, "doc_id long, text string"), BYTES).collect()
    windows = defaultdict(list)
    for p in pieces:
        windows[p.sequence_id].append(p.doc_id)
    twice = sum(len(w) != len(set(w)) for w in windows.values())
    assert twice <= 1 and len(windows) > 40  # the end of the stream may have nothing else left


def test_seeds_get_their_best_unused_documents(spark):
    """Against brute force on 2,000 documents: placements that take one of the seed's ten best unused ones."""
    rng = np.random.default_rng(24)
    topics = [rng.choice(40_000, 300, replace=False) for _ in range(60)]
    docs = [np.concatenate([rng.choice(topics[rng.integers(60)], rng.integers(40, 400)), rng.integers(0, 50, 60)]) for _ in range(2000)]
    found = [np.unique(d, return_counts=True) for d in docs]
    df = np.bincount(np.concatenate([f[0] for f in found]), minlength=40_000)
    corpus = retrieval_packing._Corpus(len(docs), sum(map(len, docs)), df)
    block = retrieval_packing._Block(corpus, *(np.concatenate([f[i] for f in found]) for i in (0, 1)), np.array([len(f[0]) for f in found]))
    score = retrieval_packing._all_scores(block)
    rare = df < 0.5 * len(docs)  # terms that are not in nearly all documents
    sizes = np.array([len(d) for d in docs])
    start = walk(sizes, score, np.arange(len(docs)), 2048)
    order = np.argsort(start, kind="stable")
    used, seed, good, placed = np.zeros(len(docs), bool), None, 0, 0
    for i, doc in enumerate(order.tolist()):
        window, first = start[doc] // 2048, start[doc] % 2048 == 0
        if not first and seed is not None:
            own = score[seed].copy()
            own[used] = 0
            shares = own[doc] > 0 or any(rare[t] for t in np.intersect1d(found[seed][0], found[doc][0]))
            if own.max() > 0:
                placed += 1
                good += shares and own[doc] >= np.sort(own)[-10]
        used[doc] = True
        if (start[doc] + sizes[doc]) // 2048 > window or first:
            seed = doc if (start[doc] + sizes[doc]) % 2048 else None
    assert placed > 1500 and good / placed >= 0.9
