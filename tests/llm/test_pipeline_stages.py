"""The pipeline's stages on rows that repeat a doc_id or have none."""

import random

import corpus_pipeline


def test_one_row_of_each_group_goes_through_the_stages(spark):
    rng = random.Random(11)
    text = [" ".join(f"{c}{rng.randint(0, 999)}" for _ in range(120)) for c in "abcdef"]
    rows = [(1, text[0]), (1, text[0]), (None, text[0]), (2, text[1]), (None, text[1] + " end"), (None, text[2]), (None, text[2])]
    rows += [(3, text[3]), (3, text[4]), (4, text[3] + " end"), (None, text[5]), (None, None), (None, None), (5, "")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, n long")
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    left = [(1, text[0]), (2, text[1]), (None, text[2]), (3, text[3]), (3, text[4]), (None, text[5])]
    assert found == sorted([*left, (None, None), (None, None), (5, "")], key=str)
    after = sorted(((r.doc_id, r.text) for r in corpus_pipeline.repeats(spark, kept, "").collect()), key=str)
    assert after == sorted(left, key=str)


def test_the_whole_chain_packs_what_the_stages_keep(spark):
    from collections import defaultdict

    import numpy as np

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
    kept = {r.doc_id for r in docs.collect()}
    pieces = corpus_pipeline.run(spark, sf).collect()
    assert {p.doc_id for p in pieces} == kept
    depth, windows = {}, defaultdict(list)
    for p in pieces:
        found = depth.setdefault((p.doc_id, p.doc_tokens), np.zeros(p.doc_tokens, int))
        found[p.start : p.start + p.length] += 1
        windows[p.sequence_id].append((p.offset, p.length, p.doc_id))
    # each document is covered as a whole, as often as the mixing stage repeats it
    copies = {r.doc_id: r["count"] for r in docs.groupBy("doc_id").count().collect()}
    assert all((found == copies[doc_id]).all() for (doc_id, _), found in depth.items())
    twice = 0
    for parts in windows.values():
        ends = 0
        for offset, length, _ in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= 2048 and (ends == 2048 or ends & (ends - 1) == 0)
        twice += len({d for *_, d in parts}) != len(parts)
    assert twice <= 1 + len(windows) // 20  # where little else is left
