"""The packing's search over all documents and all of their ids."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from stratalake.llm import retrieval_packing
from stratalake.llm.retrieval_packing import pack, pack_shard

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def sequences(pieces):
    out = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        out.setdefault(p.sequence_id, []).append(p.doc_id)
    return list(out.values())


def test_neighbours_are_found_however_far_apart_their_ids_lie(spark):
    rng = random.Random(13)
    words = ["".join(" " + "".join(rng.choices("bcdfghjklmnpqrstvwxz", k=9)) for _ in range(4)) for _ in range(3000)]
    start = "".join(" " + "".join(rng.choices("bcdfghjklmnpqrstvwxz", k=9)) for _ in range(25))
    rows = [(i, start + words[i % 3000]) for i in range(6000)]
    found = [x for x in sequences(pack(spark.createDataFrame(rows, "doc_id long, text string"), BYTES).collect()) if len(x) > 9]
    seen, followed = set(), []
    for docs in found:
        pair = (docs[0] + 3000) % 6000
        if pair not in seen:
            followed.append(pair == docs[1])
        seen.update(docs)
    assert len(followed) > 100 and all(followed)


def test_scores_equal_the_formula():
    from stratalake.llm import retrieval_packing as r

    rng = np.random.default_rng(14)
    docs = [rng.zipf(1.3, rng.integers(1, 400)) % 3000 for _ in range(120)]
    found = [np.unique(d, return_counts=True) for d in docs]
    df, mean = np.bincount(np.concatenate([f[0] for f in found]), minlength=3000), np.mean([len(d) for d in docs])
    corpus = r._Corpus(len(docs), sum(map(len, docs)), df)
    blocks = [r._Block(corpus, *(np.concatenate([f[i] for f in part]) for i in (0, 1)), np.array([len(f[0]) for f in part])) for part in (found[:50], found[50:])]
    score = r._scores(blocks[0].query(), blocks[1].index())
    tf = [dict(zip(*f, strict=True)) for f in found]
    for q in range(50):
        for d in range(50, 120):
            norm = 1.2 * (0.25 + 0.75 * len(docs[d]) / mean)
            own = sum(c * np.log1p((120 - df[t] + 0.5) / (df[t] + 0.5)) * tf[d][t] * 2.2 / (tf[d][t] + norm) for t, c in tf[q].items() if t in tf[d])
            assert abs(score[q, d - 50] - own) < 2e-6


def test_search_in_blocks_equals_one_block(spark, monkeypatch):
    from stratalake.llm import retrieval_packing as r

    monkeypatch.setattr(r, "BLOCK", 16)
    monkeypatch.setattr(r, "SEARCHED", 2)
    rng = random.Random(15)
    words = [" " + "".join(rng.choices("abcdefgh", k=6)) for _ in range(300)]
    rows = [(i, "".join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(150)]
    found = {tuple(s) for s in sequences(pack(spark.createDataFrame(rows, "doc_id long, text string"), BYTES, window=512).collect())}
    tokenizer = Tokenizer.from_file(BYTES)
    docs = [np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1]) for _, t in rows]
    tails = [i for i, d in enumerate(docs) if len(d) % 512]
    if len(tails) == len(docs) and max(map(len, docs)) < 512:
        assert found == {tuple(d for d, _, _ in s) for s in pack_shard(docs, 512)}
    else:
        raise AssertionError("the rows should be shorter than a window")


def test_a_long_document_is_found_by_all_of_its_ids(spark):
    rng = random.Random(16)
    tokenizer = Tokenizer.from_file(BYTES)
    topics = [[" " + "".join(rng.choices("bcdfghjklmnpqrstvwxz", k=9)) for _ in range(40)] for _ in range(5)]
    long = ""
    while len(tokenizer.encode(long, add_special_tokens=False).ids) < 2048:
        long += rng.choice(topics[0])
    rows = [(0, long + "".join(rng.choices(topics[1], k=20)))]  # only its end is packed, with what the whole is like
    rows += [(i, "".join(rng.choices(topics[i % 5], k=30))) for i in range(1, 100)]
    found = sequences(pack(spark.createDataFrame(rows, "doc_id long, text string"), BYTES).collect())
    beside = next(s for s in found if 0 in s and len(s) > 1)
    assert beside[0] == 0 and {i % 5 for i in beside[1:6]} == {0}


def test_texts_are_tokenized_in_small_shards(monkeypatch):
    sizes, cut = [], retrieval_packing.shards

    def watched(batches, column, most):
        for texts in cut(batches, column, most):
            sizes.append(texts[column].nbytes)
            yield texts

    monkeypatch.setattr(retrieval_packing, "shards", watched)
    batches = [pa.RecordBatch.from_pydict({"doc_id": [i], "text": ["some words " * 90_000]}) for i in range(12)]
    made = list(retrieval_packing._tokenizer(public_tokenizers.path("byte_bpe_50k.json"), 1, 2048)(iter(batches)))
    assert sum(b.num_rows for b in made) == 12 and max(sizes) < 6 << 20


def test_documents_are_dealt_in_small_batches_by_their_rarest_terms():
    rng = np.random.default_rng(17)
    docs = [np.unique(rng.zipf(1.2, rng.integers(0, 30)) % 5000).astype("<u2") for _ in range(3000)]
    df = np.bincount(np.concatenate(docs), minlength=5000)
    batch = pa.RecordBatch.from_pydict({"tail": [d.tobytes() for d in docs], "terms": [d.tobytes() for d in docs]})
    made = list(retrieval_packing._dealer(df, 2)(iter([batch.slice(0, 0), batch])))
    assert sum(b.num_rows for b in made) == 3000 and max(b.num_rows for b in made) <= 1024
    found = pa.Table.from_batches(made).select(["terms", "first", "second", "third"]).to_pylist()
    for doc, row in zip(docs, found, strict=True):
        rarest = sorted((t for t in doc.tolist() if df[t] > 1), key=lambda t: (df[t], t))[:3]
        assert row["terms"] == doc.tobytes() and [row["first"], row["second"], row["third"]] == (rarest + [-1] * 3)[:3]
