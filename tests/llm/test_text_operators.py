"""Text operators against brute force, on the smallest test tables and on awkward rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratalake.llm.common import table
from stratalake.llm.domain_mixing import mix_domains
from stratalake.llm.encode import PieceEncoder
from stratalake.llm.queries import DOMAIN_WEIGHTS, labelled_domains
from stratalake.llm.retrieval_packing import pack, pack_shard
from stratalake.llm.run_index import cut_repeats, repeat_report
from stratalake.llm.shingle_forest import prefix_length, shingle_join
from stratalake.llm.site_quality import site_quality
from stratalake.llm.token_blocks import decode_shard, encode_shard, read_tokens, token_blocks, write_tokens

@pytest.fixture(scope="module")
def sf():
    return "/root/testdata/sf0.001"


WORDS, BYTES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def awkward(spark):
    """Null, empty, blank, tied, repeated and very long texts, and columns with names used inside."""
    rng = random.Random(1)
    long = " ".join(rng.choices(["alpha", "beta,", "Gamma.", "déjà", "vu\nand"], k=60_000))
    texts = [None, "", "   ", "one", "one two", long, long, long + " end", "x" * 300, "x" * 300, "<|endoftext|> a", "a  b ", "\t\n"]
    rows = [(i, t, "en", "src", "k", 1) for i, t in enumerate(texts)]
    rows += [(5, long, "en", "src", "k", 1), (3, "other text", None, None, "k", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, key string, n int")


def documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text").collect()


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_pieces_give_the_tokenizers_ids(path):
    rng, known = random.Random(2), PieceEncoder(path)
    letters = [*"ab  \n\t é'sΣ.!,1²<|\x1c\x85\xa0", "<|endoftext|>", "  ", " 's", "中文", "\r\n", "İ", "ß", "Word, ", "word.\nNext "]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(5000)]
    texts.append("word " * 700_000)
    expected = known.tokenizer.encode_batch(texts, add_special_tokens=False)
    for text, found in zip(texts, expected, strict=True):
        assert known.encode(text) == np.array(found.ids, known.dtype).tobytes(), repr(text[:50])


def test_shards_round_trip():
    rng = np.random.default_rng(3)
    for n in (0, 1, 255, 256, 257, 3000):
        docs = [rng.integers(0, 50_000, n), rng.zipf(1.3, n) % (1 << 32), np.zeros(n), np.full(n, 2**32 - 1)]
        index, ids = decode_shard(encode_shard([7, -1, 7, 9], [d.astype(np.uint32) for d in docs]))
        assert (ids == np.concatenate(docs).astype(np.uint32)).all()
        assert list(index["ids"]) == [n] * 4 and list(index["doc_id"]) == [7, -1, 7, 9]
    assert len(decode_shard(encode_shard([], []))[1]) == 0


def test_token_files_hold_every_document_in_order(spark, sf, path):
    tokenizer = Tokenizer.from_file(WORDS)
    for docs in (table(spark, sf, "documents"), awkward(spark)):
        rows = sorted((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())
        ids = [np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], "<u4") for _, t in rows]
        starts = np.cumsum([0, *map(len, ids)])
        expected = [(d, int(s), len(i), zlib.crc32(i.tobytes())) for (d, _), s, i in zip(rows, starts, ids, strict=False)]
        assert sorted(map(tuple, token_blocks(docs, WORDS, 2).collect())) == sorted(expected)
    manifest = write_tokens(table(spark, sf, "documents"), WORDS, 2, path("small"), shard_ids=5000)
    assert manifest.count() > 10
    small = read_tokens(manifest, path("small")).collect()
    assert sorted(map(tuple, small)) == sorted(map(tuple, token_blocks(table(spark, sf, "documents"), WORDS, 2).collect()))


def brute_repeats(rows, length=200):
    counts = Counter()
    for _, text in rows:
        data = (text or "").encode()
        counts.update(hash(data[i : i + length]) for i in range(len(data) - length + 1))
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if counts[hash(data[i : i + length])] > 1:
                gone[i : i + length] = b"\1" * length
        left = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def test_repeats_equal_brute_force(spark, sf):
    found = sorted(map(tuple, repeat_report(table(spark, sf, "documents")).collect()), key=str)
    assert found == brute_repeats(documents(spark, sf))
    rng = random.Random(4)
    base = ["".join(rng.choices("ab é", k=400)) for _ in range(5)]
    rows = [(i, "".join(b[rng.randint(0, 200) :][: rng.randint(100, 300)] for b in rng.choices(base, k=rng.randint(0, 5)))) for i in range(200)]
    rows += [(1000, None), (1001, ""), (None, base[0]), (1002, "a" * 5000), (1003, "ab" * 2000), (7, base[1] * 2), (7, base[1] * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, repeat_report(docs).collect()), key=str) == brute_repeats(rows)


def test_repeats_of_a_hot_gram_are_dealt_in_blocks(spark, monkeypatch):
    from stratalake.llm import run_index

    monkeypatch.setattr(run_index, "BLOCK", 8)
    rng = random.Random(5)
    passage = "".join(rng.choices("abcdefgh ", k=230))
    rows = [(i, "".join(rng.choices("abcdefgh ", k=150)) + passage + "".join(rng.choices("abcdefgh ", k=150))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, repeat_report(docs).collect()), key=str) == brute_repeats(rows)


def test_cutting_keeps_columns_and_rows(spark):
    docs = awkward(spark)
    cut = cut_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert {r.doc_id: r.text for r in cut.filter("doc_id in (0, 4, 8)").collect()} == {0: None, 4: "one two", 8: ""}


def brute_links(rows, threshold=0.8):
    def shingles(text):
        words = (text or "").encode().split()
        return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()

    sets = [shingles(t) for _, t in rows]
    by = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    links = defaultdict(set)
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in by[x] if j != i)
        links[i] = {j for j, n in common.items() if n >= threshold * (len(s) + len(sets[j]) - n) - 1e-9}
    out = []
    for i, (doc_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        out.append((doc_id, min(rows[j][0] for j in seen), len(links[i])))
    return sorted(out)


def test_similarity_join_equals_brute_force(spark, sf):
    for rows in ([tuple(r) for r in documents(spark, sf)], [(r.doc_id, r.text) for r in awkward(spark).collect()]):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        found = shingle_join(docs).select("doc_id", "class_id", "n_links", "kept").collect()
        assert sorted(tuple(r)[:3] for r in found) == brute_links(rows)
        assert all(r.kept == (r.doc_id == r.class_id) for r in found)


def test_similarity_join_of_repeated_rows(spark):
    rng = random.Random(12)
    one, two, three = ([f"{c}{rng.randint(0, 999)}" for _ in range(120)] for c in "abc")
    rows = [(7, " ".join(one)), (7, " ".join(one)), (8, " ".join([*one, "end"])), (7, " ".join(two)), (9, "start " + " ".join(two)), (9, " ".join(three)), (4, "  ".join(three))]
    rows += [(r.doc_id, r.text) for r in awkward(spark).collect()]
    found = shingle_join(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "class_id", "n_links").collect()
    assert sorted(map(tuple, found)) == brute_links(rows)


def test_similarity_join_in_blocks(spark, monkeypatch):
    from stratalake.llm import shingle_forest

    monkeypatch.setattr(shingle_forest, "BUCKET_BLOCK", 16)
    monkeypatch.setattr(shingle_forest, "GROUP_BLOCK", 8)
    rng = random.Random(6)
    base = [f"w{rng.randint(0, 999)}" for _ in range(120)]
    rows = []
    for i in range(80):  # a family of near copies, some closer than others
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(120)] = f"n{rng.randint(0, 99)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r)[:3] for r in shingle_join(docs).select("doc_id", "class_id", "n_links").collect()) == brute_links(rows)


def test_prefixes_shorten_until_the_recall():
    for recall in (0.5, 0.9, 0.9999):
        n = prefix_length(0.8, 24, 8, recall)
        assert 1 - (1 - 0.8**n) ** 24 >= recall and (n == 8 or 1 - (1 - 0.8 ** (n + 1)) ** 24 < recall)


def check_packing(rows, pieces, window=2048):
    tokenizer = Tokenizer.from_file(BYTES)
    whole = Counter((d, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in ((d, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for d, t in rows))
    assert sum(p.length for p in pieces) == sum(n * k for (_, n, _), k in whole.items())
    assert Counter((p.doc_id, p.doc_tokens, p.ids_crc32) for p in pieces if p.length == p.doc_tokens) == Counter({k: v for k, v in whole.items() if (k[0], k[1]) in {(p.doc_id, p.doc_tokens) for p in pieces if p.length == p.doc_tokens}})
    by = defaultdict(list)
    for p in pieces:
        by[p.sequence_id].append((p.offset, p.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window and at & (at - 1) == 0  # full or a power of two


def test_packing_places_every_id_once(spark, sf):
    for docs in (table(spark, sf, "documents"), awkward(spark)):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        check_packing(rows, pack(docs, BYTES).collect())
    tokenizer = Tokenizer.from_file(BYTES)
    texts = {r.doc_id: [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1] for r in documents(spark, sf)}
    for p in pack(table(spark, sf, "documents"), BYTES).collect():
        assert p.ids_crc32 == zlib.crc32(np.array(texts[p.doc_id][p.start : p.start + p.length], "<u4").tobytes())


def test_a_seed_is_followed_by_its_neighbours():
    rng = np.random.default_rng(7)
    topics = [rng.choice(5000, 40, replace=False) + 5000 * t for t in range(4)]
    docs = [rng.choice(topics[i % 4], 100) for i in range(80)]
    sequences = pack_shard(docs, 1024)
    same = [len({d % 4 for d, _, _ in s}) for s in sequences if sum(b - a for _, a, b in s) == 1024]
    assert np.mean(same) < 2  # a window of about ten documents holds one topic, or two where one ends
    assert pack_shard([], 1024) == []


def test_quality_on_documents_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    fit, held = labels.filter("doc_id % 4 != 0"), labels.filter("doc_id % 4 = 0")
    held = held.groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("toxic").alias("toxic"))
    judged = site_quality(docs, fit).join(held, "doc_id").collect()
    clean = [r.kept for r in judged if r.label == 1 and r.toxic == 0]
    junk = [r.kept for r in judged if r.label == 0]
    assert len(clean) > 400 and np.mean(clean) > 0.95
    assert len(junk) > 50 and np.mean(junk) < 0.1


def test_toxic_documents_held_out_are_rejected_in_every_language(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    held = labels.filter("doc_id % 4 = 0 and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("label"))
    judged = site_quality(docs, labels.filter("doc_id % 4 != 0")).join(docs.select("doc_id", "lang").distinct(), "doc_id").join(held, "doc_id").collect()
    rejected = defaultdict(list)
    for r in judged:
        if r.toxic:
            rejected[r.lang].append(not r.kept)
    for lang in ("de", "en", "es", "fr"):
        assert len(rejected[lang]) > 5 and np.mean(rejected[lang]) >= 0.85, lang


def test_quality_of_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 0, 0), (5, 1, 0), (5, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    docs = awkward(spark)
    out = site_quality(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r.quality <= 1 for r in out)
    assert site_quality(docs, labels.limit(0)).count() == docs.count()
    assert site_quality(docs.limit(0), labels).count() == 0


def test_rates_meet_the_targets(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    out = mix_domains(docs, labelled_domains(docs, labels), DOMAIN_WEIGHTS).toPandas()
    held = np.array([(out[f"p_{d}"] * out.n_tokens * out.rate).sum() for d in sorted(DOMAIN_WEIGHTS)])
    assert np.abs(held / held.sum() - [DOMAIN_WEIGHTS[d] for d in sorted(DOMAIN_WEIGHTS)]).max() < 1e-3
    assert held.sum() == pytest.approx(out.n_tokens.sum(), rel=1e-3) and (out.rate >= 0).all()
    assert (abs(out.copies - out.rate) < 1).all()
    languages = docs.select("doc_id", "lang").toPandas().set_index("doc_id").lang
    guess = out.set_index("doc_id")[[f"p_{d}" for d in sorted(DOMAIN_WEIGHTS)]].idxmax(axis=1).str[2:]
    assert (guess == languages[guess.index]).mean() > 0.85
    floor = mix_domains(docs, labelled_domains(docs, labels), DOMAIN_WEIGHTS, floor=1.0).toPandas()
    assert (floor.rate >= 1).all() and (floor.copies >= 1).all()


def test_words_are_parted_by_any_white_space(spark):
    rng = random.Random(17)
    words = [[rng.choice(("der", "die", "und", "the", "and", "of")) for _ in range(40)] for _ in range(20)]
    rows = [(3 * i + j, blank.join(w)) for i, w in enumerate(words) for j, blank in enumerate((" ", "\n", " \t\r\n "))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labelled = spark.createDataFrame([(d, "en" if d % 2 else "de") for d, _ in rows], "doc_id long, domain string")
    out = {r.doc_id: r for r in mix_domains(docs, labelled, {"de": 0.5, "en": 0.5}).collect()}
    for d, r in out.items():
        assert r.n_tokens == 40 and r.p_de == pytest.approx(out[d - d % 3].p_de)


def test_mixing_awkward_rows(spark, sf):
    docs, labels = awkward(spark), table(spark, sf, "labels")
    out = mix_domains(docs, labelled_domains(docs, labels), DOMAIN_WEIGHTS)
    assert out.count() == docs.select("doc_id", "text").distinct().count()
    assert mix_domains(docs.limit(0), labelled_domains(docs, labels), DOMAIN_WEIGHTS).count() == 0


def test_empty_documents(spark):
    docs = awkward(spark).limit(0)
    assert token_blocks(docs, WORDS).count() == 0
    assert repeat_report(docs).count() == 0
    assert shingle_join(docs).count() == 0
    assert pack(docs, BYTES).count() == 0
