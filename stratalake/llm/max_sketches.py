"""Ranked lexical search: bounds from hashed sketches of documents, exact scores from the texts above them."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import MOST_KEYS, map_arrow, written
from .words import Words, byte_class, shards

#: Letters of a term: ASCII digits and letters and every character beyond ASCII.
TERM_BYTES = byte_class((48, 57), (65, 90), (97, 122), (128, 255))
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Cells of a sketch; a document stores only those it fills.
CELLS = 1 << 16
#: Items looked up in one go, and documents of the highest bounds that set an item's first threshold.
BLOCK_ITEMS, HEAD = 256, 32
#: Distinct terms whose document frequencies one pass over the texts counts.
BLOCK_TERMS = 500_000
#: Cells of the dense array of a block of documents.
_DENSE = 4_000_000

#: Occurrences up to 200 are stored as they are, more as the next higher 200 * 2**k.
_EXACT = 200
_MOST = np.concatenate([np.arange(_EXACT + 1), _EXACT << np.arange(1, 55)]).astype(np.int64)
_ONE = 1_000_000_000

_SKETCH = "doc_id long, tid long, n long, cells binary, most binary"
_BOUND = "item long, doc_id long, tid long, bound double"


def _rows(docs: DataFrame) -> DataFrame:
    """``doc_id``, whole text and ``tid``, which tells rows of one doc_id apart."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.withColumn("tid", F.xxhash64("text"))


def _binaries(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary value per count, cut out of ``values``."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts * values.itemsize, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for shard in shards(batches, "text"):
        words = Words(shard["text"], TERM_BYTES, lower=True)
        # (document, cell, rest of the term's hash); equal keys are occurrences of one term, or of terms taken for one
        keys = np.sort((words.doc.astype(np.uint64) << np.uint64(40)) | (words.hashes() >> np.uint64(24)))
        at = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
        times, cell = np.diff(at, append=len(keys)), keys[at] >> np.uint64(24)
        fold = np.flatnonzero(np.diff(cell, prepend=~cell[:1]))
        most = np.maximum.reduceat(times, fold) if len(fold) else times
        filled = cell[fold]
        codes = np.searchsorted(_MOST, most).astype(np.uint8)
        per_doc = np.bincount((filled >> np.uint64(16)).astype(np.int64), minlength=words.documents)
        yield pa.RecordBatch.from_arrays(
            [
                shard["doc_id"].combine_chunks(),
                shard["tid"].combine_chunks(),
                pa.array(np.bincount(words.doc, minlength=words.documents).astype(np.int64)),
                _binaries((filled & np.uint64(CELLS - 1)).astype("<u2"), per_doc),
                _binaries(codes, per_doc),
            ],
            names=["doc_id", "tid", "n", "cells", "most"],
        )


def sketches(docs: DataFrame) -> DataFrame:
    """The index: ``(doc_id, tid, n, cells, most)`` of each row of ``docs(doc_id, text)``, stored.

    Every term of the whole text falls into one of 2**16 cells by its hash; a cell keeps
    the most occurrences that one of its terms has. A term's impact only grows with its
    occurrences, so this is the coordinatewise maximum of the impacts, for whatever
    collection statistics and queries come later.
    """
    return written(map_arrow(_rows(docs), _sketch, _SKETCH), "sketches")


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for shard in shards(batches, "text"):
        words = Words(shard["text"], TERM_BYTES, lower=True)
        if not len(words.starts):
            continue
        order, run = words.sorted_runs()
        keys = np.sort(run * words.documents + words.doc[order])
        at = np.flatnonzero(np.diff(keys, prepend=-1))
        run_of, doc_of = np.divmod(keys[at], words.documents)
        first = order[np.flatnonzero(np.diff(run, prepend=-1))]
        out = pa.table(
            {
                "item_id": shard["item_id"].take(pa.array(doc_of)),
                "tid": shard["tid"].take(pa.array(doc_of)),
                "term": words.texts(first).take(pa.array(run_of)),
                "times": np.diff(at, append=len(keys)),
            }
        )
        yield from out.to_batches(max_chunksize=100_000)


class _Vocabulary:
    """Finds which words of a shard are listed terms, by hash and then byte for byte."""

    def __init__(self, terms: list[str]) -> None:
        self.words = Words(pa.array(terms, pa.string()), TERM_BYTES)
        h = self.words.hashes()
        self.order = np.argsort(h)
        self.hashes = h[self.order]
        self.listed = np.zeros(1 << 20, dtype=bool)
        self.listed[(h >> np.uint64(44)).astype(np.int64)] = True

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """``(word, term)`` numbers of the words that are listed."""
        h = words.hashes()
        which = np.flatnonzero(self.listed[(h >> np.uint64(44)).astype(np.int64)])
        place = np.searchsorted(self.hashes, h[which])
        fits = place < len(self.hashes)
        which, place = which[fits], place[fits]
        fits = self.hashes[place] == h[which]
        which, term = which[fits], self.order[place[fits]]
        same = words.lengths[which] == self.words.lengths[term]
        depth, open_ = 0, np.flatnonzero(same)
        while len(open_):
            same[open_] = words.slices(depth, which[open_]) == self.words.slices(depth, term[open_])
            depth += 1
            open_ = open_[same[open_] & (words.lengths[which[open_]] > 8 * depth)]
        return which[same], term[same]


def _frequencies(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``(term, df)``: the documents that hold each of the distinct ``terms``; one pass over all texts per block of terms."""
    blocks = max(1, math.ceil(terms.count() / BLOCK_TERMS))
    found = None
    for block in range(blocks):
        names = [r.term for r in terms.filter(F.pmod(F.xxhash64("term"), F.lit(blocks)) == block).collect()]

        def count(batches: Iterator[pa.RecordBatch], names=names) -> Iterator[pa.RecordBatch]:
            known = _Vocabulary(names)
            total = np.zeros(len(names), dtype=np.int64)
            for shard in shards(batches, "text"):
                words = Words(shard["text"], TERM_BYTES, lower=True)
                which, term = known.find(words)
                held = np.sort(term * words.documents + words.doc[which])
                held = held[np.diff(held, prepend=-1) != 0]
                total += np.bincount(held // words.documents, minlength=len(names))
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"term": pa.array(names, pa.string()).take(pa.array(some)), "df": total[some]})

        texts = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
        part = map_arrow(texts, count, "term string, df long").groupBy("term").agg(F.sum("df").alias("df"))
        found = part if found is None else found.union(part)
    return written(found, "frequencies")


class _Lookup:
    """A block of items as weights of sketch cells; bounds of documents are products with it.

    All numbers are integers held in doubles: exact below 2**53, else rounded up.
    """

    def __init__(self, items: list[dict], n_docs: int, n_words: int) -> None:
        self.n_docs, self.n_words = n_docs, n_words
        names = sorted({t for item in items for t in item["weights"]})
        h = dict(zip(names, Words(pa.array(names, pa.string()), TERM_BYTES).hashes().tolist(), strict=True))
        cells = sorted({x >> 48 for x in h.values()})
        self.slot = np.full(CELLS, -1, dtype=np.int32)
        self.slot[cells] = np.arange(len(cells))
        self.weights = np.zeros((len(cells), len(items)))
        for i, item in enumerate(items):
            for term, weight in item["weights"].items():
                self.weights[self.slot[h[term] >> 48], i] += weight
        self.rounds = float(self.weights.sum(axis=0).max(initial=0)) * 1e6 >= 2**53

    def bounds(self, batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        """``(first row, bounds by row and item)`` for stretches of a batch of sketches."""
        cells, most = batch.column("cells"), batch.column("most")
        n = batch.column("n").to_numpy()
        m = 75 + np.array([25 * int(x) * self.n_docs // self.n_words for x in n], dtype=np.int64)
        step = max(1, _DENSE // max(1, len(self.weights)))
        for at in range(0, len(n), step):
            part_cells = np.frombuffer(b"".join(cells.slice(at, step).to_pylist()), dtype="<u2")
            part_most = np.frombuffer(b"".join(most.slice(at, step).to_pylist()), dtype=np.uint8)
            counts = np.array([len(x) for x in most.slice(at, step).to_pylist()])
            slot = self.slot[part_cells]
            used = slot >= 0
            doc = np.repeat(np.arange(len(counts)), counts)[used]
            times = _MOST[part_most[used]]
            dense = np.zeros((len(counts), len(self.weights)))
            dense[doc, slot[used]] = _ONE * times // (1000 * times + 12 * m[at + doc])
            bound = dense @ self.weights
            yield at, np.where(bound > 0, np.floor(bound * (1 + 1e-9)) + 1, 0) if self.rounds else bound


def _heads(look: _Lookup) -> Callable:
    """The documents of the ``HEAD`` highest bounds of each item, per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            ids = batch.column("doc_id").fill_null(0).to_numpy()
            none = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            tid = batch.column("tid").to_numpy()
            for at, bound in look.bounds(batch):
                top = _top(bound)
                found = [np.take_along_axis(bound, top, axis=0), *(x[at + top] for x in (ids, none, tid))]
                if best is not None:
                    found = [np.concatenate([x, y]) for x, y in zip(best, found, strict=True)]
                    top = _top(found[0])
                    found = [np.take_along_axis(x, top, axis=0) for x in found]
                best = found
        if best is not None:
            row, item = np.nonzero(best[0] > 0)
            bound, ids, none, tid = (x[row, item] for x in best)
            yield pa.RecordBatch.from_pydict(
                {"item": item, "doc_id": pa.array(ids, pa.int64(), mask=none), "tid": tid, "bound": bound}
            )

    return run


def _top(bound: np.ndarray) -> np.ndarray:
    """Rows of the ``HEAD`` highest bounds of each column."""
    if len(bound) <= HEAD:
        return np.repeat(np.arange(len(bound))[:, None], bound.shape[1], axis=1)
    return np.argpartition(-bound, HEAD - 1, axis=0)[:HEAD]


def _above(look: _Lookup, least: np.ndarray, last: np.ndarray) -> Callable:
    """Documents whose bound does not rule them out: above ``least``, or equal and not behind ``last`` in a tie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("doc_id").fill_null(np.iinfo(np.int64).max).to_numpy()
            for at, bound in look.bounds(batch):
                tied = (bound == least) & (place[at : at + len(bound), None] <= last)
                row, item = np.nonzero((bound > least) | tied)
                where = pa.array(at + row)
                yield pa.RecordBatch.from_pydict(
                    {
                        "item": item,
                        "doc_id": batch.column("doc_id").take(where),
                        "tid": batch.column("tid").take(where),
                        "bound": bound[row, item],
                    }
                )

    return run


def _exact(items: list[dict], n_docs: int, n_words: int) -> Callable:
    """Exact scores of documents for the items that each is a candidate for, from the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = [{t.encode(): w for t, w in item["weights"].items()} for item in items]
        for batch in batches:
            out = {"item": [], "doc_id": [], "score": []}
            for doc_id, text, wanted in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "items")), strict=True):
                words = _TERM.findall(text.encode().lower())
                times = Counter(words)
                m = 75 + 25 * len(words) * n_docs // n_words
                for i in wanted:
                    held = weights[i].keys() & times.keys()
                    score = sum(weights[i][t] * (_ONE * times[t] // (1000 * times[t] + 12 * m)) for t in held)
                    if score > 0:
                        out["item"].append(i)
                        out["doc_id"].append(doc_id)
                        out["score"].append(score)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(c, pa.int64()) for c in out]))

    return run


def _rescored(rows: DataFrame, candidates: DataFrame, score: Callable, k: int, label: str) -> DataFrame:
    """The ``k`` best exact scores per item among ``candidates(item, doc_id, tid)``."""
    wanted = candidates.groupBy("doc_id", "tid").agg(F.collect_set("item").alias("items"))
    wanted = written(wanted.withColumnsRenamed({"doc_id": "__id", "tid": "__tid"}), label)
    few = wanted.count() <= MOST_KEYS // 5
    same = (F.col("tid") == F.col("__tid")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    texts = rows.join(F.broadcast(wanted) if few else wanted, same).select("doc_id", "text", "items")
    scores = map_arrow(texts, score, "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return written(scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), label + "-best")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, index: DataFrame | None = None) -> DataFrame:
    """The ``k`` best documents of ``docs(doc_id, text)`` for each row of ``items(item_id, text)``, exactly.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower
    case. With N documents that have a term, L terms in all, n in a document, df documents
    holding a term and tf its occurrences in one: w = floor(1000 * ln((2N + 2) / (2df + 1))),
    m = 75 + 25 * n * N div L; a score sums w * (10**9 * tf div (1000 * tf + 12 * m)) over the
    item's terms, repeats included. Returns ``item_id, rank, doc_id, score``; ties go by doc_id.

    ``index`` is what ``sketches`` stored for the same documents. Items are looked up in
    blocks: their weights times the sketches bound every document's score from above. The
    highest bounds are scored exactly first; of the rest only documents whose bound reaches
    the ``k``-th of these scores. So no result is lost, whatever falls into one cell.

    Null texts have no terms. A null doc_id or item_id stays null and comes last in ties.
    Repeated rows of documents are ranked one by one; an item row that repeats id and text
    is answered once, one that repeats an id with another text by a list of its own. Other
    columns are not read; empty tables give no rows.
    """
    rows = _rows(docs)
    schema = "item_id long, rank int, doc_id long, score long"
    if index is None:
        index = sketches(docs)
    n_docs, n_words = index.filter("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    asked = asked.withColumn("tid", F.xxhash64("text")).distinct()
    terms = written(map_arrow(asked, _item_terms, "item_id long, tid long, term string, times long"), "item-terms")
    df = _frequencies(docs, terms.select("term").distinct())
    terms = written(terms.join(df, "term"), "known-terms")
    names = written(terms.select("item_id", "tid").distinct(), "items")
    blocks = math.ceil(names.count() / (BLOCK_ITEMS / 2)) if names.count() > BLOCK_ITEMS else 1
    block_of = F.pmod(F.xxhash64("item_id", "tid"), F.lit(blocks))
    results = []
    for block in range(blocks):
        found: dict[tuple, dict] = {}
        for r in terms.filter(block_of == block).collect():
            weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r.df + 1)))
            found.setdefault((r.item_id, r.tid), {})[r.term] = r.times * weight
        block_items = [{"item_id": item_id, "weights": w} for (item_id, _), w in found.items()]
        if not block_items:
            continue
        look, score = _Lookup(block_items, n_docs, n_words), _exact(block_items, n_docs, n_words)
        first = Window.partitionBy("item").orderBy(F.desc("bound"), F.col("doc_id").asc_nulls_last())
        heads = map_arrow(index, _heads(look), _BOUND).withColumn("place", F.row_number().over(first))
        best = _rescored(rows, heads.filter(F.col("place") <= HEAD), score, k, "heads")
        least = np.ones(len(block_items), dtype=np.int64)
        last = np.full(len(block_items), np.iinfo(np.int64).max)
        for r in best.filter(F.col("rank") == k).collect():
            least[r["item"]] = r.score
            last[r["item"]] = last[r["item"]] if r.doc_id is None else r.doc_id
        best = _rescored(rows, map_arrow(index, _above(look, least, last), _BOUND), score, k, "above")
        ids = docs.sparkSession.createDataFrame([(i, x["item_id"]) for i, x in enumerate(block_items)], "item long, item_id long")
        results.append(best.join(F.broadcast(ids), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    if not results:
        return docs.sparkSession.createDataFrame([], schema)
    union = results[0]
    for part in results[1:]:
        union = union.union(part)
    return union
