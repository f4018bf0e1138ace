"""Lexical retrieval packing: documents share a window with their nearest unused neighbours under BM25."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, written
from .encode_columns import SHARD_BYTES, column_encoder
from .words import binaries, gathered, shards

#: Documents of a shard of the index, and shards that a task packs one after the other.
SHARD, IN_TURN = 2048, 4
#: Within a shard: documents that query in one go, and blocks of that many that they are scored against in one go.
BLOCK, SEARCHED = 512, 4
#: Share of the documents from which a term is a dense column, and additions made in one go for the other terms.
DENSE, ADDED = 0.03, 4_000_000
K1, B = 1.2, 0.75
#: Text bytes tokenized in one go; terms, counts and checksums of a shard need several times its ids.
TOKENIZED_BYTES = SHARD_BYTES // 8
#: Words whose ids a worker remembers.
REMEMBERED = 500_000
#: Terms that decide which documents come into one shard: the rarest that others hold too.
RAREST = 3
#: Documents that are given these terms in one go.
DEALT = 1024
_KEYS = ["first", "second", "third", "crc"]
_PIECE = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
          ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in _PIECE]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _PIECE, strict=True)], names=[n for n, _ in _PIECE])


def _tokenizer(path: str, end: int, window: int):
    """Per document one row: its full windows as finished pieces, the ids of what is left, its terms and their counts."""

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = column_encoder(path, REMEMBERED)
        for texts in shards(batches, "text", TOKENIZED_BYTES):
            body, offsets = known.encode(texts["text"])
            stops = offsets + np.arange(len(offsets))  # each text has the end id behind its own
            lengths = np.diff(stops)
            own = np.ones(stops[-1], dtype=bool)
            own[stops[1:] - 1] = False
            ids = np.full(stops[-1], end, known.dtype)
            ids[own] = body
            full = lengths // window * window
            tails = ids[gathered(stops[:-1] + full, lengths - full)]
            # terms of a document in order, each with its count
            held = np.sort(np.repeat(np.arange(len(lengths), dtype=np.uint64) << np.uint64(32), lengths) | ids)
            first = np.flatnonzero(np.diff(held, prepend=~held[:1]))
            terms = (held[first] & np.uint64((1 << 32) - 1)).astype(known.dtype)
            counts = np.diff(first, append=len(held)).astype("<u4")
            many = np.bincount((held[first] >> np.uint64(32)).astype(np.int64), minlength=len(lengths))
            crcs = [[_crc(ids[a : a + window]) for a in range(s, s + f, window)] if f else [] for s, f in zip(stops[:-1].tolist(), full.tolist(), strict=True)]
            out = pa.table(
                {
                    "doc_id": texts["doc_id"],
                    "doc_tokens": lengths,
                    "crcs": pa.array(crcs, pa.list_(pa.int64())),
                    "tail": binaries(tails, lengths - full),
                    "terms": binaries(terms, many),
                    "counts": binaries(counts, many),
                }
            )
            yield from out.to_batches(max_chunksize=1024)

    return tokenize


def _frequencies(size: int, width: int):
    """Per task, how many documents hold each term; term -1 has the ids of all documents, -2 their number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, total, n = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            df += np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), f"<u{width}"), minlength=size)
            total += sum(batch.column("doc_tokens").to_pylist())
            n += batch.num_rows
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": np.concatenate([[-1, -2], some]), "df": np.concatenate([[total, n], df[some]])})

    return count


class _Corpus:
    """What BM25 knows of all documents: their number and mean length, and how many hold each term."""

    def __init__(self, n: int, total: int, df: np.ndarray) -> None:
        self.mean = total / max(n, 1)
        self.idf = np.log1p((n - df + 0.5) / (df + 0.5))
        dense = np.flatnonzero(df > DENSE * n)
        self.column, self.width = np.full(len(df), -1, np.int32), len(dense)
        self.column[dense] = np.arange(len(dense))


class _Block:
    """Documents as queries, weighted by their terms' counts, and as an index of BM25 impacts."""

    def __init__(self, corpus: _Corpus, terms: np.ndarray, counts: np.ndarray, held: np.ndarray) -> None:
        self.corpus, self.n = corpus, len(held)
        self.owner = np.repeat(np.arange(self.n), held)
        self.terms, self.counts = terms.astype(np.int64), counts.astype(float)
        self.column = corpus.column[self.terms]

    def part(self, first: int, stop: int) -> _Block:
        """Some of the documents, which follow each other."""
        a, b = np.searchsorted(self.owner, [first, stop])
        held = np.bincount(self.owner[a:b] - first, minlength=min(stop, self.n) - first)
        return _Block(self.corpus, self.terms[a:b], self.counts[a:b], held)

    def _split(self, weight: np.ndarray) -> tuple:
        dense = self.column >= 0
        matrix = np.zeros((self.n, self.corpus.width))
        matrix[self.owner[dense], self.column[dense]] = weight[dense]
        return matrix, self.owner[~dense], self.terms[~dense], weight[~dense]

    def query(self) -> tuple:
        return self._split(self.counts)

    def index(self) -> tuple:
        sizes = np.bincount(self.owner, self.counts, self.n)[self.owner]
        impact = self.corpus.idf[self.terms] * self.counts * (K1 + 1) / (self.counts + K1 * (1 - B + B * sizes / self.corpus.mean))
        matrix, owner, terms, weight = self._split(impact)
        order = np.argsort(terms, kind="stable")
        return matrix, owner[order], terms[order], weight[order]


def _scores(query: tuple, index: tuple) -> np.ndarray:
    """BM25 of each document of ``index`` for each of ``query``, over all terms they share."""
    score = query[0] @ index[0].T
    flat, n = score.reshape(-1), index[0].shape[0]
    first, last = (np.searchsorted(index[2], query[2], side) for side in ("left", "right"))
    some = np.flatnonzero(last > first)
    found = last[some] - first[some]
    done = np.cumsum(found)
    cuts = np.unique(np.searchsorted(done, np.arange(0, done[-1] if len(done) else 0, ADDED)))
    for part in np.split(np.arange(len(some)), cuts[1:]) if len(some) else []:
        many, own = found[part], some[part]
        place = np.repeat(first[own] - np.cumsum(many) + many, many) + np.arange(many.sum())
        row = np.repeat(query[1][own], many)
        low, high = row[0] * n, (row[-1] + 1) * n  # queries are in order
        flat[low:high] += np.bincount(row * n + index[1][place] - low, np.repeat(query[3][own], many) * index[3][place], high - low).astype(score.dtype)
    return np.round(score, 6) if score.dtype == np.float64 else score  # sums of equal documents are equal


def _all_scores(block: _Block) -> np.ndarray:
    """Scores of all documents of a shard for each other, in single precision to three places."""
    score = np.zeros((block.n, block.n), dtype=np.float32)
    for b in range(0, block.n, BLOCK * SEARCHED):
        matrix, *rest = block.part(b, b + BLOCK * SEARCHED).index()
        index = matrix.astype(np.float32), *rest
        for a in range(0, block.n, BLOCK):
            matrix, *rest = block.part(a, a + BLOCK).query()
            score[a : a + BLOCK, b : b + BLOCK * SEARCHED] = _scores((matrix.astype(np.float32), *rest), index)
    np.fill_diagonal(score, 0)
    np.round(score, 3, out=score)
    return score


def walk(sizes: np.ndarray, score: np.ndarray, alike: np.ndarray, window: int) -> np.ndarray:
    """Where each document starts in one stream of all their ids that is cut into windows.

    The document that is cut, or else the first of a window, is its seed: it is followed by
    the best of all unused documents for it, as long as the window has room, then by the
    first unused document. ``score[seed]`` ranks documents, 0 is no neighbour. Documents
    with the same number in ``alike`` are copies of one; while there are others, no two of
    them come into one window.
    """
    start, n, at = np.full(len(sizes), -1, np.int64), len(sizes), 0
    used, sizes, alike = np.zeros(n, dtype=bool), sizes.tolist(), alike.tolist()
    waiting, inside, ranked = 0, set(), None
    while True:
        nxt = -1
        if ranked is not None:
            for found in ranked:
                if not used[found] and alike[found] not in inside:
                    nxt = found
                    break
        if nxt < 0:
            ranked = None if ranked is None else iter(())
            while waiting < n and used[waiting]:
                waiting += 1
            if waiting == n:
                return start
            free = np.flatnonzero(~used[waiting:]) + waiting if alike[waiting] in inside else [waiting]
            nxt = next((int(i) for i in free if alike[i] not in inside), waiting)
        used[nxt] = True
        start[nxt] = at
        before, at = at // window, at + sizes[nxt]
        if at // window > before:  # what is cut leads the next window; else the next document does
            seed = nxt if at % window else -1
            inside = {alike[nxt]} if at % window else set()
        else:
            inside.add(alike[nxt])
            seed = nxt if ranked is None else -2
        if seed == -1:
            ranked = None
        elif seed >= 0:
            near = np.flatnonzero((score[seed] > 0) & ~used)
            ranked = iter(near[np.argsort(-score[seed][near], kind="stable")].tolist())


def _bounds(total: int, window: int) -> np.ndarray:
    """Where the sequences of the last, partial window start: their lengths are powers of two, so nothing is padded."""
    at, out = total // window * window, []
    while at < total:
        out.append(at)
        at += 1 << ((total - at).bit_length() - 1)
    return np.array(out, np.int64)


def _cut(start: int, size: int, total: int, window: int, last: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Pieces of a document in the stream: from, to, number of the sequence, offset in it."""
    a = 0
    while a < size:
        at = start + a
        if at < total // window * window:
            number, begin = at // window, at // window * window
            stop = begin + window
        else:
            k = int(np.searchsorted(last, at, side="right")) - 1
            number, begin = total // window + k, int(last[k])
            stop = int(last[k + 1]) if k + 1 < len(last) else total
        b = min(size, a + stop - at)
        yield a, b, number, at - begin
        a = b


def _alike(keys: list) -> np.ndarray:
    """Numbers of equal keys; a key of None is like no other."""
    known: dict = {}
    return np.array([known.setdefault(i if key is None else (key,), len(known)) for i, key in enumerate(keys)], dtype=np.int64)


def _packed(block: _Block, sizes: np.ndarray, keys: list, window: int) -> Iterator[tuple[int, int, int, int, int]]:
    """``(document, from, to, sequence, offset)`` of all pieces of a shard's documents."""
    start, total = walk(sizes, _all_scores(block), _alike(keys), window), int(sizes.sum())
    last = _bounds(total, window)
    for doc in np.argsort(start, kind="stable").tolist():
        for a, b, number, offset in _cut(int(start[doc]), int(sizes[doc]), total, window, last):
            yield doc, a, b, number, offset


def pack_shard(docs: list[np.ndarray], window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces ``(document, from, to)`` of documents in memory."""
    if not docs:
        return []
    found = [np.unique(d, return_counts=True) for d in docs]
    terms, counts = (np.concatenate([f[i] for f in found]).astype(np.int64) for i in (0, 1))
    sizes = np.array([len(d) for d in docs])
    block = _Block(_Corpus(len(docs), int(sizes.sum()), np.bincount(terms)), terms, counts, np.array([len(f[0]) for f in found]))
    out: dict[int, list] = {}
    for doc, a, b, number, _ in _packed(block, sizes, [None] * len(docs), window):
        out.setdefault(number, []).append((doc, a, b))
    return [out[k] for k in sorted(out)]


def _ranks(df: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms that several documents hold, rarest first, and each term's place among them; behind them come all others."""
    order = np.lexsort((np.arange(len(df)), df))
    order = order[df[order] > 1]
    places = np.full(len(df), len(order), np.int32)
    places[order] = np.arange(len(order))
    return order, places


def _rarest(ranks: tuple[np.ndarray, np.ndarray], terms: list[bytes], width: int) -> np.ndarray:
    """Per document its ``RAREST`` rarest terms among those that another document holds, -1 where there are none."""
    order, places = ranks
    held = np.array([len(t) // width for t in terms])
    keys = places[np.frombuffer(b"".join(terms), f"<u{width}")]
    some = np.flatnonzero(held)
    first = (np.cumsum(held) - held)[some]
    out = np.full((len(terms), RAREST), -1, np.int64)
    for i in range(RAREST if len(some) else 0):
        least = np.minimum.reduceat(keys, first)
        found = least < len(order)
        out[some[found], i] = order[least[found]]
        keys[keys == np.repeat(least, held[some])] = len(order)
    return out


def _dealer(df: np.ndarray, width: int):
    """Documents with the keys they are dealt by: their rarest terms, then a checksum that equal tails share."""
    ranks = _ranks(df)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in batches:  # passed on in small batches, as both sides hold a batch as a whole
            for batch in (held.slice(a, DEALT) for a in range(0, held.num_rows, DEALT)):
                keys = _rarest(ranks, batch.column("terms").to_pylist(), width)
                crc = pa.array([zlib.crc32(t) for t in batch.column("tail").to_pylist()], pa.int64())
                names = [*batch.schema.names, *_KEYS]
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(k) for k in keys.T), crc], names=names)

    return deal


def _packer(corpus: _Corpus, width: int, window: int, most: int):
    """Rows in order as shards of about ``most`` documents, each indexed, searched and packed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0

        def one(rows: pa.Table) -> pa.RecordBatch:
            nonlocal count
            rows = rows.sort_by([("doc_id", "ascending"), ("doc_tokens", "ascending")])
            tails, terms, counts = (rows[c].to_pylist() for c in ("tail", "terms", "counts"))
            ids, totals = rows["doc_id"].to_pylist(), rows["doc_tokens"].to_pylist()
            held = np.array([len(x) // width for x in terms])
            block = _Block(corpus, np.frombuffer(b"".join(terms), f"<u{width}"), np.frombuffer(b"".join(counts), "<u4"), held)
            keys = list(zip(ids, totals, tails, strict=True))
            tails = [np.frombuffer(t, f"<u{width}") for t in tails]
            sizes, out, first = np.array([len(t) for t in tails]), [], count
            for doc, a, b, number, offset in _packed(block, sizes, keys, window):
                done = totals[doc] - len(tails[doc])
                out.append((ids[doc], done + a, b - a, _crc(tails[doc][a:b]), totals[doc], (part << 33 | first + number) * 2 + 1, offset))
                count = max(count, first + number + 1)
            return _pieces(out)

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            while size > most + most // 4:  # a shard ends where the key changes, if that is near
                rows = pa.Table.from_batches(held)
                key = rows.slice(0, most + 1).select(_KEYS).to_pandas().to_numpy()
                new = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
                cut = int(new[-1]) if len(new) and new[-1] > most * 3 // 4 else most
                yield one(rows.slice(0, cut))
                held, size = rows.slice(cut).to_batches(), size - cut
        if size:
            yield one(pa.Table.from_batches(held))

    return pack


def _windows(window: int):
    """The full windows of long documents, each a sequence of its own."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        for batch in batches:
            out = []
            for doc_id, total, crcs in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "doc_tokens", "crcs")), strict=True):
                for i, crc in enumerate(crcs):
                    out.append((doc_id, i * window, window, crc, total, (part << 33 | count) * 2, 0))
                    count += 1
            yield _pieces(out)

    return cut


def pack(docs: DataFrame, path: str, end: int = 1, window: int = 2048) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Documents of more than ``window`` ids fill windows of their own; what is left of them
    and shorter ones are packed behind each other by BM25 over the ids of whole documents,
    with the statistics of the whole corpus. The index is dealt into shards of about
    ``SHARD`` documents that share their rarest terms, so copies and near copies meet; ranges
    of these terms, then of doc_id, split a frequent key. In its shard every seed is scored exactly against all documents
    and followed by the best that are still unused, so the cost grows with the documents.
    Neighbours in other shards are not looked at.

    Every sequence has ``window`` ids or a power of two below it, so nothing is padded. A
    null text is empty and holds the end id alone. Rows that repeat a doc_id, or have none,
    are packed like any other; rows that repeat doc_id and text come into different windows
    as long as their shard has other documents left.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = column_encoder(path)
    width = known.dtype.itemsize
    tokens = map_arrow(
        rows, _tokenizer(path, end, window), "doc_id long, doc_tokens long, crcs array<long>, tail binary, terms binary, counts binary", encodes=True
    )
    tokens = written(tokens, "token-tails")
    long = map_arrow(tokens.filter("size(crcs) > 0").select("doc_id", "doc_tokens", "crcs"), _windows(window), _SCHEMA)

    size = max(known.texts.tokenizer.get_vocab_size(), end + 1)
    counted = map_arrow(tokens.select("doc_tokens", "terms"), _frequencies(size, width), "term long, df long")
    df, other = np.zeros(size, np.int64), {-1: 0, -2: 0}
    for row in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():  # at most a row per term
        if row.term >= 0:
            df[row.term] = row.df
        else:
            other[row.term] = row.df
    corpus = _Corpus(other[-2], other[-1], df)

    tails = tokens.filter("octet_length(tail) > 0").select("doc_id", "doc_tokens", "tail", "terms", "counts")
    schema = "doc_id long, doc_tokens long, tail binary, terms binary, counts binary, first long, second long, third long, crc long"
    dealt = map_arrow(tails, _dealer(df, width), schema)
    parts = max(1, math.ceil(other[-2] / (SHARD * IN_TURN)))
    dealt = dealt.repartitionByRange(parts, *_KEYS, "doc_id").sortWithinPartitions(*_KEYS, "doc_id", "doc_tokens", "tail")
    return long.union(map_arrow(dealt, _packer(corpus, width, window, SHARD), _SCHEMA))
