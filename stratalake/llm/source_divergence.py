"""How far the sources of a language differ in their words: exact counts from sorted word pointers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, whole_groups, written
from .words import Words, byte_class, shards

#: Letters of a term: ASCII letters and every character beyond ASCII.
TERM_BYTES = byte_class((65, 90), (97, 122), (128, 255))
#: Shares are counted in parts of this many.
ONE = 1_000_000_000
#: Kept terms of a language compared in one go, and sources on either side.
BLOCK_TERMS, TILE_SOURCES = 4096, 256

_COUNTS = "lang string, source string, term string, n long, docs long"


def _shard_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each (lang, source, term) of a shard of texts."""
    for shard in shards(batches, "text"):
        words = Words(shard["text"], TERM_BYTES, lower=True)
        if not len(words.starts):
            continue
        order, run = words.sorted_runs()
        # documents numbered so that those of one group follow each other
        pairs = shard.select(["lang", "source"]).to_pylist()
        groups = {}
        group = np.array([groups.setdefault((p["lang"], p["source"]), len(groups)) for p in pairs])
        by_group = np.argsort(group, kind="stable")
        rank = np.empty(len(group), dtype=np.int64)
        rank[by_group] = np.arange(len(group))
        # equal runs give occurrences per document, then occurrences and documents per group
        held = np.sort(run * len(group) + rank[words.doc[order]])
        fresh = np.flatnonzero(np.diff(held, prepend=-1))
        times = np.diff(fresh, append=len(held))
        run_of, rank_of = np.divmod(held[fresh], len(group))
        key = run_of * len(groups) + group[by_group][rank_of]
        at = np.flatnonzero(np.diff(key, prepend=-1))
        run_of, group_of = np.divmod(key[at], len(groups))
        names = list(groups)
        lang = pa.DictionaryArray.from_arrays(pa.array(group_of, pa.int32()), pa.array([x for x, _ in names]))
        source = pa.DictionaryArray.from_arrays(pa.array(group_of, pa.int32()), pa.array([x for _, x in names]))
        first = order[np.flatnonzero(np.diff(run, prepend=-1))]
        out = pa.table(
            {
                "lang": lang.cast(pa.string()),
                "source": source.cast(pa.string()),
                "term": words.texts(first).take(pa.array(run_of)),
                "n": np.add.reduceat(times, at),
                "docs": np.diff(at, append=len(key)),
            }
        )
        yield from out.to_batches(max_chunksize=100_000)


def term_counts(docs: DataFrame, least: int) -> DataFrame:
    """``(lang, source, term, n, total, first)`` of the terms in at least ``least`` documents of their language.

    ``n`` counts occurrences in the source, ``total`` in the language; ``first`` marks one
    row of each (lang, term). Counts are summed within a shard of texts before the one
    shuffle, which is by (lang, term), so both sums and the document frequency share it
    and no term brings more rows than shards times sources.
    """
    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counts = map_arrow(texts, _shard_counts, _COUNTS).repartition("lang", "term")
    counts = counts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", "term")
    counts = counts.withColumns(
        {
            "df": F.sum("docs").over(whole),
            "total": F.sum("n").over(whole),
            "first": F.row_number().over(whole.orderBy("source")) == 1,
        }
    )
    return counts.filter(F.col("df") >= least).select("lang", "source", "term", "n", "total", "first")


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(ONE * (count + 2) / (total + 2 * terms)), exactly."""
    part = (count + 2).cast("decimal(20,0)") * F.lit(ONE).cast("decimal(10,0)")
    return F.call_function("div", part, (total + 2 * terms).cast("decimal(20,0)")) + 1


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of distances of the sources of two tiles over a block of terms.

    ``seen`` counts the block's terms that a source of these tiles holds; a term that
    none holds has the same distance everywhere and is added by the caller.
    """
    for rows in whole_groups(batches, ["lang", "block", "low", "high"]):
        keys = list(zip(*(rows[c].to_pylist() for c in ("lang", "block", "low", "high")), strict=True))
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            lang, _, low, high = keys[a]
            part = rows.slice(a, b - a)
            names = part["source"].to_pylist()
            terms = part["term"].to_pylist()
            shares = part["p"].to_numpy()
            tiles = part["tile"].to_numpy()
            members = [i for i, t in enumerate(terms) if t is None]
            place = {names[i]: k for k, i in enumerate(members)}
            base = shares[members]
            tile = tiles[members]
            lines: dict[str, int] = {}
            entries = [(lines.setdefault(t, len(lines)), place[names[i]], i) for i, t in enumerate(terms) if t is not None]
            dense = np.repeat(base[None, :], len(lines), axis=0)
            if entries:
                line, column, at = (np.array(x) for x in zip(*entries, strict=True))
                dense[line, column] = shares[at]
            out = {"a": [], "b": [], "value": [], "pa": [], "pb": []}
            for i in np.flatnonzero(tile == low):
                others = np.flatnonzero(tile == high)
                if low == high:
                    others = others[others > i]
                if not len(others):
                    continue
                p, q = dense[:, [i]], dense[:, others]
                out["value"].extend(((p - q) ** 2 // (p + q)).sum(axis=0).tolist())
                out["a"].extend([names[members[i]]] * len(others))
                out["b"].extend(names[members[j]] for j in others)
                out["pa"].extend([int(base[i])] * len(others))
                out["pb"].extend(base[others].tolist())
            if out["a"]:
                size = len(out["a"])
                yield pa.RecordBatch.from_pydict({"lang": [lang] * size, **out, "seen": [len(lines)] * size})


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """``(lang, source, item, value)`` for every two sources of a language."""
    tiles = F.ceil(F.col("sources") / TILE_SOURCES).cast("int")
    groups = groups.withColumns(
        {
            "blocks": F.greatest(F.lit(1), F.ceil(F.col("terms") / BLOCK_TERMS).cast("int")),
            "tiles": tiles,
            "tile": F.pmod(F.xxhash64("source"), tiles).cast("int"),
        }
    )
    names = ["lang", "source", "p", "tile", "term", "block", "tiles"]
    members = groups.withColumns({"p": F.col("p0"), "term": F.lit(None).cast("string")})
    members = members.withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).select(*names)
    entries = shares.join(groups.select("lang", "source", "blocks", "tiles", "tile"), ["lang", "source"])
    entries = entries.withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")).select(*names)
    dealt = members.union(entries).withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
    dealt = dealt.withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")}).drop("tiles", "other")
    group = ["lang", "block", "low", "high"]
    dealt = dealt.repartition(*group).sortWithinPartitions(*group, F.col("term").asc_nulls_first())
    sums = map_arrow(dealt, _compare, "lang string, a string, b string, value long, pa long, pb long, seen long")
    sums = sums.groupBy("lang", "a", "b", "pa", "pb").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    terms = groups.select("lang", "terms").distinct()
    sums = sums.join(terms, "lang").withColumn(
        "value", F.col("value") + (F.col("terms") - F.col("seen")) * _distance(F.col("pa"), F.col("pb"))
    )
    ways = [F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in (("a", "b"), ("b", "a"))]
    return sums.select("lang", "value", F.explode(F.array(*ways)).alias("x")).select("lang", "x.source", "x.item", "value")


def source_divergence(docs: DataFrame, least: int = 10, top: int = 10) -> DataFrame:
    """How each source of a language differs from the others (``pair``) and which terms stand out in it (``term``).

    Terms are runs of ASCII letters and characters beyond ASCII, A-Z in lower case; a
    language keeps those in at least ``least`` of its documents (rows). With ``count`` the
    occurrences of a kept term in a source, ``N`` their sum and ``V`` the number of kept
    terms, a term's share is p = 1 + floor(10**9 * (count + 2) / (N + 2 * V)) and two
    shares differ by floor((p - q)**2 / (p + q)). Part ``pair``: the sum over all kept terms,
    for each other source of the language (0 if V = 0), all ranks. Part ``term``: kept terms
    that the source holds and whose share is above the language's, the first ``top``.
    Returns ``lang, source, part, item, value, rank``.

    Null text, lang and source count as ''. A group without any term takes part with zero
    counts. Repeated rows are separate documents; ties go by the item's UTF-8 bytes. Other
    columns are not read; an empty table gives no row. Sums are 64-bit integers,
    products beyond that are decimals.
    """
    kept = written(term_counts(docs, least), "kept-terms")
    held = kept.groupBy("lang", "source").agg(F.sum("n").alias("held"))
    langs = kept.groupBy("lang").agg(F.sum(F.col("first").cast("long")).alias("terms"), F.sum("n").alias("all"))
    names = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    groups = names.join(held, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.na.fill(0, ["held", "terms", "all"])
    groups = groups.join(names.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")), "lang")
    none = F.when(F.col("terms") > 0, _share(F.lit(0), F.col("held"), F.col("terms"))).otherwise(1)
    groups = written(groups.withColumn("p0", none), "groups")

    stats = groups.filter("terms > 0").select("lang", "source", "held", "terms", "all")
    shares = kept.join(stats, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("held"), F.col("terms")))
    pairs = _pairs(groups, shares.select("lang", "source", "term", "p"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumns({"part": F.lit("pair"), "rank": F.row_number().over(order)})

    own = shares.withColumn("q", _share(F.col("total"), F.col("all"), F.col("terms"))).filter("p > q")
    own = own.select("lang", "source", F.col("term").alias("item"), _distance(F.col("p"), F.col("q")).alias("value"))
    own = own.withColumns({"part": F.lit("term"), "rank": F.row_number().over(order)}).filter(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).union(own.select(*columns))
