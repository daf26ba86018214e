"""Source divergence audit: how far apart the sources of each language lie, by a partitioned cube.

Terms are runs of letters. One pass counts them per (language, source) and in how many documents
of the language they stand; each task sums its own counts before they travel. A language keeps the terms of
MIN_DOCUMENTS documents. A group (language and source) gives each kept term the scaled probability
p = 1 + floor(SCALE * (count + 1) / (all counts + kept terms)); a term it lacks gets the same p0.

The divergences f(p, q) = floor((p - q)**2 / q) of all ordered pairs of a language's groups, summed
over its terms, fill a cube (group, group, term). It is cut into cells of two group blocks and one
term block; both kinds of blocks are dealt by hash, so that they have about GROUPS groups and TERMS
terms however many there are. A group block's slice of counts is copied to every cell it meets. A cell
is a task's work: it lays its slices out densely and gives one partial sum per ordered pair, over
the terms that either slice has, less what p0 of both would give; the cells of the first term block
add that for all terms. Partial sums are added along the term axis.

All arithmetic is on integers and exact while a language has fewer than 2**53 counts and terms.

Defined results: null text, language and source are empty strings; rows are documents, whatever
their ids; a group without terms takes part with p0 alone; a language without kept terms has value 0
everywhere; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from kestrel.llm import textscan as ts
from kestrel.llm.common import partitions, stored

MIN_DOCUMENTS = 3
SCALE = 1_000_000_000
GROUPS = 16     # of a group block
TERMS = 1024    # of a term block
RANKS = 200     # of the terms reported per group
FLUSH_ROWS = 1 << 18  # counts a task holds before they leave it

COUNTED = "lang string, source string, term string, n bigint, docs bigint"
PARTIAL = "lang string, source string, item string, value bigint"

_BREAKS = np.zeros(256, dtype=bool)
_BREAKS[[*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


def _term_counts(batch: pa.RecordBatch, data: np.ndarray, bounds: np.ndarray) -> pa.Table:
    """(lang, source, term, n, docs) of a slice; terms are told apart by their bytes."""
    words = ts.Words(data, bounds, _BREAKS)
    inside = ~_BREAKS[data]
    edges = np.append(0, np.cumsum(words.ends - words.starts))
    terms = pa.LargeStringArray.from_buffers(len(words.starts), pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(ts.LOWER[data[inside]])).dictionary_encode()
    code = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    group = pa.array(pc.binary_join_element_wise(batch.column(0), batch.column(1), "\0")).dictionary_encode()
    of_doc = group.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = max(len(terms.dictionary), 1)
    in_doc, n = np.unique(words.doc * size + code, return_counts=True)          # per document and term
    key, at = np.unique(of_doc[in_doc // size] * size + in_doc % size, return_inverse=True)  # per group and term
    first = np.zeros(len(group.dictionary), dtype=np.int64)
    first[of_doc[::-1]] = np.arange(len(of_doc))[::-1]                          # a document of each group names it
    names = first[key // size]
    return pa.table({"lang": batch.column(0).take(pa.array(names)), "source": batch.column(1).take(pa.array(names)),
                     "term": terms.dictionary.take(pa.array(key % size)).cast(pa.string()),
                     "n": np.bincount(at, weights=n, minlength=len(key)).astype(np.int64),
                     "docs": np.bincount(at, minlength=len(key)).astype(np.int64)})


def _counter(batches):
    """mapInArrow body: documents (lang, source, text) -> COUNTED, summed over what a task holds."""
    held, rows = None, 0
    for batch, data, bounds in ts.slices(batches, "text"):
        counts = _term_counts(batch, data, bounds)
        held = counts if held is None else pa.concat_tables([held, counts])
        if held.num_rows - rows > FLUSH_ROWS // 4:
            held = _summed(held)
            rows = held.num_rows
            if rows > FLUSH_ROWS:
                yield from held.to_batches()
                held, rows = None, 0
    if held is not None:
        yield from _summed(held).to_batches()


def _summed(counts: pa.Table) -> pa.Table:
    out = counts.group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return out.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(["lang", "source", "term", "n", "docs"])


def scaled(count: str, total: str):
    """1 + floor(SCALE * (count + 1) / total) of the columns; the quotient is built in three steps of
    three digits, so that nothing passes 64 bits while total is below 2**53."""
    a = f"(({count} + 1) * 1000) div {total}"
    rest_a = f"(({count} + 1) * 1000) % {total}"
    b, rest_b = f"(({rest_a}) * 1000) div {total}", f"(({rest_a}) * 1000) % {total}"
    c = f"(({rest_b}) * 1000) div {total}"
    return F.expr(f"1 + ({a}) * 1000000 + ({b}) * 1000 + ({c})")


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """f: floor((p - q)**2 / q)."""
    d = p - q
    return d * d // q


def _cell(rows: pa.Table) -> pa.RecordBatch:
    """PARTIAL of one cell: group rows (term null; p is p0, ``terms`` the language's kept terms in the
    first term block, else 0) and counts (term not null) of one or two group blocks."""
    lang = rows["lang"][0].as_py()
    left, right, t = (rows[c][0].as_py() for c in ("left", "right", "t"))
    source = rows["source"].combine_chunks().dictionary_encode()
    is_term = pc.is_valid(rows["term"]).to_numpy(zero_copy_only=False)
    code = source.indices.to_numpy(zero_copy_only=False)
    p = rows["p"].to_numpy()
    n = len(source.dictionary)
    base, block, everywhere = (np.zeros(n, dtype=np.int64) for _ in range(3))
    base[code[~is_term]] = p[~is_term]
    block[code[~is_term]] = rows["block"].to_numpy()[~is_term]
    everywhere[code[~is_term]] = rows["terms"].to_numpy()[~is_term]
    terms = rows["term"].combine_chunks().filter(pa.array(is_term)).dictionary_encode()
    m = len(terms.dictionary)
    dense = np.repeat(base[:, None], m, axis=1)
    dense[code[is_term], terms.indices.to_numpy(zero_copy_only=False)] = p[is_term]
    a, b, values = [], [], []
    sources = np.arange(n)
    for i in sources[block == left]:
        others = sources[(block == right) & (sources != i)]
        if left == right:
            others = others[others > i]
        if not len(others) or not base[i]:  # p0 is 0 where the language has no kept term
            values.append(np.zeros(2 * len(others), dtype=np.int64))
        else:
            more = everywhere[i] - m  # terms that none of the cell's groups has, if this cell sums p0 over them all
            there = gaps(dense[i], dense[others]).sum(axis=1) + more * gaps(base[i], base[others])
            back = gaps(dense[others], dense[i]).sum(axis=1) + more * gaps(base[others], base[i])
            values += [there, back]
        a += [np.full(len(others), i), others]
        b += [others, np.full(len(others), i)]
    a, b, values = (np.concatenate([np.empty(0, np.int64), *x]) for x in (a, b, values))
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(a), pa.string()), source.dictionary.take(pa.array(a)), source.dictionary.take(pa.array(b)),
                                       pa.array(values)], names=["lang", "source", "item", "value"])


def _cells(batches):
    """mapInArrow body over rows sorted by cell: PARTIAL of every cell."""
    held = None
    for batch in _with_end(batches):
        if batch is not None:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
        if held is None or not held.num_rows:
            continue
        change = np.zeros(held.num_rows - 1, dtype=bool)
        for c in ("lang", "left", "right", "t"):
            column = held[c].combine_chunks()
            change |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
        cut = np.append(0, np.flatnonzero(change) + 1)
        edges = np.append(cut, held.num_rows) if batch is None else cut  # the last cell may go on
        for a, b in zip(edges[:-1], edges[1:]):
            yield _cell(held.slice(a, b - a))
        held = held.slice(edges[-1]).combine_chunks()


def _with_end(batches):
    yield from batches
    yield None


def counted(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups (lang, source), counts (lang, source, term, n) of the kept terms)."""
    slim = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    groups = stored(slim.select("lang", "source").distinct())
    counts = stored(slim.mapInArrow(_counter, COUNTED).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).filter(f"docs >= {MIN_DOCUMENTS}").select("lang", "term")
    return groups, stored(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n"))


def audit(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` holds for each group all other sources of
    its language, ``term`` the RANKS terms it favours most over its language."""
    groups, counts = counted(docs)
    spark = docs.sparkSession
    whole = stored(counts.groupBy("lang", "term").agg(F.sum("n").alias("n_lang")))
    langs = whole.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("n_all"))
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    sizes = groups.groupBy("lang").agg(F.count("*").alias("n_sources"))
    of_group = stored(groups.join(sizes, "lang").join(langs, "lang", "left").join(sums, ["lang", "source"], "left")
                      .selectExpr("lang", "source", "coalesce(v, 0L) v", "coalesce(n_all, 0L) n_all", "coalesce(n_group, 0L) n_group",
                                  f"ceil(n_sources / {GROUPS}) blocks", f"greatest(ceil(coalesce(v, 0L) / {TERMS}), 1) term_blocks")
                      .withColumn("block", F.expr("pmod(xxhash64(source), blocks)")))
    rows = counts.join(of_group, ["lang", "source"]).withColumn("p", scaled("n", "(n_group + v)"))
    return _pairs(spark, of_group, rows).unionByName(_terms(rows, whole))


def _pairs(spark, of_group: DataFrame, rows: DataFrame) -> DataFrame:
    p0 = F.when(F.col("v") > 0, scaled("0L", "greatest(n_group + v, 1L)")).otherwise(0)
    slices = (rows.withColumn("t", F.expr("pmod(xxhash64(term), term_blocks)")).withColumn("terms", F.lit(0).cast("bigint"))
              .select("lang", "source", "term", "p", "block", "blocks", "t", "terms"))
    # every cell of a group's block knows the group, also where it has no count
    heads = (of_group.withColumn("p", p0).withColumn("t", F.explode(F.expr("sequence(0L, term_blocks - 1)")))
             .withColumn("terms", F.expr("if(t = 0, v, 0L)")).withColumn("term", F.lit(None).cast("string"))
             .select("lang", "source", "term", "p", "block", "blocks", "t", "terms"))
    copies = (slices.unionByName(heads).withColumn("with", F.explode(F.expr("sequence(0L, blocks - 1)")))
              .withColumn("left", F.least("block", "with")).withColumn("right", F.greatest("block", "with"))
              .select("lang", "left", "right", "t", "source", "term", "p", "block", "terms"))
    cells = copies.repartition(partitions(spark), "lang", "left", "right", "t").sortWithinPartitions("lang", "left", "right", "t")
    value = cells.mapInArrow(_cells, PARTIAL).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return value.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def _terms(rows: DataFrame, whole: DataFrame) -> DataFrame:
    favoured = (rows.join(whole, ["lang", "term"]).withColumn("q", scaled("n_lang", "(n_all + v)")).filter("p > q")
                .selectExpr("lang", "source", "term as item", "((p - q) * (p - q)) div q as value"))
    # the filter on the rank lets every task keep its best RANKS rows a group before they are shuffled
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return favoured.withColumn("rank", rank).filter(f"rank <= {RANKS}").select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
