"""Ordered content digests: a Merkle tree over the ordinals of a batch's records.

A record's leaf is the sha256 of its canonical JSON (keys sorted). A node of level 1 covers FAN ordinals,
one of level i covers FAN**i; its digest is the sha256 of its children's places and digests, in order. So:

* the digest of a batch changes with any record and with the order of any two different records, and
  never with the partitioning: ranges of ordinals are the only groups there are;
* no task holds more than FAN digests at once, and a level has FAN times fewer rows than the one below;
* digests merge by range: a node of an unchanged range stays as it is, and two versions of a batch are
  compared from the top (:func:`changed_ranges`) without their records.

Ordinals need not be dense, but must be unique within a batch and below FAN**HEIGHT; records without an
ordinal, or with the same, raise. :func:`with_ordinals` numbers records by their place in the landed files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.session import cut_lineage
from kestrel.sources.ingest import canonical_json

FAN = 1024
HEIGHT = 4  # levels above the records: 10**12 ordinals


def _above(nodes: DataFrame, batch_cols: list[str]) -> DataFrame:
    """The next level: (batch, place, n, digest)."""
    child = F.struct((F.col("place") % FAN).alias("i"), F.col("digest").alias("d"))
    text = F.concat_ws(";", F.transform(F.array_sort(F.collect_list(child)), lambda c: F.concat(c["i"].cast("string"), F.lit(":"), c["d"])))
    return nodes.groupBy(*batch_cols, F.expr(f"place div {FAN}").alias("place")).agg(F.sum("n").alias("n"), F.sha2(text, 256).alias("digest"))


def leaves(records: DataFrame, batch_cols: list[str], ordinal: str, record_cols: list[str]) -> DataFrame:
    """(batch, place, n, digest) of every record."""
    place = F.col(ordinal).cast("bigint")
    sound = F.when(place.isNull() | (place < 0) | (place >= FAN ** HEIGHT), F.raise_error(F.lit("a record's ordinal is missing or out of range"))).otherwise(place)
    return records.select(*batch_cols, sound.cast("bigint").alias("place"), F.lit(1).cast("bigint").alias("n"),
                          F.sha2(canonical_json(record_cols), 256).alias("digest"))


def tree_level(records: DataFrame, batch_cols: list[str], ordinal: str, record_cols: list[str], level: int) -> DataFrame:
    """The nodes of one level (0: the records, HEIGHT: one per batch)."""
    nodes = leaves(records, batch_cols, ordinal, record_cols)
    for i in range(level):
        nodes = _above(nodes, batch_cols)
        if i == 0:  # as many records as ordinals, or two have the same: a group would grow without bound
            nodes = nodes.withColumn("digest", F.when(F.col("n") > FAN, F.raise_error(F.lit("records share an ordinal")).cast("string")).otherwise(F.col("digest")))
    return nodes


def ordered_checksums(records: DataFrame, batch_cols: list[str], ordinal: str, record_cols: list[str]) -> DataFrame:
    """Per batch: record count and the root of its tree (sha256 over count and top digest)."""
    top = tree_level(records, batch_cols, ordinal, record_cols, HEIGHT)
    return top.select(*batch_cols, F.col("n").alias("n_records"), F.sha2(F.concat_ws(":", F.col("n").cast("string"), "digest"), 256).alias("checksum"))


def changed_ranges(old: DataFrame, new: DataFrame, batch_cols: list[str], level: int = 1) -> DataFrame:
    """(batch, first, last): ranges of ordinals whose records differ between two versions, from their
    nodes of one level (kept by an earlier run, as :func:`tree_level` gives them)."""
    keys = [*batch_cols, "place"]
    both = old.select(*keys, F.col("digest").alias("__old")).join(new.select(*keys, F.col("digest").alias("__new")), keys, "full_outer")
    size = FAN ** level
    return both.where(~F.col("__old").eqNullSafe(F.col("__new"))).select(
        *batch_cols, (F.col("place") * size).alias("first"), ((F.col("place") + 1) * size - 1).alias("last"))


def with_ordinals(records: DataFrame, batch_cols: list[str], order: list[str], name: str = "ordinal") -> DataFrame:
    """records with their dense number, from 0, in their batch's order. Ranges of (batch, order) are
    numbered by themselves and then shifted by what lies before them, so no task holds a batch."""
    keys = [*batch_cols, *order]
    ordered = cut_lineage(records.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__part", F.spark_partition_id()))
    inside = Window.partitionBy(*batch_cols, "__part").orderBy(*order)
    parts = ordered.groupBy(*batch_cols, "__part").agg(F.count(F.lit(1)).alias("__n"))  # a batch's parts are few
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*batch_cols).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    carry = parts.select(*batch_cols, "__part", before.alias("__before"))
    local = ordered.withColumn(name, F.row_number().over(inside).cast("bigint") - 1)
    return local.join(carry, [*batch_cols, "__part"]).withColumn(name, F.col(name) + F.col("__before")).drop("__part", "__before")
