"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

ROWS_PER_BATCH = 1000  # of an Arrow batch between Spark and its Python workers

#: Name under which operators carry a document's key; input columns may be called anything else.
KEY = "__key"


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; only a session without one (as in
    tests) gets a folder beside its warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or spark.conf.get("spark.sql.warehouse.dir") + "/checkpoints").rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage: write df once as Parquet in the shared folder and read it back, so that a
    lost executor costs no recomputation and several readers share one computation."""
    path = f"{shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_id(col="doc_id"):
    """The remainder that deals rows to the held-out fold: crc32 of the id as text, modulo 5."""
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(5))


def excerpts(text, chars: int, parts: int = 8):
    """A text's whole content where it has at most ``chars`` characters, else ``parts`` stretches of together about
    that many, evenly spread from its beginning to its end, less the words they cut."""
    size = chars // parts
    start = lambda i: (F.lit(1) + F.floor(i * (F.length(text) - size) / (parts - 1))).cast("int")
    stretch = lambda i: F.regexp_replace(F.substring(text, start(i), F.lit(size)), r"^\S+\s|\s\S+$", " ")
    return F.when(text.isNull() | (F.length(text) <= chars), text).otherwise(F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), stretch)))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """docs as (KEY bigint, id, text, and the columns ``keep``), one row per input row, where KEY orders documents as their
    ids do and tells them apart; and the same with one row per key.

    Ids that are unique and not null are the keys themselves. Otherwise documents are the
    distinct (id, text) pairs, numbered in the order null ids, id, text hash; rows that repeat a
    pair share its key (each row keeps its own place in the result)."""
    slim = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"), *keep)
    bad = slim.groupBy("id").count().filter("id is null or count > 1").limit(1).count()
    if not bad:
        own = slim.select(F.col("id").alias(KEY), "id", "text", *keep)
        return own, own
    slim = slim.withColumn("digest", F.xxhash64(F.coalesce("text", F.lit(""))))
    numbers = ordinals(slim.select("id", "digest").distinct(), ["id", "digest"], KEY)
    joined = slim.alias("a").join(numbers.alias("b"), F.expr("a.id <=> b.id and a.digest = b.digest"))
    own = joined.select(f"b.{KEY}", F.col("a.id").alias("id"), F.col("a.text").alias("text"), *[f"a.{c}" for c in keep])
    return own, own.dropDuplicates([KEY])


SIEVE_WORDS = 1 << 17  # of 64 bits: 1 MB, whatever the number of keys


def sieved(docs: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """docs in two parts: those whose KEY may be among ``keys`` (all that are, and some by chance)
    and those whose KEY certainly isn't. Only the first part need be shuffled to meet what is
    known of the keys. A bitmap of fixed size decides; it is broadcast, SIEVE_WORDS rows at most."""
    def place(df):
        digest = F.xxhash64(KEY)
        return df.withColumn("__word", digest.bitwiseAND(SIEVE_WORDS - 1)).withColumn("__bit", F.expr(f"cast(shiftright(xxhash64({KEY}), 40) & 63 as int)"))

    bits = place(keys.select(KEY)).groupBy("__word").agg(F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__bits"))
    marked = place(docs).join(F.broadcast(stored(bits)), "__word", "left")
    hit = F.expr("coalesce(shiftright(__bits, __bit) & 1, 0) = 1")
    return tuple(marked.filter(part).select(*docs.columns) for part in (hit, ~hit))


def ordinals(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """df with a dense number from 0 in the order of ``by``: range partitions are counted, and
    each adds the rows of those before it. The sorted rows are written once, so that a lost
    executor can't deal them out anew."""
    spark = df.sparkSession
    ordered = stored(df.repartitionByRange(partitions(spark), *by).sortWithinPartitions(*by)
                           .withColumn("__part", F.spark_partition_id())
                           .withColumn("__row", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    counts = {r["__part"]: r["n"] for r in ordered.groupBy("__part").agg(F.count("*").alias("n")).collect()}  # one row per partition
    before, base = {}, 0
    for part in sorted(counts):
        before[part] = base
        base += counts[part]
    offsets = spark.createDataFrame([(p, b) for p, b in before.items()], "__part int, __before bigint")
    return ordered.join(offsets, "__part").withColumn(name, F.col("__before") + F.col("__row")).drop("__part", "__row", "__before")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application (they need not have it installed),
    and set the session's Arrow batch size."""
    # documents are long rows: small batches keep both sides of the pipe to the workers small
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    target = Path(tempfile.mkdtemp(prefix="kestrel-")) / "kestrel_llm.zip"
    with zipfile.ZipFile(target, "w") as out:
        for source in [root / "kestrel/__init__.py", *sorted((root / "kestrel/llm").glob("*.py"))]:
            out.write(source, source.relative_to(root))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)
