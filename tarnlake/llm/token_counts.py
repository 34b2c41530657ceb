"""Token counts of flat token files: ids one after another, each document ended by a separator, no index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnlake.llm.common import named, settle
from tarnlake.llm.tokens import TEXT_BYTES, slices, word_tokens

# The file format: little-endian ids of WIDTH bytes, stored plus one, so that 0 is free to end a document.
WIDTH, END_ID = 2, 0
BLOCK_BYTES = 1 << 20
# Writing files shares an executor with whole files that are read: a smaller store of words, and less text at once.
STORED_WORDS = 150_000
PARTITIONS = "spark.sql.files.minPartitionNum"


def write_token_files(docs: DataFrame, path: str, tokenizer: str, *, key: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """Tokenise whole documents into flat files ``part-<n>-*``, and return where each went: ``doc_id``, ``file``
    (n) and ``ordinal`` (its place in the file).

    Every task writes the documents of its partition as they come, so that no token is shuffled. Spark's text
    writer puts its line separator behind every row: with two zero bytes that is the format. A null text is
    an empty one and leaves its separator only. ``docs`` must have the same partitions and the same order of
    rows when it is read again, as tables in files and given rows have; the number of partitions is held fixed
    meanwhile, as Spark else derives it from the executors it has just then.
    """
    spark = docs.sparkSession
    frame = docs.select(
        named(key).cast("long").alias("doc_id"), F.coalesce(named(text), F.lit("")).cast("binary").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokens(tokenizer, STORED_WORDS)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for low, high in slices(texts, TEXT_BYTES // 2):
                counts, ids = words.encode(texts[low:high])
                data, ends = (ids + 1).astype("<u2").tobytes(), np.cumsum(counts) * WIDTH
                offsets = np.r_[0, ends].astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(
                    pa.binary(), high - low, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])], ["ids"])

    fixed = spark.conf.get(PARTITIONS, None)
    if fixed is None:
        spark.conf.set(PARTITIONS, str(spark.sparkContext.defaultParallelism))
    try:
        frame.mapInArrow(encode, "ids binary").select(F.col("ids").cast("string").alias("value")) \
            .write.option("lineSep", "\0" * WIDTH).text(path)
        # The same columns are read, so that an exchange in docs deals the rows out as it did before.
        number = F.monotonically_increasing_id()
        return settle(frame.select(
            "doc_id", F.spark_partition_id().alias("file"), number.bitwiseAND(F.lit(2**33 - 1)).alias("ordinal"),
            F.octet_length("text").alias("octets")), "token-places").drop("octets")
    finally:
        if fixed is None:
            spark.conf.unset(PARTITIONS)


def scan_token_files(spark: SparkSession, path: str, *, end_id: int = END_ID, width: int = WIDTH,
                     block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents of flat token files: ``path``, the folder's partition columns, ``ordinal``, ``start`` (ids
    ahead of it in the file), ``n_tokens`` (without the separator) and ``ended``.

    Files are cut into blocks. Each block is searched for separators by itself; sums and maxima over the
    blocks ahead then tell which document a block's first separator ends and where that document began.
    Ids behind the last separator are a document that has not ended; a file without ids has no documents; two
    separators in a row hold an empty one. Files must be of less than 2 GB, a whole number of ids, and fit
    in a task's memory, as Spark hands out binary files whole.
    """
    if block_bytes % width:
        raise ValueError("a block must hold whole ids")
    files = spark.read.format("binaryFile").load(path).drop("modificationTime").where("length > 0")
    folders = [c for c in files.columns if c not in ("path", "length", "content")]
    blocks = files.withColumn("block", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("length") - 1) / block_bytes)))).select(
        "path", *folders, "block", (F.col("length") / width).cast("long").alias("ids"),
        F.expr(f"substring(content, CAST(block * {block_bytes} + 1 AS INT), {block_bytes})").alias("payload"))
    kind = {2: "<u2", 4: "<u4"}[width]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("payload")
            found = []
            for row in range(batch.num_rows):
                first = batch.column("block")[row].as_py() * (block_bytes // width)
                ids = np.frombuffer(batch.column(at)[row].as_buffer(), kind)
                found.append(np.flatnonzero(ids == end_id) + first)
            offsets = np.r_[0, np.cumsum([len(f) for f in found])].astype(np.int32)
            ends = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in range(at)] + [ends], batch.schema.names[:at] + ["ends"])

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in blocks.schema.fields if f.name != "payload"]
    searched = blocks.mapInArrow(search, ", ".join([*fields, "ends array<long>"]))
    whole = Window.partitionBy("path")
    ahead = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    stitched = searched.withColumns({
        "before": F.coalesce(F.sum(F.size("ends")).over(ahead), F.lit(0)),
        "last": F.coalesce(F.max(F.try_element_at("ends", F.lit(-1))).over(ahead), F.lit(-1)),
        "final": F.col("block") == F.max("block").over(whole)})
    stitched = stitched.withColumn("open", F.col("final") & (
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.col("last")) < F.col("ids") - 1))
    stitched = stitched.withColumn(
        "stops", F.when(F.col("open"), F.concat("ends", F.array("ids"))).otherwise(F.col("ends")))
    documents = stitched.select("path", *folders, "before", "last", "ids", "stops", F.posexplode("stops"))
    begins = F.when(F.col("pos") == 0, F.col("last")).otherwise(F.get("stops", F.col("pos") - 1)) + 1
    return documents.select(
        "path", *folders, (F.col("before") + F.col("pos")).alias("ordinal"), begins.alias("start"),
        (F.col("col") - begins).alias("n_tokens"), (F.col("col") < F.col("ids")).alias("ended"))
