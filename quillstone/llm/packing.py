"""Packing: documents are concatenated, in the order of their partitions, and cut into windows of a fixed size.

The first pass counts the tokens of every partition; running sums of these totals give each partition its place in the
whole. The second pass cuts each partition at multiples of the window size. Only a partition's first and last window can
be incomplete; these boundary records, two a partition at most, are put together by one small shuffle. Tokens are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.byte_bpe import byte_bpe, model_json
from quillstone.llm.common import checkpointed, ship, text_or_empty

WINDOW = 1024
#: Characters that are encoded, and windows that are returned, at once.
ROUND_CHARS, OUT_ROWS = 1_000_000, 256
_PIECES = "array<struct<doc_id:{0},start:bigint,length:bigint,doc_tokens:bigint,offset:bigint>>"


def rounds(texts: list[str], most: int = ROUND_CHARS) -> Iterator[list[str]]:
    """texts in runs of about ``most`` characters."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def tokenized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None, end_id: int = 0) -> DataFrame:
    """doc_id, ids (bytes of the vocabulary's width, ``end_id`` last), n, width; a null text counts as empty."""
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(model_json(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(model.value)
        end, width = np.array([end_id], bpe.width).tobytes(), bpe.width.itemsize
        for batch in batches:
            start = 0
            for texts in rounds(batch.column(1).to_pylist()):
                ids = [x + end for x in bpe.encode(texts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), pa.array(ids, pa.binary()), pa.array([len(x) // width for x in ids], pa.int64()), pa.array([width] * len(ids), pa.int32())],
                    names=["doc_id", "ids", "n", "width"],
                )
                start += len(texts)

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col)).mapInArrow(run, f"doc_id {id_type}, ids binary, n long, width int")


def placed(tokens: DataFrame) -> DataFrame:
    """tokens, kept in their partitions, with ``base``, the number of tokens in all partitions before.

    The driver sees one number a partition, which is no more than its scheduler holds.
    """
    kept = checkpointed(tokens.withColumn("part", F.spark_partition_id()))
    totals = sorted((r["part"], r["total"]) for r in kept.groupBy("part").agg(F.sum("n").alias("total")).collect())
    before = [0, *accumulate(t for _, t in totals)]
    bases = kept.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(totals, before, strict=False)], "part int, base long")
    return kept.join(F.broadcast(bases), "part")


def windows(tokens: DataFrame, size: int = WINDOW, boundary: bool = False) -> DataFrame:
    """sequence_id, at, ids (32-bit, little-endian), pieces: the complete windows of each partition or, if ``boundary``, the incomplete ones.

    at is the window's first place in its sequence. A piece has its document's id, start and doc_tokens, its length and its offset in the sequence.
    """
    id_type = tokens.schema["doc_id"].dataType.simpleString()
    out_type = f"sequence_id long, at long, ids binary, pieces {_PIECES.format(id_type)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = None  # in the whole concatenation
        first, ids, pieces, out = 0, [], [], []
        kinds: list[pa.DataType] = []

        def packed() -> pa.RecordBatch:
            piece = pa.struct([("doc_id", kinds[0]), *[(c, pa.int64()) for c in ("start", "length", "doc_tokens", "offset")]])
            types = [pa.int64(), pa.int64(), pa.binary(), pa.list_(piece)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["sequence_id", "at", "ids", "pieces"])

        def close() -> None:
            nonlocal ids, pieces, first
            whole = place - first == size
            if whole != boundary:
                joined = np.frombuffer(b"".join(ids), f"<u{width}").astype("<u4").tobytes()
                out.append((first // size, first % size, joined, pieces))
            ids, pieces, first = [], [], place

        for batch in batches:
            kinds = [batch.schema.field("doc_id").type]
            for doc_id, held, n, width, base in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "ids", "n", "width", "base")], strict=True):
                if place is None:
                    place = first = base
                start = 0
                while start < n:
                    take = min(n - start, size - place % size)
                    ids.append(held[start * width : (start + take) * width])
                    pieces.append({"doc_id": doc_id, "start": start, "length": take, "doc_tokens": n, "offset": place % size})
                    place, start = place + take, start + take
                    if place % size == 0:
                        close()
                if len(out) >= OUT_ROWS:
                    yield packed()
                    out = []
        if pieces:
            close()
        if out:
            yield packed()

    return tokens.select("doc_id", "ids", "n", "width", "base").mapInArrow(run, out_type)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None, size: int = WINDOW, end_id: int = 0, pad_id: int = 0) -> DataFrame:
    """One row per sequence: sequence_id, length, padded_to, ids (padded, 32-bit little-endian), pieces (in order).

    Every token of every document, ``end_id`` behind it, lies in one piece. All sequences but the last hold ``size`` tokens; the last is
    padded to ``size``, unless its length is a power of two. A null or empty text gives a document of one token. Repeated rows are documents of
    their own, ids may be null, texts may be of any length; no other columns are read, so their names can't clash. No rows give no sequences. Documents follow each other as the
    table's partitions hold them.
    """
    tokens = placed(tokenized(docs, id_col, text_col, model_path, end_id))
    complete = windows(tokens, size).select("sequence_id", "ids", "pieces")
    parts = windows(tokens, size, boundary=True).groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("at", "ids", "pieces"))).alias("parts"))
    joined = parts.select(
        "sequence_id", F.aggregate(F.col("parts.ids"), F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"), F.flatten(F.col("parts.pieces")).alias("pieces")
    )
    length = (F.octet_length("ids") / 4).cast("long")
    power = F.col("length").bitwiseAND(F.col("length") - 1) == 0
    pad = F.unhex(F.repeat(F.lit(int(pad_id).to_bytes(4, "little").hex()), (F.col("padded_to") - F.col("length")).cast("int")))
    return (
        complete.unionByName(joined).withColumn("length", length).withColumn("padded_to", F.when(power, F.col("length")).otherwise(size))
        .select("sequence_id", "length", "padded_to", F.when(F.col("length") < F.col("padded_to"), F.concat("ids", pad)).otherwise(F.col("ids")).alias("ids"), "pieces")
    )


def pieces_digest(sequences: DataFrame) -> DataFrame:
    """Of each piece of the packed sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    cut = F.substring(F.col("ids"), (F.col("p.offset") * 4 + 1).cast("int"), (F.col("p.length") * 4).cast("int"))
    return sequences.select("sequence_id", "ids", F.explode("pieces").alias("p")).select(
        "p.doc_id", "p.start", "p.length", F.crc32(cut).alias("ids_crc32"), "p.doc_tokens", "sequence_id", "p.offset"
    )
