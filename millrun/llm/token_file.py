"""Token-id files: one zstandard frame per document under a shared dictionary.

Format. A folder ``<path>/blocks`` of uncompressed Parquet files whose rows
are blocks: the frames of consecutive documents (ascending ids) back to back
in ``payload``, the offset index (``offsets``, one more than documents), the
documents' ids and token counts, the number of tokens before each inside its
part, and the hash of the dictionary. ``<path>/dictionary`` has the
dictionary and its SHA-256, ``<path>/parts`` the number of tokens before each
part. A frame holds the ids as little-endian unsigned 32-bit integers; a
single document is read by its block's row and two offsets, without
decompressing its neighbours.

The dictionary is trained on a bounded sample (``SAMPLE_DOCS`` documents with
the smallest hashes, at most ``SAMPLE_IDS`` ids of each); every document is
written whole. If the sample is too small to train on, the dictionary is
empty and its frames stand alone.

Spark writes the files, so they go to any store it can reach, and a lost
executor's attempt leaves nothing behind. Documents are dealt by ranges of
(doc_id, hash of the text): a repeated id is split as well.

Defined cases: null text is an empty one (its frame holds the end id alone);
null ids come first; equal ids follow each other by the hash of their text;
an empty table gives a file without blocks and no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import emit, rows_of, text_of, uncollected
from .tokens import file_encoder, packed, words_le

SAMPLE_DOCS = 400
SAMPLE_IDS = 2_000
DICTIONARY_BYTES = 64 * 1024
BLOCK_BYTES = 1 << 20
LEVEL = 3

_BLOCKS = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("first_doc", pa.int64()),
        ("last_doc", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("n_tokens", pa.list_(pa.int64())),
        ("before", pa.list_(pa.int64())),
        ("offsets", pa.list_(pa.int64())),
        ("dictionary_sha256", pa.string()),
        ("payload", pa.binary()),
    ]
)
_BLOCKS_SQL = "part int, block int, first_doc long, last_doc long, doc_ids array<long>, n_tokens array<long>, before array<long>, offsets array<long>, dictionary_sha256 string, payload binary"


def train(docs: DataFrame, path: str, end_id: int) -> bytes:
    """The shared dictionary, from at most SAMPLE_DOCS * SAMPLE_IDS ids."""
    import zstandard

    picked = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS).distinct()
    # a text of SAMPLE_IDS tokens has at most a few letters a token; only the dictionary sees this sample
    texts = docs.join(F.broadcast(picked), docs["doc_id"].eqNullSafe(picked["doc_id"]), "left_semi").select(F.substring("text", 1, 4 * SAMPLE_IDS).alias("text")).limit(SAMPLE_DOCS)
    encode = file_encoder(path)
    end = packed([end_id])
    samples = [encode(r.text)[: 4 * SAMPLE_IDS] + end for r in texts.toLocalIterator()]
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if size >= 1024 else b""
    except zstandard.ZstdError:
        return b""


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode, compress and write every document of ``docs`` below ``path``."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    dictionary = train(docs, tokenizer, end_id)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, bytearray(dictionary))], "sha256 string, data binary").coalesce(1).write.parquet(f"{path}/dictionary")
    spread = docs.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        encode, end = file_encoder(tokenizer), packed([end_id])
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared).compress
        part, block, before = TaskContext.get().partitionId(), 0, 0
        ids: list = []
        counts: list = []
        starts: list = []
        frames: list = []
        offsets = [0]
        for batch in batches:
            docs, texts = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text"))
            flat, upto = encode.batch(texts)
            for doc, a, b in zip(docs.to_pylist(), upto.tolist(), upto[1:].tolist()):
                data = flat[a:b].tobytes() + end
                frame = compress(data)
                ids.append(doc)
                counts.append(len(data) // 4)
                starts.append(before)
                frames.append(frame)
                offsets.append(offsets[-1] + len(frame))
                before += len(data) // 4
                if offsets[-1] >= BLOCK_BYTES:
                    yield emit(_BLOCKS, [[x] for x in (part, block, ids[0], ids[-1], ids, counts, starts, offsets, digest, b"".join(frames))])
                    block, ids, counts, starts, frames, offsets = block + 1, [], [], [], [], [0]
        if ids:
            yield emit(_BLOCKS, [[x] for x in (part, block, ids[0], ids[-1], ids, counts, starts, offsets, digest, b"".join(frames))])

    spread.select("doc_id", "text").mapInArrow(uncollected(run), _BLOCKS_SQL).write.option("compression", "none").parquet(f"{path}/blocks")
    totals = _blocks(spark, path).select("part", F.expr("aggregate(n_tokens, 0L, (a, x) -> a + x)").alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    # one row a part, in the parts' order
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    totals.select("part", F.coalesce(before, F.lit(0)).alias("tokens_before")).write.parquet(f"{path}/parts")


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_BLOCKS_SQL).parquet(f"{path}/blocks")


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{path}/dictionary").head()
    return row.sha256, bytes(row.data)


def _frames(blocks: DataFrame, digest: str, dictionary: bytes, schema: pa.Schema, ddl: str, make) -> DataFrame:
    """``make(doc_id, ids as bytes)`` for each document, with its part and the tokens before it there."""
    wanted = "wanted" in blocks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        decompress = zstandard.ZstdDecompressor(dict_data=shared).decompress
        for batch in batches:
            for part, docs, starts, offsets, sha, payload, *only in rows_of(batch, "part", "doc_ids", "before", "offsets", "dictionary_sha256", "payload", *["wanted"] * wanted):
                if sha != digest:
                    raise ValueError(f"part {part} was written under another dictionary: {sha}")
                keep = set(only[0]) if wanted else None
                out: list[list] = [[] for _ in schema]
                for doc, start, a, b in zip(docs, starts, offsets, offsets[1:], strict=False):
                    if keep is None or doc in keep:
                        for column, v in zip(out, (part, start, *make(doc, decompress(payload[a:b]))), strict=True):
                            column.append(v)
                yield emit(schema, out)

    names = ["part", "doc_ids", "before", "offsets", "dictionary_sha256", "payload", *["wanted"] * wanted]
    return blocks.select(*names).mapInArrow(run, ddl)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from its decompressed ids."""
    schema = pa.schema([("part", pa.int32()), ("before", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    docs = _frames(_blocks(spark, path), *_dictionary(spark, path), schema, "part int, before long, doc_id long, n_tokens long, ids_crc32 long", lambda doc, data: (doc, len(data) // 4, zlib.crc32(data)))
    parts = spark.read.schema("part int, tokens_before long").parquet(f"{path}/parts")
    return docs.join(parts, "part").select("doc_id", (F.col("tokens_before") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def fetch(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of a few documents: only blocks whose range holds one of
    them are read, and only their own frames are decompressed."""
    schema = pa.schema([("part", pa.int32()), ("before", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))])
    wanted = F.array(*[F.lit(int(d)) for d in doc_ids]).cast("array<long>")
    near = F.lit(False)
    for d in doc_ids:
        near = near | ((F.col("first_doc") <= d) & (F.col("last_doc") >= d))
    blocks = _blocks(spark, path).where(near).withColumn("wanted", wanted)
    return _frames(blocks, *_dictionary(spark, path), schema, "part int, before long, doc_id long, ids array<long>", lambda doc, data: (doc, words_le(data).astype(np.int64).tolist())).select("doc_id", "ids")


def round_trip(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> DataFrame:
    """Write ``docs`` below ``path`` and return what the files say of each document."""
    write(docs, path, tokenizer, end_id)
    return read(docs.sparkSession, path)


