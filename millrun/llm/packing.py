"""Best-fit packing with bounds that certify each partition's bin count.

Documents are tokenized where they lie; only piece lengths and checksums go
on. A document longer than a sequence is cut from its end into pieces of
full size (its first piece may be shorter); a full piece is a sequence of
its own. The others are dealt over partitions by a hash and packed in each by
best-fit decreasing. Dual-feasible functions of the lengths give a lower
bound for each partition: where bins equal the bound, the packing is proven
best and stays. Partitions with a gap give the documents of their unfilled
bins to a common pool, which is dealt anew (so that documents meet others) and
packed again, until no gap is left, one partition was left or a round wins
nothing; that round is dropped. Each round moves (id, piece, length) rows only,
and is dealt so wide that a partition holds ``PER_PARTITION`` pieces on
average, however many stay open. A round's result is written to the shared
folder.

Defined cases: null text is an empty one (a piece of the end id alone);
repeated rows and repeated ids are packed each; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import emit, stored, text_of, uncollected
from .tokens import file_encoder, packed

PER_PARTITION = 50_000
ROUNDS = 12

_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
_PIECES_SQL = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int) -> DataFrame:
    """The pieces of each whole document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = file_encoder(tokenizer), packed([end_id])
        for batch in batches:
            out: list[list] = [[] for _ in _PIECES]
            doc_ids, texts = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text"))
            ids, ends = encode.batch(texts)
            for doc, a, b in zip(doc_ids.to_pylist(), ends.tolist(), ends[1:].tolist()):
                data = ids[a:b].tobytes() + end
                n = len(data) // 4
                first = n - (n - 1) // size * size  # of a longer one, the rest goes first
                at, k = 0, 0
                while at < n:
                    length = first if k == 0 else size
                    for column, v in zip(out, (doc, k, at, length, zlib.crc32(data[4 * at : 4 * (at + length)])), strict=True):
                        column.append(v)
                    at, k = at + length, k + 1
            yield emit(_PIECES, out)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(uncollected(run), _PIECES_SQL)


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the bins' fill."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    rooms = 0  # bit r is set if some bin has room r left
    fill: list[int] = []
    for i, need in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = rooms >> need
        if fitting:
            room = need + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            b, room = len(fill), size
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += need
        left = room - need
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins, offsets, np.asarray(fill, np.int64)


def lower_bound(lengths: np.ndarray, size: int) -> int:
    """The best of two families of dual-feasible functions, over all their parameters.

    f_t: lengths above size - t count as a whole bin, those below t as
    nothing, others as they are (t up to half a bin). u_k: a length x counts
    floor((k + 1) x / size) / k bins, or x / size where (k + 1) x / size is whole.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=size + 1).astype(np.int64)
    x = np.arange(size + 1)
    volume, many = np.cumsum(counts * x), np.cumsum(counts)
    best = -(-int(volume[-1]) // size)
    t = np.arange(1, size // 2 + 1)
    whole = many[-1] - many[size - t]
    best = max(best, int(np.max(whole - (-(volume[size - t] - volume[t - 1]) // size))))
    for k in range(1, 33):
        times = (k + 1) * x
        share = np.where(times % size == 0, x * k, times // size * size)  # in units of 1 / (k * size) of a bin
        best = max(best, -(-int((counts * share).sum()) // (k * size)))
    return best


_ITEM = pa.schema([("pool", pa.int64()), ("item", pa.int64()), ("length", pa.int64())])
_PLACED = pa.schema([("item", pa.int64()), ("length", pa.int64()), ("pool", pa.int64()), ("bin", pa.int64()), ("offset", pa.int64()), ("open", pa.bool_())])
_PLACED_SQL = "item long, length long, pool long, bin long, offset long, open boolean"


def _pack(items: DataFrame, size: int, pools: int, salt: int) -> DataFrame:
    """One round: deal (item, length) over ``pools`` and pack each pool. A bin
    is open (its documents may be exchanged) if it has room and its pool's
    count isn't certified by the bound; of a certified pool only the emptiest
    bin is, as those of several pools may fill each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(list(batches), schema=_ITEM)
        if not whole.num_rows:
            return
        pool, item, length = (whole.column(n).to_numpy() for n in ("pool", "item", "length"))
        order = np.lexsort((item, pool))  # a repeated task packs alike
        cuts = np.flatnonzero(np.diff(pool[order])) + 1
        for at in np.split(order, cuts):
            bins, offsets, fill = best_fit_decreasing(length[at], size)
            gap = len(fill) - lower_bound(length[at], size)
            opened = (fill[bins] < size) & ((gap > 0) | (bins == fill.argmin()))
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((item[at], length[at], pool[at], bins, offsets, opened), _PLACED, strict=True)], schema=_PLACED)

    dealt = items.select(F.pmod(F.xxhash64("item", F.lit(salt)), F.lit(pools)).alias("pool"), "item", "length")
    return dealt.repartition(max(1, pools), "pool").mapInArrow(run, _PLACED_SQL)


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    cut = stored(pieces(docs, tokenizer, size, end_id).withColumn("item", F.monotonically_increasing_id()), "pieces")
    rest = cut.where(F.col("length") < size).select("item", "length")
    count = rest.count()
    places = cut.where(F.col("length") >= size).select("item", (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    pools, salt = max(1, -(-count // PER_PARTITION)), 0
    opened, opened_bins = None, 0
    while count:
        placed = stored(_pack(rest, size, pools, salt), f"round-{salt}")
        starts = F.col("offset") == 0  # one piece of each bin
        stats = placed.agg(
            F.count_if(starts).alias("bins"), F.count_if("open").alias("n"), F.count_if(starts & F.col("open")).alias("open_bins")
        ).first()
        # round, pool and bin make the number: up to 2**24 pools of up to 2**34 bins
        numbered = placed.select("item", "length", "open", (F.lit(salt << 58) + F.col("pool") * (1 << 34) + F.col("bin")).alias("sequence_id"), "offset")
        if opened is not None and stats.bins >= opened_bins:  # this exchange won nothing
            places = places.unionByName(opened.select("item", "sequence_id", "offset"))
            break
        if not stats.n or pools == 1 or salt + 1 == ROUNDS:
            places = places.unionByName(numbered.select("item", "sequence_id", "offset"))
            break
        places = places.unionByName(numbered.where("not open").select("item", "sequence_id", "offset"))
        opened, opened_bins = numbered.where("open"), stats.open_bins
        rest, salt = opened.select("item", "length"), salt + 1
        pools = -(-stats.n // PER_PARTITION)
    return cut.join(places, "item").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
