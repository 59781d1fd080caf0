"""SimHash near-duplicates by a self-join of binary tries.

1. Fingerprints: words lower-cased in A-Z, shingles of consecutive words,
   XXH64 of each, one bit per position by majority. One map over the texts.
2. Copies of a text share a fingerprint, so the join works on distinct
   fingerprints only (a partial aggregate; a group of copies is one row).
3. Candidate groups. Two fingerprints within ``distance`` bits agree in full
   on one of ``distance + 1`` blocks of bits, so each fingerprint goes to one
   group per block, keyed by (mask of exact bits, their value). A group of more
   than ``group_rows`` fingerprints is split the same way over its remaining
   bits, again without loss, until groups are small; after five levels a
   group has at most 2**15 members whatever the data.
4. In each group the binary trie over the remaining bits is joined with
   itself: pairs of nodes go down together, differing bits add up, and a pair
   goes no further once the error budget is spent. The budget grows from 1 to
   ``distance``, and a pair of nodes whose leaves are all in one component by
   now is pruned as well, so a dense group of near copies costs about its
   size and not its square. What leaves a task is a spanning star per
   component, at most one link per fingerprint.
5. Components of the links by alternating large and small stars on Spark,
   then joined back to the documents.

Defined cases: null or empty texts have fingerprint zero and are linked like
any other; texts of fewer words than a shingle have one shingle, all their
words; repeated rows and ids keep one row each; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import emit, rows_of, stored, text_of

BITS = 64
GROUP_ROWS = 1024
_LEVELS = 5
_CHUNK = 1 << 19  # node pairs held at once
_BUFFER = 1 << 18  # fingerprints held at once, at least one whole group

_BIT_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_COLUMN = (256 * np.arange(8)).astype(np.int16)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the 64-bit hashes."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        seen = np.bincount((part + _COLUMN).ravel(), minlength=2048).reshape(8, 256)
        counts += (seen @ _BIT_OF_BYTE).ravel()
    return sum(1 << int(i) for i in np.flatnonzero(2 * counts > len(hashes)))


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and \\x20 \\x09-\\x0D only
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return majority(np.array([digest(joined, seed)], np.uint64))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - shingle + 1
    spans = zip(starts[:n].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    return majority(np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, n))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp, the long columns of ``carry``): the fingerprint's 64 bits as a signed long."""
    names = ["doc_id", "fp", *carry]
    schema = pa.schema([(n, pa.int64()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for doc, text, *rest in rows_of(batch, "doc_id", "text", *carry):
                fp = fingerprint(text, shingle, seed)
                for column, v in zip(out, (doc, fp - (1 << 64) if fp >> 63 else fp, *rest), strict=True):
                    column.append(v)
            yield emit(schema, out)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"), *carry).mapInArrow(run, ", ".join(f"{n} long" for n in names))


class _Components:
    """Labels of n leaves (each the index of a member), merged by pairs."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)
        self._changes()

    def _changes(self) -> None:
        self.steps = np.concatenate(([0], np.cumsum(self.label[1:] != self.label[:-1])))

    def merge(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.label[i], self.label[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            parent = np.arange(len(self.label))
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            while True:
                above = parent[parent]
                if np.array_equal(above, parent):
                    break
                parent = above
            self.label = parent[self.label]
        self._changes()

    def joined(self, alo, ahi, blo, bhi) -> np.ndarray:
        """Whether all leaves of both ranges are in one component."""
        return (self.steps[ahi - 1] == self.steps[alo]) & (self.steps[bhi - 1] == self.steps[blo]) & (self.label[alo] == self.label[blo])


def trie_components(groups: np.ndarray, fps: np.ndarray, distance: int) -> np.ndarray:
    """For each row (sorted by group and fingerprint, without repeats) the
    index of its component's first row, linking rows of one group that differ
    in at most ``distance`` bits."""
    n = len(fps)
    parts = _Components(n)
    first = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1]))) if n else np.empty(0, np.int64)
    last = np.append(first[1:], n)
    many = last - first > 1
    ones = [None] * BITS  # for each bit, how many rows before a place have it set
    for budget in range(1, distance + 1):
        lo, hi = first[many], last[many]
        stack = [(BITS - 1, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
        while stack:
            bit, alo, ahi, blo, bhi, errors = stack.pop()
            same = alo == blo
            keep = (errors <= budget) & (ahi > alo) & (bhi > blo) & ~(same & (ahi - alo == 1))
            keep[keep] &= ~parts.joined(alo[keep], ahi[keep], blo[keep], bhi[keep])
            alo, ahi, blo, bhi, errors, same = (x[keep] for x in (alo, ahi, blo, bhi, errors, same))
            leaf = (ahi - alo == 1) & (bhi - blo == 1)  # nothing branches below: the rest of the bits at once
            if leaf.any():
                i, j = alo[leaf], blo[leaf]
                near = np.bitwise_count(fps[i] ^ fps[j]) <= budget
                parts.merge(i[near], j[near])
                alo, ahi, blo, bhi, errors, same = (x[~leaf] for x in (alo, ahi, blo, bhi, errors, same))
            if not len(alo) or bit < 0:
                continue
            if len(alo) > _CHUNK:
                half = len(alo) // 2
                for part in (slice(half, None), slice(None, half)):
                    stack.append((bit, *(x[part] for x in (alo, ahi, blo, bhi, errors))))
                continue
            if ones[bit] is None:
                ones[bit] = np.concatenate(([0], np.cumsum((fps >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)))
            before = ones[bit]
            amid, bmid = ahi - (before[ahi] - before[alo]), bhi - (before[bhi] - before[blo])
            pair = ~same
            more = errors + np.int8(1)
            children = [(alo, amid, blo, bmid, errors), (amid, ahi, bmid, bhi, errors), (alo, amid, bmid, bhi, more)]
            children.append(tuple(x[pair] for x in (amid, ahi, blo, bmid, more)))
            stack.append((bit - 1, *(np.concatenate(x) for x in zip(*children, strict=True))))
    return parts.label


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _trie_join(distance: int):
    def stars(mask: np.ndarray, value: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((fp.view(np.uint64), value, mask))
        mask, value, fp = mask[order], value[order], fp[order]
        new = np.concatenate(([True], (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])))
        root = trie_components(np.cumsum(new), fp.view(np.uint64), distance)
        linked = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[root[linked]])], schema=_LINK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0
        for batch in batches:  # sorted by group
            held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)))
            rows += batch.num_rows
            if rows >= _BUFFER:
                mask, value, fp = (np.concatenate(x) for x in zip(*held, strict=True))
                inside = np.flatnonzero((mask != mask[-1]) | (value != value[-1]))
                cut = inside[-1] + 1 if len(inside) else 0  # the last group may go on
                if cut:
                    yield stars(mask[:cut], value[:cut], fp[:cut])
                held, rows = [(mask[cut:], value[cut:], fp[cut:])], len(mask) - cut
        if rows:
            yield stars(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _finer(mask: int, parts: int) -> list[int]:
    """``mask`` with each of ``parts`` blocks of its unset bits added."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    return [mask | sum(1 << b for b in free[len(free) * k // parts : len(free) * (k + 1) // parts]) for k in range(parts)]


def _groups(fps: DataFrame, distance: int, group_rows: int) -> DataFrame:
    """(mask, value, fp) so that every pair within ``distance`` shares a group."""
    masks = [0]
    rows = fps.select(F.lit(0).cast("long").alias("mask"), F.lit(0).cast("long").alias("value"), "fp")
    settled: DataFrame | None = None
    for level in range(_LEVELS):
        children = {m: _finer(m, distance + 1) for m in masks}
        masks = sorted({c for cs in children.values() for c in cs})
        to = F.create_map(*[x for m, cs in children.items() for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(c)) for c in cs]))])
        rows = rows.select(F.explode(to[F.col("mask")]).alias("mask"), "fp").select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp")
        if level + 1 == _LEVELS:
            break
        large = rows.groupBy("mask", "value").agg(F.count("*").alias("n")).where(F.col("n") > group_rows).select("mask", "value")
        large = stored(large, f"large-groups-{level}")
        if large.isEmpty():
            break
        small = rows.join(large, ["mask", "value"], "left_anti")
        settled = small if settled is None else settled.unionByName(small)
        rows = stored(rows.join(large, ["mask", "value"], "left_semi").select("mask", "value", "fp"), f"split-{level}")
    return rows if settled is None else settled.unionByName(rows)


def links(fps: DataFrame, distance: int = 3, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints of column ``fp``
    that a chain of pairs within ``distance`` bits connects."""
    grouped = _groups(fps.select("fp").distinct(), distance, group_rows)
    dealt = grouped.repartition("mask", "value").sortWithinPartitions("mask", "value")
    return dealt.mapInArrow(_trie_join(distance), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); root is the smallest
    node of its component. Alternating large and small stars: each round is
    two partial aggregates and joins, its result is written."""
    edges = stored(edges.select("a", "b").where("a <> b").distinct(), "links")
    seen = None
    k = 0
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        lowest = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(lowest, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = stored(small.where("a <> b").distinct(), f"stars-{k}")
        now = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h"), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")).alias("s")).first()
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen, k = now, k + 1


def _rooted(classes: DataFrame, distance: int) -> DataFrame:
    """``classes`` (one row a fingerprint) with the ``root`` of each one's component."""
    rooted = components(links(classes, distance))
    return classes.join(rooted, classes["fp"] == rooted["node"], "left").select(*classes.columns, F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document."""
    marked = stored(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    classes = marked.groupBy("fp").agg(F.min("doc_id").alias("least_doc"))
    named = _rooted(classes, distance)
    least = named.groupBy("root").agg(F.min("least_doc").alias("component_id"))
    of_fp = named.join(least, "root").select("fp", "component_id")
    return marked.join(of_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3, seed: int = 42) -> DataFrame:
    """One document of each component, with all its columns: the smallest id's
    (null ids last; of one id's texts the one with the smallest hash, and one
    row of those that are the same)."""
    doc, tie = F.col(id_col).cast("long"), F.xxhash64(text_of(text_col))
    given = docs.select(F.col(id_col), F.col(text_col), tie.alias("__tie"))
    marked = stored(fingerprints(given, id_col, text_col, shingle, seed, carry=("__tie",)), "fingerprints")
    classes = marked.groupBy("fp").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "__tie")).alias("least"))
    kept = stored(_rooted(classes, distance).groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.doc_id").alias("__doc"), F.col("least.__tie").alias("__kept")), "kept")
    rows = docs.select(F.struct(*docs.columns).alias("__row"), doc.alias("__id"), tie.alias("__tie"))
    found = rows.join(kept, F.col("__id").eqNullSafe(F.col("__doc")) & (F.col("__tie") == F.col("__kept")))
    first = F.row_number().over(Window.partitionBy("__id", "__tie").orderBy("__tie"))
    return found.withColumn("__n", first).where("__n = 1").select("__row.*")
