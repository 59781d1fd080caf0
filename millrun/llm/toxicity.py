"""Toxicity by a weighted lexicon, learned from labels and matched by Aho-Corasick.

Folding undoes disguise first: case, accents and look-alike letters of other
scripts become plain letters, and digits and signs inside a word become the
letters they stand for; marks around a word go. The folded text, words joined
by one blank, is matched once against an automaton of

* entries: whole words and word beginnings with a weight (their log odds), and
* exception phrases: an entry with the word before or after it that only
  clean texts have; an entry inside such a phrase does not count.

A text's evidence is the sum of its entries' weights, also per word (so a
long text needs more of it); a logistic curve turns both into a score.

Lexicon, exceptions and curve are fitted on a bounded sample of the labelled
rows (``SAMPLE`` ids that have a document, and as many of their texts, by hash)
with crc32(doc_id) mod 5 other than 0. Near
copies in the sample, told by two min-hashes, count once, else the chance
words of a text with many copies would look toxic. Labels, language, source
and id are no inputs of a score.

Defined cases: null and empty texts have no evidence, so the curve's foot is
their score; a labelled id with several labels counts as its largest; without
labels of both kinds the lexicon is empty and every score is the labels' mean
(0 without any); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, emit, rows_of, stored, text_of

SAMPLE = 16_000
ENTRIES = 4_000
EXCEPTIONS = 2_000
PREFIXES = range(4, 8)
SUPPORT = 3
_SURE = 1.64  # standard errors that an entry's log odds must stand above LEAST_WEIGHT
LEAST_WEIGHT = 1.0

#: Letters of other scripts that look like Latin ones, and what digits and signs stand for in a word.
LOOK_ALIKES = str.maketrans("абвеёзікмнопрстухѕјԁԛԝαβεηικνορτυχω", "abbeе3ikmhonpctyxsjdqwabeniknoptuxw".replace("е", "e"))
DIGITS = str.maketrans("0134578@$!|+", "oieastbasilt")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[^\w@$!|+]|_")


def fold_word(word: str) -> str:
    """A word without its disguise; nothing if it has no letter."""
    word = _EDGE.sub("", word)
    if not word:
        return ""
    if not word.isascii():
        word = "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))
    word = word.lower()
    if not word.isascii():
        word = word.translate(LOOK_ALIKES)
    if word.isalpha():
        return word
    if not any(c.isalpha() for c in word):
        return ""
    return _INNER.sub("", word.translate(DIGITS))


def folder():
    """Whole text to folded words."""
    memo = Memo(fold_word)

    def fold(text: str) -> list[str]:
        return [w for w in [memo[w] for w in text.split()] if w]

    return fold


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of a bounded number of labelled rows that may be learned from, near copies once."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    usable = usable.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    usable = usable.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    picked = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)  # at most SAMPLE pairs of numbers
    schema = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("one", pa.int64()), ("two", pa.int64()), ("words", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        fold = folder()
        for batch in batches:
            for doc, toxic, text in rows_of(batch, "doc_id", "toxic", "text"):
                words = fold(text)
                shingles = {" ".join(words[i : i + 3]).encode() for i in range(max(1, len(words) - 2))}
                mins = [min(xxhash.xxh64_intdigest(s, seed) for s in shingles) >> 1 for seed in (1, 2)]
                yield emit(schema, [[doc], [toxic], [mins[0]], [mins[1]], [words]])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).where(F.col("doc_id").isNotNull())
    folded = texts.join(F.broadcast(picked), "doc_id").mapInArrow(run, "doc_id long, toxic int, one long, two long, words array<string>")
    for least in ("one", "two"):
        kept = F.min(F.struct("doc_id", "toxic", "one", "two", "words")).alias("r")
        folded = folded.groupBy(least, "toxic").agg(kept).select("r.*")
    folded = stored(folded, "labelled")
    # an id may have any number of texts: of the rows, too, SAMPLE at most; the keys alone are sorted
    keys = folded.select("one", "toxic").orderBy(F.xxhash64("one"), "one", "toxic").limit(SAMPLE)
    return stored(folded.join(F.broadcast(keys), ["one", "toxic"], "left_semi").select("toxic", "words"), "sample")


def _counted(sample: DataFrame, features) -> DataFrame:
    """(feature, toxic, clean): in how many sample texts of each kind a feature stands."""
    schema = pa.schema([("feature", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())  # of the sample, so bounded
        for batch in batches:
            for toxic, words in rows_of(batch, "toxic", "words"):
                seen[bool(toxic)].update(features(words))
        names = list(seen[0].keys() | seen[1].keys())
        for at in range(0, len(names), 100_000):
            part = names[at : at + 100_000]
            yield emit(schema, [part, [seen[1][f] for f in part], [seen[0][f] for f in part]])

    return sample.mapInArrow(run, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _entries_of(words: list[str]) -> set[str]:
    """Whole words with a blank on both sides, beginnings with one before."""
    found = {f" {w} " for w in words}
    for n in PREFIXES:
        found.update(" " + w[:n] for w in words if len(w) > n)
    return found


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    n = {r.toxic: r.n for r in sample.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return {}
    a, c = F.col("toxic") + 0.5, F.col("clean") + 0.5
    b, d = n[1] - F.col("toxic") + 0.5, n[0] - F.col("clean") + 0.5
    weight = F.log(a / b) - F.log(c / d)
    error = F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    found = _counted(sample, _entries_of).where(F.col("toxic") >= SUPPORT).withColumn("weight", weight).withColumn("sure", weight - _SURE * error)
    best = found.where(F.col("sure") > LEAST_WEIGHT).orderBy(F.desc("sure"), "feature").limit(ENTRIES).collect()
    lexicon = {r.feature: r.weight for r in best}
    # a beginning stands for the longer entries that share it unless they say more
    return {f: w for f, w in lexicon.items() if not any(lexicon.get(f[:k].rstrip(), -1e9) >= w for k in range(1 + PREFIXES[0], len(f)) if f[:k].rstrip() != f)}


class Matcher:
    """One automaton of entries and exception phrases."""

    def __init__(self, lexicon: dict[str, float], exceptions: list[str] = ()) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for entry, weight in lexicon.items():
            self.automaton.add_word(entry, (entry, weight))
        for phrase in exceptions:
            self.automaton.add_word(phrase, (phrase, None))
        self.any = bool(lexicon)
        if self.any:
            self.automaton.make_automaton()

    def hits(self, words: list[str]) -> tuple[str, list[tuple[int, str, float]]]:
        """The folded text, and (start, entry, weight) of the entries that count, the best one at each start."""
        if not self.any or not words:
            return "", []
        text = f" {' '.join(words)} "
        best: dict[int, tuple[str, float]] = {}
        excused: list[tuple[int, int]] = []
        for end, (entry, weight) in self.automaton.iter(text):
            start = end - len(entry) + 1
            if weight is None:
                excused.append((start, end))
            elif start not in best or weight > best[start][1]:
                best[start] = entry, weight
        found = [(s, *best[s]) for s in sorted(best)]
        if excused:
            found = [h for h in found if not any(a <= h[0] and h[0] + len(h[1].rstrip()) <= b for a, b in excused)]
        return text, found


def learn_exceptions(sample: DataFrame, lexicon: dict[str, float]) -> list[str]:
    """Entries with a neighbour that only clean texts have."""

    def phrases(words: list[str]) -> set[str]:
        text, found = matcher().hits(words)
        out = set()
        for start, entry, _ in found:
            stop = text.index(" ", start + 1)
            after, before = text.find(" ", stop + 1), text.rfind(" ", 0, start)
            if after > 0:
                out.add(text[start : after + 1])
            if before >= 0:
                out.add(text[before : stop + 1])
        return out

    made: list[Matcher] = []

    def matcher() -> Matcher:  # once per task; an automaton isn't sent along
        if not made:
            made.append(Matcher(lexicon))
        return made[0]

    rows = _counted(sample, phrases).where((F.col("toxic") == 0) & (F.col("clean") >= SUPPORT)).orderBy(F.desc("clean"), "feature").limit(EXCEPTIONS).collect()
    return [r.feature for r in rows]


def evidence(matcher: Matcher, words: list[str]) -> tuple[float, float, float]:
    _, found = matcher.hits(words)
    total = sum(w for _, _, w in found)
    return np.log1p(total), total / (len(words) + 20), float(np.log1p(len({e for _, e, _ in found})))


def fit_curve(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Logistic regression with a small ridge, by Newton's steps."""
    if not len(y) or y.min() == y.max():
        mean = float(y.mean()) if len(y) else 0.0
        return [float(np.log((mean + 1e-6) / (1 - mean + 1e-6))), 0.0, 0.0, 0.0]
    design = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(design.shape[1])
    ridge = np.diag([1e-6] + [1e-2] * x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        step = np.linalg.solve(design.T @ (design * (p * (1 - p) + 1e-9)[:, None]) + ridge, design.T @ (y - p) - ridge @ beta)
        size = np.abs(step).max()
        beta += step / max(1.0, size / 4)
        if size < 1e-8:
            break
    return beta.tolist()


def _with_evidence(df: DataFrame, columns: str, make, lexicon, exceptions, schema: pa.Schema, ddl: str) -> DataFrame:
    names = columns.split()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, fold = Matcher(lexicon, exceptions), folder()
        for batch in batches:
            out: list[list] = [[] for _ in schema]
            for row in rows_of(batch, *names):
                for column, v in zip(out, make(matcher, fold, row), strict=True):
                    column.append(v)
            yield emit(schema, out)

    return df.select(*names).mapInArrow(run, ddl)


def train(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], list[str], list[float]]:
    """Lexicon, exceptions and curve (bounded by ENTRIES, EXCEPTIONS and four numbers)."""
    sample = _sample(docs, labels)
    lexicon = learn_lexicon(sample)
    exceptions = learn_exceptions(sample, lexicon) if lexicon else []
    schema = pa.schema([("toxic", pa.int32()), ("a", pa.float64()), ("b", pa.float64()), ("c", pa.float64())])
    rows = _with_evidence(sample, "toxic words", lambda m, _, r: (r[0], *evidence(m, r[1])), lexicon, exceptions, schema, "toxic int, a double, b double, c double").collect()  # at most SAMPLE
    x = np.array(sorted(map(tuple, rows)), float).reshape(-1, 4)
    return lexicon, exceptions, fit_curve(x[:, 1:], (x[:, 0] > 0).astype(float))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text."""
    lexicon, exceptions, beta = train(docs, labels)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def one(matcher: Matcher, fold, row: tuple) -> tuple[int, float]:
        z = beta[0] + sum(b * v for b, v in zip(beta[1:], evidence(matcher, fold(row[1])), strict=True))
        return row[0], float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    scored = _with_evidence(texts, "doc_id text", one, lexicon, exceptions, schema, "doc_id long, score double")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
