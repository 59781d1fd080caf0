"""Language identification by fusing evidence as Bayes has it.

Classes are the languages of the training rows and ``und`` (no language: the
uniform distribution over n-gram cells). Evidence for a row:

* its text: log likelihood of its byte trigrams under each class, on the scale
  of at most ``TEMPER`` trigrams (they are not independent, and a long text
  must not drown all else);
* its host: the class distribution of the host's other rows, smoothed by the
  distribution of its domain, that by its address suffix, and that by all rows
  (``STRENGTH`` pseudo rows at each step). The suffix is the parent of its
  hosts, so it counts once. A row's own text is taken out of all four;
* its declared language: how often rows of each class declare it.

The distributions behind host, domain, suffix and declaration are sums of the
text posteriors of all rows by grouped aggregation: partial sums, so a host
with a third of all rows is one row a task after the map side. A posterior is
one array, whatever the number of classes.

A class is a primary language subtag (two or three letters; what follows ``-``
or ``_`` is region or script, so ``en-US`` is ``en``) that at least
``LEAST_ROWS`` rows of the whole table declare (texts with letters), however
rare. Other strings are declarations like any, but no classes. A class's text
model is counts of trigram cells over its own sample by hash: all of its
distinct rows, or about ``SAMPLE`` where it has more. The model has at most
``MODEL`` numbers: ``CELLS`` cells a class, halved while classes are too many.

Rejected is a row whose class is ``und`` or whose posterior is below
``ACCEPT``. Defined cases: a text without letters (null or empty as well) is
``und`` with posterior 1; a null host or declaration is no evidence; repeated
rows count as often as they stand; without training rows all is ``und``; an
empty table gives no rows; other columns pass where ``carry`` names them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from .common import emit, rows_of, stored, text_of

SAMPLE = 3_000  # distinct rows a language
LEAST_ROWS = 5  # of a language in the whole table, to be a class
CELLS = 1 << 15
MODEL = 1 << 24  # cells x classes at most
SUMS = 1 << 21  # numbers that a task holds of its partial sums
TEMPER = 40
STRENGTH = 5.0
ACCEPT = 0.5
UND = "und"

#: What makes a cell: an ASCII letter or any other character.
_LETTER = r"[A-Za-z]|[^\x00-\x7F]"
#: The primary subtag of a well-formed language tag.
_SUBTAG = r"^\s*([a-z]{2,3})(?:[-_].*)?\s*$"
#: ASCII that is no letter becomes blank.
_LETTERS_ONLY = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def cells(text: str) -> np.ndarray:
    """The cell of each byte trigram that has a letter in its middle."""
    data = np.frombuffer(b" " + text.lower().encode().translate(_LETTERS_ONLY) + b" ", np.uint8).astype(np.uint32)
    code = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
    return (code[data[1:-1] != 32] * np.uint32(2654435761)) >> np.uint32(32 - 15)


def _halvings(classes: int) -> int:
    """How often the cells are halved for a model of so many classes."""
    times = 0
    while (CELLS >> times) * classes > MODEL and CELLS >> times > 1:
        times += 1
    return times


def log_likelihood(found: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """The mean log probability of the cells under each class, a bounded slice at a time."""
    at = found >> np.uint32((CELLS // len(logs)).bit_length() - 1)
    step = max(1, (1 << 18) // logs.shape[1])
    return sum(logs[at[i : i + step]].sum(axis=0) for i in range(0, len(at), step)) / len(at)


def train(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """The classes, and log probabilities (cells x classes), ``und`` last."""
    known = rows.select(F.regexp_extract(F.lower(lang_col), _SUBTAG, 1).alias("lang"), text_of(text_col).alias("text"), F.xxhash64(id_col, text_of(text_col)).alias("row"))
    known = known.where((F.col("lang") != "") & (F.col("lang") != UND) & F.col("text").rlike(_LETTER))
    # rows tell the classes; distinct rows (within a few per cent) the share of the hashes that a class samples
    classes = known.groupBy("lang").agg(F.count("*").alias("rows"), F.approx_count_distinct("row").alias("distinct")).where(F.col("rows") >= LEAST_ROWS)
    shares = classes.select("lang", F.least(F.lit(1.0), 1.2 * SAMPLE / F.col("distinct")).alias("share"))
    at = F.pmod(F.xxhash64("row"), F.lit(1 << 30)) / (1 << 30)
    # a row a class: 26^2 + 26^3 at most
    sample = known.join(F.broadcast(shares), "lang").where(at < F.col("share")).dropDuplicates(["lang", "row"])
    sample = stored(sample.select("lang", "text"), "language-sample")
    langs = sorted(r.lang for r in sample.select("lang").distinct().collect())
    halvings = _halvings(len(langs) + 1)
    width = CELLS >> halvings
    schema = pa.schema([("lang", pa.string()), ("cell", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # sums of a batch: what is held does not grow with the classes
            seen: dict[str, list[np.ndarray]] = {}
            for lang, text in rows_of(batch, "lang", "text"):
                seen.setdefault(lang, []).append(cells(text) >> np.uint32(halvings))
            for lang, found in seen.items():
                at, counts = np.unique(np.concatenate(found), return_counts=True)
                yield emit(schema, [[lang] * len(at), at.tolist(), counts.tolist()])

    counted = sample.mapInArrow(run, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    counts = np.full((width, len(langs)), 0.01)
    place = {lang: k for k, lang in enumerate(langs)}
    for batch in counted.toArrow().to_batches():  # at most MODEL rows
        lang = np.array([place[x] for x in batch.column(0).to_pylist()], np.int64)
        counts[batch.column(1).to_numpy(), lang] += batch.column(2).to_numpy()
    logs = np.log(counts / counts.sum(axis=0)) if langs else counts
    return [*langs, UND], np.column_stack([logs, np.full(width, -np.log(width))])


def _posterior(text: str, logs: np.ndarray) -> tuple[int, np.ndarray]:
    """The text's trigrams and its posterior over the classes; all alike without any."""
    found, count = cells(text), logs.shape[1]
    if not len(found):
        return 0, np.full(count, 1.0 / count)
    z = log_likelihood(found, logs) * min(len(found), TEMPER)
    z = np.exp(z - z.max())
    return len(found), z / z.sum()


def _scored(given: DataFrame, logs: np.ndarray, carry: list[str]) -> DataFrame:
    """The carried columns, host, declared, n (trigrams) and q, the text's posterior over the classes."""
    out = StructType([given.schema[c] for c in carry]).add("__host", "string").add("__declared", "string").add("__n", "long").add("__q", ArrayType(DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # few rows at a time where the classes are many
            step = max(1, (1 << 18) // logs.shape[1])
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                found = [_posterior(text, logs) for (text,) in rows_of(part, "__text")]
                kept = [f.name for f in part.schema if f.name != "__text"]
                q = pa.ListArray.from_arrays(np.arange(0, (len(found) + 1) * logs.shape[1], logs.shape[1], dtype=np.int32), np.concatenate([q for _, q in found]))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + [pa.array([n for n, _ in found], pa.int64()), q], names=[*kept, "__n", "__q"])

    return given.select(*carry, "__host", "__declared", "__text").mapInArrow(run, out)


_PAIR = pa.schema([("__host", pa.string()), ("__declared", pa.string()), ("s", pa.list_(pa.float64()))])


def _summed(given: DataFrame, logs: np.ndarray) -> DataFrame:
    """(host, declared, s): a task's sums of the posteriors of texts with
    letters, and last their number. What a task holds is bounded."""
    most = max(1, SUMS // (logs.shape[1] + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in held], pa.string()), pa.array([k[1] for k in held], pa.string()), pa.array(list(held.values()), pa.list_(pa.float64()))], schema=_PAIR)

        for batch in batches:
            for host, declared, text in rows_of(batch, "__host", "__declared", "__text"):
                n, q = _posterior(text, logs)
                if n:
                    q = np.append(q, 1.0)
                    held[host, declared] = held[host, declared] + q if (host, declared) in held else q
                    if len(held) >= most:
                        yield out()
                        held = {}
        if held:
            yield out()

    return given.select("__host", "__declared", "__text").mapInArrow(run, "__host string, __declared string, s array<double>")


def _added(df: DataFrame, keys: list[str], name: str, source: str = "s") -> DataFrame:
    """The arrays ``source`` added up by ``keys``: each element is a partial aggregate."""
    element = df.select(*keys, F.posexplode(source).alias("k", "x")).groupBy(*keys, "k").agg(F.sum("x").alias("x"))
    whole = element.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("k", "x"))).alias(name))  # an element a class
    return whole.withColumn(name, F.transform(name, lambda e: e["x"]))


def identify(rows: DataFrame, model: tuple[list[str], np.ndarray], text: Column, host: Column, declared: Column, carry: list[str], names: tuple[str, str, str] = ("language", "posterior", "accepted")) -> DataFrame:
    """The carried columns of every row with its language, posterior and whether it is accepted, under ``names``."""
    classes, logs = model
    count = len(classes)
    given = rows.withColumns({"__text": F.coalesce(text.cast("string"), F.lit("")), "__host": F.lower(host.cast("string")), "__declared": F.lower(declared.cast("string"))})
    scored = _scored(given, logs, carry)  # a text without letters tells nothing of its host

    # one row a (host, declaration); all four distributions come from it
    pairs = stored(_added(_summed(given, logs), ["__host", "__declared"], "s"), "evidence")
    total = [0.0] * (count + 1)
    for r in pairs.select(F.posexplode("s").alias("k", "x")).groupBy("k").agg(F.sum("x").alias("x")).collect():  # a row a class
        total[r.k] = r.x
    hosts = _added(pairs.where("__host is not null"), ["__host"], "__h")
    hosts = hosts.withColumns({"__domain": F.regexp_extract("__host", r"([^.]+\.)?[^.]+$", 0), "__suffix": F.regexp_extract("__host", r"[^.]+$", 0)})
    hosts = stored(hosts, "hosts")
    domains, suffixes = (_added(hosts, [key], name, "__h") for key, name in (("__domain", "__d"), ("__suffix", "__s")))
    hosts = stored(hosts.join(domains, "__domain").join(suffixes, "__suffix").drop("__domain", "__suffix"), "priors")
    said = stored(_added(pairs.where("__declared is not null"), ["__declared"], "__e"), "declared")
    kinds = max(1, said.count())

    joined = scored.join(hosts, "__host", "left").join(said, "__declared", "left")
    real = F.col("__n") > 0
    every = F.sequence(F.lit(0), F.lit(count - 1))
    totals = F.split(F.lit(",".join(map(repr, total))), ",").cast("array<double>")

    def own(k: Column) -> Column:
        return F.when(real, F.get("__q", k)).otherwise(0.0)

    def level(name: str, parent: Column) -> Column:
        """An array over the classes, as its parent."""
        rest = F.transform(every, lambda k: F.greatest(F.get(name, k) - own(k), F.lit(0.0)))
        many = F.get(name, F.lit(count)) - real.cast("int")
        return F.when(F.col(name).isNull(), parent).otherwise(F.zip_with(rest, parent, lambda r, p: (r + STRENGTH * p) / (many + STRENGTH)))

    def others(k: Column) -> Column:
        return F.greatest(F.get(totals, k) - own(k), F.lit(0.0))

    def everywhere(k: Column) -> Column:
        return (others(k) + 1) / (F.lit(total[count]) - real.cast("int") + count)

    def saying(k: Column) -> Column:
        told = (F.greatest(F.get("__e", k) - own(k), F.lit(0.0)) + STRENGTH / kinds) / (others(k) + STRENGTH)
        return F.when(F.col("__e").isNull(), 1.0).otherwise(told)

    # each step of the hierarchy is an array of its own, from the root down
    prior = joined.withColumn("__p", F.transform(every, everywhere))
    for name in ("__s", "__d", "__h"):
        prior = prior.withColumn("__p", level(name, F.col("__p")))
    said_so = F.transform(every, lambda k: F.get("__q", k) * saying(k))
    weighed = prior.withColumn("__w", F.zip_with(said_so, F.col("__p"), lambda told, p: told * p))
    names_of = F.split(F.lit(",".join(classes)), ",")
    best = F.array_max(F.transform("__w", lambda w, k: F.struct(w.alias("w"), F.get(names_of, k).alias("c"))))
    whole = F.aggregate("__w", F.lit(0.0), lambda a, w: a + w)
    named = weighed.withColumns({"__best": best, "__whole": whole})
    language = F.when(real, F.col("__best.c")).otherwise(UND)
    posterior = F.when(real, F.round(F.try_divide(F.col("__best.w"), F.col("__whole")), 6)).otherwise(1.0)
    return named.select(*carry, language.alias(names[0]), posterior.alias(names[1]), ((language != UND) & (posterior >= ACCEPT)).alias(names[2]))


def of_documents(docs: DataFrame, carry: list[str], names: tuple[str, str, str] = ("language", "posterior", "accepted")) -> DataFrame:
    """Documents: their source stands for the host, their ``lang`` is the declaration."""
    return identify(docs, train(docs), F.col("text"), F.col("source"), F.col("lang"), carry, names)


def of_pages(pages: DataFrame, training: DataFrame, carry: list[str]) -> DataFrame:
    """Raw pages: the host of the address, its suffix, and the language that the markup declares."""
    host = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)
    lang = F.regexp_extract("html", r"""(?i)<html[^>]*\blang\s*=\s*["']?([A-Za-z]+)""", 1)
    body = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>|&[#\w]+;", " ")
    some = lambda c: F.when(c != "", c)
    return identify(pages, train(training), body, some(host), some(lang), carry)


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language is accepted, all columns as they were."""
    return of_documents(docs, docs.columns, ("__language", "__posterior", "__accepted")).where("__accepted").select(*docs.columns)
