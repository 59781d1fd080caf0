"""Benchmark decontamination by a positional inverted index, in DataFrame functions only.

A window is ``window`` consecutive words of a test item, or the whole item if
it has fewer. Words are lower-cased in A-Z; a word is a run of characters other
than ASCII ones that are neither letter nor digit.

1. The texts' words are written once, one row per text, under a row number.
2. Terms of the windows are counted in the texts (partial aggregates). A
   window with a term that no text has cannot occur and ends here.
3. Of each window the rarest term is looked up, and the next one too if its
   list is at most ``LIST_RATIO`` times as long. Postings (term, text,
   position) are stored for these terms; a term has a slot for every
   ``SLOT_ROWS`` postings, so that a very common term is spread over tasks.
4. A posting of a window's term, less the term's offset, is a place where the
   window may begin. Places that all lists of the window give are compared in
   full with the words there: exact phrase matches.
5. Proximity: texts that have all lists of a window are searched around each
   posting of its rarest term for ``span`` consecutive words that hold every
   term of the window, in any order.

Defined cases: null texts have no words; rows of one id are texts of their own
and each gets a row; an item's null id is no item to list, but its windows
count as hits; equal windows of several items are one window; repeated items
are one; empty tables give no matches; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrun.operators.keyed import bounded_broadcast

from .common import stored

LIST_RATIO = 8
SLOT_ROWS = 50_000
TERMS_MAX_ROWS = 500_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normal_words(text: str) -> Column:
    """The words of a text joined by single spaces."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    # lower() folds other scripts too, so it serves texts of ASCII alone
    low = F.when(F.octet_length(whole) == F.length(whole), F.lower(whole)).otherwise(F.translate(whole, _UPPER, _LOWER))
    return F.trim(F.regexp_replace(low, _NO_WORD, " "))


def _n_words(words: str) -> Column:
    return F.when(F.col(words) == "", 0).otherwise(F.size(F.split(F.col(words), " "))).cast("long")


@dataclass
class Index:
    """``texts`` (row, doc_id, words, n_words), ``items`` (item_id, phrase), ``windows`` (win, phrase),
    ``lists`` (win, lists, place, off, term, slots) and ``postings`` (term, slot, row, pos)."""

    texts: DataFrame
    items: DataFrame
    windows: DataFrame
    lists: DataFrame
    postings: DataFrame


def windows_of(items: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, phrase): the different windows of each item."""
    words = F.split("words", " ")
    n = F.size(words)
    each = F.transform(F.sequence(F.lit(0), F.greatest(n - window, F.lit(0))), lambda at: F.concat_ws(" ", F.slice(words, at + 1, window)))
    split = items.select(F.col(id_col).cast("string").alias("item_id"), normal_words(text_col).alias("words")).where("words <> ''")
    return split.select("item_id", F.explode(each).alias("phrase")).distinct()


def _tokens(texts: DataFrame) -> DataFrame:
    return texts.where("words <> ''").select("row", F.posexplode(F.split("words", " ")).alias("pos", "term"))


def build_index(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> Index:
    words = docs.select(F.col(id_col).alias("doc_id"), normal_words(text_col).alias("words"))
    texts = stored(words.select(F.monotonically_increasing_id().alias("row"), "doc_id", "words", _n_words("words").alias("n_words")), "texts")
    of_items = stored(windows_of(items, window, item_col, item_text_col), "items")
    windows = stored(of_items.select("phrase").distinct().select(F.monotonically_increasing_id().alias("win"), "phrase"), "windows")
    parts = windows.select("win", F.size(F.split("phrase", " ")).alias("n"), F.posexplode(F.split("phrase", " ")).alias("off", "term"))
    wanted = bounded_broadcast(parts.select("term").distinct(), TERMS_MAX_ROWS, bound_by=parts.select("term"))
    counts = stored(_tokens(texts).select("term").join(wanted, "term", "left_semi").groupBy("term").agg(F.count("*").alias("many")), "counts")

    of_window = Window.partitionBy("win")
    ranked = parts.join(counts, "term").select(
        "win", "n", "off", "term", "many",
        F.count("*").over(of_window).alias("known"),
        F.min("many").over(of_window).alias("least"),
        F.row_number().over(of_window.orderBy("many", "off")).alias("place"),
    )
    looked_up = ranked.where((F.col("known") == F.col("n")) & (F.col("place") <= 2) & (F.col("many") <= F.col("least") * LIST_RATIO))
    lists = stored(
        looked_up.select("win", F.count("*").over(of_window).alias("lists"), "place", "off", "term", F.ceil(F.col("many") / SLOT_ROWS).cast("int").alias("slots")),
        "lists",
    )
    slots = lists.select("term", "slots").distinct()
    posted = _tokens(texts).join(bounded_broadcast(slots, TERMS_MAX_ROWS, bound_by=lists.select("term", "slots")), "term")
    slot = F.pmod(F.xxhash64("row", "pos"), F.col("slots")).cast("int")
    postings = posted.select("term", slot.alias("slot"), "row", "pos").repartition("term", "slot").sortWithinPartitions("term", "slot", "row", "pos")
    return Index(texts, of_items, windows, lists, stored(postings, "postings"))


def _looked_up(index: Index) -> DataFrame:
    """Each posting with each window that looks its term up."""
    asked = index.lists.select("win", "lists", "place", "off", "term", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"))
    return index.postings.join(asked, ["term", "slot"])


def phrase_matches(index: Index) -> DataFrame:
    """(row, matches): for each text with any, its exact matches as (start, n, win)."""
    begin = _looked_up(index).select("row", "win", "lists", (F.col("pos") - F.col("off")).alias("start")).where("start >= 0")
    places = begin.groupBy("row", "win", "lists", "start").agg(F.count("*").alias("given")).where("given = lists")
    phrases = index.windows.select("win", "phrase", F.size(F.split("phrase", " ")).alias("n"))
    found = places.join(phrases, "win").groupBy("row").agg(F.collect_list(F.struct("start", "n", "win", "phrase")).alias("places"))
    # the words are split once per text: bound to the variable of the outer function
    equal = F.transform(
        F.array(F.split("words", " ")),
        lambda words: F.filter("places", lambda p: F.concat_ws(" ", F.slice(words, p["start"] + 1, p["n"])) == p["phrase"]),
    )[0]
    matches = F.transform(equal, lambda p: F.struct(p["start"].alias("start"), p["n"].alias("n"), p["win"].alias("win")))
    checked = index.texts.select("row", "words").join(found, "row").select("row", matches.alias("matches"))
    return stored(checked.where(F.size("matches") > 0), "matches")


def near_matches(index: Index, span: int = 20) -> DataFrame:
    """(row, wins): for each text with any, the windows whose terms all stand within ``span`` consecutive words."""
    seen = _looked_up(index).groupBy("row", "win", "lists").agg(
        F.collect_list(F.when(F.col("place") == 1, F.col("pos"))).alias("first"),
        F.collect_list(F.when(F.col("place") == 2, F.col("pos"))).alias("second"),
    )
    # postings of both lists less than a span apart
    close = F.filter("first", lambda at: (F.col("lists") == 1) | F.exists("second", lambda other: F.abs(other - at) < span))
    seen = seen.select("row", "win", close.alias("at")).where(F.size("at") > 0)
    terms = index.windows.select("win", F.array_distinct(F.split("phrase", " ")).alias("terms"))
    found = seen.join(terms, "win").groupBy("row").agg(F.collect_list(F.struct("win", "at", "terms")).alias("places"))

    def holds(words: Column, p: Column) -> Column:
        lacks = lambda begin, many: F.size(F.array_except(p["terms"], F.slice(words, begin + 1, many))) > 0
        first = lambda at: F.greatest(at - (span - 1), F.lit(0))
        # most places lack a term all around, so no stretch there needs a look
        around = F.filter(p["at"], lambda at: ~lacks(first(at), 2 * span - 1))
        return F.exists(around, lambda at: F.exists(F.sequence(first(at), at), lambda begin: ~lacks(begin, span)))

    near = F.transform(F.array(F.split("words", " ")), lambda words: F.filter("places", lambda p: holds(words, p)))[0]
    wins = F.transform(near, lambda p: p["win"])
    checked = index.texts.select("row", "words").join(found, "row").select("row", wins.alias("wins"))
    return stored(checked.where(F.size("wins") > 0), "near")


def items_of(index: Index, wins: DataFrame) -> DataFrame:
    """(row, item_ids) of (row, win) rows: sorted as strings, without repeats."""
    names = index.items.join(index.windows, "phrase").where("item_id IS NOT NULL").select("win", "item_id")
    return wins.distinct().join(names, "win").groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))


def _digest(index: Index, found: DataFrame) -> DataFrame:
    """Every text with its columns of ``found`` (row, ..., item_ids), none where it has no match."""
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    joined = index.texts.select("row", "doc_id", "n_words").join(found, "row", "left")
    return joined.select("*", F.size(ids).cast("long").alias("n_items"), F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, **names: str) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every text, by exact phrases."""
    index = build_index(docs, items, window, **names)
    matches = phrase_matches(index)
    covered = F.array_distinct(F.flatten(F.transform("matches", lambda m: F.sequence(m["start"], m["start"] + m["n"] - 1))))
    hits = matches.select("row", F.size(covered).cast("long").alias("n_hit"))
    listed = items_of(index, matches.select("row", F.explode("matches.win").alias("win")))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    out = _digest(index, hits.join(listed, "row", "left"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), "n_items", "items_sha256", (n_hit > 0).alias("contaminated"))


def decontaminate_near(docs: DataFrame, items: DataFrame, window: int = 10, span: int = 20, **names: str) -> DataFrame:
    """(doc_id, n_words, n_items, items_sha256) of every text, by windows whose words stand near each other."""
    index = build_index(docs, items, window, **names)
    near = near_matches(index, span)
    out = _digest(index, items_of(index, near.select("row", F.explode("wins").alias("win"))))
    return out.select("doc_id", "n_words", "n_items", "items_sha256")


_SQL_WORDS = f"coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])"
_SQL_WINDOWS = f"""
    d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_SQL_WORDS} AS w FROM documents),
    b AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
    wins AS MATERIALIZED (
        SELECT DISTINCT item_id, list_slice(w, s, s + least(len(w), 10) - 1) AS phrase, least(len(w), 10) AS n
        FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(s) WHERE len(w) > 0)"""
_SQL_ITEMS = "SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r"
ORACLE_SQL = {
    "phrase": f"""
        WITH {_SQL_WINDOWS},
        grams AS (
            SELECT r, s, n, list_slice(w, s, s + n - 1) AS phrase
            FROM d, (SELECT DISTINCT n FROM wins) x, unnest(range(1, len(w) - n + 2)) t(s)),
        found AS MATERIALIZED (SELECT r, s, g.n, item_id FROM grams g JOIN wins USING (phrase)),
        hits AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(s, s + n)) AS p FROM found) GROUP BY r),
        items AS ({_SQL_ITEMS})
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
    """,
    "near": f"""
        WITH {_SQL_WINDOWS},
        terms AS (SELECT DISTINCT item_id, phrase, unnest(list_distinct(phrase)) AS term, len(list_distinct(phrase)) AS many FROM wins),
        places AS MATERIALIZED (SELECT r, unnest(w) AS term, unnest(range(len(w))) AS p FROM d),
        whole AS (SELECT r, item_id, phrase, many FROM (SELECT DISTINCT r, term FROM places) JOIN terms USING (term) GROUP BY ALL HAVING count(*) = many),
        seen AS MATERIALIZED (SELECT r, item_id, phrase, many, term, p FROM whole JOIN terms USING (item_id, phrase, many) JOIN places USING (r, term)),
        found AS MATERIALIZED (
            SELECT DISTINCT a.r, a.item_id FROM seen a JOIN seen b ON a.r = b.r AND a.item_id IS NOT DISTINCT FROM b.item_id AND a.phrase = b.phrase AND b.p BETWEEN a.p AND a.p + 19
            GROUP BY a.r, a.item_id, a.phrase, a.p, a.many HAVING count(DISTINCT b.term) = a.many),
        items AS ({_SQL_ITEMS})
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256
        FROM d LEFT JOIN items USING (r)
    """,
}
