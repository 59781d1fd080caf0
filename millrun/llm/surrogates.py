"""PII surrogates: detected entities get keyed, type-consistent replacements.

Everything is DataFrame and SQL functions. One pattern finds the entities;
texts without one (nearly all) pass a single scan and no shuffle. The others
are written once, their entities are exploded, and the distinct (type,
canonical value) pairs get a surrogate core from SHA-256 of key, type, value
and attempt:

* email: letters become letters of their script (of a script without a table:
  Latin ones), digits digits, the last label stays;
* phone, card, ssn: digits become digits in the same layout; a country code
  and a card's first digit stay, and a valid check digit stays valid;
* ip: another address; * secret: the same alphabet (hexadecimal stays so)
  after the same prefix;
* person (a name after a title; of one word that is the surname): a
  pronounceable surname by script and surname, and a first name of the title's
  gender and script by its own key, in the name's case. So "Mr John Smith" and
  "Mr Smith" get the same surname; first names differ among equal surnames, and
  are joined to double names where the list is too short for that.

Collision checks: in each round the cores that two values share (all but the
least value's), or that some value of the corpus or one settled before has, are
drawn again with the next attempt, until none is left. So distinct values stay
distinct, no surrogate is another's real value, and equal values (ignoring
layout and case) get equal surrogates everywhere.

Numbers and addresses cannot grow. Where over 40 % (``CROWDED``) of a
layout is in use, surrogates that are nobody's real value need not exist; all
values of the layout then get a keyed permutation of it without fixed points.
They stay distinct and nobody keeps their own, but one's surrogate may be
another's real value (and of an address have numbers above 255). The surrogates go back by value and
row; a value in a third of all documents is one row of the table of values.

A short email or secret has few surrogates of its own length; from its eighth
attempt on it grows. Defined cases: a secret without a letter or digit (a blank
form field) is no entity; null and empty texts stay as they are; repeated rows are
rewritten alike; an empty table gives no rows; all other columns pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Titles by gender and script, and first names.
TITLES = {
    ("m", "latin"): ["Mr", "Herr", "Señor", "Monsieur"],
    ("f", "latin"): ["Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Mme"],
    ("m", "cyrillic"): ["господин", "Господин"],
    ("f", "cyrillic"): ["госпожа", "Госпожа"],
}
FIRST_NAMES = {
    ("m", "latin"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Louis", "Marco", "Oscar", "Paul", "Simon", "Victor", "Walter"],
    ("f", "latin"): ["Alice", "Bella", "Clara", "Diana", "Elena", "Flora", "Helen", "Ines", "Julia", "Laura", "Marta", "Nora", "Olga", "Paula", "Sonia", "Vera"],
    ("m", "cyrillic"): ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Игорь", "Павел", "Роман"],
    ("f", "cyrillic"): ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга"],
}
CONSONANTS = {"latin": "bdfgklmnprstvz", "cyrillic": "бвгдклмнпрст"}
VOWELS = {"latin": "aeiou", "cyrillic": "аеиоу"}
SURNAME_ENDS = {("m", "cyrillic"): "ов", ("f", "cyrillic"): "ова"}
#: What stays within its own alphabet.
#: A few scripts without case have some common letters here.
ALPHABETS = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "абвгдежзиклмнопрстуфхцчшщэюя", "αβγδεζηθικλμνξοπρστυφχψω"]
SCRIPTS = {
    r"\p{IsLatin}": ALPHABETS[1],
    r"\p{IsCyrillic}": ALPHABETS[3],
    r"\p{IsGreek}": ALPHABETS[4],
    r"\p{IsHan}": "安白北长成大东方高光国海和红华江金开来林马明木南平青清日山石水天田王文西新星雪阳永玉云中",
    r"\p{IsHiragana}": "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむめもやゆよらりるれろわ",
    r"\p{IsKatakana}": "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワ",
    r"\p{IsHangul}": "가나다라마바사아자차카타파하거너더러머버서어저처커터퍼허고노도로모보소오조초코토포호",
    r"\p{IsHebrew}": "אבגדהוזחטיכלמנסעפצקרשת",
    r"\p{IsArabic}": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
}

_TITLE = "|".join(t for titles in TITLES.values() for t in titles)
_NAME = r"\p{Lu}[\p{L}'’-]{1,30}"
PATTERNS = {
    "email": r"[\p{L}\p{N}][\p{L}\p{N}._%+-]{0,63}+@(?:[\p{L}\p{N}-]{1,63}\.){1,8}\p{L}{2,24}",
    "secret": r"\bAKIA[0-9A-Z]{16}\b|\b(?:password|passwd|pwd|secret|api_key|apikey|token)\s?[=:]\s?[\"']?(?=[+/_-]{0,127}[A-Za-z0-9])[A-Za-z0-9+/_-]{8,128}[\"']?",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d)",
    "phone": r"(?<![\d\p{L}])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)|(?<![\d\p{L}])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d\p{L}.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d\p{L}.])[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\d\p{L}])",
    "person": rf"(?<!\p{{L}})(?:{_TITLE})\.? {_NAME}(?: {_NAME})?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _kind() -> str:
    """The type of an entity ``raw``: the first pattern that matches all of it."""
    cases = " ".join(f"WHEN raw RLIKE {_sql(f'^(?:{p})$')} THEN '{kind}'" for kind, p in PATTERNS.items())
    # an address or a name after a prefix that the pattern only looks behind at still matches whole
    return f"CASE {cases} ELSE 'secret' END"


_DIGITS = r"regexp_replace(raw, '\\D', '')"
#: Of a secret, what is replaced: after the last of blank, equals, colon and quote.
_VALUE = r"""CASE WHEN raw LIKE 'AKIA%' THEN substr(raw, 5) ELSE regexp_extract(raw, '[=:]\\s?["\']?([^"\']+)["\']?$', 1) END"""
_NAME_ONLY = f"regexp_replace(raw, {_sql(f'^(?:{_TITLE})[.]? ')}, '')"
_HEAD = r"""regexp_extract(raw, '^(?:AKIA|[^=:]*[=:]\\s?["\']?)', 0)"""
_CANONICAL = rf"""CASE kind
  WHEN 'email' THEN lower(raw)
  WHEN 'phone' THEN CASE WHEN length({_DIGITS}) > 10 AND {_DIGITS} LIKE '1%' THEN substr({_DIGITS}, 2) ELSE {_DIGITS} END
  WHEN 'card' THEN {_DIGITS}
  WHEN 'ssn' THEN {_DIGITS}
  WHEN 'ip' THEN regexp_replace(raw, '(^|[.])0+(?=[0-9])', '$1')
  WHEN 'secret' THEN {_VALUE}
  ELSE concat(script, '/', lower(regexp_extract(raw, '[^ ]+$', 0)))
END"""
#: The first name of a full name, below gender, script and surname.
_FIRST = rf"""CASE WHEN kind = 'person' AND {_NAME_ONLY} LIKE '% %' THEN concat(gender, '/', canonical, '/', lower(substring_index({_NAME_ONLY}, ' ', 1))) END"""


def _titled(field: int) -> str:
    """Gender (0) or script (1) of a name's title."""
    cases = " ".join(f"WHEN raw RLIKE {_sql('^(?:' + '|'.join(titles) + ')[.]? ')} THEN '{by[field]}'" for by, titles in TITLES.items())
    return f"CASE {cases} END"


def _byte(at: str) -> str:
    """Keyed byte number ``at`` (from 1) of a value's stream."""
    return f"cast(conv(substr(stream, 2 * ({at}) - 1, 2), 16, 10) AS int)"


def _pick(alphabet: str, at: str) -> str:
    return f"substr('{alphabet}', {_byte(at)} % {len(alphabet)} + 1, 1)"


def _shaped(text: str, whole: str | None = None) -> str:
    """Each character replaced within its own alphabet, other letters by one of their script, other numbers by a digit."""
    c = "substr(t, i, 1)"
    cases = " ".join(f"WHEN instr('{a}', {c}) > 0 THEN {_pick(a, 'i')}" for a in ALPHABETS)
    other = " ".join(f"WHEN {c} RLIKE {_sql(p)} THEN {_pick(a, 'i')}" for p, a in {r"\p{N}": ALPHABETS[0], **SCRIPTS, r"[\p{L}\p{M}]": ALPHABETS[1]}.items())
    one = f"CASE {cases} WHEN ascii({c}) < 128 THEN {c} {other} ELSE {c} END"
    if whole:
        one = f"CASE WHEN t RLIKE '^[0-9a-f]+$' THEN {_pick('0123456789abcdef', 'i')} ELSE {one} END"
    return f"array_join(transform(sequence(1, length({text})), i -> transform(array({text}), t -> {one})[0]), '')"


#: The sum that a card's check digit makes a multiple of ten.
def _luhn(digits: str) -> str:
    d = f"cast(substr({digits}, length({digits}) + 1 - i, 1) AS int)"
    return f"aggregate(transform(sequence(1, length({digits})), i -> IF(i % 2 = 0, 2 * {d} - IF(2 * {d} > 9, 9, 0), {d})), 0, (a, x) -> a + x)"


def _grown(alphabet: str) -> str:
    """What a value gets besides its own length: a letter more every eight attempts."""
    return f"IF(attempt < 8, '', array_join(transform(sequence(1, greatest(1, attempt div 8)), i -> {_pick(alphabet, 'length(canonical) + i')}), ''))"


def _surname(script: str) -> str:
    letters = "greatest(5, least(length(canonical), 9)) + attempt div 4"
    return f"initcap(array_join(transform(sequence(1, {letters}), i -> IF(i % 2 = 1, {_pick(CONSONANTS[script], 'i + 1')}, {_pick(VOWELS[script], 'i + 1')})), ''))"


def _person() -> str:
    """A surname without its ending."""
    return f"CASE {' '.join(f'WHEN canonical LIKE {_sql(f"{script}/%")} THEN {_surname(script)}' for script in CONSONANTS)} END"


def _first() -> str:
    """A first name (one more every four attempts) below what stands before it."""
    cases = []
    for by, names in FIRST_NAMES.items():
        one = f"element_at(array({', '.join(_sql(n) for n in names)}), {_byte('i')} % {len(names)} + 1)"
        cases.append(f"WHEN canonical LIKE '{by[0]}/{by[1]}/%' THEN array_join(transform(sequence(1, 1 + attempt div 4), i -> {one}), '-')")
    return f"concat(regexp_extract(canonical, '^.*/', 0), CASE {' '.join(cases)} END)"


_NEW_DIGITS = f"array_join(transform(sequence(1, length(canonical)), i -> {_pick('0123456789', 'i')}), '')"
_CARD = f"concat(substr(canonical, 1, 1), substr({_NEW_DIGITS}, 2))"
_CARD_FIXED = f"transform(array(substr({_CARD}, 1, length(canonical) - 1)), t -> concat(t, cast((10 - {_luhn("concat(t, '0')")} % 10) % 10 AS string)))[0]"
#: A number grows no longer: its attempts run on, and its layout stays.
_CORE = f"""CASE kind
  WHEN 'email' THEN concat({_grown(ALPHABETS[1])}, {_shaped("regexp_extract(canonical, '^(.*)[.][^.]+$', 1)")}, regexp_extract(canonical, '[.][^.]+$', 0))
  WHEN 'phone' THEN {_NEW_DIGITS}
  WHEN 'ssn' THEN {_NEW_DIGITS}
  WHEN 'card' THEN IF({_luhn('canonical')} % 10 = 0, {_CARD_FIXED}, {_CARD})
  WHEN 'ip' THEN array_join(transform(sequence(1, 4), i -> cast({_byte('i')} % 254 + 1 AS string)), '.')
  WHEN 'secret' THEN concat({_shaped('canonical', 'hex')}, IF(canonical RLIKE '^[0-9a-f]+$', {_grown('0123456789abcdef')}, {_grown(ALPHABETS[1])}))
  WHEN 'first' THEN {_first()}
  ELSE {_person()}
END"""
_ENDING = f"CASE {' '.join(f"WHEN gender = '{g}' AND canonical LIKE '{script}/%' THEN '{end}'" for (g, script), end in SURNAME_ENDS.items())} ELSE '' END"
#: The core in the layout and case of the entity it replaces.
_LAID_OUT = rf"""CASE
  WHEN kind IN ('phone', 'card', 'ssn') THEN aggregate(split(raw, ''),
    named_struct('out', '', 'k', length(core) - length({_DIGITS})),
    (a, c) -> CASE WHEN c NOT RLIKE '^[0-9]$' THEN named_struct('out', concat(a.out, c), 'k', a.k)
      ELSE named_struct('out', concat(a.out, IF(a.k < 0, c, substr(core, a.k + 1, 1))), 'k', a.k + 1) END,
    a -> a.out)
  WHEN kind = 'email' THEN transform(array(length(core) - length(raw)), more -> concat(IF(raw = upper(raw), upper(substr(core, 1, more)), substr(core, 1, more)),
    array_join(transform(sequence(1, length(raw)), i -> IF(substr(raw, i, 1) = lower(substr(raw, i, 1)), substr(core, more + i, 1), upper(substr(core, more + i, 1)))), '')))[0]
  WHEN kind = 'secret' THEN concat({_HEAD}, core, substr(raw, length({_HEAD}) + length(canonical) + 1))
  WHEN kind = 'person' THEN concat(regexp_extract(raw, {_sql(f"^(?:{_TITLE})[.]? ")}, 0), transform(array(concat_ws(' ', regexp_extract(first_core, '[^/]+$', 0), concat(core, {_ENDING}))), t -> IF({_NAME_ONLY} = upper({_NAME_ONLY}), upper(t), t))[0])
  ELSE core
END"""


def _drawn(values: DataFrame, key: str) -> DataFrame:
    """``core`` of each (kind, canonical, attempt); ``canonical`` of a person starts with the script."""
    stream = "array_join(transform(sequence(0, (length(canonical) + attempt) div 32 + 1), j -> sha2(concat_ws('/', {key}, kind, canonical, attempt, j), 256)), '')".replace("{key}", _sql(key))
    return values.withColumn("stream", F.expr(stream)).withColumn("core", F.expr(_CORE)).drop("stream")


def _real(values: DataFrame) -> DataFrame:
    """The real values in the form of a core; a surname that gets an ending counts without it."""
    ends = "|".join(sorted(set(SURNAME_ENDS.values())))
    scripts = "|".join(sorted({script for _, script in SURNAME_ENDS}))
    bare = f"regexp_replace(regexp_replace(canonical, '^(({scripts})/.+?)({ends})$', '$1'), '^[a-z]+/', '')"
    return values.select("kind", F.expr(f"CASE WHEN kind = 'person' THEN {bare} ELSE lower(canonical) END").alias("taken")).distinct()


#: The values that share a number of surrogates which cannot grow, and that number.
_LAYOUT = f"""CASE WHEN kind IN ('phone', 'ssn') THEN cast(length(canonical) AS string) WHEN kind = 'ip' THEN '4'
  WHEN kind = 'card' THEN concat_ws('/', length(canonical), substr(canonical, 1, 1), {_luhn('canonical')} % 10 = 0) END"""
_ROOM = "CASE kind WHEN 'ip' THEN pow(254, 4) WHEN 'card' THEN pow(10, length(canonical) - 2) ELSE pow(10, length(canonical)) END"
#: A layout with more than this share of it in use is permuted.
CROWDED = 0.4
_PASSES = 8  # an even number, so that the halves end as long as they began


def _permuted(digits: str, key: str) -> str:
    """A keyed permutation of the digit strings of one length that leaves none as
    it is: Feistel passes, the last digit moved on, the passes undone."""
    mixed = f"cast(conv(substr(sha2(concat_ws('/', {_sql(key)}, 'permuted', kind, r, {{half}}), 256), 1, 15), 16, 10) AS bigint)"
    number = "coalesce(try_cast({half} AS bigint), 0)"
    modulus = "cast(rpad('1', length({half}) + 1, '0') AS bigint)"

    def moved(half: str, by: str, sign: str) -> str:
        return f"lpad(cast(pmod({number.format(half=half)} {sign} {mixed.format(half=by)}, {modulus.format(half=half)}) AS string), length({half}), '0')"

    def passes(text: str, order: str, step: str) -> str:
        start = f"transform(array({text}), t -> named_struct('a', substr(t, 1, length(t) div 2), 'b', substr(t, length(t) div 2 + 1)))[0]"
        return f"aggregate({order}, {start}, (s, r) -> {step}, s -> concat(s.a, s.b))"

    there = passes(digits, f"sequence(1, {_PASSES})", f"named_struct('a', s.b, 'b', {moved('s.a', 's.b', '+')})")
    by = f"(1 + cast(conv(substr(sha2(concat_ws('/', {_sql(key)}, 'moved on', kind), 256), 1, 8), 16, 10) AS bigint) % 9)"
    on = f"transform(array({there}), t -> concat(substr(t, 1, length(t) - 1), cast((cast(right(t, 1) AS int) + {by}) % 10 AS string)))[0]"
    return passes(on, f"sequence({_PASSES}, 1, -1)", f"named_struct('a', {moved('s.b', 's.a', '-')}, 'b', s.a)")


def _crowded_core(key: str) -> str:
    """Distinct by construction: of a card the digits between the first and the
    check digit are permuted, and the check digit stays as valid as it was."""
    card = f"""transform(array(concat(substr(canonical, 1, 1), {_permuted("substr(canonical, 2, length(canonical) - 2)", key)})),
      t -> concat(t, cast((20 - {_luhn("concat(t, '0')")} % 10 + {_luhn('canonical')} % 10) % 10 AS string)))[0]"""
    padded = "array_join(transform(split(canonical, '[.]'), x -> lpad(x, 3, '0')), '')"
    ip = f"transform(array({_permuted(padded, key)}), t -> array_join(transform(sequence(0, 3), i -> cast(cast(substr(t, 3 * i + 1, 3) AS int) AS string)), '.'))[0]"
    return f"CASE kind WHEN 'card' THEN {card} WHEN 'ip' THEN {ip} ELSE {_permuted('canonical', key)} END"


def resolve(values: DataFrame, key: str) -> DataFrame:
    """(kind, canonical, core) of the distinct ``values`` (kind, canonical), with
    distinct cores that, but for crowded layouts, are nobody's real value.

    A round draws again only what still clashes. At least a fifth of a layout
    that isn't crowded is free at any time, and the others grow, so the rounds end.
    """
    real = stored(_real(values), "real")
    laid = values.withColumn("layout", F.expr(_LAYOUT))
    used = laid.where("layout IS NOT NULL").groupBy("kind", "layout").agg(F.count("*").alias("n"), F.max(F.expr(_ROOM)).alias("room"))
    # at most a row per kind, length, first digit and validity
    crowded = stored(used.where(F.col("n") > CROWDED * F.col("room")).select("kind", "layout"), "crowded")
    by_layout = laid.join(F.broadcast(crowded), ["kind", "layout"], "left_semi").select("kind", "canonical", F.expr(_crowded_core(key)).alias("core"))
    settled = stored(by_layout, "cores")
    rest = laid.join(F.broadcast(crowded), ["kind", "layout"], "left_anti").select("kind", "canonical", F.lit(0).alias("attempt"))
    form = F.lower("core").alias("taken")
    k = 0
    while True:
        moving = stored(_drawn(rest, key), f"drawn-{k}")
        owners = moving.groupBy("kind", form).agg(F.min("canonical").alias("canonical"))
        taken = real.unionByName(settled.select("kind", form))
        good = owners.join(taken, ["kind", "taken"], "left_anti").select("kind", "canonical")
        done = stored(moving.join(good, ["kind", "canonical"], "left_semi"), f"cores-{k}")
        settled = settled.unionByName(done.select("kind", "canonical", "core"))
        if k % 16 == 15:
            settled = stored(settled, f"settled-{k}")
        rest = moving.join(done, ["kind", "canonical"], "left_anti").select("kind", "canonical", (F.col("attempt") + 1).alias("attempt"))
        if rest.isEmpty():
            return settled
        k += 1


def pseudonymize(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with every entity in ``text_col`` replaced; ``count_col`` gets their number."""
    names = docs.columns
    found = F.coalesce(F.col(text_col).rlike(ANY), F.lit(False))
    clean = docs.where(~found)
    hit = docs.where(found).select(F.struct(*names).alias("doc"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))
    hit = stored(hit.withColumn("entities", F.regexp_extract_all("text", F.lit(ANY), F.lit(0))), "with-entities")
    each = hit.select("row", F.posexplode("entities").alias("pos", "raw")).withColumn("kind", F.expr(_kind()))
    each = each.withColumns({"gender": F.expr(_titled(0)), "script": F.expr(_titled(1))}).withColumn("canonical", F.expr(_CANONICAL))
    each = stored(each.withColumn("first", F.expr(_FIRST)).select("row", "pos", "raw", "kind", "canonical", "gender", "first"), "entities")
    firsts = each.where("first is not null").select(F.lit("first").alias("kind"), F.col("first").alias("canonical"))
    cores = stored(resolve(each.select("kind", "canonical").unionByName(firsts).distinct(), key), "cores")
    first_cores = cores.where("kind = 'first'").select(F.col("canonical").alias("first"), F.col("core").alias("first_core"))
    plain = each.where("first is null").join(cores, ["kind", "canonical"]).withColumn("first_core", F.lit(None).cast("string"))
    full = each.where("first is not null").join(cores, ["kind", "canonical"]).join(first_cores, "first")
    laid = plain.unionByName(full).select("row", "pos", F.expr(_LAID_OUT).alias("new"))
    # the entities of one text: as long as the text
    by_row = laid.groupBy("row").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "new"))), lambda x: x["new"]).alias("news"))
    between = F.split("text", ANY, -1)
    rebuilt = F.array_join(F.zip_with(between, F.concat("news", F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    done = hit.join(by_row, "row").select("doc.*", rebuilt.alias("__new"), F.size("entities").alias("__count"))
    count = [F.col("__count").alias(count_col)] if count_col else []
    zero = [F.lit(0).alias(count_col)] if count_col else []
    return clean.select(*names, *zero).unionByName(done.select(*[F.col("__new").alias(n) if n == text_col else F.col(n) for n in names], *count))
