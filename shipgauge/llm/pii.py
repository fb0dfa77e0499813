"""Personal data replaced by keyed surrogates of the same kind, in SQL expressions alone.

One expression finds all entities; the text between them stays as it is. A
surrogate comes from a keyed permutation of the strings of one format: every
replaceable character moves within its own alphabet (digits, vowels,
consonants, by case and script), by an amount that a keyed hash of all other
characters gives. Undoing the moves in reverse shows that different entities
of one format have different surrogates; equal ones have equal surrogates in
every document. Given names move within a list of one gender. A check over all
distinct entities finds surrogates that are themselves entities of the corpus
(or unchanged) and gives those others that are not.

Phone numbers are found with 9 to 15 digits: after ``+`` or from a 0 on in any
grouping, after an area code in brackets, as 10 digits (plain, 3-3-4, 3-7, 6-4,
5-5), or in groups of 2 to 4. Out of reach are national numbers without a
leading 0 in any other grouping, numbers of fewer than 9 digits, extensions,
and marks other than blank, dot, hyphen and round brackets between digits.
Names are found after a form of address or from a listed given name on, with
one blank between the words. Out of reach are all other names: an unlisted
given name with its surname ('Robert Miller'), a given name or a surname
alone, initials, and scripts without capital letters.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import unused, written

ROUNDS = 2
STALLED = 12  # further permutations in a row that give no entity a free surrogate, after which its format counts as full

# The alphabets characters move in.
ALPHABETS = ("0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ",
             "áéíóúàèìòùâêîôûäëïöü", "ÁÉÍÓÚÀÈÌÒÙÂÊÎÔÛÄËÏÖÜ", "аеиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "АЕИОУЫЭЮЯ",
             "БВГДЖЗЙКЛМНПРСТФХЦЧШЩ", "αεηιουω", "βγδζθκλμνξπρστφχψ", "ΑΕΗΙΟΥΩ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ")

# Given names by gender, and forms of address before a name.
FEMALE = "Mary Anna Emma Julia Laura Sarah Sophie Marie Claire Camille Elena Lucia Carmen Maria Isabel Hanna Lena Greta".split()
MALE = "John James Peter Paul David Thomas Michael Lukas Felix Jonas Pierre Louis Antoine Carlos Miguel Javier Diego Luis".split()
_ADDRESS = r"(?:Mrs?|Ms|Miss|Dr|Prof|Herrn?|Frau|Mme|Mlle|Sra?|Srta)\b\.? "
_NAME = r"\p{Lu}[\p{Ll}]{1,40}"

# Forms of phone numbers; a last group has two digits at least, as a single digit after a blank is likelier a word of its own.
_COUNT = r"(?=\+?(?:[ .()-]{0,2}\d){9,15}(?!\d))"
_PLUS = r"\+(?=[\d(])(?:[ .()-]{0,2}\d){9,15}(?<![ .()-]\d)"
_ZERO = r"(?<!\d[.,])(?=0\d|\(0\d{1,4}\))(?:[ .()-]{0,2}\d){9,15}(?<![ .()-]\d)(?![.,]\d)"
_AREA = _COUNT + r"\(\d{2,5}\)(?:[ .-]{0,2}\d){5,12}(?<![ .-]\d)"
_TEN = r"(?<!\d[.,])(?:\d{3}[ .-]?\d{3}[ .-]?\d{4}|\d{5}[ .-]\d{5})(?![.,]\d)"
_GROUPS = _COUNT + r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{1,4}\)|\d{2,4})(?:[ .-]{1,2}\d{2,4}){1,4}"
# country codes of numbers without a separator after them
_COUNTRY = r"\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"

# Kinds in order of preference, and their patterns.
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@(?:[A-Za-z0-9-]{1,63}+\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\w|\.\d)",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "card": r"(?<![\w+])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{4,5})(?![\w-])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": rf"(?<![\w+])(?:{_PLUS}|{_ZERO}|{_AREA}|{_TEN}|{_GROUPS})(?!\w)",
    "name": rf"(?<!\w)(?:{_ADDRESS}{_NAME}(?: {_NAME}){{0,2}}|(?:{'|'.join(FEMALE + MALE)}) {_NAME})(?!\w)",
}
# every kind begins where no word character stands before; asked first, that settles most positions
FIND = r"(?<!\w)(?:" + "|".join(f"(?:{p})" for p in KINDS.values()) + ")"
DIGITS, PLAIN = ALPHABETS[:1], ALPHABETS[:5]


def _hashed(key: str, *parts: Column) -> Column:
    """A number below 2^32 from the key and the parts."""
    return F.conv(F.substring(F.sha2(F.concat_ws("\u0001", F.lit(key), *parts), 256), 1, 8), 16, 10).cast("long")


def _moved(text: Column, key: str, alphabets: tuple[str, ...], fixed: Column | None = None) -> Column:
    """The keyed permutation on characters of ``alphabets`` after the first ``fixed``; others stay."""
    fixed = F.lit(0) if fixed is None else fixed

    def move(done: Column, at: Column) -> Column:
        spot = F.lit(1) + at % F.length(text)
        char = F.substr(done, spot, F.lit(1))
        before, after = F.substr(done, F.lit(1), spot - 1), F.substr(done, spot + 1)
        out = char
        amount = _hashed(key, at.cast("string"), before, after)
        for alphabet in alphabets:
            place = F.instr(F.lit(alphabet), char)
            new = F.substr(F.lit(alphabet), (1 + (place - 1 + amount) % len(alphabet)).cast("int"), F.lit(1))
            out = F.when((place > 0) & (char != ""), new).otherwise(out)
        return F.when(spot > fixed, F.concat(before, out, after)).otherwise(done)

    steps = F.sequence(F.lit(0), F.greatest(F.length(text) * ROUNDS - 1, F.lit(0)))
    return F.when(F.length(text) > 0, F.aggregate(steps, text, move)).otherwise(text)


def _digits_sum(digits: Column) -> Column:
    """Luhn sum of a string of digits whose last one is the check digit's left neighbour."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(d == "", 0).otherwise(
        F.when(i % 2 == 0, (d.cast("int") * 2) % 10 + (d.cast("int") * 2 / 10).cast("int")).otherwise(d.cast("int"))))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def _card(entity: Column, key: str) -> Column:
    """First digit and grouping stay; a number that passes the Luhn check passes it again, a failing one fails."""
    body = F.substr(entity, F.lit(1), F.length(entity) - 1)
    new = _moved(body, key, DIGITS, F.lit(1))
    only = lambda c: F.regexp_replace(c, "[^0-9]", "")
    off = (F.substr(entity, F.length(entity)).cast("int") + _digits_sum(only(body))) % 10
    return F.concat(new, ((off - _digits_sum(only(new)) % 10 + 10) % 10).cast("string"))


def _ip(entity: Column, key: str) -> Column:
    """Octets are moved one by one, by a hash of the other three: still an address, still a permutation."""
    octets = F.transform(F.split(entity, r"\."), lambda x: x.cast("int"))

    def move(done: Column, at: Column) -> Column:
        rest = F.concat_ws(".", F.transform(done, lambda x, i: F.when(i == at % 4, F.lit("-")).otherwise(x.cast("string"))))
        return F.transform(done, lambda x, i: F.when(
            i == at % 4, ((x + _hashed(key, at.cast("string"), rest)) % 256).cast("int")).otherwise(x))

    return F.concat_ws(".", F.transform(F.aggregate(F.sequence(F.lit(0), F.lit(4 * ROUNDS - 1)), octets, move),
                                        lambda x: x.cast("string")))


def _phone(entity: Column, key: str) -> Column:
    """The country code stays, else a leading 0; another first digit moves last, within 1 to 9."""
    code = F.coalesce(*(F.nullif(F.length(F.regexp_extract(entity, p, 1)), F.lit(0))
                        for p in (r"^(\+\d{1,3})[ .(-]", f"^({_COUNTRY})")), F.lit(1))
    at = F.length(F.regexp_extract(entity, r"^(\(?)", 1)) + 1
    new = _moved(entity, key, DIGITS, F.when(entity.startswith("+"), code).otherwise(at))
    place, rest = F.instr(F.lit("123456789"), F.substr(new, at, F.lit(1))), F.substr(new, at + 1)
    first = F.substr(F.lit("123456789"), (1 + (place - 1 + _hashed(key, F.lit("first"), rest)) % 9).cast("int"), F.lit(1))
    return F.when(entity.startswith("+") | (place == 0), new).otherwise(F.concat(F.substr(new, F.lit(1), at - 1), first, rest))


def _names(key: str) -> dict[str, str]:
    """A keyed permutation of each gender's given names."""
    out = {}
    for names in (FEMALE, MALE):
        mixed = sorted(names, key=lambda n: hashlib.sha256(f"{key}\u0001{n}".encode()).digest())
        out.update({a: mixed[(i + 1) % len(mixed)] for i, a in enumerate(mixed)})
    return out


def _name(entity: Column, key: str) -> Column:
    """The form of address stays; a listed given name becomes another of its gender, all else moves by letters.

    The last letter of an unlisted name stays if it is a vowel, as it may mark gender.
    """
    listed = F.create_map(*(F.lit(x) for pair in _names(key).items() for x in pair))
    words = F.split(entity, " ")

    def one(word: Column, at: Column) -> Column:
        keep = F.when(word.rlike("[aeiouyáéíóúаеиоуя]$"), 1).otherwise(0)
        stem = F.substr(word, F.lit(1), F.length(word) - keep)
        return (F.when((at == 0) & F.concat(word, F.lit(" ")).rlike(f"^{_ADDRESS}$"), word)
                .when(listed[word].isNotNull(), listed[word])
                .otherwise(F.concat(_moved(stem, key, ALPHABETS[1:]), F.substr(word, F.length(stem) + 1))))

    return F.array_join(F.transform(words, one), " ")


def kind_of(entity: Column) -> Column:
    out = F.lit("name")
    for kind, pattern in reversed(list(KINDS.items())):
        out = F.when(entity.rlike(f"^(?:{pattern})$"), kind).otherwise(out)
    return out


def surrogate(entity: Column, kind: Column, key: str) -> Column:
    """The permutation of the entity's kind; country codes, top-level domains and marks stay."""
    user, host = F.substring_index(entity, "@", 1), F.substring_index(entity, "@", -1)
    domain = F.substring_index(host, ".", -1)
    sub = F.substr(host, F.lit(1), F.length(host) - F.length(domain) - 1)
    return (F.when(kind == "email", F.concat(_moved(user, key + "u", PLAIN), F.lit("@"), _moved(sub, key + "h", PLAIN), F.lit("."),
                                             domain))
            .when(kind == "ip", _ip(entity, key + "i"))
            .when(kind == "card", _card(entity, key + "c"))
            .when(kind == "iban", _moved(entity, key + "b", PLAIN, F.lit(2)))
            .when(kind == "phone", _phone(entity, key + "p"))
            .when(kind == "ssn", _moved(entity, key + "s", DIGITS))
            .otherwise(_name(entity, key + "n")))


def entities(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(FIND), F.lit(0))


def colliding(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Entities whose first surrogate can't stay, with another one: (entity, surrogate).

    It can't stay if it is an entity of the corpus, or if a smaller entity has
    the same: permutations of one alphabet never meet, but those of a listed and
    an unlisted name may. Such entities get further permutations until their
    surrogate is no entity, taken by no other, and theirs alone among those
    tried together. After ``STALLED`` permutations in a row that settle none,
    the formats of what is left count as full, and each keeps its first surrogate.
    """
    each = docs.select(F.explode(F.array_distinct(entities(F.col(text)))).alias("entity")).distinct()
    each = each.select("entity", kind_of(F.col("entity")).alias("kind"))
    known = written(each.withColumn("surrogate", surrogate(F.col("entity"), F.col("kind"), key)), "entities")
    found = known.select(F.col("entity").alias("surrogate"))

    def free(tried: DataFrame) -> DataFrame:
        """One entity of each surrogate that is no entity."""
        own = tried.groupBy("surrogate").agg(F.min(F.struct("entity", "kind")).alias("own"))
        return own.join(found, "surrogate", "left_anti").select("own.*", "surrogate")

    stays = written(free(known), "first-surrogates")
    taken = stays.select("surrogate")
    first = left = written(known.join(stays.select("entity"), "entity", "left_anti").select("entity", "kind", "surrogate"), "colliding")
    settled, k, stalled = None, 0, 0
    while stalled < STALLED and not left.isEmpty():
        k += 1
        tried = left.select("entity", "kind", surrogate(F.col("entity"), F.col("kind"), f"{key}#{k}").alias("surrogate"))
        new = written(free(tried).join(taken, "surrogate", "left_anti").select("entity", "surrogate"), "settled")
        if new.isEmpty():
            stalled += 1
            continue
        stalled = 0
        taken = taken.unionByName(new.select("surrogate"))
        settled = new if settled is None else settled.unionByName(new)
        left = written(left.join(new, "entity", "left_anti").select("entity", "kind", "surrogate"), "colliding")
    return first.limit(0).select("entity", "surrogate") if settled is None else settled


def replace_entities(docs: DataFrame, key: str, text: str = "text", count: str = "entities") -> DataFrame:
    """``docs`` with every entity of ``text`` replaced, and ``count``: how many were.

    The same entity has the same surrogate in all documents, different ones
    have different surrogates, and no surrogate is an entity of the corpus,
    unless a format is full (``colliding``). A null text stays null with
    0 entities, an empty one empty; repeated rows are replaced alike.
    """
    docs = docs.drop(count)
    spots, body, other, whole = (unused(n, docs) for n in ("_spots", "_text", "_moved", "_whole"))
    moved = written(colliding(docs, key, text), "moved")
    spot = F.transform(F.transform(entities(F.col(text)), lambda e: F.struct(e.alias("entity"), kind_of(e).alias("kind"))),
                       lambda s: F.struct(s["entity"].alias("entity"), surrogate(s["entity"], s["kind"], key).alias("new")))
    if moved.isEmpty():
        found = docs.withColumn(spots, spot)
        new = F.transform(spots, lambda s: s["new"])
    else:
        # one map for each distinct text that has such an entity, joined to its rows
        hashed = docs.withColumn(body, F.sha2(text, 256))
        few = (hashed.select(F.col(body).alias("body"), F.explode(F.array_distinct(entities(F.col(text)))).alias("entity"))
               .join(moved, "entity").distinct()
               .groupBy("body").agg(F.map_from_entries(F.collect_list(F.struct("entity", "surrogate"))).alias(other))
               .withColumnRenamed("body", body))
        few = written(few, "moved-texts")
        found = hashed.join(few, body, "left").withColumn(spots, spot)
        new = F.transform(spots, lambda s: F.coalesce(F.col(other)[s["entity"]], s["new"]))
    between = F.split(F.col(text), FIND, -1)
    replaced = F.array_join(F.zip_with(between, new, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    out = found.withColumn(whole, F.when(F.size(spots) > 0, replaced).otherwise(F.col(text)))
    kept = [F.col(whole).alias(text) if c == text else F.col(c) for c in docs.columns]
    return out.select(*kept, F.greatest(F.size(spots), F.lit(0)).alias(count))
