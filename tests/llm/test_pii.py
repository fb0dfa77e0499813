"""PII surrogates against a plain Python reading of the permutation, and what they must preserve."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from shipgauge.llm import pii
from shipgauge.llm.pii import ALPHABETS, DIGITS, FEMALE, MALE, PLAIN, ROUNDS, colliding, replace_entities
from shipgauge.llm.queries import PII_KEY

KEY = "k"


def hashed(key, *parts):
    return int(hashlib.sha256("\u0001".join([key, *parts]).encode()).hexdigest()[:8], 16)


def moved(text, key, alphabets, fixed=0):
    for at in range(len(text) * ROUNDS):
        i = at % len(text)
        if i < fixed:
            continue
        before, after = text[:i], text[i + 1:]
        for alphabet in alphabets:
            if text[i] in alphabet:
                text = before + alphabet[(alphabet.index(text[i]) + hashed(key, str(at), before, after)) % len(alphabet)] + after
                break
    return text


def luhn(number):
    total = 0
    for i, d in enumerate(reversed([int(c) for c in number if c.isdigit()])):
        d = d * 2 if i % 2 else d
        total += d // 10 + d % 10
    return total % 10 == 0


def replaced(spark, texts, key=KEY):
    rows = replace_entities(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), key).collect()
    return [r.text for r in sorted(rows, key=lambda r: r.doc_id)], [r.entities for r in sorted(rows, key=lambda r: r.doc_id)]


def test_equals_the_plain_reading(spark):
    texts = ["x bosbt.42@mail8.example.com, y", "(123-45-6789)", "call +1 (988) 555-2485 now", "DE89 3704 0044 0532 0130 00"]
    got, counts = replaced(spark, texts)
    user, host = moved("bosbt.42", KEY + "u", PLAIN), moved("mail8.example", KEY + "h", PLAIN)
    assert got == [f"x {user}@{host}.com, y", f"({moved('123-45-6789', KEY + 's', DIGITS)})",
                   f"call {moved('+1 (988) 555-2485', KEY + 'p', DIGITS, 2)} now",
                   moved("DE89 3704 0044 0532 0130 00", KEY + "b", PLAIN, 2)]
    assert counts == [1, 1, 1, 1]


def test_kind_format_script_and_gender_stay(spark):
    texts = ["4111111111111111", "4111 1111 1111 1112", "10.0.0.255", "Mrs. Anna Müller", "John Smith", "Herr Иванов met Dr. Παπαδόπουλος",
             "no 1.2.3.4.5 and 2024-01-02 and 999.1.1.1 and abc@ and 12345678", "Sra. Carmen García López"]
    got, counts = replaced(spark, texts)
    assert counts == [1, 1, 1, 1, 1, 2, 0, 1] and got[6] == texts[6]
    assert luhn(got[0]) and got[0][0] == "4" and not luhn(got[1]) and re.fullmatch(r"4\d{3} \d{4} \d{4} \d{4}", got[1])
    assert all(0 <= int(x) < 256 for x in got[2].split(".")) and got[2] != texts[2]
    title, given, family = got[3].split()
    assert title == "Mrs." and given in FEMALE and given != "Anna" and family[1] in ALPHABETS[5] and len(family) == 6
    assert got[4].split()[0] in MALE and got[4].split()[1] != "Smith"
    assert re.fullmatch(r"Herr [А-Я][а-я]+ met Dr\. [Α-Ω][α-ωάόί]+ς?", got[5])
    assert got[7].split()[1] in FEMALE and len(got[7]) >= len("Sra. Lu García López") - 4


def test_forms_of_phone_numbers(spark):
    forms = ["+14155550123", "5551234567", "+34 612345678", "+49 30 1234567", "07700 900123", "+91 98765 43210", "98765 43210",
             "(415) 5550123", "(415)555-0123", "(030) 1234567", "555 1234567", "415-555-0123", "+1 (988) 555-2485", "+442071838750"]
    texts = [f"call {x}, or ({x}). {x} 5 times" for x in forms]
    left = ["pi is 3.1415926535 or 0.0123456789", "5551234567.25 and a5551234567 and 55512345678", "0123456789abcdef", "+1 23 and 012345"]
    got, counts = replaced(spark, texts + left)
    assert counts == [3] * len(forms) + [0] * len(left) and got[len(forms):] == left
    for form, new in zip(forms, got):
        first = re.match(r"call (.*?), or", new)[1]
        assert new == f"call {first}, or ({first}). {first} 5 times" and first != form
        assert re.sub(r"\d", "0", first) == re.sub(r"\d", "0", form)
        code = re.match(r"\+(?:1|34|44|49|91)|\(?0|", form)[0]
        assert first.startswith(code) and (code or first.lstrip("(")[0] != "0")


def test_phone_surrogates_of_one_layout_differ(spark):
    texts = [f"({a}15) 5550{b:03}" for a in range(10) for b in range(60)]
    rows = spark.createDataFrame([(t,) for t in texts], "e string").select(pii.surrogate(F.col("e"), F.lit("phone"), KEY)).collect()
    assert len(set(rows)) == len(texts) and sum(r[0][1] == "0" for r in rows) == 60


def test_same_entity_same_surrogate_different_entities_different_ones(spark):
    ids = [f"{a}{b}@x.org" for a in "abcdefghij" for b in "aeiou"] + [f"10.0.{i}.{j}" for i in range(12) for j in range(12)]
    got, _ = replaced(spark, ids + ids[::7])
    assert len(set(got[:len(ids)])) == len(ids) and got[len(ids):] == got[:len(ids)][::7]


def test_surrogates_that_are_entities_move_on(spark):
    first = ["a@b.co", "10.1.2.3", "123-45-6789"]
    step, _ = replaced(spark, first)
    texts = [*first, *step]  # now the surrogates are entities too
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.entity: r.surrogate for r in colliding(docs, KEY).collect()}
    got, _ = replaced(spark, texts)
    assert set(found) >= set(first) and len(set(got)) == len(texts)
    assert not set(got[1:3]) & set(texts) and got[:3] == [found[x] for x in first]


def test_listed_and_unlisted_names_never_share_a_surrogate(spark):
    texts = ["Ms Zixa Smith", "Ms Mary Smith"]
    first = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "e string")
             .select(pii.surrogate(F.col("e"), F.lit("name"), PII_KEY)).collect()]
    assert first[0] == first[1]  # the first permutation doesn't keep these apart
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    new = [r.text for r in replace_entities(docs, PII_KEY).orderBy("doc_id").collect()]
    assert new[0] != new[1] and not set(new) & set(texts)


def test_all_words_of_a_listed_names_form_differ(spark):
    texts = [f"Ms {a}{b}{c}a Smith" for a in "BCDFGHJKLMNPQRSTVWXYZ" for b in "aeiou" for c in "bcdfghjklmnpqrstvwxyz"]
    texts += [f"Ms {n} Smith" for n in FEMALE]
    new, _ = replaced(spark, texts)
    assert len(set(new)) == len(set(texts)) and not set(new) & set(texts)


def test_clashing_names_of_helpers(spark):
    names = ("_spots", "_text", "_moved", "_whole", "_entities", "body", "entity")
    schema = "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)
    df = spark.createDataFrame([(1, "a@b.co", *"1234567"), (2, "10.1.2.3", *"1234567")], schema)
    out = replace_entities(df, KEY)
    assert out.columns == [*df.columns, "entities"]
    assert all([r[n] for n in names] == list("1234567") and r.entities == 1 for r in out.collect())


def test_closed_cycle_keeps_entities_apart(spark):
    texts = [f"{a}@{b}.co" for a in "aeiou" for b in "aeiou"]  # every string of the format: none is free
    got, _ = replaced(spark, texts)
    assert sorted(set(got)) == sorted(texts)


def test_table_has_none_of_its_entities_left(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    new = {r.doc_id: r for r in replace_entities(docs, KEY).collect()}
    plain = re.compile(r"[\w.]+@mail\d\.example\.com|\+1 \(\d{3}\) 555-\d{4}|(?<!\w)4\d{15}(?!\w)|(?<![\w.])\d+\.\d+\.\d+\.\d+(?![\w.])")
    changed = 0
    for r in docs.collect():
        old = plain.findall(r.text)
        assert not any(x in new[r.doc_id].text for x in old) and new[r.doc_id].entities >= len(old)
        assert old or new[r.doc_id].entities or new[r.doc_id].text == r.text
        changed += bool(old)
    assert changed > 20


def test_nulls_repeats_clashes_and_empty_tables(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "a.b@c.org", None), (3, "a.b@c.org", None), (None, "a" * 200000 + " 1.2.3.4", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, entities string")
    got = replace_entities(docs, KEY).collect()
    assert sorted((r.doc_id or 0, r.entities) for r in got) == [(0, 1), (1, 0), (2, 0), (3, 1), (3, 1)]
    assert {r.text for r in got if r.doc_id in (1, 2)} == {None, ""} and len({r.text for r in got if r.doc_id == 3}) == 1
    assert replace_entities(docs.limit(0), KEY).count() == 0


@pytest.mark.parametrize("kind", list(pii.KINDS))
def test_no_pattern_runs_away_on_long_texts(spark, kind):
    texts = ["1" * 100000, "a." * 50000, "1.2." * 25000, "Mr " * 30000, "(1) " * 25000, "A1B2 " * 20000, "a@" * 50000]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    assert docs.select(F.size(F.regexp_extract_all("text", F.lit(pii.KINDS[kind]), F.lit(0))).alias("n")).agg(F.sum("n")).head()[0] >= 0
