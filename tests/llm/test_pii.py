import re

import pytest
from helpers import AWKWARD, frame

from topicflow.llm import pii


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed([int(c) for c in digits if c.isdigit()])):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


@pytest.fixture(scope="module")
def shown(spark):
    rows = list(AWKWARD) + [
        (20, "write to Ann.Lee@Mail5.example.com or ann.lee@mail5.example.com, or ANN.LEE@MAIL5.EXAMPLE.COM."),
        (21, "call +1 (555) 123-4567 or +1 555 123 4567"),
        (22, "card 4785380592391139; again 4785 3805 9239 1139"),
        (23, "host 8.196.197.208 twice 8.196.197.208."),
        (24, "Mrs. Jones met Mr. Jones, Herr Müller and Госпожа Иванова"),
        (25, "ssn 123-45-6789, iban DE89 3704 0044 0532 0130 00"),
        (26, "mail ann.lee@mail5.example.com" + " x" * 50_000),
        (27, "no entity 1234 5678 here, v1.2.3"), (28, "ring (555) 123-4567"), (28, "ring (555) 123-4567"),
        (29, "a@b.co and c@b.co"),
    ]
    return rows, pii.pseudonymised(frame(spark, rows), "k1").collect()


def of(found, doc):
    return [r for r in found[1] if r.doc_id == doc][0].text


def test_rows_and_clean_texts_are_unchanged(shown):
    rows, found = shown
    assert len(found) == len(rows)
    clean = {(r[0], r[1]) for r in rows if r[0] is None or r[0] < 20 or r[0] == 27}
    assert {(r.doc_id, r.text) for r in found if r.n_entities == 0} == clean


def test_nothing_personal_is_left(shown):
    text = " ".join(r.text or "" for r in shown[1])
    for part in ("ann.lee", "Ann.Lee", "ANN.LEE", "123-4567", "123 4567", "478538", "8.196", "Jones", "Müller", "Иванова", "6789", "3704"):
        assert part not in text


def test_formats_fit(shown):
    one, two, three = re.findall(r"\S+@\S+[a-zA-Z]", of(shown, 20))
    assert one == two and three == one.upper() and re.fullmatch(r"[a-z]{3}\.[a-z]{3}@[a-z]{4}\d\.[a-z]{7}\.com", one)
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} or \+1 \d{3} \d{3} \d{4}", of(shown, 21))
    cards = re.findall(r"\d{16}|\d{4}(?: \d{4}){3}", of(shown, 22))
    assert len(cards) == 2 and cards[0] == cards[1].replace(" ", "") and luhn(cards[0])
    first, second = re.findall(r"\d+\.\d+\.\d+\.\d+", of(shown, 23))
    assert first == second and all(int(x) < 256 for x in first.split("."))
    names = re.fullmatch(r"Mrs\. (\w+) met Mr\. (\w+), Herr (\w+) and Госпожа ([А-Яа-я]+)", of(shown, 24)).groups()
    assert [n[0].isupper() for n in names] == [True] * 4 and names[0].endswith("na") and names[3].endswith("на")
    assert re.fullmatch(r"ssn \d{3}-\d{2}-\d{4}, iban DE\d\d( \d{4}){4} \d\d", of(shown, 25))


def test_same_entity_same_surrogate_and_others_differ(shown, spark):
    assert re.search(r"\S+@\S+", of(shown, 26))[0] == re.findall(r"\S+@\S+[a-z]", of(shown, 20))[0]
    a, b = re.findall(r"\S+@\S+", of(shown, 29))
    assert a != b
    other = pii.pseudonymised(frame(spark, [r for r in shown[0] if r[0] == 20]), "k2").first().text
    assert other != of(shown, 20)
    assert pii.pseudonymised(frame(spark, []), "k1").collect() == []


def test_collisions_are_drawn_again(spark):
    entities = spark.createDataFrame([("ssn", f"{i:02d}") for i in range(0, 100, 5)], "kind string, core string")
    found = pii.surrogates(entities, "k").collect()
    given = {r.substitute for r in found}
    assert len(found) == len(given) == 20 and not given & {r.core for r in found}


def test_native(spark):
    plan = pii.pseudonymised(frame(spark, AWKWARD), "k")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_more_entities_than_their_form_has_values(spark):
    """Addresses of single letters, numbers of few digits, names in any number: never an error, never two alike."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    mails = [f"{a}@{b}.co" for a in letters for b in letters]
    entities = [("mail", m) for m in mails] + [("ssn", str(n)) for n in range(10, 90)] + [("card", f"{n}") for n in range(100, 400)]
    entities += [("man", "Γιώργος"), ("woman", "Иванова"), ("man", "Smith")]
    found = pii.surrogates(spark.createDataFrame(entities, "kind string, core string"), "k").collect()
    assert len(found) == len(entities)
    shown = {(r.kind, r.substitute) for r in found}
    assert len(shown) == len(entities) and not shown & set(entities)
    by_core = {r.core: r.substitute for r in found}
    assert re.fullmatch("[Α-Ω][α-ω]+", by_core["Γιώργος"])
    assert re.fullmatch("[А-Я][а-я]+", by_core["Иванова"]) and re.fullmatch("[A-Z][a-z]+", by_core["Smith"])
    assert all(re.fullmatch(r"[a-z0-9]+@[a-z]\.co", by_core[m]) for m in mails)


def test_further_digits_are_shown(spark):
    row = spark.sql("select 'phone' as kind, '(555) 123-4567' as raw, '555987654321' as core")
    assert row.select(pii.rendered(row["kind"], row["raw"], row["core"])).first()[0] == "(555) 987-654321"
