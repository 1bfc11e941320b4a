"""Surrogates of personal data: same form, same value same surrogate, never two alike."""

import re

import pytest
import regex
from pyspark.sql import functions as F

from gridtally.llm import pii

ROWS = [
    (1, "Mr. John Smith met Frau Anna Schmidt and Mrs Smith; a.B9@x.org, +1 (974) 555-1257"),
    (2, None),
    (3, ""),
    (4, "Herr Max Smith; Господин Иван Петров, a.B9@x.org 4111 1111 1111 1111 10.0.0.1."),
    (5, "plain words only 12 34"),
    (6, "10.0.0.1 " * 3),
    (6, "10.0.0.1 " * 3),
    (None, "mail b.B9@x.org"),
    (7, "word " * 40_000 + "c@d.example"),
]


@pytest.fixture(scope="module")
def replaced(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    docs = docs.withColumns({c: F.lit("x") for c in ("kind", "value", "_row", "surrogate", "attempt")})
    out = pii.replace_entities(docs.repartition(3), "key")
    assert out.columns == ["doc_id", "text", "n_entities"]
    assert pii.replace_entities(docs.limit(0), "key").collect() == []
    return out.collect()


def test_form_gender_script_and_coreference(replaced):
    assert len(replaced) == len(ROWS)
    text = {r.doc_id: r.text for r in replaced}
    assert text[2] is None and text[3] == "" and text[5] == ROWS[4][1]
    found = re.fullmatch(
        r"Mr\. (\w+) (\w+) met Frau (\w+) (\w+) and Mrs (\w+); ([a-z])\.([A-Z])(\d)@([a-z])\.org, "
        r"\+\d \(\d{3}\) \d{3}-\d{4}", text[1],
    )
    assert found
    given_male, smith, given_female, schmidt, again = found.groups()[:5]
    assert smith == again != schmidt and "Smith" not in text[1]
    assert given_male in pii.GIVEN["latin", "male"] and given_female in pii.GIVEN["latin", "female"]
    mail = re.search(r"\S+@\S+(?=,)", text[1])[0]
    other = re.fullmatch(
        r"Herr (\w+) (\w+); Господин ([А-я]+) ([А-я]+), (\S+) (\d{4} \d{4} \d{4} \d{4}) ([\d.]+)\.", text[4]
    )
    assert other and other[2] == smith and other[5] == mail
    assert other[3] in pii.GIVEN["cyrillic", "male"] and other[4] != "Петров"
    digits = [int(d) for d in other[6] if d != " "][::-1]
    assert (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0
    assert text[6] == f"{other[7]} " * 3
    assert [r.text for r in replaced if r.doc_id == 6] == [text[6]] * 2
    assert text[None] != "mail " + mail and text[7].startswith("word ") and "c@d" not in text[7]
    assert {r.doc_id: r.n_entities for r in replaced} == {1: 5, 2: 0, 3: 0, 4: 5, 5: 0, 6: 3, None: 1, 7: 1}


def test_surrogates_stay_distinct_where_room_is_short(spark):
    # all numbers of one digit: every surrogate collides until it grows
    rows = [("phone", str(d)) for d in range(10)] + [("email", "a@b.c"), ("email", "b@b.c")]
    rows += [("given-male-latin", f"Name{i}") for i in range(100)]
    found = pii.surrogates(spark.createDataFrame(rows, "kind string, value string"), "k").collect()
    assert len(found) == len(rows)
    assert len({r.surrogate for r in found}) == len(rows)
    assert not {(r.kind, r.surrogate) for r in found} & set(rows)


def test_another_key_gives_other_surrogates(spark):
    values = spark.createDataFrame([("phone", "5551234567")], "kind string, value string")
    first, again, other = (pii.surrogates(values, k).first().surrogate for k in ("a", "a", "b"))
    assert first == again != other and re.fullmatch(r"\d{10}", first)


def test_main_path_is_native(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    plan = pii.replace_entities(docs, "key")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def replace_all(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(pii.replace_entities(docs, "key").collect())
    return [(r.text, r.n_entities) for r in rows]


NAMES = [
    ("Mr McDonald said", r"Mr (\w+) said", "McDonald"),
    ("Frau Müller-Lüdenscheidt kam", r"Frau (\w+-\w+) kam", "Müller Lüdenscheidt"),
    ("Mr John Paul Smith and", r"Mr (\w+ \w+ \w+) and", "John Smith"),
    ("Mr J. Smith, Mr J.R. Smith", r"Mr ([A-Z]\. \w+), Mr ([A-Z]\.[A-Z]\. \w+)", "J. Smith"),
    ("Mrs O'Brien's house", r"Mrs (O'\w+)'s house", "Brien"),
    ("Dr Smith. He", r"Dr (\w+)\. He", "Smith"),
    ("Herr Prof. Dr. Max von Stein ging", r"Herr Prof\. Dr\. (\w+ von \w+) ging", "Max Stein"),
    ("Mr Smith Mrs Jones", r"Mr (\w+) Mrs (\w+)", "Smith Jones"),
    ("Doctor Κώστα Παπαδόπουλος", r"Doctor (\w+ \w+)", "Κώστα Παπαδόπουλος"),
]


def test_names_are_replaced_whole(spark):
    found = replace_all(spark, [text for text, _, _ in NAMES])
    for (text, form, gone), (new, n) in zip(NAMES, found, strict=True):
        match = re.fullmatch(form, new)
        assert match and n == len(match.groups()), (text, new)
        assert not any(word in new for word in gone.split()), (text, new)


def luhn(digits):
    digits = [int(d) for d in digits if d.isdigit()][::-1]
    return (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0


def test_cards_of_other_lengths_and_international_phones(spark):
    cards = ["378282246310005", "3782 822463 10005", "30569309025904", "4222222222222", "6304000000000000000",
             "6304 0000 0000 0000 000", "4111 1111 1111 1112"]
    phones = ["+44 20 7946 0958", "+49 (0)30 901820", "+33 1 23 45 67 89", "+442079460958", "0044 20 7946 0958",
              "(974) 5551257", "+19745551257", "+1 974 5551257"]
    others = ["378282246310006", "12345678901234", "2024-01-02 12:30", "1234567"]
    found = replace_all(spark, [f"a {v}, b" for v in cards + phones + others])
    for value, (new, n) in zip(cards + phones, found, strict=False):
        shape = lambda t: re.sub("[0-9]", "9", t)
        assert n == 1 and new != f"a {value}, b" and shape(new) == shape(f"a {value}, b"), (value, new)
        assert value not in cards or luhn(new)
    assert found[len(cards + phones) :] == [(f"a {v}, b", 0) for v in others]
    mixed = replace_all(
        spark, ["4111 1111 1111 1111 12 men", "4111 1111 1111 1111 974-555-1257", "+49 30 901820 4111 1111 1111 1111",
                "4111 1111 1111 1111 12.a@x.org"],
    )
    assert [n for _, n in mixed] == [1, 2, 2, 2] and mixed[0][0].endswith(" 12 men")
    assert not any("1111" in t or "555" in t or "901820" in t or "12.a" in t for t, _ in mixed)


def test_one_entity_in_several_forms(spark):
    texts = [
        "card 4111 1111 1111 1111 and 4111111111111111 and 4111-1111-1111-1111.",
        "call +1 (974) 555-1257, (974) 555-1257, 974-555-1257 or 001 974 555 1257",
        "+49 (0)30 901820, +49 30 901820, 0049 30 901820",
        "Jane.Doe@Mail.example, jane.doe@mail.example, JANE.DOE@MAIL.EXAMPLE",
        "Mr Smith and MR SMITH; Mr SMITH",
    ]
    found = replace_all(spark, texts)
    assert [n for _, n in found] == [3, 4, 3, 3, 2]
    same = lambda t, pattern: {re.sub("[^0-9]", "", v)[-10:] for v in re.findall(pattern, t)}
    assert len(same(found[0][0], r"[0-9][0-9 -]{14,}[0-9]")) == 1
    assert len(same(found[1][0], r"[0-9+(][0-9 ()-]{9,}[0-9]")) == 1 and "+1 (" in found[1][0] and " 001 " in found[1][0]
    german = re.fullmatch(r"\+(\d\d) \(0\)(\d\d) (\d{6}), \+(\d\d) (\d\d) (\d{6}), 00(\d\d) (\d\d) (\d{6})", found[2][0])
    assert german and german.groups()[:3] == german.groups()[3:6] == german.groups()[6:]
    first, low, high = found[3][0].split(", ")
    assert first.lower() == low == high.lower() and high == high.upper() and re.match(r"[A-Z][a-z]+\.[A-Z]", first)
    smith = re.fullmatch(r"Mr (\w+) and MR SMITH; Mr (\w+)", found[4][0])
    assert smith and smith[1].upper() == smith[2]


def test_family_names_alone(spark):
    texts = [
        "Smith came. Mr John Smith sat. Then Smith's dog and Smithson left, said Smith.",
        "Mrs Green met Herr Grün. Green, green, Grün and GRÜN. Dr Green agreed with Grün.",
        "Господин Иван Петров ушёл. Петров вернулся.",
        "Smith is no entity here",
    ]
    (one, n1), (two, n2), (three, n3), (four, n4) = replace_all(spark, texts)
    found = re.fullmatch(r"Smith came\. Mr (\w+) (\w+) sat\. Then (\w+)'s dog and Smithson left, said (\w+)\.", one)
    assert found and found[2] == found[3] == found[4] != "Smith" and n1 == 3
    found = re.fullmatch(r"Mrs (\w+) met Herr (\w+)\. (\w+), green, (\w+) and GRÜN\. Dr (\w+) agreed with (\w+)\.", two)
    assert found and found[1] == found[3] == found[5] and found[2] == found[4] == found[6] and n2 == 6
    assert re.fullmatch(r"Господин \w+ (\w+) ушёл\. \1 вернулся\.", three) and "Петров" not in three and n3 == 2
    assert (four, n4) == (texts[3], 0)


def plain_normal(kind, value):
    if kind not in ("card", "phone"):
        return value.lower()
    if kind == "phone":
        called = re.sub("[^0-9]", "", value.replace("(0)", ""))
        called = called[2:] if value.startswith("00") else called
        return called[1:] if re.fullmatch("1[0-9]{10}", called) else called
    return re.sub("[^0-9]", "", value)


def plain_laid(kind, value, new):
    if kind in ("card", "phone"):
        digits = [i for i, c in enumerate(value) if c.isdigit() and value[i - 1 : i + 2] != "(0)"]
        digits = digits[len(digits) - len(plain_normal(kind, value)) :]
        out = list(value)
        for i, c in zip(digits, new):
            out[i] = c
        return "".join(out) + new[len(digits) :]
    if kind == "email":
        sides = zip(value.split("@", 1), new.split("@", 1))
        return "@".join("".join(c.upper() if i < len(a) and a[i].isupper() else c for i, c in enumerate(b)) for a, b in sides)
    return new if kind == "ip" else None


@pytest.mark.parametrize("folder", ["sf0.01"])
def test_replacement_equals_plain_find_and_replace(spark, folder):
    """Entities by Python's regular expressions, replaced one by one; names by what stands in their place."""
    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet").select("doc_id", "text")
    rows = {r.doc_id: r.text or "" for r in docs.collect()}
    found = {r.doc_id: r for r in pii.replace_entities(docs, "key").collect()}
    anything = regex.compile(pii.ANY)
    kinds = {k: regex.compile(v) for k, v in pii.PATTERNS.items()}
    new_of, seen = {}, set()
    for key, text in rows.items():
        out, at, n, families = found[key].text, 0, 0, {}
        done = 0
        for match in [*anything.finditer(text), None]:
            between = text[done : match.start() if match else len(text)]
            for word in regex.findall(r"[\p{L}\p{M}]+|[^\p{L}\p{M}]+", between):
                wanted = families.get(word, word)
                n += word in families
                assert out.startswith(wanted, at), (key, word, out[at : at + 30])
                at += len(wanted)
            if match is None:
                break
            done, value = match.end(), match[0]
            kind = next(k for k, p in kinds.items() if k == "person" or p.fullmatch(value))
            n += 1
            if kind == "person":
                # word for word: the form of address stays, and the last word is the family's
                words = regex.findall(r"[\p{L}\p{M}]+|[^\p{L}\p{M}]+", value)
                made = regex.match("".join(r"([\p{L}\p{M}]+)" if w[0].isalpha() else regex.escape(w) for w in words), out[at:])
                assert made, (value, out[at : at + 40])
                pairs = [(w, m) for w, m in zip([w for w in words if w[0].isalpha()], made.groups()) if w != m]
                assert pairs and pairs[-1][0] == [w for w in words if w[0].isalpha()][-1]
                families[pairs[-1][0]] = pairs[-1][1]
                assert new_of.setdefault(("family", pairs[-1][0].lower()), pairs[-1][1].lower()) == pairs[-1][1].lower()
                seen.add(pairs[-1][1].lower())
                at += made.end()
            else:
                normal = plain_normal(kind, value)
                width = len(value) if kind != "ip" else len(regex.match(r"[0-9.]*[0-9]", out[at:])[0])
                made = out[at : at + width]
                if kind == "card" and made == value:
                    n -= 1  # no card number
                else:
                    new = new_of.setdefault((kind, normal), plain_normal(kind, made))
                    assert new == plain_normal(kind, made) != normal
                    assert made == (plain_laid(kind, value, new) or made)
                at += width
        assert at == len(out) and n == found[key].n_entities, key
    assert len(new_of) > 50 and len({(k, v) for (k, _), v in new_of.items()}) == len(new_of)
    assert not {(k, v) for (k, _), v in new_of.items()} & set(new_of)
