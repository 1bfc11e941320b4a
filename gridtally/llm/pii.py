"""Personal data: every detected entity gets a surrogate of the same type and form.

Only DataFrame and SQL functions run on the rows.  One pattern finds e-mail
addresses, card numbers, IP addresses, phone numbers, and names after a form of
address.  Sixteen digits in fours are a card number; those of other lengths (13
to 19 digits) have to have a valid check digit.  A name is all that follows the
form of address on its line: given names, initials, particles, compounds.

A surrogate is derived from a keyed hash of kind and value, whatever way the value is
written: numbers by their digits, phone numbers without the prefix of a long-distance
call, names and addresses without their case.  It is then laid into the form of each
mention: digits stand where digits stood, capitals where capitals stood, card numbers
keep a valid check digit, given names the gender that the form of address tells.  So
the same value gets the same surrogate everywhere; surrogates that collide with one
another, or with a value of the corpus that looks alike, are derived anew until none
does.  After a name was found, its family name alone is replaced in the rest of the
document too.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.staging import stage

# Forms of address by gender, and given names by script and gender.
ADDRESS_MALE = ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος", "Mister", "Herrn", "Sir", "Lord"]
ADDRESS_FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία", "Mlle", "Mademoiselle", "Señorita", "Srta", "Lady", "Madam"]
ADDRESS_ANY = ["Dr", "Doctor", "Doktor", "Prof", "Professor", "Доктор", "Профессор", "Δρ"]
#: Words of a name that are no name themselves.
PARTICLES = ["von", "van", "der", "den", "de", "del", "della", "di", "da", "dos", "du", "la", "le",
             "zu", "zum", "zur", "ten", "ter", "bin", "ibn", "al", "el", "af", "av"]
GIVEN = {
    ("latin", "male"): ["Adrian", "Bruno", "Conrad", "Daniel", "Emil", "Felix", "Gustav", "Hugo",
                        "Ivan", "Jonas", "Karl", "Leon", "Martin", "Nils", "Oscar", "Paul"],
    ("latin", "female"): ["Alma", "Berta", "Clara", "Diana", "Elena", "Flora", "Greta", "Helena",
                          "Irene", "Julia", "Karla", "Laura", "Maria", "Nora", "Olga", "Paula"],
    ("latin", "any"): ["Alexis", "Casey", "Charlie", "Dominique", "Jamie", "Jessie", "Kim", "Luca",
                       "Morgan", "Noel", "Quinn", "Robin", "Rowan", "Sascha", "Taylor", "Toni"],
    ("cyrillic", "any"): ["Валя", "Женя", "Саша", "Слава"],
    ("greek", "any"): ["Άλεξ", "Κάρολ", "Νίκι", "Ρένο"],
    ("cyrillic", "male"): ["Алексей", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Игорь", "Кирилл"],
    ("cyrillic", "female"): ["Алина", "Вера", "Галина", "Дарья", "Елена", "Инна", "Ксения", "Лидия"],
    ("greek", "male"): ["Ανδρέας", "Γιώργος", "Δημήτρης", "Κώστας", "Λουκάς", "Νίκος", "Πέτρος", "Στέφανος"],
    ("greek", "female"): ["Άννα", "Βασιλική", "Δήμητρα", "Ελένη", "Ιωάννα", "Κατερίνα", "Μαρία", "Σοφία"],
}
ALPHABET = {
    "latin": "bcdfghklmnprstvzaeiou",
    "cyrillic": "бвгдзклмнпрстаеиоу",
    "greek": "βγδζκλμνπρσταειου",
}
#: Consonants and vowels that take turns in a name that is made up.
SOUNDS = {
    "latin": ("bcdfghklmnprstvz", "aeiou"),
    "cyrillic": ("бвгдзклмнпрст", "аеиоу"),
    "greek": ("βγδζκλμνπρστ", "αειου"),
}
#: Ends of made-up given names by script and gender.
ENDINGS = {
    ("latin", "male"): "us", ("latin", "female"): "ina", ("latin", "any"): "y",
    ("cyrillic", "male"): "ий", ("cyrillic", "female"): "ия", ("cyrillic", "any"): "ша",
    ("greek", "male"): "ος", ("greek", "female"): "ια", ("greek", "any"): "ι",
}

#: Capital letters among which an initial gets another one.
CAPITALS = [
    [chr(c) for c in range(first, last) if chr(c).isupper()]
    for first, last in ((0x41, 0x5B), (0xC0, 0x250), (0x386, 0x3AC), (0x400, 0x430))
]

_ADDRESS = "|".join(sorted(ADDRESS_MALE + ADDRESS_FEMALE + ADDRESS_ANY, key=len, reverse=True))
_BLANK = "[ \t  ]"
_HEAD = rf"(?:(?:{_ADDRESS})(?:\.{_BLANK}{{0,3}}|{_BLANK}{{1,3}}))++"
_PARTICLES = rf"(?:(?:{'|'.join(PARTICLES)}){_BLANK}{{1,3}})*+"
# a word of two letters or more with hyphens and apostrophes (not that of a genitive), or initials
_NAME = (
    rf"(?!(?:{_ADDRESS})(?:\.|{_BLANK}))(?:(?:[dl]['’](?=\p{{Lu}}))?"
    r"\p{Lu}(?:[\p{L}\p{M}]|['’](?=\p{Lu}|\p{L}{3})|[-‐](?=\p{L}))++"
    rf"|\p{{Lu}}\.(?:-?\p{{Lu}}\.)*+|\p{{Lu}}(?={_BLANK}{{1,3}}\p{{Lu}}))"
)
_CARD = (
    # the digits after four fours may begin another entity
    r"(?<![0-9A-Za-z])(?:(?:[0-9]{4}[ -]){4}[0-9]{1,3}(?![ .-]?[0-9])(?![A-Za-z0-9._%+-]*+@)"
    r"|(?:[0-9]{4}[ -]?){3}[0-9]{4}"
    r"|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}|[0-9]{4}(?:[ -][0-9]{3}){3}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{5}"
    r"|[0-9]{6}[ -][0-9]{13}|[0-9]{13,19})(?![0-9A-Za-z])"
)
# digits of a phone number one by one, with what may stand before each; a card number is none
_DIGIT = rf"(?:[ .-]| ?\(|\)[ .-]?| ?/ ?| - )?(?!{_CARD})[0-9]"
_END = "(?![0-9A-Za-z])"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}"
    r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9]|\.[0-9])",
    "card": _CARD,
    "phone": r"(?<![0-9A-Za-z+])(?:"
    rf"\+1[ .-]?(?:\([0-9]{{3}}\)|[0-9]{{3}})[ .-]?[0-9]{{3}}[ .-]?[0-9]{{4}}{_END}"
    rf"|\+[1-9](?:{_DIGIT}){{6,14}}{_END}|00[1-9][0-9]{{0,2}}(?=[ .-])(?:{_DIGIT}){{6,12}}{_END}"
    rf"|(?:\+[0-9]{{1,3}}[ .-]?)?(?:\([0-9]{{2,4}}\)|[0-9]{{3}})[ .-]?[0-9]{{3}}[ .-][0-9]{{4}}{_END}"
    rf"|\([0-9]{{2,4}}\)[ .-]?[0-9]{{7}}{_END}|\(0[0-9]{{1,4}}\)(?:[ .-]?[0-9]){{5,9}}{_END})",
    "person": rf"(?<!\p{{L}})(?=[{''.join(sorted({a[0] for a in _ADDRESS.split('|')}))}])"
    rf"{_HEAD}{_PARTICLES}{_NAME}(?:(?:{_BLANK}{{1,3}}|(?<=\.)){_PARTICLES}{_NAME})*+",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())

#: Attempts after which a surrogate grows, for forms with few values.
GROW_AFTER = 8


def _kind(value: Column) -> Column:
    kind = F.lit("person")
    for name in reversed(list(PATTERNS)[:-1]):
        kind = F.when(value.rlike(f"^(?:{PATTERNS[name]})$"), F.lit(name)).otherwise(kind)
    return kind


def _script(value: Column) -> Column:
    return (
        F.when(value.rlike(r"\p{IsCyrillic}"), "cyrillic")
        .when(value.rlike(r"\p{IsGreek}"), "greek")
        .otherwise("latin")
    )


def _tokens(text: Column) -> Column:
    """Runs of letters and what lies between them; together the text."""
    return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{M}]++|[^\p{L}\p{M}]++"), F.lit(0))


def _name_units(value: Column) -> Column:
    """The last word of a name is the family's, those before it are given names."""
    head = F.regexp_extract(value, f"^{_HEAD}", 0)
    name = F.substring(value, F.length(head) + 1, F.length(value))
    gender = F.lit("any")
    for each, titles in (("female", ADDRESS_FEMALE), ("male", ADDRESS_MALE)):
        told = head.rlike(rf"(?<!\p{{L}})(?:{'|'.join(titles)})(?!\p{{L}})")
        gender = F.when(told, F.lit(each)).otherwise(gender)
    tokens = _tokens(name)
    family = F.size(tokens) - F.size(_tokens(F.regexp_extract(name, r"[^ \t\x{00A0}\x{202F}]+$", 0)))

    def unit(word: Column, i: Column) -> Column:
        short = F.length(word) == 1
        # the O of O'Brien stays like a particle
        prefix = short & F.coalesce(F.get(tokens, i + 1).rlike("^['’]"), F.lit(False))
        form = F.concat_ws(
            "-", F.when(i < family, F.concat(F.lit("given-"), gender)).otherwise("family"), _script(word)
        )
        kind = (
            F.when(~word.rlike(r"^\p{L}") | prefix | word.isin(*PARTICLES), "keep")
            .when(short, "initial")
            .otherwise(form)
        )
        return F.struct(kind.alias("kind"), word.alias("value"))

    first = F.array(F.struct(F.lit("keep").alias("kind"), head.alias("value")))
    return F.concat(first, F.transform(tokens, unit))


def _card_units(value: Column) -> Column:
    """Sixteen digits in fours, or any length with a valid check digit; other numbers stay."""

    def units(*parts: tuple[str, Column]) -> Column:
        return F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in parts])

    fours = value.rlike("^(?:[0-9]{4}[ -]?){3}[0-9]{4}$")
    return (
        F.when(fours | (_with_check_digit(value) == value), units(("card", value)))
        # a card number in fours, and a number after it
        .when(
            value.rlike("^(?:[0-9]{4}[ -]){4}"),
            units(
                ("card", F.substring(value, F.lit(1), F.lit(19))),
                ("keep", F.substring(value, F.lit(20), F.length(value))),
            ),
        )
        .otherwise(units(("keep", value)))
    )


def _units(value: Column, kind: Column) -> Column:
    """An entity as units to replace or to keep: names and card numbers in parts, all else whole."""
    return (
        F.when(kind == "person", _name_units(value))
        .when(kind == "card", _card_units(value))
        .otherwise(F.array(F.struct(kind.alias("kind"), value.alias("value"))))
    )


def _initial(key: str, value: Column) -> Column:
    """Another capital letter; different ones stay different."""
    old, new = [], []
    for letters in CAPITALS:
        order = sorted(letters, key=lambda c: hashlib.sha256(f"{key}\u0001initial\u0001{c}".encode()).digest())
        old += order
        new += order[1:] + order[:1]
    return F.translate(value, "".join(old), "".join(new))


def _draws(key: str, length: Column) -> Column:
    """An array of at least ``length`` numbers from 0 to 65535, keyed by kind, value and attempt."""
    seed = F.concat_ws("\u0001", F.lit(key), F.col("kind"), F.col("value"), F.col("attempt").cast("string"))
    blocks = F.transform(
        F.sequence(F.lit(0), F.ceil(length / 16).cast("int")),
        lambda b: F.sha2(F.concat_ws("\u0001", seed, b.cast("string")), 256),
    )
    text = F.array_join(blocks, "")
    return F.transform(
        F.sequence(F.lit(0), length),
        lambda i: F.conv(F.substring(text, i * 4 + 1, F.lit(4)), 16, 10).cast("int"),
    )


def _pick(letters: str, draw: Column) -> Column:
    return F.substring(F.lit(letters), draw % len(letters) + 1, F.lit(1))


def _spell(letters: str, draws: Column) -> Column:
    return F.array_join(F.transform(draws, lambda d: _pick(letters, d)), "")


def _same_form(value: Column, draws: Column) -> Column:
    """Digits for digits, letters for letters of the same case; the rest stays."""

    def one(c: Column, i: Column) -> Column:
        draw = F.get(draws, i)
        small = _pick(ALPHABET["latin"], draw)
        return (
            F.when(c.rlike("[0-9]"), _pick("0123456789", draw))
            .when(c.rlike(r"\p{Lu}"), F.upper(small))
            .when(c.rlike(r"\p{L}"), small)
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _with_check_digit(value: Column) -> Column:
    """Replace the last digit so that the Luhn sum of the digits is a multiple of 10."""
    body = F.split(F.reverse(F.regexp_replace(F.substring(value, F.lit(1), F.length(value) - 1), "[^0-9]", "")), "")
    doubled = F.transform(
        body,
        lambda c, i: F.when(i % 2 == 1, c.cast("int")).otherwise(
            (c.cast("int") * 2) % 10 + F.floor(c.cast("int") * 2 / 10).cast("int")
        ),
    )
    total = F.aggregate(doubled, F.lit(0), lambda a, x: a + x)
    return F.concat(
        F.substring(value, F.lit(1), F.length(value) - 1), ((10 - total % 10) % 10).cast("string")
    )


def _made_up(script: str, draws: Column, length: Column) -> Column:
    """A word of about ``length`` letters, consonants and vowels in turns."""
    consonants, vowels = SOUNDS[script]
    return F.array_join(
        F.transform(
            F.slice(draws, F.lit(1), length),
            lambda d, i: F.when(i % 2 == 0, _pick(consonants, d)).otherwise(_pick(vowels, d)),
        ),
        "",
    )


def _surrogate() -> Column:
    """The surrogate of (kind, value, attempt, draws), for the value as :func:`normal` writes it."""
    value, kind, attempt = F.col("value"), F.col("kind"), F.col("attempt")
    draws = F.col("draws")
    grown = F.when(
        attempt >= GROW_AFTER, _spell("0123456789", F.slice(draws, 1, 4))
    ).otherwise("")
    host = F.regexp_extract(value, r"@(.*)\.[^.]*$", 1)
    email = F.concat(
        _same_form(F.regexp_extract(value, "^([^@]*)@", 1), draws),
        grown,
        F.lit("@"),
        _same_form(host, F.reverse(draws)),
        F.regexp_extract(value, r"(\.[^.]*)$", 1),
    )
    ip = F.array_join(
        F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (F.get(draws, i) % 254 + 1).cast("string")), "."
    )
    phone = F.concat(_same_form(value, draws), grown)
    card = F.concat(_with_check_digit(_same_form(value, draws)), grown)
    out = (
        F.when(kind == "email", email)
        .when(kind == "ip", F.concat(ip, F.when(attempt >= GROW_AFTER, F.concat(F.lit("."), grown)).otherwise("")))
        .when(kind == "card", card)
        .when(kind == "phone", phone)
    )
    for script in ALPHABET:
        # every attempt has more letters to choose from
        letters = F.greatest(F.length(value), F.lit(6)) + attempt
        out = out.when(kind == f"family-{script}", _made_up(script, draws, letters))
        for gender in ("male", "female", "any"):
            names = [n.lower() for n in GIVEN[script, gender]]
            first = F.get(F.array(*map(F.lit, names)), F.get(draws, F.lit(0)) % len(names))
            # names are few: from the second attempt on they are made up
            more = F.concat(_made_up(script, draws, 2 + attempt), F.lit(ENDINGS[script, gender]))
            out = out.when(kind == f"given-{gender}-{script}", F.when(attempt == 0, first).otherwise(more))
    return out


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def normal(kind: Column, value: Column) -> Column:
    """A value without what is a matter of writing: mentions of one entity have the same."""
    called = _digits(F.regexp_replace(value, r"\(0\)", ""))
    called = F.when(value.startswith("00"), F.substring(called, F.lit(3), F.length(called))).otherwise(called)
    called = F.when(called.rlike("^1[0-9]{10}$"), F.substring(called, F.lit(2), F.length(called))).otherwise(called)
    return F.when(kind == "card", _digits(value)).when(kind == "phone", called).otherwise(F.lower(value))


def looks(kind: Column) -> Column:
    """Kinds that cannot be told apart by their looks share a name."""
    return (
        F.when(kind.rlike("^(?:given|family)-"), F.concat(F.lit("name-"), F.element_at(F.split(kind, "-"), -1)))
        .when(kind.isin("phone", "card"), F.lit("number"))
        .otherwise(kind)
    )


def _laid_digits(value: Column, digits: Column, skipped: Column) -> Column:
    """``digits`` in the places of the digits of ``value`` after the first ``skipped``; what is left over follows."""
    letters = F.split(value, "")

    def one(c: Column, i: Column) -> Column:
        before = F.length(_digits(F.substring(value, F.lit(1), i))) - skipped
        return F.when(c.rlike("[0-9]") & (before >= 0), F.substring(digits, before + 1, F.lit(1))).otherwise(c)

    there = F.length(_digits(value)) - skipped
    return F.concat(F.array_join(F.transform(letters, one), ""), F.substring(digits, there + 1, F.length(digits)))


def _laid_case(value: Column, word: Column) -> Column:
    """``word`` with capitals where ``value`` has them, letter by letter."""
    old = F.split(value, "")
    return F.array_join(
        F.transform(
            F.split(word, ""), lambda c, i: F.when(F.coalesce(F.get(old, i).rlike(r"\p{Lu}"), F.lit(False)), F.upper(c)).otherwise(c)
        ),
        "",
    )


def laid(kind: Column, value: Column, surrogate: Column) -> Column:
    """The surrogate of a normalised value in the form in which ``value`` is written."""
    # the zero of "(0)" is dialled at home only, and no part of the number
    home = F.regexp_replace(value, r"\(0\)", "(\u0001)")
    skipped = F.length(_digits(home)) - F.length(normal(kind, value))
    phone = F.translate(_laid_digits(home, surrogate, skipped), "\u0001", "0")
    local, host = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    new_local, new_host = F.substring_index(surrogate, "@", 1), F.substring_index(surrogate, "@", -1)
    name = (
        F.when((F.length(value) > 1) & (F.upper(value) == value), F.upper(surrogate))
        .when(F.lower(value) == value, surrogate)
        .otherwise(F.initcap(surrogate))
    )
    return (
        F.when(kind == "card", _laid_digits(value, surrogate, F.lit(0)))
        .when(kind == "phone", phone)
        .when(kind == "email", F.concat(_laid_case(local, new_local), F.lit("@"), _laid_case(host, new_host)))
        .when(kind == "ip", surrogate)
        .otherwise(name)
    )


def surrogates(values: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate): distinct surrogates for distinct (kind, value) rows.

    Values are written as :func:`normal` does.  A surrogate is accepted if no value
    that looks alike is the same and, of those that want it, goes to the smallest
    kind and value; the others try again.  The rounds end when none is left:
    surrogates grow after some attempts, so there is room.
    """
    values = stage(values.select("kind", "value").distinct(), "entities")
    taken = values.select(
        looks(F.col("kind")).alias("look"), F.col("value").alias("surrogate"), "kind", F.lit("").alias("value")
    )
    pending, accepted = values.withColumn("attempt", F.lit(0)), None
    while True:
        drawn = pending.withColumn("draws", _draws(key, F.length("value") + 8))
        wanted = stage(drawn.withColumn("surrogate", _surrogate()).drop("draws"), "surrogates")
        firsts = (
            wanted.select(looks(F.col("kind")).alias("look"), "surrogate", "kind", "value", F.lit(1).alias("_order"))
            .unionByName(taken.withColumn("_order", F.lit(0)))
            .groupBy("look", "surrogate")
            .agg(F.min(F.struct("_order", "kind", "value")).alias("_first"))
            .where("_first._order = 1")
            .select(F.col("_first.kind").alias("kind"), "surrogate", F.col("_first.value").alias("value"))
        )
        won = stage(firsts, "accepted")
        accepted = won if accepted is None else accepted.unionByName(won)
        lost = stage(wanted.join(won, ["kind", "value"], "left_anti"), "collisions")
        if not lost.limit(1).count():
            return accepted
        taken = taken.unionByName(won.select(looks(F.col("kind")).alias("look"), "surrogate", "kind", "value"))
        pending = lost.select("kind", "value", (F.col("attempt") + 1).alias("attempt"))


def replace_entities(
    docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, text with surrogates, n_entities.

    Mentions of an entity that are written in another way get the same surrogate in
    their own form.  A family name that stands alone, after a mention with a form of
    address in the same document, counts as an entity too.  NULL texts stay NULL with
    no entity; NULL ids stay; repeated rows give repeated results with the same
    surrogates; an empty table gives an empty result.  Only documents with an entity
    are shuffled.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = rows.withColumn("_found", F.regexp_extract_all("text", F.lit(ANY), F.lit(0)))
    plain = found.where(F.coalesce(F.size("_found"), F.lit(0)) <= 0).select(
        "doc_id", "text", F.lit(0).cast("long").alias("n_entities")
    )
    hit = found.where(F.size("_found") > 0).withColumn(
        # names a row; rows that are equal share their result
        "_row", F.sha2(F.concat_ws("\u0001", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text"), 256)
    )
    hit = stage(hit, "with-entities")
    entities = hit.select("_row", F.posexplode("_found").alias("_at", "_entity"))
    units = (
        entities.withColumn("_units", _units(F.col("_entity"), _kind(F.col("_entity"))))
        .select("_row", "_at", F.posexplode("_units").alias("_part", "_unit"))
        .select("_row", "_at", "_part", F.col("_unit.kind").alias("kind"), F.col("_unit.value").alias("written"))
        .withColumn("value", normal(F.col("kind"), F.col("written")))
    )
    units = stage(units.distinct(), "units")
    fixed = F.col("kind").isin("keep", "initial")
    known = surrogates(units.where(~fixed), key)
    kept = units.where(fixed).withColumn(
        "surrogate", F.when(F.col("kind") == "initial", _initial(key, F.col("written"))).otherwise(F.col("written"))
    )
    renamed = (
        units.where(~fixed)
        .join(known, ["kind", "value"])
        .withColumn("surrogate", laid(F.col("kind"), F.col("written"), F.col("surrogate")))
    )
    family = F.col("kind").startswith("family-") & (F.length("written") > 1)
    replaced = (
        renamed.unionByName(kept)
        .groupBy("_row")
        .agg(
            F.sort_array(F.collect_set(F.struct("_at", "_part", "surrogate"))).alias("_new"),
            # a number that turned out to be no card number is no entity
            F.size(F.collect_set(F.when(F.col("kind") != "keep", F.col("_at")))).alias("_n"),
            F.sort_array(F.collect_set(F.when(family, F.struct("_at", "written", "surrogate")))).alias("_families"),
        )
    )
    joined = hit.join(replaced, "_row")
    between = F.split("text", ANY, -1)
    new = F.transform(
        F.sequence(F.lit(0), F.size("_found") - 1),
        lambda i: F.array_join(
            F.transform(F.filter("_new", lambda n: n["_at"] == i), lambda n: n["surrogate"]), ""
        ),
    )
    # one pattern a document; names are letters, so nothing in them needs an escape
    alone = F.concat(
        F.lit(r"(?<![\p{L}\p{M}])(?:"),
        F.array_join(F.array_distinct(F.transform("_families", lambda f: f["written"])), "|"),
        F.lit(r")(?![\p{L}\p{M}])"),
    )
    parts = joined.select(
        "doc_id", "_n", "_families", alone.alias("_alone"), new.alias("_entities"),
        F.when(F.size("_families") > 0, between).alias("_between"),
        F.when(F.size("_families") == 0, F.array_join(F.zip_with(between, new, _joined), "")).alias("_done"),
    )

    def later(part: Column, i: Column) -> Column:
        """A part of the text between entities, family names of earlier ones replaced in it."""
        words = F.regexp_extract_all(part, F.col("_alone"), F.lit(0))
        replaced = F.transform(
            words,
            lambda w: F.coalesce(
                F.get(F.filter("_families", lambda f: (f["written"] == w) & (f["_at"] < i)), F.lit(0))["surrogate"], w
            ),
        )
        return F.struct(
            F.array_join(F.zip_with(F.split(part, F.col("_alone"), -1), replaced, _joined), "").alias("text"),
            F.aggregate(
                F.zip_with(words, replaced, lambda a, b: (a != b).cast("int")), F.lit(0), lambda n, x: n + x
            ).alias("n"),
        )

    done = parts.withColumn("_later", F.when(F.size("_families") > 0, F.transform("_between", later)))
    text = F.array_join(F.zip_with(F.transform("_later", lambda p: p["text"]), F.col("_entities"), _joined), "")
    more = F.aggregate(F.transform("_later", lambda p: p["n"]), F.lit(0), lambda n, x: n + x)
    return plain.unionByName(
        done.select(
            "doc_id",
            F.coalesce("_done", text).alias("text"),
            (F.col("_n") + F.coalesce(more, F.lit(0))).cast("long").alias("n_entities"),
        )
    )


def _joined(a: Column, b: Column) -> Column:
    return F.concat(a, F.coalesce(b, F.lit("")))
