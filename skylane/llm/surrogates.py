"""PII surrogates: detected entities get keyed replacements of the same type and format.

Detected are e-mail addresses, IPv4 addresses, payment cards, social security and phone
numbers, IBANs, access keys, values of ``password``, ``token`` and the like, and names
behind a title. A replacement follows from a secret key and the entity's canonical form:
digits stand for digits, letters for letters of the same case and script, separators stay,
cards that pass the check digit test pass it again, country codes, private address ranges
and top-level domains stay, and a name keeps the gender of its title and its script.

Equal entities have equal replacements in all documents and in all their spellings
(coreference), different ones different replacements (distinctness): replacements that two
entities share, or that are themselves an entity of the corpus, are drawn again. What is
open after ``MAX_DRAWS`` draws is settled by number: the open entities of a format take its
free replacements in order, and those for which the format has none left get a longer one
(an address of a full private range one of ``10.``, then an IPv6 address). Names are
replaced word by word, so that ``Mr Smith`` and ``Mr John Smith`` share a word afterwards
as well. A run of signs without a letter or digit, such as ``password: ______``, is no secret.

A null text stays null, a text without an entity stays as it is; rows are told apart by
place, so repeated rows and missing ids do no harm. All of it is DataFrame functions. The
rows of a frequent entity are only counted and joined with the one row it has on the right.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylane.llm import rows
from skylane.operators import dimensions

KEY = "surrogates"
MAX_DRAWS = 40

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_MALE = "Mr|Herr|Monsieur|Señor|Sr|Don|г-н|господин"
_FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Doña|г-жа|госпожа"
_OTHER = "Dr|Prof"
_NAME = r"\p{Lu}[\p{L}'-]*\p{L}"
# In the order in which they are tried at a place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,126}\.[A-Za-z]{2,}",
    "secret": r"(?<=(?i:password|passwd|pwd|token|secret|api_?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?)(?=[+/_-]*[A-Za-z0-9])[A-Za-z0-9+/_-]{6,}",
    "key": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "card": r"(?<![\d-])\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}(?![\d-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?\(?\d{3}\)?[ .-]?\d{3}[ .-]\d{4}(?!\d)|\+\d{1,3}(?:[ .-]?\d{2,4}){3,4}(?!\d)",
    "name": rf"(?<!\p{{L}})(?:{_MALE}|{_FEMALE}|{_OTHER})\.? {_NAME}(?: {_NAME})?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# What every entity has one of; texts without are not searched any further.
HINT = rf"[0-9@=:]|{_MALE}|{_FEMALE}|{_OTHER}"

# Syllables of made-up names by script.
_LATIN = ("ba", "den", "lo", "mir", "ka", "ren", "so", "tal", "vi", "nor", "pe", "lan", "ro", "gil", "fa", "mon")
_GREEK = ("μπα", "δεν", "λο", "μιρ", "κα", "ρεν", "σο", "ταλ", "βι", "νορ", "πε", "λαν", "ρο", "γκιλ", "φα", "μον")
_CYRILLIC = ("ба", "ден", "ло", "мир", "ка", "рен", "со", "тал", "ви", "нор", "пе", "лан", "ро", "гил", "фа", "мон")


def mentions(text: Column) -> Column:
    """Array of the entities of a text, in order and as they are written."""
    none = F.array().cast("array<string>")
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(none)


def kind_of(mention: Column) -> Column:
    """Type of an entity, from how it is written."""
    found = F.lit("secret")
    for kind in reversed([k for k in PATTERNS if k != "secret"]):
        found = F.when(mention.rlike(f"^(?:{PATTERNS[kind]})$"), F.lit(kind)).otherwise(found)
    return found


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def canonical(kind: Column, mention: Column) -> Column:
    """What spellings of one entity have in common."""
    digits = _digits(mention)
    national = F.when((F.length(digits) == 11) & digits.startswith("1"), F.substr(digits, F.lit(2))).otherwise(digits)
    return (
        F.when(kind == "phone", national)
        .when(kind.isin("card", "ssn"), digits)
        .when(kind == "iban", F.replace(mention, F.lit(" "), F.lit("")))
        .when(kind == "email", F.lower(mention))
        .when(kind.startswith("name"), F.initcap(mention))
        .otherwise(mention)
    )


def _draw(key: str, *parts: Column) -> Column:
    """A number from 0 to 2^32 - 1 that depends on the secret key and the parts."""
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), *[p.cast("string") for p in parts]), 256)
    return F.conv(F.substr(digest, F.lit(1), F.lit(8)), 16, 10).cast("long")


def _pick(letters: str, drawn: Column) -> Column:
    return F.substr(F.lit(letters), (drawn % len(letters) + 1).cast("int"), F.lit(1))


def _letters(key: str, kind: Column, value: Column, draw: Column) -> Column:
    """``value`` with each letter and digit replaced by one of its kind."""
    hexadecimal = value.rlike("^[0-9a-f]{8,}$") & value.rlike("[0-9]") & value.rlike("[a-f]")

    def one(c: Column, i: Column) -> Column:
        drawn = _draw(key, kind, value, draw, i)
        return (
            F.when(hexadecimal, _pick("0123456789abcdef", drawn))
            .when(c.rlike("[0-9]"), _pick("0123456789", drawn))
            .when(c.rlike("[a-z]"), _pick(rows.LOWER, drawn))
            .when(c.rlike("[A-Z]"), _pick(rows.UPPER, drawn))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _check_digit(digits: Column) -> Column:
    """Sum of the payment card test; a multiple of ten when the number passes."""
    places = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.struct(F.coalesce(c.try_cast("int"), F.lit(0)).alias("d"), i.alias("i")))
    doubled = F.transform(
        places, lambda x: F.when(x["i"] % 2 == 0, x["d"]).otherwise((x["d"] * 2) % 10 + F.floor(x["d"] * 2 / 10).cast("int"))
    )
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + d)


def _card(key: str, kind: Column, value: Column, draw: Column) -> Column:
    body = F.concat(F.substr(value, F.lit(1), F.lit(1)), F.substr(_letters(key, kind, value, draw), F.lit(2), F.lit(14)))
    missing = (10 - _check_digit(F.concat(body, F.lit("0"))) % 10) % 10
    # A number that fails the test keeps failing it by as much.
    return F.concat(body, ((missing + _check_digit(value)) % 10).cast("string"))


def _address(key: str, kind: Column, value: Column, draw: Column) -> Column:
    octet = lambda i: (_draw(key, kind, value, draw, F.lit(i)) % 254 + 1).cast("string")
    kept = (
        F.when(value.rlike(r"^(10|127)\."), 1).when(value.rlike(r"^(192\.168|169\.254|172\.(1[6-9]|2\d|3[01]))\."), 2).otherwise(0)
    )
    # Public addresses begin with a number that no special range begins with.
    public = (_draw(key, kind, value, draw, F.lit(0)) % 80 + 11).cast("string")
    parts = F.split(value, r"\.")
    part = lambda i: F.get(parts, F.lit(i))
    return F.concat_ws(
        ".", F.when(kept > 0, part(0)).otherwise(public), F.when(kept > 1, part(1)).otherwise(octet(1)), octet(2), octet(3)
    )


def _email(key: str, kind: Column, value: Column, draw: Column) -> Column:
    """Local part and domain apart, so that one domain has one replacement."""
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    top = F.substring_index(domain, ".", -1)
    below = F.substr(domain, F.lit(1), F.length(domain) - F.length(top) - 1)

    def one(c: Column, i: Column) -> Column:
        drawn = _draw(key, kind, value, draw, i)
        return (
            F.when(c.rlike("[0-9]"), _pick("0123456789", drawn)).when(c.rlike("[a-z]"), _pick(rows.LOWER, drawn)).otherwise(c)
        )

    new_local = F.array_join(F.transform(F.split(local, ""), one), "")
    return F.concat(new_local, F.lit("@"), _letters(key, F.lit("domain"), below, F.lit(0)), F.lit("."), top)


def _phone(key: str, kind: Column, value: Column, draw: Column) -> Column:
    first = (_draw(key, kind, value, draw, F.lit("first")) % 8 + 2).cast("string")
    # With more than ten digits the first ones are the country's.
    country = F.greatest(F.length(value) - 10, F.lit(0))
    rest = F.substr(_letters(key, kind, value, draw), country + 2)
    return F.concat(F.substr(value, F.lit(1), country), first, rest)


def _by_script(value: Column, latin: str | Column, cyrillic: str | Column, greek: str | Column) -> Column:
    """One of three by the script of a name; names of other scripts with capitals get Latin ones."""
    value_of = lambda c: F.lit(c) if isinstance(c, str) else c
    return (
        F.when(value.rlike(r"\p{IsCyrillic}"), value_of(cyrillic)).when(value.rlike(r"\p{IsGreek}"), value_of(greek))
        .otherwise(value_of(latin))
    )


def _ending(kind: Column, value: Column) -> Column:
    return (
        F.when(kind == "name_f", _by_script(value, "na", "на", "να"))
        .when(kind == "name_m", _by_script(value, "dor", "тор", "τωρ"))
        .otherwise(_by_script(value, "lin", "лин", "λιν"))
    )


def _made_up(key: str, kind: Column, value: Column, draw: Column) -> Column:
    """A made-up name word of the script and gender; more draws make it longer."""
    count = (2 + F.floor(draw / 3)).cast("int")
    syllable = lambda names: F.array_join(
        F.transform(
            F.sequence(F.lit(1), count),
            lambda i: F.get(F.array(*map(F.lit, names)), (_draw(key, kind, value, draw, i) % len(names)).cast("int")),
        ),
        "",
    )
    return F.initcap(
        F.concat(_by_script(value, syllable(_LATIN), syllable(_CYRILLIC), syllable(_GREEK)), _ending(kind, value))
    )


def replacement(key: str, kind: Column, value: Column, draw: Column) -> Column:
    """Replacement of a canonical entity at its ``draw``-th draw."""
    return (
        F.when(kind.startswith("name"), _made_up(key, kind, value, draw))
        .when(kind == "card", _card(key, kind, value, draw))
        .when(kind == "ip", _address(key, kind, value, draw))
        .when(kind == "email", _email(key, kind, value, draw))
        .when(kind == "phone", _phone(key, kind, value, draw))
        .when(kind == "iban", F.concat(F.substr(value, F.lit(1), F.lit(2)), F.substr(_letters(key, kind, value, draw), F.lit(3))))
        .when(kind == "key", F.concat(F.lit("AKIA"), F.substr(_letters(key, kind, value, draw), F.lit(5))))
        .otherwise(_letters(key, kind, value, draw))
    )


# Free places of a format's pattern: a sign, how many values it has, and the value of a number.
_PLACES = {
    "0": (10, lambda d: d.cast("string")),
    "2": (8, lambda d: (d + 2).cast("string")),
    "a": (26, lambda d: _pick(rows.LOWER, d)),
    "A": (26, lambda d: _pick(rows.UPPER, d)),
    "h": (16, lambda d: _pick("0123456789abcdef", d)),
    "o": (254, lambda d: (d + 1).cast("string")),
    "x": (256, lambda d: d.cast("string")),
    "p": (80, lambda d: (d + 11).cast("string")),
    "s": (16, lambda d: F.get(F.array(*map(F.lit, _LATIN)), d.cast("int"))),
    "c": (16, lambda d: F.get(F.array(*map(F.lit, _CYRILLIC)), d.cast("int"))),
    "g": (16, lambda d: F.get(F.array(*map(F.lit, _GREEK)), d.cast("int"))),
}
_FORMAT = ["kind", "prefix", "pattern", "suffix"]
# The own format, then a longer one; a full private range first takes a larger one.
_STEPS = 3
_COUNTLESS = 10**18


def _format(key: str, kind: Column, value: Column, step: int) -> Column:
    """Prefix, pattern and suffix that the replacements of a canonical entity have in common."""
    hexadecimal = value.rlike("^[0-9a-f]{8,}$") & value.rlike("[0-9]") & value.rlike("[a-f]")
    places = lambda c: F.translate(c, "0123456789" + rows.LOWER + rows.UPPER, "0" * 10 + "a" * 26 + "A" * 26)
    more = lambda sign: F.lit(sign * 18 if step else "")
    shape = lambda prefix, pattern, suffix="": F.struct(
        *[(F.lit(c) if isinstance(c, str) else c).alias(n) for n, c in (("prefix", prefix), ("pattern", pattern), ("suffix", suffix))]
    )
    name = shape("", _by_script(value, "s" * 16, "c" * 16, "g" * 16), _ending(kind, value))
    card = shape(F.substr(value, F.lit(1), F.lit(1)), F.concat(F.lit("0" * 13), more("0")), (_check_digit(value) % 10).cast("string"))
    wide, narrow = value.rlike(r"^(10|127)\."), value.rlike(r"^(192\.168|169\.254|172\.(1[6-9]|2\d|3[01]))\.")
    ip = [
        F.when(wide, shape(F.concat(F.substring_index(value, ".", 1), F.lit(".")), "o.o.o"))
        .when(narrow, shape(F.concat(F.substring_index(value, ".", 2), F.lit(".")), "o.o")).otherwise(shape("", "p.o.o.o")),
        F.when(wide | narrow, shape("10.", "x.x.x")).otherwise(shape("2001:db8:", ":".join(["hhhh"] * 6))),
        F.when(wide | narrow, shape("fd00:", ":".join(["hhhh"] * 7))).otherwise(shape("2001:db8:", ":".join(["hhhh"] * 6))),
    ][step]
    domain = F.substring_index(value, "@", -1)
    top = F.substring_index(domain, ".", -1)
    below = F.substr(domain, F.lit(1), F.length(domain) - F.length(top) - 1)
    email = shape(
        "", F.concat(places(F.substring_index(value, "@", 1)), more("a")),
        F.concat(F.lit("@"), _letters(key, F.lit("domain"), below, F.lit(0)), F.lit("."), top),
    )
    country = F.greatest(F.length(value) - 10, F.lit(0))
    phone = shape(
        F.substr(value, F.lit(1), country), F.concat(F.lit("2"), places(F.substr(value, country + 2)), more("0"))
    )
    return (
        F.when(kind.startswith("name"), name)
        .when(kind == "card", card)
        .when(kind == "ip", ip)
        .when(kind == "email", email)
        .when(kind == "phone", phone)
        .when(kind == "iban", shape(F.substr(value, F.lit(1), F.lit(2)), F.concat(places(F.substr(value, F.lit(3))), more("0"))))
        .when(kind == "key", shape("AKIA", F.concat(places(F.substr(value, F.lit(5))), more("A"))))
        .when(kind == "ssn", shape("", F.concat(places(value), more("0"))))
        .when(hexadecimal, shape("", F.concat(F.regexp_replace(value, ".", "h"), more("h"))))
        .otherwise(shape("", F.concat(places(value), more("a"))))
    )


def _radix(sign: Column) -> Column:
    found = F.lit(1)
    for place, (n, _) in _PLACES.items():
        found = F.when(sign == place, n).otherwise(found)
    return found


def _space(pattern: Column) -> Column:
    """How many replacements a pattern has; countless ones are ``_COUNTLESS``."""
    return F.aggregate(
        F.split(pattern, ""), F.lit(1.0), lambda n, c: F.least(n * _radix(c), F.lit(float(_COUNTLESS)))
    ).cast("long")


def _numbered(key: str, number: Column) -> Column:
    """The replacement of a format by its number; the secret key turns every place."""
    kind, prefix, pattern, suffix = map(F.col, _FORMAT)

    def one(a: Column, c: Column) -> Column:
        radix = _radix(c)
        turned = (a["left"] % radix + _draw(key, kind, prefix, pattern, suffix, a["at"]) % radix) % radix
        sign = c
        for place, (_, value) in _PLACES.items():
            sign = F.when(c == place, value(turned)).otherwise(sign)
        return F.struct(
            F.concat(a["out"], sign).alias("out"), F.floor(a["left"] / radix).cast("long").alias("left"), (a["at"] + 1).alias("at")
        )

    start = F.struct(F.lit("").alias("out"), number.cast("long").alias("left"), F.lit(0).alias("at"))
    free = F.aggregate(F.split(pattern, ""), start, one)["out"]
    body = F.concat(prefix, free)
    missing = (10 - _check_digit(F.concat(body, F.lit("0"))) % 10) % 10
    return (
        F.when(kind == "card", F.concat(body, ((missing + suffix.cast("int")) % 10).cast("string")))
        .when(kind.startswith("name"), F.initcap(F.concat(body, suffix)))
        .otherwise(F.concat(body, suffix))
    )


def _ranked(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with the place of each row within its format in ``rank`` and the rows of the format in ``n``."""
    placed = rows.written(dimensions.numbered(df, [*_FORMAT, *order], "number"), "numbers")
    first = placed.groupBy(*_FORMAT).agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("n"))
    return placed.join(first, _FORMAT).withColumn("rank", F.col("number") - F.col("first")).drop("number", "first")


def _by_number(pending: DataFrame, held: DataFrame, key: str) -> DataFrame:
    """``kind``, ``value`` and ``surrogate`` of entities whose draws all collided, however full their formats are.

    A round lists the first replacements of every format, at first as many as it has open
    entities and twice as many each time, and hands out those that nobody holds; so a round
    lists no more than twice what is held and open. Once a format is listed to its end, who
    went away empty goes on with the next format.
    """
    parts = []
    for step in range(_STEPS):
        shaped = _format(key, F.col("kind"), F.col("value"), step)
        pending = rows.written(pending.select("kind", "value", shaped.alias("s")).select("kind", "value", "s.*"), "open")
        empty, doublings = [], 0
        while not pending.isEmpty():
            turn = _draw(key, F.col("kind"), F.col("value"))
            waiting = rows.written(_ranked(pending.withColumn("turn", turn), ["turn", "value"]), "waiting")
            # Two short lists, so that no row holds a long one.
            outer, inner = 1 << doublings // 2, 1 << (doublings + 1) // 2
            listed = (
                waiting.select(*_FORMAT, "rank", "n", F.explode(F.sequence(F.lit(0), F.lit(outer - 1))).alias("a"))
                .select("*", F.explode(F.sequence(F.lit(0), F.lit(inner - 1))).alias("b"))
                .withColumn("i", F.col("rank") + F.col("n") * (F.col("a").cast("long") * inner + F.col("b")))
                .where(F.col("i") < _space(F.col("pattern")))
                .select(*_FORMAT, "i", _numbered(key, F.col("i")).alias("surrogate"))
            )
            free = _ranked(listed.join(held, ["kind", "surrogate"], "left_anti"), ["i"]).select(*_FORMAT, "rank", "surrogate")
            given = rows.written(waiting.join(free, [*_FORMAT, "rank"], "left"), "given")
            # Formats can share replacements, as a hexadecimal number may have digits only.
            won = given.where("surrogate IS NOT NULL").groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
            won = rows.written(won, "settled")
            parts.append(won.select("kind", "value", "surrogate"))
            held = held.unionByName(won.select("kind", "surrogate"))
            ended = F.col("surrogate").isNull() & (F.col("n") * F.lit(1 << doublings) >= _space(F.col("pattern")))
            empty.append(given.where(ended).select("kind", "value"))
            rest = given.where(~ended).join(won.select("kind", "value"), ["kind", "value"], "left_anti")
            pending = rows.written(rest.select("value", *_FORMAT), "open")
            doublings += 1
        if not empty:
            break
        pending = empty[0]
        for more in empty[1:]:
            pending = pending.unionByName(more)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def assign(entities: DataFrame, key: str = KEY, max_draws: int = MAX_DRAWS) -> DataFrame:
    """``kind``, ``value`` and ``surrogate`` of distinct entities; no surrogate twice, none an entity.

    Each draw settles all entities whose surrogate nobody else holds or drew before them in
    alphabetical order; the others draw again, and after ``max_draws`` draws the rest is
    settled by number. Every draw is written to the shared folder.
    """
    entities = rows.written(entities, "entities")
    held = entities.select("kind", F.col("value").alias("surrogate"))
    pending, settled = entities, entities.limit(0).select("kind", "value", F.col("value").alias("surrogate"))
    for draw in range(max_draws):
        drawn = pending.withColumn("surrogate", replacement(key, F.col("kind"), F.col("value"), F.lit(draw)))
        first = drawn.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        won = rows.written(first.join(held, ["kind", "surrogate"], "left_anti"), "settled").select("kind", "value", "surrogate")
        settled = won if draw == 0 else settled.unionByName(won)
        held = held.unionByName(won.select("kind", "surrogate"))
        pending = rows.written(pending.join(won, ["kind", "value"], "left_anti"), "pending")
        if pending.isEmpty():
            return settled
    return settled.unionByName(_by_number(pending, held, key))


def _filled(written: Column, digits: Column) -> Column:
    """``written`` with its digits replaced in order, and behind it the digits it has no place for."""
    filled = F.aggregate(
        F.split(written, ""),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("next")),
        lambda a, c: F.when(
            c.rlike("[0-9]"), F.struct(F.concat(a["out"], F.substr(digits, a["next"], F.lit(1))).alias("out"), (a["next"] + 1).alias("next"))
        ).otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["next"].alias("next"))),
    )
    return F.concat(filled["out"], F.substr(digits, filled["next"]))


def _cased(written: Column, lower: Column) -> Column:
    """``lower`` with capitals where ``written``, which is no longer, has them."""
    return F.array_join(
        F.zip_with(F.split(written, ""), F.split(lower, ""), lambda a, b: F.when(a.rlike("[A-Z]"), F.upper(b)).otherwise(b)), ""
    )


def _as_written(kind: Column, written: Column, surrogate: Column) -> Column:
    digits = _digits(written)
    national = F.when(F.length(digits) > F.length(surrogate), F.concat(F.lit("1"), surrogate)).otherwise(surrogate)
    spaced = F.aggregate(
        F.split(written, ""),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("next")),
        lambda a, c: F.when(
            c == " ", F.struct(F.concat(a["out"], c).alias("out"), a["next"].alias("next"))
        ).otherwise(F.struct(F.concat(a["out"], F.substr(surrogate, a["next"], F.lit(1))).alias("out"), (a["next"] + 1).alias("next"))),
    )
    spaced = F.concat(spaced["out"], F.substr(surrogate, spaced["next"]))
    return (
        F.when(kind == "phone", _filled(written, national))
        .when(kind.isin("card", "ssn"), _filled(written, surrogate))
        .when(kind == "iban", spaced)
        .when(kind == "email", _cased(written, surrogate))
        .when(kind.startswith("name") & (written == F.upper(written)) & (F.length(written) > 1), F.upper(surrogate))
        .otherwise(surrogate)
    )


def _words_of_names(mention: Column) -> Column:
    """Title, then given and family name with their kinds; a single name is a family's."""
    words = F.split(mention, " ")
    title = F.regexp_replace(F.get(words, F.lit(0)), r"\.$", "")
    gender = F.when(title.rlike(f"^(?:{_MALE})$"), "name_m").when(title.rlike(f"^(?:{_FEMALE})$"), "name_f").otherwise("name_x")
    names = F.slice(words, 2, 2)
    return F.transform(
        names, lambda w, i: F.struct(F.when((F.size(names) == 2) & (i == 0), gender).otherwise("name_family").alias("kind"), w.alias("written"))
    )


def _with_known_gender(each: DataFrame) -> DataFrame:
    """Given names behind a title that says nothing get the gender that the same full name has elsewhere."""
    full = F.initcap(F.regexp_replace("mention", r"^\S+ ", "")).alias("full")
    known = (
        each.where(F.col("kind").isin("name_m", "name_f")).groupBy(full).agg(F.min("kind").alias("known"))
    )
    open_ = each.where("kind = 'name_x'").select("*", full).join(known, "full", "left")
    settled = open_.withColumn("kind", F.coalesce("known", "kind")).select(each.columns)
    return rows.written(each.where("kind <> 'name_x'").unionByName(settled), "mentions")


def replace_entities(docs: DataFrame, text: str = "text", key: str = KEY) -> tuple[DataFrame, str]:
    """``docs`` with the entities of ``text`` replaced, and the name of a count of them."""
    base, file, row = rows.keyed(docs)
    counted = rows.fresh(docs, "n_replaced")
    found = base.select(F.col(file).alias("f"), F.col(row).alias("r"), mentions(F.col(f"`{text}`")).alias("m")).where(F.size("m") > 0)
    each = found.select("f", "r", F.posexplode("m").alias("at", "mention")).withColumn("kind", kind_of(F.col("mention")))
    parts = F.when(F.col("kind") == "name", _words_of_names(F.col("mention"))).otherwise(
        F.array(F.struct(F.col("kind"), F.col("mention").alias("written")))
    )
    each = each.withColumn("parts", parts).select("f", "r", "at", "mention", F.posexplode("parts").alias("part", "p"))
    each = each.select("f", "r", "at", "mention", "part", "p.kind", "p.written").withColumn(
        "value", canonical(F.col("kind"), F.col("written"))
    )
    each = _with_known_gender(rows.written(each, "mentions"))
    surrogates = assign(each.select("kind", "value").distinct(), key)
    new = each.join(surrogates, ["kind", "value"]).withColumn("new", _as_written(F.col("kind"), F.col("written"), F.col("surrogate")))
    # Words of a name stand behind its title in their order.
    whole = F.array_sort(F.collect_list(F.struct("at", "part", "kind", "mention", "new")))
    by_text = new.groupBy("f", "r").agg(whole.alias("news"))
    news = F.transform(
        F.array_sort(F.array_distinct(F.transform("news", lambda x: x["at"]))),
        lambda at: F.aggregate(
            F.filter("news", lambda x: x["at"] == at),
            F.lit(""),
            lambda out, x: F.when(x["kind"].startswith("name"), F.concat(
                F.when(out == "", F.substring_index(x["mention"], " ", 1)).otherwise(out), F.lit(" "), x["new"]
            )).otherwise(x["new"]),
        ),
    )
    by_text = by_text.select(F.col("f").alias(file), F.col("r").alias(row), news.alias(counted))
    joined = base.join(by_text, [file, row], "left")
    between = F.split(F.col(f"`{text}`"), ANY, -1)
    rebuilt = F.array_join(
        F.zip_with(between, F.concat(F.col(counted), F.array(F.lit(""))), lambda a, b: F.concat(a, b)), ""
    )
    given = docs.schema[text].dataType
    return joined.select(
        *[
            F.when(F.col(counted).isNull(), F.col(f"`{c}`")).otherwise(rebuilt.cast(given)).alias(c) if c == text else F.col(f"`{c}`")
            for c in docs.columns
        ],
        F.coalesce(F.size(counted), F.lit(0)).cast("long").alias(counted),
    ), counted
