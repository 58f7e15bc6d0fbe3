"""PII surrogates: detected entities get keyed replacements of the same kind and format.

Built-in functions only. Mentions are gathered to distinct entities, a kind and a normal form. The
surrogate of an entity follows from the secret key, both of these and an attempt number, which is 0
unless the surrogate meets that of another entity, or an entity of the corpus. Each distinct form
of mention is then filled once and joined back to where it stands.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.llm.common import ROW, with_rows
from sievemark.session import materialize

_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)++[A-Za-z]{2,}"
_HEX = r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![0-9A-Za-z])"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_IP = rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)"
_SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
_PHONE = r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\) ?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?![\w])"
_CARD = r"(?<![\w-])(?:\d{13,19}|\d{4}(?: \d{4}){2} \d{1,7}|\d{4}(?:-\d{4}){2}-\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])"
#: Forms of address by gender; a name is one or two capitalised words behind one.
MALE = ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Don", "Господин", "Г-н", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Señorita", "Doña", "Госпожа", "Г-жа", "Κυρία")


def _either_case(titles: tuple[str, ...]) -> str:
    """The titles as they are or in capitals, longer ones first."""
    return "|".join(sorted({*titles, *(t.upper() for t in titles)}, key=lambda t: (-len(t), t)))


_TITLE = rf"(?<![\p{{L}}])(?:{_either_case(MALE + FEMALE)})\.? "
_WORD = r"\p{Lu}[\p{L}'’-]+"
_NAME = rf"{_TITLE}{_WORD}(?: {_WORD})?"
#: In order of preference where several could match.
KINDS = {"email": _EMAIL, "secret": _HEX, "ip": _IP, "ssn": _SSN, "card": _CARD, "phone": _PHONE, "name": _NAME}
ENTITY = "|".join(KINDS.values())
#: Sixteen syllables for each script, one per hexadecimal digit, and endings by gender.
SYLLABLES = {
    "Cyrillic": ("ба", "во", "ги", "ду", "жа", "зо", "ки", "лу", "ма", "но", "пи", "ру", "са", "то", "фи", "ху"),
    "Greek": ("βα", "γο", "δι", "ζε", "θα", "κο", "λι", "με", "να", "ξο", "πι", "ρε", "σα", "το", "φι", "χε"),
    "Latin": ("ba", "de", "fi", "go", "hu", "ja", "ke", "li", "mo", "nu", "pa", "re", "si", "to", "va", "ze"),
}
ENDINGS = {
    ("Cyrillic", "surname", "m"): "нов", ("Cyrillic", "surname", "f"): "нова", ("Cyrillic", "given", "m"): "й", ("Cyrillic", "given", "f"): "я",
    ("Greek", "surname", "m"): "ς", ("Greek", "surname", "f"): "υ", ("Greek", "given", "m"): "ς", ("Greek", "given", "f"): "α",
    ("Latin", "surname", "m"): "r", ("Latin", "surname", "f"): "r", ("Latin", "given", "m"): "n", ("Latin", "given", "f"): "na",
}


def kind_of(match: Column) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for kind, pattern in KINDS.items():
        out = out.when(match.rlike(f"^(?:{pattern})$"), F.lit(kind))
    return out


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _country(match: Column) -> Column:
    return F.regexp_extract(match, r"^(\+\d{1,3}[ .-]?)", 1)


def _rest(match: Column) -> Column:
    return F.regexp_replace(match, r"^\+\d{1,3}[ .-]?", "")


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "Cyrillic").when(word.rlike(r"\p{IsGreek}"), "Greek").otherwise("Latin")


def _gender(match: Column) -> Column:
    return F.when(match.rlike(rf"^(?:{_either_case(FEMALE)})\.? "), "f").otherwise("m")


def _words(match: Column) -> Column:
    return F.split(F.regexp_replace(match, rf"^{_TITLE}", ""), " ")


def entities_of(forms: DataFrame) -> DataFrame:
    """(match, kind, part, norm): the entity of each form of mention, or one for each word of a name."""
    kind, words, match = F.col("form"), F.col("words"), F.col("match")
    norm = F.when(kind == "phone", _digits(_rest(match))).when(kind.isin("card", "ssn"), _digits(match)).otherwise(F.lower(match))
    one = F.struct(kind.alias("kind"), F.lit("whole").alias("part"), norm.alias("norm"))
    last, first = F.element_at(words, -1), F.element_at(words, 1)
    # A surname has the same root for either gender, so that relatives stay recognisable.
    surname = F.struct(F.concat(F.lit("surname "), _script(last)).alias("kind"), F.lit("surname").alias("part"), F.lower(last).alias("norm"))
    given = F.struct(
        F.concat(F.lit("given "), _script(first), F.lit(" "), F.col("gender")).alias("kind"), F.lit("given").alias("part"), F.lower(first).alias("norm")
    )
    names = F.when(F.size(words) > 1, F.array(given, surname)).otherwise(F.array(surname))
    return forms.select("match", F.explode(F.when(kind == "name", names).otherwise(F.array(one))).alias("e")).select("match", "e.*")


def _luhn(digits: Column) -> Column:
    """Luhn sum; the last digit counts once, the one before it twice."""
    turned = F.reverse(digits)

    def term(i: Column) -> Column:
        d = F.substring(turned, i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), term), F.lit(0), lambda a, b: a + b)


def with_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """Append ``made``, the replacement of (kind, norm, attempt), still without the format of a mention."""
    kind, norm, attempt, h = (F.col(c) for c in ("kind", "norm", "attempt", "__h"))
    seed = F.concat_ws("\u0001", F.lit(key), kind, norm, attempt.cast("string"))
    hashed = F.sha2(F.concat_ws("\u0001", F.sha2(seed, 512), F.lit(key)), 512)  # 128 hexadecimal digits
    block = lambda i: F.substring(F.lpad(F.conv(F.substring(h, 1 + 15 * i, 15), 16, 10), 18, "0"), 3, 16)
    stream = F.concat(block(0), block(1))
    size = F.length(norm)
    plain = F.substring(stream, F.lit(1), size)
    # No leading 0 or 1 where numbers have none.
    opening = F.concat((F.conv(F.substring(h, 70, 4), 16, 10).cast("long") % 8 + 2).cast("string"), F.substring(stream, F.lit(2), size - 1))
    body = F.concat(F.substring(norm, 1, 1), F.substring(stream, F.lit(2), size - 2))
    check = ((10 - _luhn(F.concat(body, F.lit("0"))) % 10) % 10).cast("string")
    card = F.concat(body, F.when(_luhn(norm) % 10 == 0, check).otherwise(F.substring(stream, 30, 1)))
    octet = lambda i: (F.conv(F.substring(h, 1 + 4 * i, 4), 16, 10).cast("long") % 254 + 1).cast("string")
    ip = F.concat_ws(".", *[octet(i) for i in range(4)])
    local, domain = F.substring_index(norm, "@", 1), F.substring_index(norm, "@", -1)

    def letter(c: Column, i: Column) -> Column:
        n = F.conv(F.substring(h, 1 + F.pmod(i * 2, F.lit(126)), F.lit(3)), 16, 10).cast("int")
        return (
            F.when(c.rlike("^[0-9]$"), (n % 10).cast("string"))
            .when(c.rlike("^[a-z]$"), F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), n % 26 + 1, F.lit(1)))
            .otherwise(c)
        )

    host = F.sha2(F.concat_ws("\u0001", F.lit(key), F.lit("domain"), domain), 256)
    email = F.concat(
        F.array_join(F.transform(F.split(local, ""), letter), ""),
        F.when(attempt > 0, F.substring(h, 40, 8)).otherwise(""),
        F.lit("@m"), F.substring(host, 1, 10), F.lit("."), F.substring_index(domain, ".", -1),
    )

    def name(script: str) -> Column:
        syllables = F.array(*[F.lit(s) for s in SYLLABLES[script]])
        picked = F.transform(
            F.sequence(F.lit(1), F.lit(4) + F.least(attempt, F.lit(4))),
            lambda i: F.element_at(syllables, (F.conv(F.substring(h, i, F.lit(1)), 16, 10).cast("int") + 1)),
        )
        return F.array_join(picked, "")

    named = reduce(lambda c, s: c.when(kind.contains(s), name(s)), ("Cyrillic", "Greek"), F.when(F.lit(False), "")).otherwise(name("Latin"))
    made = (
        F.when(kind == "email", email)
        .when(kind == "ip", ip)
        .when(kind == "secret", F.substring(h, F.lit(1), size))
        .when(kind == "ssn", plain)
        .when(kind == "phone", opening)
        .when(kind == "card", card)
        .otherwise(named)
    )
    return entities.withColumn("__h", hashed).withColumn("made", made).drop("__h")


def _fill(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced one by one."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("i"))

    def step(acc: Column, c: Column) -> Column:
        digit = c.rlike("^[0-9]$")
        return F.struct(
            F.concat(acc["out"], F.when(digit, F.substring(digits, acc["i"], F.lit(1))).otherwise(c)).alias("out"),
            (acc["i"] + digit.cast("int")).alias("i"),
        )

    return F.aggregate(F.split(form, ""), start, step)["out"]


def _like(word: Column, mention: Column) -> Column:
    return F.when((mention == F.upper(mention)) & (mention != F.lower(mention)), F.upper(word)).otherwise(word)


def filled(forms: DataFrame) -> DataFrame:
    """(match, new): forms of mention with the surrogates of their entities put in."""
    kind, match, words = F.col("form"), F.col("match"), F.col("words")

    def ended(part: str, mention: Column) -> Column:
        ending = F.when(F.lit(False), "")
        for (script, p, gender), tail in ENDINGS.items():
            if p == part:
                ending = ending.when((_script(mention) == script) & (F.col("gender") == gender), tail)
        return _like(F.initcap(F.concat(F.col(part), ending)), mention)

    surname = ended("surname", F.element_at(words, -1))
    given = F.concat(ended("given", F.element_at(words, 1)), F.lit(" "))
    title = F.regexp_extract(match, rf"^({_TITLE})", 1)
    new = (
        F.when(kind == "name", F.concat(title, F.when(F.size(words) > 1, given).otherwise(""), surname))
        .when(kind == "phone", F.concat(_country(match), _fill(_rest(match), F.col("whole"))))
        .when(kind.isin("card", "ssn"), _fill(match, F.col("whole")))
        .otherwise(_like(F.col("whole"), match))
    )
    return forms.select("match", new.alias("new"), kind.alias("kind"))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, norm, made) for distinct (kind, norm): surrogates that are distinct and no entities.

    Of entities with the same surrogate the smallest keeps it; the others try again.
    """
    own = entities.select("kind", "norm")
    now = materialize(with_surrogates(own.withColumn("attempt", F.lit(0)), key), "pii-surrogates")
    while True:
        twice = now.groupBy("kind", "made").agg(F.min("norm").alias("lowest"), F.count("*").alias("n")).filter("n > 1")
        clash = now.join(twice, ["kind", "made"]).filter("norm <> lowest").select("kind", "norm")
        real = now.join(own.withColumnRenamed("norm", "made"), ["kind", "made"]).select("kind", "norm")
        again = materialize(clash.unionAll(real).distinct().withColumn("again", F.lit(1)), "pii-clashes")
        if again.isEmpty():
            return now.select("kind", "norm", "made")
        moved = now.select("kind", "norm", "attempt").join(again, ["kind", "norm"], "left")
        moved = moved.withColumn("attempt", F.col("attempt") + F.coalesce("again", F.lit(0))).drop("again")
        now = materialize(with_surrogates(moved, key), "pii-surrogates")


def replace_pii(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with surrogates in the text, and ``n_entities``, ``kinds``.

    Equal entities get equal surrogates in all documents, whatever their format; different ones get
    different surrogates, none of which occurs as an entity. Numbers keep their punctuation and
    country code, cards their first digit and check digit, names their title, gender, script and case. Null
    and empty texts stay as they are; repeated rows get the same text. Only documents with an
    entity are written down and joined. Input columns named like a result are replaced.
    """
    names = [c for c in docs.columns if c not in ("n_entities", "kinds")]
    own = docs.select(*names)
    has = F.coalesce(F.col(text).rlike(rf"[0-9@]|{_TITLE}") & F.col(text).rlike(ENTITY), F.lit(False))
    found = F.regexp_extract_all(F.col(text), F.lit(f"({ENTITY})"), 1)
    rows = with_rows(own.filter(has).withColumn("__found", found), "pii-input")
    mentions = rows.select(ROW, F.posexplode("__found").alias("at", "match"))

    forms = mentions.select("match").distinct().withColumn("form", kind_of(F.col("match")))
    forms = materialize(forms.withColumn("words", _words(F.col("match"))).withColumn("gender", _gender(F.col("match"))), "pii-forms")
    parts = materialize(entities_of(forms), "pii-parts")
    made = surrogates(parts.select("kind", "norm").distinct(), key)
    pick = [F.max(F.when(F.col("part") == p, F.col("made"))).alias(p) for p in ("whole", "given", "surname")]
    ready = forms.join(parts.join(made, ["kind", "norm"]).groupBy("match").agg(*pick), "match")
    new = materialize(filled(ready), "pii-filled")

    order = F.array_sort(F.collect_list(F.struct("at", "new", "kind")))
    changes = materialize(mentions.join(new, "match").groupBy(ROW).agg(order.alias("__changes")), "pii-changes")
    joined = rows.join(changes.hint("merge"), ROW)
    gaps = F.split(F.col(text), ENTITY, -1)
    whole = F.array_join(F.zip_with(gaps, F.col("__changes.new"), lambda g, r: F.concat(g, F.coalesce(r, F.lit("")))), "")
    out = [whole.alias(c) if c == text else F.col(c) for c in names]
    changed = joined.select(*out, F.size("__changes").cast("long").alias("n_entities"), F.array_sort(F.array_distinct("__changes.kind")).alias("kinds"))
    rest = own.filter(~has).select(*names, F.lit(0).cast("long").alias("n_entities"), F.array().cast("array<string>").alias("kinds"))
    return changed.unionAll(rest)
