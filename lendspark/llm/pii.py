"""Personal data: keyed surrogates of the same type and format, in SQL functions alone.

One pattern finds all entities of a text. The distinct entities of the whole corpus get
surrogates from a keyed hash; entities whose surrogates clash with each other, or with a
value that is in the corpus, draw again until none do. So equal entities stay equal,
different ones stay different, and a name keeps its gender, script and case.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.llm.common import table, written

TITLES = {
    "m": ("Mr", "Herr", "Señor", "Monsieur", "господин"),
    "f": ("Mrs", "Ms", "Frau", "Señora", "Madame", "госпожа"),
}
GIVEN = {
    ("m", "latin"): ("Adrian", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Leo", "Marco", "Oscar"),
    ("f", "latin"): ("Alma", "Bella", "Clara", "Dora", "Emma", "Flora", "Helena", "Irma", "Julia", "Lena", "Marta", "Olga"),
    ("m", "cyrillic"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Максим", "Олег"),
    ("f", "cyrillic"): ("Алла", "Вера", "Галина", "Дарья", "Елена", "Мария", "Нина", "Ольга"),
}
SYLLABLES = {
    "latin": ("ba", "ber", "dal", "den", "fer", "gan", "hol", "kas", "lin", "mar", "nor", "pel", "ros", "sten", "tor", "wen"),
    "cyrillic": ("бал", "вер", "гор", "дан", "зор", "кал", "лин", "мар", "нов", "пет", "рос", "сам", "тар", "фед", "хол", "чер"),
}
UPPER = r"\p{Lu}\p{L}+"
SECRET_WORDS = "password|passwd|secret|token|api[_-]?key"
"""Patterns by type, tried in this order at each place of a text."""
PATTERNS = {
    "email": r"\b[A-Za-z0-9][\w.+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "secret": rf"(?i:\b(?:{SECRET_WORDS})[\"']?\s{{0,3}}[=:]\s{{0,3}}[\"']?)[A-Za-z0-9_+/\-]{{8,}}",
    "access_key": r"\bAKIA[0-9A-Z]{16}\b",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
    "card": r"\b\d{4}(?:[ -]?\d{4}){3}\b",
    "phone": r"(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3}[ .-]?\d{4}\b|\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}\b",
    "national_id": r"\b\d{3}-\d{2}-\d{4}\b",
    "name": r"\b(?:" + "|".join(TITLES["m"] + TITLES["f"]) + rf")\b\.? {UPPER}(?: {UPPER})?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
HINT = f"[0-9@=]|AKIA|(?i:{SECRET_WORDS})|" + "|".join(TITLES["m"] + TITLES["f"])
"""Holds wherever a pattern does, and is far cheaper to look for."""


@dataclass(frozen=True)
class Surrogates:
    """``key``: the secret that decides all surrogates; ``rounds``: draws before it is an error."""

    key: str = "surrogate-key"
    rounds: int = 20


def kind_of(value: Column) -> Column:
    return F.coalesce(*(F.when(value.rlike(f"^(?:{p})$"), F.lit(name)) for name, p in PATTERNS.items()))


def canonical(kind: Column, value: Column) -> Column:
    """What spellings of one entity share: case of emails and names, separators of numbers."""
    title = "^(?:" + "|".join(TITLES["m"] + TITLES["f"]) + r")\.? "
    secret = r"[A-Za-z0-9_+/\-]{8,}$"
    return (
        F.when(kind == "email", F.lower(value))
        .when(kind.isin("phone", "card"), F.regexp_replace(value, "[^0-9+]", ""))
        .when(kind == "iban", F.regexp_replace(value, " ", ""))
        .when(kind == "secret", F.regexp_extract(value, secret, 0))
        .when(kind == "name", F.concat(gender(value), F.lit(":"), F.lower(F.regexp_replace(value, title, ""))))
        .otherwise(value)
    )


def gender(value: Column) -> Column:
    return F.when(value.rlike("^(?:" + "|".join(TITLES["f"]) + r")\b"), F.lit("f")).otherwise(F.lit("m"))


def number(digest: Column, at: Column, modulus: int) -> Column:
    """A number below ``modulus`` from three hex digits of the digest, which repeats."""
    pair = digest.substr(F.pmod(at * 2, F.lit(126)) + 1, F.lit(3))
    return F.pmod(F.conv(pair, 16, 10).cast("int"), F.lit(modulus))


def like(text: Column, digest: Column) -> Column:
    """Each letter or digit replaced by one of its class; hex digits stay hex digits."""
    lower_hex, upper_hex = text.rlike("^[0-9a-f]{16,}$"), text.rlike("^[0-9A-F]{16,}$")

    def pick(alphabet: str, at: Column) -> Column:
        return F.lit(alphabet).substr(number(digest, at, len(alphabet)) + 1, F.lit(1))

    def one(c: Column, i: Column) -> Column:
        return (
            F.when(c.rlike("[0-9]"), pick("0123456789", i))
            .when(c.rlike("[a-z]"), F.when(lower_hex, pick("abcdef", i)).otherwise(pick("abcdefghijklmnopqrstuvwxyz", i)))
            .when(c.rlike("[A-Z]"), F.when(upper_hex, pick("ABCDEF", i)).otherwise(pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", i)))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def with_check_digit(digits: Column) -> Column:
    """The last digit replaced so that the number passes the usual card check."""
    body = F.split(F.reverse(digits.substr(F.lit(1), F.length(digits) - 1)), "")
    doubled = F.transform(
        body,
        lambda d, i: F.when(i % 2 == 0, F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2))
        .otherwise(d.cast("int")),
    )
    total = F.aggregate(doubled, F.lit(0), lambda a, x: a + x)
    return F.concat(digits.substr(F.lit(1), F.length(digits) - 1), F.pmod(-total, F.lit(10)).cast("string"))


def name_for(entity: Column, digest: Column, attempt: Column) -> Column:
    """A lower-case name of the entity's gender and script, one syllable longer each round."""
    words = F.size(F.split(entity, " "))

    def of(script: str) -> Column:
        parts = F.array(*map(F.lit, SYLLABLES[script]))
        family = F.array_join(
            F.transform(F.sequence(F.lit(0), attempt + 2), lambda i: F.element_at(parts, number(digest, i + 3, len(SYLLABLES[script])) + 1)), ""
        )
        given = lambda g: F.element_at(
            F.array(*(F.lit(n.lower()) for n in GIVEN[g, script])), number(digest, F.lit(1), len(GIVEN[g, script])) + 1
        )
        first = F.when(entity.startswith("f:"), given("f")).otherwise(given("m"))
        return F.when(words > 1, F.concat_ws(" ", first, family)).otherwise(family)

    return F.when(entity.rlike(r"\p{IsCyrillic}"), of("cyrillic")).otherwise(of("latin"))


def surrogate_of(kind: Column, entity: Column, attempt: Column, key: str) -> Column:
    digest = F.sha2(F.concat_ws("\u0001", F.lit(key), kind, attempt.cast("string"), entity), 512)
    digits = like(entity, digest)
    # The country code of a phone and the issuer's digit of a card stay.
    kept = F.when(kind == "phone", F.regexp_extract(entity, r"^\+[0-9]", 0)).otherwise(entity.substr(1, 1))
    kept_size = F.length(kept)
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: number(digest, i, 256).cast("string")), ".")
    domain = F.regexp_extract(entity, r"@(.*)\.[^.]*$", 1)
    return (
        F.when(kind == "email", F.concat(
            like(F.regexp_extract(entity, "^[^@]*", 0), digest), F.lit("@"), like(domain, F.reverse(digest)),
            F.regexp_extract(entity, r"\.[^.]*$", 0),
        ))
        .when(kind == "ip", octets)
        .when(kind == "card", with_check_digit(F.concat(kept, digits.substr(F.lit(2), F.length(digits)))))
        .when(kind == "phone", F.concat(kept, digits.substr(kept_size + 1, F.length(digits))))
        .when(kind == "access_key", F.concat(F.lit("AKIA"), digits.substr(F.lit(5), F.length(digits))))
        .when(kind == "name", name_for(entity, digest, attempt))
        .otherwise(digits)
    )


def rendered(kind: Column, value: Column, surrogate: Column) -> Column:
    """The entity's surrogate in the spelling of one value: its separators, case and frame."""
    place = lambda c, i, inside: F.length(F.regexp_replace(value.substr(F.lit(1), i + 1), inside, ""))

    def spaced(outside: str) -> Column:
        fill = lambda c, i: F.when(c.rlike(outside), c).otherwise(surrogate.substr(place(c, i, outside), F.lit(1)))
        return F.array_join(F.transform(F.split(value, ""), fill), "")

    cased = F.array_join(
        F.transform(
            F.split(surrogate, ""),
            lambda c, i: F.when(value.substr(i + 1, F.lit(1)).rlike("[A-Z]"), F.upper(c)).otherwise(c),
        ),
        "",
    )
    title = F.regexp_extract(value, "^(?:" + "|".join(TITLES["m"] + TITLES["f"]) + r")\.? ", 0)
    rest = value.substr(F.length(title) + 1, F.length(value))
    name = F.when(F.upper(rest) == rest, F.upper(surrogate)).otherwise(F.initcap(surrogate))
    frame = F.regexp_replace(value, r"[A-Za-z0-9_+/\-]{8,}$", "")
    return (
        F.when(kind == "email", cased)
        .when(kind.isin("phone", "card"), spaced("[^0-9+]"))
        .when(kind == "iban", spaced(" "))
        .when(kind == "name", F.concat(title, name))
        .when(kind == "secret", F.concat(frame, surrogate))
        .otherwise(surrogate)
    )


def found(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ANY), F.lit(0))


def surrogates(values: DataFrame, settings: Surrogates = Surrogates()) -> DataFrame:
    """(value, kind, replacement) for distinct ``value``s; no two entities share a surrogate."""
    typed = values.select("value", kind_of(F.col("value")).alias("kind"))
    typed = written(typed.withColumn("entity", canonical(F.col("kind"), F.col("value"))), "entities")
    present = typed.select("kind", F.col("entity").alias("surrogate")).distinct()
    todo = typed.select("kind", "entity").distinct().withColumn("attempt", F.lit(0))
    settled = None
    for _ in range(settings.rounds):
        drawn = todo.withColumn("surrogate", surrogate_of(F.col("kind"), F.col("entity"), F.col("attempt"), settings.key))
        # Of entities with one surrogate the least hash keeps it, and none may be a real value.
        owner = drawn.groupBy("kind", "surrogate").agg(
            F.min_by("entity", F.struct(F.xxhash64("entity"), "entity")).alias("owner")
        )
        owner = owner.join(present, ["kind", "surrogate"], "left_anti")
        if settled is not None:
            owner = owner.join(settled, ["kind", "surrogate"], "left_anti")
        marked = drawn.join(owner, ["kind", "surrogate"], "left")
        marked = written(marked.withColumn("ok", F.coalesce(F.col("owner") == F.col("entity"), F.lit(False))), "surrogates")
        good = marked.where("ok").select("kind", "entity", "surrogate")
        settled = good if settled is None else settled.unionByName(good)
        todo = marked.where("not ok").select("kind", "entity", (F.col("attempt") + 1).alias("attempt"))
        if todo.isEmpty():
            break
    else:
        raise RuntimeError(f"surrogates still clash after {settings.rounds} rounds")
    joined = typed.join(settled, ["kind", "entity"])
    return joined.select("value", "kind", rendered(F.col("kind"), F.col("value"), F.col("surrogate")).alias("replacement"))


def anonymise(docs: DataFrame, settings: Surrogates = Surrogates(), text_column: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, the text with surrogates, and ``pii_count``.

    Texts without entities, null and empty ones pass unchanged with a count of 0, and do
    not shuffle. Repeated rows get the same text. A column named ``pii_count`` is
    replaced; other columns stay.
    """
    text = F.col(text_column)
    names = [c for c in docs.columns if c != "pii_count"]
    docs = docs.select(*names)
    matches = F.when(text.rlike(HINT), found(text)).otherwise(F.array().cast("array<string>"))
    held = docs.withColumn("pii_count", F.coalesce(F.size(F.when(text.isNotNull(), matches)), F.lit(0)).cast("long"))
    held = held.withColumn("pii_count", F.greatest("pii_count", F.lit(0).cast("long")))
    hits = docs.where(text.rlike(HINT)).select(text.alias("text"), found(text).alias("values")).where(F.size("values") > 0)
    hits = hits.select(F.md5("text").alias("digest"), "values").dropDuplicates(["digest"])
    pairs = written(hits.select("digest", F.explode(F.array_distinct("values")).alias("value")), "pii")
    mapping = written(surrogates(pairs.select("value").distinct(), settings), "replacements")
    by_text = pairs.join(mapping, "value").groupBy("digest").agg(
        F.map_from_entries(F.collect_list(F.struct("value", "replacement"))).alias("replacements")
    )
    without = held.where(F.col("pii_count") == 0)
    digest = "pii_digest"
    while digest in names:
        digest += "_"
    with_some = held.where(F.col("pii_count") > 0).withColumn(digest, F.md5(text))
    joined = with_some.join(
        by_text.select(F.col("digest").alias(digest), F.col("replacements").alias(f"{digest}_map")), digest
    )
    gaps = F.split(text, ANY, -1)
    put = F.transform(found(text), lambda v: F.element_at(F.col(f"{digest}_map"), v))
    replaced = F.array_join(F.zip_with(gaps, put, lambda g, p: F.concat(g, F.coalesce(p, F.lit("")))), "")
    changed = joined.select(*(replaced.alias(c) if c == text_column else F.col(c) for c in [*names, "pii_count"]))
    return without.select(*names, "pii_count").unionByName(changed)


def op7_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))
