"""Surrogates for personal data, in column expressions only.

Entities are found by one pattern and replaced by keyed surrogates of the same type
and shape: digits stay digits in the same punctuation, a card number passes its check
digit, an address keeps its number of parts, a name keeps gender, script and case. A
surrogate depends on the key, the type and the canonical form of the entity alone, so
an entity gets the same surrogate in all documents and notations, and no mapping has
to be joined to texts.

The distinct entities of the corpus are then checked: a surrogate that two entities
share, or that is itself an entity of the corpus, is drawn again for all but the first
of them, and longer than its entity after a few draws. Only documents with such an
entity meet a table of draws.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from glossmill.llm.common import saved

MALE, FEMALE = "Mr|Herr|Señor|Monsieur|Господин", "Mrs|Ms|Miss|Frau|Señora|Madame|Госпожа"
#: What may stand between a title and the name, and inside the name.
_DEGREES = r"(?:(?:Dr|Prof|Ing|Dipl|Mag|Sir|Don|Doña)(?:\.-?| |-)){0,3}+ ?"
_PARTICLES = r"(?:(?:von|vom|van|der|den|de|del|della|di|da|do|dos|das|du|la|le|las|los|zu|zum|zur|ten|ter|bin|ibn|al|el|y|e) ){0,3}+"
#: A word of a name may have hyphens and apostrophes before capitals.
_WORD = rf"(?!(?:{MALE}|{FEMALE})(?!\p{{L}}))\p{{Lu}}[\p{{L}}\p{{M}}]{{0,40}}+(?:['’-]\p{{Lu}}[\p{{L}}\p{{M}}]{{0,40}}+){{0,3}}+"
#: All capitalised words of the line, six at most; a lone capital may have a point.
_NAME = rf"{_DEGREES}{_PARTICLES}{_WORD}(?:(?:(?<=\s\p{{Lu}})\.)? {_PARTICLES}{_WORD}){{0,5}}+"
#: Looks ahead for eight digits in groups.
_EIGHT = r"(?=(?:[ ./()-]{0,3}+\d){8})"

#: Patterns by type, in the order in which they are tried at a place. Counted and possessive
#: parts only, each begun behind a border, so time is linear in the text.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{3})[ .-]\d{3}[ .-]\d{4}(?!\w)"
    # A country code and a number in any groups; a trunk prefix may stand in brackets.
    rf"|(?<![\w+])(?:\+(?!\d{{16}})|00(?=[1-9])(?!\d{{14}})){_EIGHT}\d{{1,4}}(?:[ ./-]?\(\d{{1,5}}\))?(?:(?: ?[./-] ?| )?\d{{1,14}}+){{1,7}}+(?!\w)"
    # National numbers after a 0: five pairs or unbroken, and an area code before one to four groups.
    r"|(?<![\w+.-])0[1-9](?:(?:[ .-]?\d\d){4}|\d{8,10})(?!\w)"
    rf"|(?<![\w+.-]){_EIGHT}(?:0[1-9]\d{{1,4}}(?: ?/ ?|[ -])|\(0[1-9]\d{{1,4}}\) ?)\d{{2,9}}+(?:[ -]\d{{1,5}}){{0,3}}+(?!\w)"
    # Nine digits from 6 to 9 on, as in Spain.
    r"|(?<![\w+.-])(?<!\d )(?:[6-9]\d\d \d{3} \d{3}|[6-9]\d\d-\d{3}-\d{3}|[6-9]\d\d(?: \d\d){3}|[89]\d \d{3} \d\d \d\d)(?!\w|[ .-]\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "ip": r"(?<![\w.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?!\w|\.\d)",
    "card": r"(?<![\w-])(?:\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}|\d{4}[ -]\d{6}[ -]\d{4,5})(?![\w-])",
    "male": rf"(?<!\w)(?:{MALE})\.?\s{_NAME}",
    "female": rf"(?<!\w)(?:{FEMALE})\.?\s{_NAME}",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())

#: What family names are made of, by script; endings by gender where the script shows it.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga ha ka ke la le li lo ma me mi na ne no pa ra re ri ro sa se ta te ti va ve wa ze".split(),
    "cyrillic": "ба бе бо ва ве га да де за зо ка ко ла ле ли ма ми на не но па ра ре ро са се та те ти хо".split(),
}
ENDINGS = {
    "latin": {"male": ["n", "r", "s", "l"], "female": ["n", "r", "s", "l"]},
    "cyrillic": {"male": ["ов", "ин", "ев"], "female": ["ова", "ина", "ева"]},
}


def _number(seed: Column, i: Column | int, below: int) -> Column:
    """A number drawn from a seed, by a keyed digest."""
    return F.pmod(F.xxhash64(seed, F.lit(i) if isinstance(i, int) else i), F.lit(below))


def kind_of(value: Column) -> Column:
    """The type of a match; NULL for a number that fails its card check digit."""
    out = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS.items()):
        condition = value.rlike(rf"\A(?:{pattern})\z")
        out = F.when(condition & luhn(value) if name == "card" else condition, name).otherwise(out)
    return out


def digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def luhn_sum(number: Column) -> Column:
    """Check sum of a string of digits."""
    doubled = lambda d, i: F.when(i % 2 == 1, F.when(2 * d > 9, 2 * d - 9).otherwise(2 * d)).otherwise(d)
    each = F.transform(F.split(F.reverse(number), ""), lambda c, i: doubled(F.coalesce(c.try_cast("int"), F.lit(0)), i))
    return F.aggregate(each, F.lit(0), lambda s, x: s + x.cast("int"))


def luhn(value: Column) -> Column:
    return F.length(digits(value)).between(13, 19) & (luhn_sum(digits(value)) % 10 == 0)


def canonical(kind: Column, value: Column) -> Column:
    """What makes two notations one entity: letters in lower case, digits, the family name."""
    name = F.regexp_extract(value, r"(\S+)\z", 1)
    return (
        F.when(kind == "email", F.lower(value))
        .when(kind.isin("phone", "ssn", "card"), digits(value))
        .when(kind.isin("male", "female"), F.concat(kind, F.lit(":"), F.translate(F.lower(name), "’", "'")))
        .otherwise(value)
    )


def surrogate(kind: Column, entity: Column, key: str, attempt: Column) -> Column:
    """The canonical surrogate of a canonical entity."""
    seed = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, entity, attempt.cast("string")), 256)

    letter = "abcdefghijklmnopqrstuvwxyz"

    def shaped(text: Column, offset: int = 0) -> Column:
        drawn = F.transform(
            F.split(text, ""),
            lambda c, i: F.when(c.rlike("[0-9]"), _number(seed, i + offset, 10).cast("string"))
            .when(c.rlike("[a-z]"), F.substring(F.lit(letter), (_number(seed, i + offset, 26) + 1).cast("int"), F.lit(1)))
            .otherwise(c),
        )
        return F.array_join(drawn, "")

    def longer(mark: str, after: int, draw: Callable[[Column], Column]) -> Column:
        """As many more drawn parts as there were attempts above `after`, so the space grows until it has room."""
        more = F.array_repeat(F.lit(mark), F.greatest(attempt - after, F.lit(0)).cast("int"))
        return F.array_join(F.transform(more, lambda c, i: F.concat(c, draw(i + 200))), "")

    more_letters = longer("", 2, lambda i: F.substring(F.lit(letter), (_number(seed, i, 26) + 1).cast("int"), F.lit(1)))
    more_digits = longer("", 8, lambda i: _number(seed, i, 10).cast("string"))
    more_octets = longer(".", 8, lambda i: (_number(seed, i, 254) + 1).cast("string"))
    local, domain = F.substring_index(entity, "@", 1), F.substring_index(entity, "@", -1)
    top = F.substring_index(domain, ".", -1)
    host = F.substring(domain, F.lit(1), F.length(domain) - F.length(top) - 1)
    # A card keeps its first digit, which names the network, a phone a 0 at its start and what stands before ten digits.
    size = F.length(entity)
    body = F.concat(F.substring(entity, 1, 1), shaped(F.substring(entity, F.lit(2), size - 2)), more_digits)
    code = F.greatest(size - 10, F.when(entity.startswith("0"), 1).otherwise(0))
    phone = F.concat(F.substring(entity, F.lit(1), code), shaped(F.substring(entity, code + 1, size)))
    check = (10 - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10
    octets = F.transform(F.split(entity, r"\."), lambda x, i: (_number(seed, i, 254) + 1).cast("string"))
    return (
        F.when(kind == "email", F.concat(shaped(local), more_letters, F.lit("@"), shaped(host, 100), F.lit("."), top))
        .when(kind == "card", F.concat(body, check.cast("int").cast("string")))
        .when(kind == "phone", F.concat(phone, more_digits))
        .when(kind == "ip", F.concat(F.array_join(octets, "."), more_octets))
        .when(kind.isin("male", "female"), F.concat(kind, F.lit(":"), _name(kind, entity, seed, attempt)))
        .otherwise(F.concat(shaped(entity), more_digits))
    )


def _name(kind: Column, entity: Column, seed: Column, attempt: Column) -> Column:
    def made(script: str) -> Column:
        parts = F.array(*map(F.lit, SYLLABLES[script]))
        pick = lambda i: F.element_at(parts, (_number(seed, i, len(SYLLABLES[script])) + 1).cast("int"))
        more = F.array_repeat(F.lit(""), F.greatest(attempt - 2, F.lit(0)).cast("int"))
        ending = lambda g: F.element_at(
            F.array(*map(F.lit, ENDINGS[script][g])), (_number(seed, 9, len(ENDINGS[script][g])) + 1).cast("int")
        )
        end = F.when(kind == "male", ending("male")).otherwise(ending("female"))
        longer = F.array_join(F.transform(more, lambda c, i: pick(i + 200)), "")
        return F.concat(pick(1), pick(2), pick(3), pick(4), longer, end)

    return F.when(entity.rlike(r"\p{IsCyrillic}"), made("cyrillic")).otherwise(made("latin"))


def _given(kind: Column, word: Column, key: str) -> Column:
    """A surrogate for a name before the family name; particles stay, an initial stays one."""
    lower = F.lower(word)
    seed = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("given"), kind, lower), 256)
    drawn = F.initcap(_name(kind, lower, seed, F.lit(0)))
    other = F.when(F.lower(drawn) == lower, F.concat(drawn, F.lit("o"))).otherwise(drawn)
    initial = word.rlike(r"\A\p{Lu}\.?\z")
    return F.when(initial, F.concat(F.substring(drawn, 1, 1), F.substring(word, 2, 1))).when(word.rlike(r"\A\p{Lu}"), other).otherwise(word)


def written(kind: Column, value: Column, drawn: Column, key: str) -> Column:
    """A canonical surrogate in the notation of the match it replaces."""
    into = F.aggregate(
        F.split(value, ""),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("k")),
        lambda s, c: F.when(
            c.rlike("[0-9]"),
            F.struct(F.concat(s["out"], F.substring(drawn, s["k"], F.lit(1))).alias("out"), (s["k"] + 1).alias("k")),
        ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["k"].alias("k"))),
        # A surrogate that had to be longer than its entity ends in the digits that are left.
        lambda s: F.concat(s["out"], F.substring(drawn, s["k"], F.length(drawn))),
    )
    cased = lambda text: F.when(value == F.upper(value), F.upper(text)).otherwise(text)
    family = F.substring_index(drawn, ":", -1)
    title = F.regexp_extract(value, rf"\A(\S+\s{_DEGREES})", 1)
    last = F.length(F.regexp_extract(value, r"(\S+)\z", 1))
    between = F.substring(value, F.length(title) + 1, F.length(value) - F.length(title) - last)
    given = F.array_join(F.transform(F.split(between, " "), lambda w: _given(kind, w, key)), " ")
    return (
        F.when(kind.isin("phone", "ssn", "card"), into)
        .when(kind.isin("male", "female"), F.concat(title, given, F.initcap(family)))
        .when(kind == "email", cased(drawn))
        .otherwise(drawn)
    )


def with_entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add `_found`, the matches with `value, kind, entity` in order, and `_pieces`, the text between them."""
    # The condition, always true but not deterministic, keeps later filters from doing the search again.
    raw = F.when(F.monotonically_increasing_id() >= 0, F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))
    typed = F.transform("_raw", lambda v: F.struct(v.alias("value"), kind_of(v).alias("kind")))
    named = F.transform(
        "_typed",
        lambda x: F.struct(x["value"].alias("value"), x["kind"].alias("kind"), canonical(x["kind"], x["value"]).alias("entity")),
    )
    return (
        docs.withColumn("_raw", F.coalesce(raw, F.array().cast("array<string>")))
        .withColumn("_typed", typed)
        .withColumn("_found", named)
        .withColumn("_pieces", F.when(F.size("_raw") > 0, F.split(text, PATTERN, -1)))
        .drop("_raw", "_typed")
    )


def entities(docs: DataFrame) -> DataFrame:
    """The distinct `kind, entity` of `docs(text)`, written, so that texts are searched once."""
    found = with_entities(docs.select("text")).select(F.explode_outer("_found").alias("e"))
    found = found.select("e.kind", "e.entity").filter("kind IS NOT NULL").distinct()
    return saved(found, "entities")


def redrawn(found: DataFrame, key: str) -> DataFrame:
    """`kind, entity, attempt` of the entities whose first surrogate is not theirs alone.

    Each round draws again for all but the smallest of those that collide. The rounds
    end because a draw that stands is never given up, and draws grow longer by a part a
    round after the first few, so also a shape without free surrogates, or one in which
    nothing can vary, gets room.
    """
    drawn = found.withColumn("attempt", F.lit(0)).withColumn(
        "drawn", surrogate(F.col("kind"), F.col("entity"), key, F.col("attempt"))
    )
    drawn = saved(drawn, "surrogates")
    while True:
        first = drawn.groupBy("kind", "drawn").agg(F.min(F.struct("attempt", "entity")).alias("first"), F.count("*").alias("n"))
        real = found.select("kind", F.col("entity").alias("drawn"), F.lit(True).alias("real"))
        # Only surrogates that collide are met again; a hot one is a few rows after combining.
        clash = first.join(real, ["kind", "drawn"], "left").filter("n > 1 OR real")
        losers = (
            drawn.join(clash, ["kind", "drawn"])
            .filter("real OR entity != first.entity")
            .select("kind", "entity", (F.col("attempt") + 1).alias("again"))
        )
        losers = saved(losers, "collisions")
        if not losers.take(1):
            return drawn.filter("attempt > 0").select("kind", "entity", "attempt")
        drawn = saved(
            drawn.join(losers, ["kind", "entity"], "left")
            .withColumn("attempt", F.coalesce("again", "attempt"))
            .withColumn(
                "drawn",
                F.when(
                    F.col("again").isNotNull(), surrogate(F.col("kind"), F.col("entity"), key, F.col("attempt"))
                ).otherwise(F.col("drawn")),
            )
            .drop("again"),
            "surrogates",
        )


def pseudonymise(docs: DataFrame, key: str, redraws: DataFrame | None = None) -> DataFrame:
    """`doc_id, text, n_entities, kinds` of every row of `docs(doc_id, text)`.

    `kinds` lists the types found, sorted. A null text stays null. Rows may repeat, ids
    may be null, other columns are ignored.
    """
    rows = docs.select("doc_id", "text")
    if redraws is None:
        redraws = redrawn(entities(rows), key)
    found = with_entities(rows)
    if redraws.take(1):
        found = _with_attempts(found, redraws)
    else:
        found = found.withColumn("_attempts", F.lit(None).cast("map<string,int>"))
    attempt = lambda e: F.coalesce(
        F.try_element_at(F.col("_attempts"), F.concat_ws("\x1f", e["kind"], e["entity"])), F.lit(0)
    )
    replaced = F.transform(
        "_found",
        lambda e: F.when(e["kind"].isNull(), e["value"]).otherwise(
            written(e["kind"], e["value"], surrogate(e["kind"], e["entity"], key, attempt(e)), key)
        ),
    )
    joined = F.array_join(F.zip_with("_pieces", "_new", lambda p, v: F.concat(p, F.coalesce(v, F.lit("")))), "")
    kinds = F.filter(F.transform("_found", lambda e: e["kind"]), lambda k: k.isNotNull())
    return found.withColumn("_new", F.when(F.size("_found") > 0, replaced)).select(
        "doc_id",
        F.when(F.size("_found") > 0, joined).otherwise(F.col("text")).alias("text"),
        F.size(kinds).cast("long").alias("n_entities"),
        F.array_join(F.array_sort(F.array_distinct(kinds)), ",").alias("kinds"),
    )


def _with_attempts(found: DataFrame, redraws: DataFrame) -> DataFrame:
    """Add `_attempts`, the draws of the entities of the row that were drawn again."""
    keyed = found.withColumn("_id", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).withColumn(
        "_hash", F.xxhash64("text")
    )
    per_entity = keyed.select("_id", "_hash", F.explode_outer("_found").alias("e")).select("_id", "_hash", "e.kind", "e.entity")
    own = (
        per_entity.filter("kind IS NOT NULL")
        .distinct()
        .join(redraws, ["kind", "entity"])
        .groupBy("_id", "_hash")
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct(F.concat_ws("\x1f", "kind", "entity"), F.col("attempt")))
            ).alias("_attempts")
        )
    )
    return keyed.join(own, ["_id", "_hash"], "left").drop("_id", "_hash")
