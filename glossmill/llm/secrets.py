"""Secret scans with a random forest against false positives, in DataFrame operations only.

Candidates come from context and from form. Every value that is assigned to a name with an
announcing word is one, whatever its length and characters: up to the closing quote, or
else up to white space. So are unbroken tokens with a digit: of 16 characters or more, or of 12
with a sign such as `!` or `#` in them. Features describe the candidate (length, kinds of
characters and changes between them, how much of it a dictionary of letter groups covers,
whether it looks like a path, a date or a number) and what stands around it in the text
(words that announce a secret, assignment, quotes, slashes). A forest of decision trees,
trained on labelled findings, decides which candidates are reported.

The labelled findings are written by column expressions from a seeded range, a bounded
number; a caller with findings of its own passes them instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from glossmill.session import shared_path

N_LABELLED = 6000
BEFORE, AFTER = 32, 8

#: Words that announce a secret, and letter groups of ordinary words.
ANNOUNCING = "token|secret|passw|pwd|api.?key|apikey|access.?key|private.?key|auth|bearer|credential|signature|key"
HARMLESS = "sha1|sha256|md5|commit|uuid|guid|checksum|digest|hash|revision|version|http|href|src|path|file|url|id"
DICTIONARY = (
    "the|ing|and|ion|ent|tion|for|ter|ver|que|ment|con|com|pro|est|ation|able|der|ung|sch|ich|ein|eau|ado|ción|with|that"
    "|this|from|have|file|name|data|test|user|page|main|index|image|report|user|com|net|org|www|html|src|lib|usr|bin"
)

#: A name with an announcing word, the assignment and an opening quote. The look ahead drops
#: other names at once, and names are entered at their start only, so time is linear in the text.
LEAD = (
    r"(?<![A-Za-z0-9_.-])(?=[A-Za-z0-9_.-]++[\"'`]?\s{0,3}[=:])"
    rf"[A-Za-z0-9_.-]*?(?i:{ANNOUNCING})[A-Za-z0-9_.-]*+[\"'`]?\s{{0,3}}[=:]{{1,2}}[=>]?[ \t]{{0,3}}(?:(?i:bearer|basic)[ \t]{{1,3}})?"
)
ASSIGNED = LEAD + r"(?:\"[^\"\r\n]++|'[^'\r\n]++|`[^`\r\n]++|[^\s\"'`]++)"
#: Both begun behind a border and possessive.
SIGNED = (
    r"(?<![^\s\"'`(])(?=[A-Za-z!#$%&*+@^_~?-]*+[0-9])(?=[A-Za-z0-9+_-]*+[!#$%&*@^~?])"
    r"[A-Za-z0-9!#$%&*+@^_~?-]{12,}+(?![^\s\"'`),.;:])"
)
LONG = r"(?<![A-Za-z0-9+/_.-])(?=[A-Za-z+/_.-]*+[0-9])[A-Za-z0-9+/_.-]{16,}+(?:={1,2}(?![A-Za-z0-9\"'`]))?"
CANDIDATE = f"{ASSIGNED}|{SIGNED}|{LONG}"
#: No match is shorter, so this many before or behind reach over all that is shown around a candidate.
SHORTEST = 5
FEATURES = [
    "length",
    "digit_ratio",
    "upper_ratio",
    "lower_ratio",
    "other_ratio",
    "change_ratio",
    "distinct_ratio",
    "dictionary_ratio",
    "vowel_ratio",
    "is_hex",
    "is_uuid",
    "is_number",
    "slashes",
    "dots",
    "known_prefix",
    "announced",
    "harmless",
    "assigned",
    "quoted",
    "after_slash",
    "spaces",
    "opens",
]


def _share(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)) / F.greatest(F.length(value), F.lit(1))


def described(findings: DataFrame) -> DataFrame:
    """Add `FEATURES` to `value, before, after`."""
    v, before, after = F.col("value"), F.col("before"), F.col("after")
    change = (
        r"(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Za-z]|(?<=[A-Z][A-Z])[a-z]|(?<=[0-9])[^0-9]"
    )
    flag = lambda condition: condition.cast("double")
    columns = {
        "length": F.log1p(F.length(v)),
        "digit_ratio": _share(v, "[0-9]"),
        "upper_ratio": _share(v, "[A-Z]"),
        "lower_ratio": _share(v, "[a-z]"),
        "other_ratio": _share(v, "[^A-Za-z0-9]"),
        "change_ratio": _share(v, change),
        "distinct_ratio": F.size(F.array_distinct(F.split(v, ""))) / F.least(F.greatest(F.length(v), F.lit(1)), F.lit(64)),
        "dictionary_ratio": 1 - F.length(F.regexp_replace(F.lower(v), DICTIONARY, "")) / F.greatest(F.length(v), F.lit(1)),
        "vowel_ratio": _share(F.lower(v), "[aeiou]"),
        "is_hex": flag(v.rlike(r"\A(?:[0-9a-f]++|[0-9A-F]++)\z")),
        "is_uuid": flag(v.rlike(r"\A[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\z")),
        "is_number": flag(v.rlike(r"\A[0-9.+-]++\z")),
        "slashes": F.regexp_count(v, F.lit("/")).cast("double"),
        "dots": F.regexp_count(v, F.lit(r"\.")).cast("double"),
        "known_prefix": flag(v.rlike(r"\A(?:AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|sk-|sk_live_|pk_live_|xox[abpr]-|glpat-|AIza|eyJ)")),
        "announced": flag(before.rlike(rf"(?i)(?:{ANNOUNCING})[^\s]{{0,24}}\s*[=:>]{{0,2}}\s*(?:(?:bearer|basic)\s+)?[\"'`]?\z")),
        "harmless": flag(before.rlike(rf"(?i)(?:\b(?:{HARMLESS}))[\"']?\s*[=:]?\s*[\"'`]?\z")),
        "assigned": flag(before.rlike(r"[=:]\s*[\"'`]?\z")),
        "quoted": flag(before.rlike(r"[\"'`]\z") & after.rlike(r"\A[\"'`]")),
        "after_slash": flag(before.rlike(r"[/\\@]\z")),
        "spaces": F.regexp_count(v, F.lit(r"\s")).cast("double"),
        "opens": flag(v.rlike(r"\A[$<{%(\[*]")),
    }
    return findings.withColumns({name: F.coalesce(c.cast("double"), F.lit(0.0)) for name, c in columns.items()})


def candidates(docs: DataFrame) -> DataFrame:
    """`doc_id, n, value, before, after`: the n-th candidate of each text with what stands around it in the text."""
    # The condition, always true but not deterministic, keeps later filters from doing the search again.
    found = (
        docs.select("doc_id", "text")
        .withColumn("_matches", F.when(F.monotonically_increasing_id() >= 0, F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))))
        .withColumn("_pieces", F.when(F.size("_matches") > 0, F.split("text", CANDIDATE, -1)))
        .withColumn("_starts", _ends(lambda x: F.left(x, F.lit(AFTER))))
        .withColumn("_tails", _ends(lambda x: F.right(x, F.lit(BEFORE))))
    )
    back, ahead = -(-BEFORE // SHORTEST), -(-AFTER // SHORTEST)

    def described_match(match: Column, i: Column) -> Column:
        first = F.greatest(i - back, F.lit(0))
        lead = F.regexp_extract(match, rf"\A{LEAD}[\"'`]?", 0)
        whole = F.substring(match, F.length(lead) + 1, F.length(match))
        # Behind a bare value a comma or semicolon belongs to the sentence.
        value = F.when(lead.rlike(r"[^\"'`]\z"), F.rtrim(whole, F.lit(",;"))).otherwise(whole)
        rest = F.substring(whole, F.length(value) + 1, F.length(whole))
        # Pieces and matches in turn: match i stands at 2 * i + 1, from 0.
        before = F.concat(F.array_join(F.slice("_tails", 2 * first + 1, 2 * (i - first) + 1), ""), lead)
        after = F.concat(rest, F.array_join(F.slice("_starts", 2 * i + 3, F.lit(2 * ahead + 1)), ""))
        return F.struct(
            value.alias("value"),
            F.right(before, F.lit(BEFORE)).alias("before"),
            F.left(after, F.lit(AFTER)).alias("after"),
        )

    # The outer form, as the optimizer adds no filter of its own to it.
    return (
        found.select("doc_id", F.posexplode_outer(F.filter(F.transform("_matches", described_match), lambda f: f["value"] != "")).alias("n", "f"))
        .filter("f IS NOT NULL")
        .select("doc_id", F.col("n").cast("long").alias("n"), "f.*")
    )


def _ends(cut: Callable[[Column], Column]) -> Column:
    """A cut of every piece and match of a text, in turn."""
    pairs = F.arrays_zip("_pieces", "_matches")
    return F.flatten(F.transform(pairs, lambda x: F.array(cut(x["_pieces"]), F.coalesce(cut(x["_matches"]), F.lit("")))))


def labelled_findings(spark: SparkSession, n: int = N_LABELLED, seed: int = 11) -> DataFrame:
    """`value, before, after, label` of `n` findings, half of them secrets."""
    draw = lambda k, below: F.pmod(F.xxhash64("id", F.lit(seed), F.lit(k)), F.lit(below))
    pick = lambda k, *options: F.element_at(
        F.array(*[o if isinstance(o, Column) else F.lit(o) for o in options]), (draw(k, len(options)) + 1).cast("int")
    )
    digest = lambda k, bits=256: F.sha2(F.concat_ws(":", F.col("id"), F.lit(seed), F.lit(k)), bits)
    base64 = lambda k: F.regexp_replace(F.base64(F.unhex(digest(k, 512))), r"[\r\n]", "")
    alnum = lambda k: F.regexp_replace(base64(k), "[+/=]", "")
    cut = lambda text, k, low, high: F.substring(text, F.lit(1), (draw(k, high - low) + low).cast("int"))
    letters = lambda k: F.translate(F.lower(alnum(k)), "0123456789", "aeioutnsrl")
    word = lambda k: pick(k, "thereand", "report", "image", "contention", "archive", "latest", "schung", "document", "summary")
    number = lambda k, size: F.substring(F.translate(digest(k), "abcdef", "123456"), 1, size)

    secret = pick(
        1,
        F.substring(digest(2), 1, 40),
        F.upper(F.substring(digest(2), 1, 40)),
        F.substring(digest(2), 1, 32),
        digest(2),
        cut(alnum(2), 3, 20, 60),
        cut(base64(2), 3, 24, 80),
        F.concat(F.lit("AKIA"), F.upper(F.substring(alnum(2), 1, 16))),
        F.concat(F.lit("ghp_"), F.substring(alnum(2), 1, 36)),
        F.concat(F.lit("sk-"), F.substring(alnum(2), 1, 48)),
        F.concat(F.lit("eyJ"), cut(alnum(2), 3, 20, 50), F.lit("."), cut(alnum(4), 5, 20, 50)),
        # What people choose: letters with digits and signs, and words in a row.
        F.concat(cut(letters(2), 3, 4, 10), number(4, 2), pick(5, "!", "#", "$", "%", "?", "")),
        F.concat(cut(letters(2), 3, 5, 9), cut(letters(4), 5, 5, 9), cut(letters(12), 13, 5, 10)),
        F.concat(cut(alnum(2), 3, 3, 8), pick(4, "!", "#", "%", "&"), cut(alnum(5), 12, 3, 8), pick(13, "!", "#", "*", "^"), cut(alnum(14), 15, 3, 8)),
    )
    harmless = pick(
        1,
        F.concat(word(2), F.lit("_"), word(3), F.lit("_"), number(4, 4)),
        F.concat(word(2), F.lit("/"), word(3), F.lit("/"), number(4, 2), F.lit("/"), word(5), F.lit(".html")),
        F.concat(F.lit("www."), word(2), number(3, 2), F.lit(".example.com/"), word(4)),
        number(2, 16),
        F.concat(number(2, 4), F.lit("-"), number(3, 4), F.lit("-"), number(4, 4), F.lit("-"), number(5, 4)),
        F.concat(word(2), F.lit("."), number(3, 2), F.lit("-mail7.example.com")),
        F.concat_ws("-", F.substring(digest(2), 1, 8), F.substring(digest(2), 9, 4), F.substring(digest(2), 13, 4), F.substring(digest(2), 17, 4), F.substring(digest(2), 21, 12)),
        F.substring(digest(2), 1, 40),
        digest(2),
        F.concat(F.lit("20"), number(2, 2), F.lit("-05-17T12.30."), number(3, 6)),
        F.repeat(pick(2, "x1", "abc123", "0", "1234567890"), 8),
        F.concat(word(2), word(3), word(4), number(5, 1)),
    )
    # Announced and yet no secret: a word of a sentence, a sentence, a setting, a reference.
    named = pick(
        14,
        word(2),
        pick(3, "the", "a", "to", "is", "true", "false", "null", "none", "required", "int", "str", "value", "string", "yes"),
        F.concat_ws(" ", word(2), word(3), word(4)),
        F.concat(F.lit("${"), F.upper(word(2)), F.lit("}")),
        F.concat(F.lit("<your-"), word(2), F.lit(">")),
        F.concat(F.lit("config."), word(2), F.lit("()")),
        number(2, 3),
        F.repeat(F.lit("*"), 8),
    )
    name = pick(6, "token", "api_key", "secret", "password", "access_key", "auth_token", "API-KEY", "Bearer", "TOKEN", "client_secret")
    sign = pick(7, " = \"", "=", ": ", ": \"", "='", " = '", " = ")
    around = F.concat(word(8), F.lit(" "), word(9), F.lit(" "))
    neutral = pick(10, "commit ", "sha256: ", "see ", "(", "/", "file=\"", "version ", "id: ", "checksum = ", "in ", "", "href=\"", "uuid=")
    bad, announced = draw(0, 2) == 1, draw(15, 3) == 0
    prefix = F.when(bad | announced, F.concat(around, name, sign)).otherwise(F.concat(around, neutral))
    quote = F.regexp_extract(prefix, r"([\"'])\z", 1)
    return spark.range(n).select(
        F.when(bad, secret).when(announced, named).otherwise(harmless).alias("value"),
        F.substring(prefix, F.greatest(F.length(prefix) - BEFORE + 1, F.lit(1)), F.lit(BEFORE)).alias("before"),
        F.substring(F.concat(quote, F.lit(" "), word(11)), 1, AFTER).alias("after"),
        bad.cast("double").alias("label"),
    )


def train(findings: DataFrame, n_trees: int = 24, depth: int = 7, seed: int = 3) -> RandomForestClassificationModel:
    """A forest from `value, before, after, label`; the caller bounds the findings."""
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=n_trees, maxDepth=depth, seed=seed, cacheNodeIds=False
    )
    # A stored model leaves its training summary behind, and with it the session, which
    # cannot go to tasks once the session has observed a metric.
    path = shared_path(findings.sparkSession, "secret-forest")
    forest.fit(_vectors(described(findings)).select("features", "label")).save(path)
    return RandomForestClassificationModel.load(path)


def _vectors(rows: DataFrame) -> DataFrame:
    return rows.withColumn("features", array_to_vector(F.array(*FEATURES)))


def scan(
    docs: DataFrame, model: RandomForestClassificationModel | None = None, threshold: float = 0.5
) -> DataFrame:
    """`doc_id, n, value, probability, is_secret` of all candidates of `docs(doc_id, text)`.

    `n` numbers the candidates of a row from 0. Null and empty texts have none, rows may
    repeat, ids may be null, other columns are ignored.
    """
    model = model or train(labelled_findings(docs.sparkSession))
    scored = model.transform(_vectors(described(candidates(docs))))
    p = F.element_at(vector_to_array("probability"), 2)
    return scored.select("doc_id", "n", "value", p.alias("probability"), (p >= threshold).alias("is_secret"))


def masked(findings: DataFrame) -> DataFrame:
    """Findings without the secrets: the first four characters and a digest of each."""
    return findings.withColumns(
        {"value_start": F.substring("value", 1, 4), "value_sha256": F.sha2("value", 256)}
    ).drop("value")
