"""Surrogates for personal data. DataFrame functions only.

Entities are found by patterns. Every distinct entity gets a surrogate that is derived from a secret
key, so all mentions of it, in all documents and spellings, get the same one. Surrogates are of
the entity's type: numbers keep their groups and punctuation, card numbers their check digit, addresses
their domain ending, names their title, gender and script. Before use they are checked: two
entities never share a surrogate and no surrogate is an entity of the data; those that fail are
derived again until none does.

Names are found behind a form of address or as a listed given name with a family name. Other names stay. A family name
found so is replaced wherever it comes again in the same text, capitalised or in capitals, unless the text
also has it as an ordinary lower-case word.

Mentions are rewritten in their own spelling. Only texts with entities are shuffled, with one row for
each different text on the entities' side; all others pass straight through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import fresh
from cartlens.session import materialize, scratch_path

OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# with inner capitals and apostrophes, as in McBride and O'Hara, but without a possessive s
CAPITALISED = r"\p{Lu}(?:[\p{Ll}\p{M}]|['’](?!s(?!\p{L}))\p{L}|(?<=\p{Ll})\p{Lu}(?=\p{Ll}))+(?:-\p{Lu}[\p{Ll}]+)?"
# Forms of address with the gender they tell, and frequent given names by gender and script.
TITLES = {
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Don", "Signor", "г-н", "господин", "κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "Doña", "Signora", "г-жа", "госпожа", "κυρία"),
    "n": ("Dr", "Prof", "Professor", "Доктор"),
}
GIVEN = {
    "m": (
        "James John Robert Michael William Peter Paul George David Richard Joseph Thomas Charles Daniel Matthew Anthony Steven Andrew Kenneth "
        "Hans Klaus Jürgen Wolfgang Stefan Pierre Michel Philippe Laurent Nicolas Carlos Javier Miguel Alejandro Fernando"
    ).split(),
    "f": (
        "Mary Patricia Linda Maria Anna Jennifer Elizabeth Barbara Susan Jessica Sarah Karen Margaret Sandra Ashley Emily Michelle Laura "
        "Ursula Monika Petra Sabine Katrin Isabelle Nathalie Sylvie Françoise Camille Lucía Carmen Pilar Dolores Isabel"
    ).split(),
    "mc": "Александр Дмитрий Сергей Андрей Алексей Михаил Владимир Николай Павел Виктор".split(),
    "fc": "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Юлия".split(),
    "mg": "Γιώργος Δημήτρης Κώστας Γιάννης Νίκος Παναγιώτης Βασίλης Χρήστος".split(),
    "fg": "Μαρία Ελένη Κατερίνα Βασιλική Σοφία Γεωργία Αναστασία Δήμητρα".split(),
}
# syllables of made-up family names by script
SYLLABLES = {
    "l": "bar den fel gor hal kin lor mar nol per ran sel tor vin wal zan".split(),
    "c": "бар вин гор дал зон кир лод мар нел пор рул сан тол фед хар шин".split(),
    "g": "βαρ γον δελ ζαν καλ λιν μαρ νικ παλ ρον σαρ τιν φιλ χαρ ψαν ωρι".split(),
}
# endings of made-up given names by gender and script
ENDINGS = {"m": {"l": "o", "c": "ий", "g": "ος"}, "f": {"l": "a", "c": "ия", "g": "α"}}
# calling codes of one and two digits; all others have three
CALLING = r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
PRIVATE = r"^(?:10|127|192\.168|172\.(?:1[6-9]|2\d|3[01]))\."
_HEX = "[0-9A-Fa-f]{1,4}"
_TITLE = "(?:" + "|".join(t for ts in TITLES.values() for t in ts) + r")\.?"
_GIVEN = "(?:" + "|".join(n for ns in GIVEN.values() for n in ns) + ")"
# the place of a word that may start a name; the first letter is looked at before the lists
_START = r"(?<![\p{L}])(?=[\p{Lu}гκ])"

# In this order: the first pattern that matches at a place decides.
PATTERNS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "secret": (
        r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9]{20,}|[0-9a-f]{40}|[0-9a-f]{64})(?![A-Za-z0-9])"
        r"|(?<=\b(?:password|passwd|pwd|secret|token|api_key|apikey)[=:])[^\s,;\"']+"
    ),
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": rf"(?<![\d.]){OCTET}(?:\.{OCTET}){{3}}(?!\.?\d)",
    "ip6": (
        rf"(?<![\w:.])(?=[0-9A-Fa-f:]*[0-9])(?:{_HEX}(?::{_HEX}){{7}}|{_HEX}(?::{_HEX}){{0,5}}::(?:{_HEX}(?::{_HEX}){{0,5}})?)(?![\w:])"
    ),
    "phone": (
        r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
        r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])"
    ),
    "card": r"(?<![\w-])\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\w-])",
    "id": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "name": rf"{_START}(?:{_TITLE} (?:{CAPITALISED} ){{0,2}}{CAPITALISED}|{_GIVEN} {CAPITALISED}(?![\p{{L}}]))",
}
# What every entity has: a digit or an at sign, the begin of a key, forty hex letters, a word before a secret, or a form of
# address or a given name.
MAYBE = rf"[0-9@]|AKIA|gh[pousr]_|sk-|[a-f]{{40}}|\b(?:password|passwd|pwd|secret|token|api_key|apikey)[=:]|{_START}(?:{_TITLE}|{_GIVEN}) "
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
ROUNDS = 12


def _hash(key: str, *parts: Column) -> Column:
    """128 hex digits that depend on the key."""
    return F.sha2(F.concat_ws("\x1f", F.lit(key), *parts), 512)


def _number(digest: Column, at: Column, modulus: int) -> Column:
    """A number below the modulus from three hex digits of the digest, at the given place (from 0, cyclic)."""
    return F.conv(F.substr(digest, (at * 3) % 120 + 1, F.lit(3)), 16, 10).cast("int") % modulus


def _chars(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def kind_of(mention: Column) -> Column:
    """Type of a mention: that of the first pattern it fits wholly."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        whole = pattern if kind != "secret" else r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9]{20,}|[0-9a-f]{40}|[0-9a-f]{64}"
        out = F.when(mention.rlike(f"^(?:{whole})$"), kind).otherwise(out)
    return F.coalesce(out, F.lit("secret"))


def canonical(kind: Column, mention: Column) -> Column:
    """What all spellings of an entity have in common."""
    digits = F.regexp_replace(mention, r"\D", "")
    return (
        F.when((kind == "phone") & mention.startswith("+"), F.concat(F.lit("+"), digits))
        .when(kind.isin("phone", "card", "id"), digits)
        .when(kind == "email", F.lower(mention))
        .when(kind == "iban", F.regexp_replace(mention, " ", ""))
        .when(kind == "ip6", F.array_join(_groups(mention), ":"))
        .otherwise(mention)
    )


def _side(mention: Column, side: int) -> Column:
    """Groups before (0) or after (1) the double colon."""
    text = F.coalesce(F.get(F.split(mention, "::"), F.lit(side)), F.lit(""))
    return F.filter(F.split(text, ":"), lambda g: g != "")


def _groups(mention: Column) -> Column:
    """All eight groups of an IPv6 address, without leading zeros."""
    left, right = _side(mention, 0), _side(mention, 1)
    whole = F.concat(left, F.array_repeat(F.lit("0"), F.lit(8) - F.size(left) - F.size(right)), right)
    return F.transform(whole, lambda g: F.regexp_replace(F.lower(g), "^0+(?=.)", ""))


def _scramble(text: Column, digest: Column, keep_zero: bool = False) -> Column:
    """Digits to digits, letters to letters of their case, the rest as it is; a leading digit of a run
    of digits stays above zero if it was."""
    chars = _chars(text)

    def swap(c: Column, i: Column) -> Column:
        lead = (i == 0) | ~F.coalesce(F.get(chars, i - 1), F.lit("")).rlike("[0-9]")
        digit = F.when(lead & (c != "0"), F.lit(1) + _number(digest, i, 9)).otherwise(_number(digest, i, 10))
        return (
            F.when(c.rlike("^[0-9]$"), digit.cast("string"))
            .when(c.rlike("^[a-z]$"), F.char(F.lit(97) + _number(digest, i, 26)))
            .when(c.rlike("^[A-Z]$"), F.char(F.lit(65) + _number(digest, i, 26)))
            .otherwise(c)
        )

    return F.when(text == "", text).otherwise(F.array_join(F.transform(chars, swap), ""))


def _hex_scramble(text: Column, digest: Column) -> Column:
    """Another hex string of the same length."""
    return F.substr(F.concat(digest, digest), F.lit(1), F.length(text))


def _luhn(digits: Column) -> Column:
    """Sum of a card number that is 0 modulo 10 if its check digit is right."""
    chars = F.reverse(_chars(digits))

    def part(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(chars, part), F.lit(0), lambda a, b: a + b) % 10


def _card(digits: Column, digest: Column) -> Column:
    """First digit as it was, the others new, with a check digit that is right if it was."""
    first = F.substr(digits, F.lit(1), F.lit(1))
    body = F.concat(first, F.array_join(F.transform(F.sequence(F.lit(1), F.length(digits) - 2), lambda i: _number(digest, i, 10).cast("string")), ""))
    check = (10 - _luhn(F.concat(body, F.lit("0")))) % 10
    wrong = (check + 1 + _number(digest, F.lit(39), 9)) % 10
    return F.concat(body, F.when(_luhn(digits) == 0, check).otherwise(wrong).cast("string"))


def _iban(text: Column, digest: Column) -> Column:
    """Country as it was, the account new, with right check digits."""
    country, account = F.substr(text, F.lit(1), F.lit(2)), _scramble(F.substring(text, 5, 40), digest)
    moved = _chars(F.concat(account, country, F.lit("00")))

    def fold(a: Column, c: Column) -> Column:
        n = F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return (a * F.when(n > 9, 100).otherwise(10) + n) % 97

    rest = F.aggregate(moved, F.lit(0), fold)
    return F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), account)


def _ip(text: Column, digest: Column) -> Column:
    """New octets; private ranges stay private."""
    octet = [(F.lit(1) + _number(digest, F.lit(k), 254)).cast("string") for k in range(4)]
    private = F.regexp_extract(text, PRIVATE, 0)
    inner = (F.lit(16) + _number(digest, F.lit(4), 16)).cast("string")
    return (
        F.when(private.startswith("172."), F.concat_ws(".", F.lit("172"), inner, *octet[:2]))
        .when(private.startswith("192."), F.concat(private, F.concat_ws(".", *octet[:2])))
        .when(private != "", F.concat(private, F.concat_ws(".", *octet[:3])))
        .otherwise(F.concat_ws(".", *octet))
    )


def _ip6(text: Column, digest: Column) -> Column:
    """New groups where there are any; zeros, and the range of local addresses, stay."""

    def new(g: Column, i: Column) -> Column:
        made = F.concat(F.lower(F.hex(F.lit(1) + _number(digest, F.lit(30) + i, 15))), F.substr(digest, i * 3 + 1, F.lit(3)))
        return (
            F.when((g == "0") | ((i == 0) & g.rlike("^(?:fe[89ab].|f[cd]..)$")), g)
            .when(i == 0, F.concat(F.lit("2"), F.substr(digest, F.lit(1), F.lit(3))))
            .otherwise(made)
        )

    return F.array_join(F.transform(F.split(text, ":"), new), ":")


def _email(text: Column, digest: Column, domain: Column) -> Column:
    """A new local part of the same form at the domain's own surrogate, so that addresses of one domain stay together."""
    return F.concat(_scramble(F.substring_index(text, "@", 1), digest), F.lit("@"), domain)


def _domain(text: Column, digest: Column) -> Column:
    """The ending stays."""
    ending = F.substring_index(text, ".", -1)
    stem = F.substr(text, F.lit(1), F.length(text) - F.length(ending))
    return F.concat(_scramble(stem, digest), ending)


def _phone(text: Column, digest: Column) -> Column:
    """The country's code as it was, the rest new."""
    country = F.regexp_extract(text, CALLING, 0)
    return F.concat(country, _scramble(F.substr(text, F.length(country) + 1), digest))


def _secret(text: Column, digest: Column) -> Column:
    prefix = F.regexp_extract(text, r"^(AKIA|gh[pousr]_|sk-)", 1)
    rest = F.substr(text, F.length(prefix) + 1)
    is_hex = text.rlike("^[0-9a-f]+$") & text.rlike("[a-f]")
    return F.when(is_hex, _hex_scramble(text, digest)).otherwise(F.concat(prefix, _scramble(rest, digest)))


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"^\p{IsCyrillic}"), "c").when(word.rlike(r"^\p{IsGreek}"), "g").otherwise("l")


def _given_gender(word: Column) -> Column:
    """Group of a listed given name (gender and script), else null."""
    out = F.lit(None).cast("string")
    for group, names in GIVEN.items():
        out = F.when(word.isin(names), group).otherwise(out)
    return out


def _given(word: Column, group: Column, key: str) -> Column:
    """Another given name of the group: the list turned by a keyed number of places, so that different names
    stay different."""
    out = word
    for g, names in GIVEN.items():
        listed = F.array(*[F.lit(n) for n in names])
        turn = 1 + _number(_hash(key, F.lit("given" + g)), F.lit(0), len(names) - 1)
        place = (F.array_position(listed, word).cast("int") - 1 + turn) % len(names)
        out = F.when(group == g, F.get(listed, place)).otherwise(out)
    return out


def _family(word: Column, digest: Column, gender: str | None = None) -> Column:
    """A made-up name in the word's script: four syllables; a given name has three and an ending that tells the gender."""
    out = word
    script = _script(word)
    for s, syllables in SYLLABLES.items():
        listed = F.array(*[F.lit(x) for x in syllables])
        made = F.concat(*[F.get(listed, _number(digest, F.lit(k), len(syllables))) for k in range(3 if gender else 4)])
        out = F.when(script == s, F.initcap(F.concat(made, F.lit(ENDINGS[gender][s])) if gender else made)).otherwise(out)
    return out


def _title_gender(word: Column) -> Column:
    plain = F.regexp_replace(word, r"\.$", "")
    return F.when(plain.isin(*TITLES["m"]), "m").when(plain.isin(*TITLES["f"]), "f")


def _is_title(word: Column) -> Column:
    return F.regexp_replace(word, r"\.$", "").isin([t for ts in TITLES.values() for t in ts])


def surrogate(kind: Column, text: Column, attempt: int, key: str, domain: Column) -> Column:
    """The surrogate of a canonical entity; another one for each attempt. domain: the surrogate of an address's domain."""
    digest = _hash(key, kind, text, F.lit(str(attempt)))
    made = (
        F.when(kind == "email", _email(text, digest, domain))
        .when(kind == "domain", _domain(text, digest))
        .when(kind == "ip6", _ip6(text, digest))
        .when(kind == "given m", _family(text, digest, "m"))
        .when(kind == "given f", _family(text, digest, "f"))
        .when(kind == "ip", _ip(text, digest))
        .when(kind == "phone", _phone(text, digest))
        .when(kind == "card", _card(text, digest))
        .when(kind == "iban", _iban(text, digest))
        .when(kind == "secret", _secret(text, digest))
        .when(kind == "family", _family(text, digest))
        .otherwise(_scramble(text, digest))
    )
    # a form too narrow for all its entities gets longer in the end, which cannot collide for ever
    return made if attempt < ROUNDS else F.concat(made, F.substr(digest, F.lit(1), F.lit(attempt)))


def _assign(entities: DataFrame, key: str) -> DataFrame:
    """kind, entity, surrogate: no two entities of a kind with the same surrogate, none that is an entity.

    entities: kind, entity, domain (surrogate of an address's domain).
    """
    spark = entities.sparkSession
    entities = materialize(entities, "pii-entities")
    path = scratch_path(spark, "pii-surrogates")
    pending, attempt = entities, 0
    done = spark.createDataFrame([], "kind string, entity string, surrogate string")
    done.write.parquet(path)
    while True:
        tried = pending.withColumn("surrogate", surrogate(F.col("kind"), F.col("entity"), attempt, key, F.col("domain")))
        first = tried.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity"))
        own = entities.select("kind", F.col("entity").alias("surrogate"))
        free = first.join(own, ["kind", "surrogate"], "left_anti")
        if attempt:
            taken = spark.read.schema(done.schema).parquet(path).select("kind", "surrogate")
            free = free.join(taken, ["kind", "surrogate"], "left_anti")
        materialize(free.select("kind", "entity", "surrogate"), "pii-round").write.mode("append").parquet(path)
        done = spark.read.schema(done.schema).parquet(path)
        pending = materialize(entities.join(done, ["kind", "entity"], "left_anti"), "pii-pending")
        attempt += 1
        if not pending.take(1):
            return done


def _in_spelling(kind: Column, mention: Column, made: Column) -> Column:
    """The surrogate written like the mention: its digits and letters in the mention's places, groups and case."""
    chars = _chars(mention)
    symbols = _chars(F.regexp_replace(made, "[^0-9A-Za-z]", ""))

    def put(c: Column, i: Column) -> Column:
        place = F.length(F.regexp_replace(F.substr(mention, F.lit(1), i + 1), "[^0-9A-Za-z]", "")) - 1
        s = F.get(symbols, place)
        return F.when(~c.rlike("^[0-9A-Za-z]$"), c).when(c.rlike("^[A-Z]$"), F.upper(s)).otherwise(s)

    # an IPv6 address is compressed where the mention is
    left, right = F.size(_side(mention, 0)), F.size(_side(mention, 1))
    groups = F.split(made, ":")
    pressed = F.concat(
        F.array_join(F.slice(groups, F.lit(1), left), ":"), F.lit("::"), F.array_join(F.slice(groups, 9 - right, right), ":")
    )
    six = F.when(mention.contains("::"), pressed).otherwise(made)
    six = F.when(mention.rlike("[A-F]"), F.upper(six)).otherwise(six)
    same_size = F.size(symbols) == F.length(F.regexp_replace(mention, "[^0-9A-Za-z]", ""))
    spelled = F.array_join(F.transform(chars, put), "")
    return F.when(kind == "ip6", six).when(kind.isin("phone", "card", "id", "iban", "email") & same_size, spelled).otherwise(made)


def _alone(word: Column) -> Column:
    """Pattern of a word that stands alone; names hold no other signs than letters, hyphens and apostrophes."""
    return F.concat(F.lit(r"(?<![\p{L}\p{M}\p{N}])"), word, F.lit(r"(?![\p{L}\p{M}\p{N}])"))


def _again(text: Column, families: Column) -> Column:
    """Patterns and replacements of family names that may come again in a text, as they are and in capitals."""
    rare = F.filter(families, lambda n: ~F.regexp_like(text, _alone(F.lower(n["mention"]))))
    plain = lambda n: F.struct(_alone(n["mention"]).alias("pattern"), n["surrogate"].alias("made"))
    capitals = lambda n: F.struct(_alone(F.upper(n["mention"])).alias("pattern"), F.upper(n["surrogate"]).alias("made"))
    return F.concat(F.transform(rare, plain), F.transform(rare, capitals))


def _count_again(gap: Column, again: Column) -> Column:
    return F.aggregate(again, F.lit(0), lambda n, a: n + F.regexp_count(gap, a["pattern"]))


def replace(
    docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """docs with surrogates in the text column, and n_entities and kinds (sorted) of what was replaced.

    Null, empty and other texts without entities stay as they are, with 0 entities. Repeated rows are
    treated each. All other columns stay; columns with the new names are replaced.
    """
    names = {n: fresh(docs, n) for n in ("text_key", "mentions", "made", "families")}
    found = F.regexp_extract_all(docs[text], F.lit(ANY), F.lit(0))
    has = F.coalesce(docs[text].rlike(MAYBE) & docs[text].rlike(ANY), F.lit(False))
    plain = docs.filter(~has)
    marked = docs.filter(has).withColumn(names["text_key"], F.sha2(docs[text], 256))
    # one row for each different text, however many copies it has
    texts = marked.select(F.col(names["text_key"]).alias("text_key"), found.alias("mentions")).groupBy("text_key")
    texts = texts.agg(F.first("mentions").alias("mentions"))
    mentions = texts.select("text_key", F.posexplode("mentions").alias("place", "mention"))
    mentions = mentions.withColumn("kind", kind_of(F.col("mention")))
    # a name is taken word by word, so that a family name alone or behind a title is the same
    word = F.when(F.col("kind") == "name", F.split("mention", " ")).otherwise(F.array("mention"))
    gender = F.when((F.col("kind") == "name") & (F.size(word) > 2), _title_gender(F.get(word, F.lit(0))))
    parts = mentions.select(
        "text_key", "place", "kind", gender.alias("gender"), (F.size(word) - 1).alias("last"), F.posexplode(word).alias("part", "mention")
    )
    given = _given_gender(F.col("mention"))
    part_kind = (
        F.when(F.col("kind") != "name", F.col("kind"))
        .when((F.col("part") == 0) & _is_title(F.col("mention")), "title")
        .when(given.isNotNull(), "given")
        .when(F.col("gender").isNotNull() & (F.col("part") < F.col("last")), F.concat(F.lit("given "), F.col("gender")))
        .otherwise("family")
    )
    parts = parts.withColumn("kind", part_kind).withColumn("entity", canonical(F.col("kind"), F.col("mention")))
    parts = materialize(parts, "pii-parts")
    entities = parts.filter(~F.col("kind").isin("title", "given")).select("kind", "entity").distinct()
    entities = entities.withColumn("of", F.when(F.col("kind") == "email", F.substring_index("entity", "@", -1)))
    domains = entities.filter(F.col("of").isNotNull()).select(F.lit("domain").alias("kind"), F.col("of").alias("entity")).distinct()
    named = _assign(domains.withColumn("domain", F.lit(None).cast("string")), key)
    named = named.select(F.col("entity").alias("of"), F.col("surrogate").alias("domain"))
    made = _assign(entities.join(named, "of", "left").drop("of"), key)
    joined = parts.join(made, ["kind", "entity"], "left")
    written = (
        F.when(F.col("kind") == "title", F.col("mention"))
        .when(F.col("kind") == "given", _given(F.col("mention"), _given_gender(F.col("mention")), key))
        .otherwise(_in_spelling(F.col("kind"), F.col("mention"), F.col("surrogate")))
    )
    kind = F.when(F.col("kind").isin("title", "given", "given m", "given f", "family"), "name").when(F.col("kind") == "ip6", "ip")
    family = F.when((F.col("kind") == "family") & (F.length("mention") > 2), F.struct("mention", "surrogate"))
    spelled = joined.select(
        "text_key", "place", "part", kind.otherwise(F.col("kind")).alias("kind"), written.alias("written"), family.alias("family")
    )
    whole = spelled.groupBy("text_key").agg(
        F.array_sort(F.collect_list(F.struct("place", "part", "kind", "written"))).alias("parts"), F.collect_set("family").alias("families")
    )
    # (place, part) in order: parts of one mention are joined by a space, mentions stay apart
    join_parts = F.aggregate(
        F.col("parts"),
        F.array().cast("array<string>"),
        lambda out, p: F.when(p["part"] == 0, F.concat(out, F.array(p["written"]))).otherwise(
            F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(F.concat(F.element_at(out, F.lit(-1)), F.lit(" "), p["written"])))
        ),
    )
    kinds = F.array_sort(F.array_distinct(F.col("parts.kind")))
    # written, so that the join deals both sides out for it and a text with very many copies can be split
    per_text = materialize(whole.select("text_key", join_parts.alias("made"), kinds.alias("kinds"), "families"), "pii-texts")
    per_text = per_text.withColumnsRenamed({"text_key": names["mentions"], "made": names["made"], "families": names["families"]})
    rest = docs.columns
    keep = [c for c in rest if c.lower() not in ("n_entities", "kinds")]
    kinds_name = fresh(docs, "found_kinds")
    per_text = per_text.withColumnRenamed("kinds", kinds_name)
    filled = marked.join(per_text, marked[names["text_key"]] == per_text[names["mentions"]])
    gaps = F.split(F.col(text), ANY, -1)
    again = _again(F.col(text), F.col(names["families"]))
    number = F.aggregate(gaps, F.size(names["made"]), lambda n, g: n + _count_again(g, again))
    gaps = F.transform(gaps, lambda g: F.aggregate(again, g, lambda t, n: F.regexp_replace(t, n["pattern"], n["made"])))
    pieces = F.zip_with(gaps, F.col(names["made"]), lambda g, m: F.concat(g, F.coalesce(m, F.lit(""))))
    new_text = F.array_join(pieces, "").alias(text)
    filled = filled.select(
        *[new_text if c == text else F.col(c) for c in keep],
        number.cast("bigint").alias("n_entities"),
        F.col(kinds_name).alias("kinds"),
    )
    plain = plain.select(*keep, F.lit(0).cast("bigint").alias("n_entities"), F.array().cast("array<string>").alias("kinds"))
    return plain.unionByName(filled)
