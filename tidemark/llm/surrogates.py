"""Keyed surrogates for personal data.

Entities are found by one pattern.  Every distinct entity of the corpus gets one
surrogate of its own kind from a keyed hash: the same entity gets the same surrogate
everywhere, no two entities of a kind share one, and none is an entity of the corpus.
Candidates that break this are drawn again.  Texts then get the surrogates in the
format of each occurrence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import cut_lineage

# Titles and common given names by gender and script.
MALE_TITLES = ("Mr.", "Mr", "Herr", "Señor", "Sr.", "Monsieur", "г-н", "господин", "κύριος")
FEMALE_TITLES = ("Mrs.", "Mrs", "Ms.", "Ms", "Miss", "Frau", "Señora", "Sra.", "Madame", "Mme", "г-жа", "госпожа", "κυρία")
GIVEN = {
    ("m", "latin"): ("adam", "albert", "bruno", "carl", "daniel", "david", "erik", "felix", "george", "henry", "hugo", "ivan", "jacob", "julian", "leon", "lucas", "martin", "max", "noah", "oscar", "paul", "peter", "robert", "simon", "thomas", "victor"),
    ("f", "latin"): ("alice", "amelia", "anna", "bianca", "carla", "clara", "diana", "elena", "emma", "eva", "flora", "greta", "helen", "ida", "irene", "julia", "laura", "lena", "lucia", "maria", "marta", "nora", "olivia", "paula", "rosa", "sofia"),
    ("m", "cyrillic"): ("алексей", "андрей", "борис", "виктор", "григорий", "дмитрий", "иван", "кирилл", "леонид", "михаил", "николай", "олег", "павел", "роман", "сергей", "юрий"),
    ("f", "cyrillic"): ("алина", "анна", "вера", "галина", "дарья", "елена", "ирина", "ксения", "лариса", "мария", "надежда", "ольга", "полина", "светлана", "татьяна", "юлия"),
    ("m", "greek"): ("ανδρέας", "γιάννης", "δημήτρης", "κώστας", "μάρκος", "νίκος", "πέτρος", "στέφανος"),
    ("f", "greek"): ("άννα", "ελένη", "ειρήνη", "κατερίνα", "μαρία", "νίκη", "σοφία", "χριστίνα"),
}
SYLLABLES = {
    "latin": ("ba", "ber", "dan", "del", "fer", "gar", "hol", "kel", "lan", "mar", "nor", "pel", "ros", "sten", "tor", "win"),
    "cyrillic": ("ба", "бер", "ван", "гор", "дан", "зар", "кол", "лен", "мар", "нов", "пел", "рос", "сав", "тар", "фед", "шев"),
    "greek": ("αλ", "βα", "γερ", "δα", "κα", "λαμ", "μαν", "νικ", "παπ", "ρο", "σαν", "τσα", "φιλ", "χρ", "ψα", "ζαν"),
}

#: Kinds of matches; a name has a given name and a surname, or a surname alone.
KINDS = ("email", "phone", "ip", "iban", "card", "secret", "name")
SECRET_NAMES = ("token", "password", "secret", "api_key")


def _titles(titles: tuple[str, ...]) -> str:
    return "|".join(t.replace(".", r"\.") for t in titles)


_NAME = r"\p{Lu}[\p{L}\p{M}'’-]{0,40}"
_SECRET_LEAD = rf"(?i:{'|'.join(SECRET_NAMES)})\s?[=:]\s?[\"']?"
_TITLE_LEAD = rf"(?:{_titles(MALE_TITLES + FEMALE_TITLES)}) "
#: One group for each of KINDS, in order.  Every repeated group is bounded (host names have at most 127
#: parts): the matcher recurses once per repeat.
PATTERN = "|".join(
    (
        r"((?<![\w.%+-])[A-Za-z0-9][\w.%+-]*@(?:[A-Za-z0-9-]+\.){1,126}[A-Za-z]{2,})",
        r"((?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[ .-]\d{4}(?!\w))",
        r"((?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d))",
        r"((?<!\w)[A-Z]{2}\d{2}[A-Z0-9]{10,30}(?!\w))",
        r"((?<![\w.])(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{13,19})(?!\w))",
        rf"(\b{_SECRET_LEAD}[A-Za-z0-9_/+-]{{8,}}|(?<!\w)AKIA[0-9A-Z]{{16}}(?!\w))",
        rf"((?<![\p{{L}}\p{{N}}]){_TITLE_LEAD}{_NAME}(?: {_NAME}){{0,3}})",
    )
)


def may_match(text: Column) -> Column:
    """True for every text with a match, by tests much cheaper than the pattern."""
    out = text.rlike("[0-9@]") | text.rlike(f"(?i:{'|'.join(SECRET_NAMES)})")
    for part in dict.fromkeys(["AKIA", *(t.rstrip(".") for t in MALE_TITLES + FEMALE_TITLES)]):
        out = out | F.contains(text, F.lit(part))
    return out


def _bytes(key: Column, *parts: Column | str) -> Column:
    """32 keyed pseudo-random bytes as hex."""
    return F.sha2(F.concat_ws("\x1f", key, *[F.lit(p) if isinstance(p, str) else p for p in parts]), 256)


def _number(hexes: Column, at: int, below: Column | int) -> Column:
    """A number below a bound, from eight hex digits."""
    return F.pmod(F.conv(F.substring(hexes, 1 + 8 * at, 8), 16, 10).cast("long"), F.lit(below) if isinstance(below, int) else below)


def _draw(seed: Column, i: Column, below: Column | int) -> Column:
    """The i-th number below a bound from a seed of any length of use."""
    return F.pmod(F.conv(F.substring(F.sha2(F.concat_ws("\x1f", seed, i.cast("string")), 256), 1, 8), 16, 10).cast("long"), F.lit(below) if isinstance(below, int) else below)


def _pick(chars: str, n: Column) -> Column:
    return F.substr(F.lit(chars), n.cast("int") + 1, F.lit(1))


def _characters(text: Column, seed: Column, lead: bool = False) -> Column:
    """Each letter and digit for one of its class; with `lead`, the first digit is not 0."""
    chars = F.split(text, "")

    def one(c: Column, i: Column) -> Column:
        digit = _pick("0123456789", _draw(seed, i, 10))
        if lead:
            digit = F.when(i == 0, _pick("123456789", _draw(seed, i, 9))).otherwise(digit)
        lower = _pick("abcdefghijklmnopqrstuvwxyz", _draw(seed, i, 26))
        return F.when(c.rlike("[0-9]"), digit).when(c.rlike("[a-z]"), lower).when(c.rlike("[A-Z]"), F.upper(lower)).otherwise(c)

    return F.array_join(F.transform(chars, one), "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a string of digits, its last digit standing alone."""
    doubled = F.transform(
        F.reverse(F.split(digits, "")),
        lambda c, i: F.when(i % 2 == 1, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x)


def _mod97(iban: Column) -> Column:
    """An IBAN's number modulo 97, the first four characters moved to the end."""
    moved = F.concat(F.substr(iban, F.lit(5)), F.substring(iban, 1, 4))
    values = F.transform(F.split(moved, ""), lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55))
    return F.aggregate(values, F.lit(0), lambda a, v: F.when(v > 9, a * 100 + v).otherwise(a * 10 + v) % 97)


def _upper_hex(kind: Column, entity: Column) -> Column:
    """True for a secret that is the upper-cased form of a hex one."""
    return (kind == "secret") & entity.rlike("^[0-9A-F]*[A-F][0-9A-F]*$")


def _norm(kind: Column, entity: Column) -> Column:
    """What makes two occurrences one entity."""
    digits = F.regexp_replace(entity, r"\D", "")
    return (
        F.when(kind == "phone", F.substr(digits, F.greatest(F.length(digits) - 9, F.lit(1)).cast("int")))
        .when(kind == "card", digits)
        .when(_upper_hex(kind, entity), F.lower(entity))
        .when(kind.isin("ip", "iban", "secret"), entity)
        .otherwise(F.lower(entity))
    )


def _script(name: Column) -> Column:
    return F.when(name.rlike(r"\p{IsCyrillic}"), "cyrillic").when(name.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _of_list(values: tuple[str, ...], seed: Column, last: Column, glue: str) -> Column:
    """Drawn entries 0 to `last`, joined."""
    listed = F.array(*[F.lit(v) for v in values])
    return F.array_join(F.transform(F.sequence(F.lit(0), last.cast("int")), lambda i: F.get(listed, _draw(seed, i, len(values)).cast("int"))), glue)


def _given(gender: str, norm: Column, seed: Column, attempt: Column) -> Column:
    """One listed name, from the third draw on joined with more of them."""
    out = None
    for script in SYLLABLES:
        name = _of_list(GIVEN[gender, script], seed, attempt / 3, "-")
        out = name if out is None else F.when(_script(norm) == script, name).otherwise(out)
    return out


def _surname(norm: Column, seed: Column, attempt: Column) -> Column:
    out = None
    for script, syllables in SYLLABLES.items():
        name = _of_list(syllables, seed, F.lit(2) + (attempt / 2).cast("int"), "")
        out = name if out is None else F.when(_script(norm) == script, name).otherwise(out)
    return out


def candidate(kind: Column, norm: Column, key: Column, attempt: Column) -> Column:
    """A surrogate of the same kind and format for a normalised entity."""
    seed = _bytes(key, kind, norm, attempt.cast("string"))
    domain, ending = F.regexp_extract(norm, r"@(.*)\.[^.]*$", 1), F.regexp_extract(norm, r"(\.[^.]*)$", 1)
    email = F.concat(_characters(F.substring_index(norm, "@", 1), seed), F.lit("@"), _characters(domain, F.concat(seed, F.lit("d"))), ending)
    octet = lambda o, i: (
        F.when(F.length(o) == 1, _draw(seed, i, 10)).when(F.length(o) == 2, 10 + _draw(seed, i, 90)).otherwise(100 + _draw(seed, i, 156))
    ).cast("string")
    ip = F.array_join(F.transform(F.split(norm, r"\."), octet), ".")
    drawn = F.concat(F.substring(norm, 1, 1), _characters(F.substr(norm, F.lit(2), F.length(norm) - 2), seed), F.lit("0"))
    check = F.pmod(10 - _luhn_sum(drawn) % 10, F.lit(10)).cast("string")
    last = F.when(_luhn_sum(norm) % 10 == 0, check).otherwise(_pick("0123456789", _draw(seed, F.lit(99), 10)))
    card = F.concat(F.substr(drawn, F.lit(1), F.length(drawn) - 1), last)
    body = _characters(F.substr(norm, F.lit(5)), seed)
    valid = F.lpad((98 - _mod97(F.concat(F.substring(norm, 1, 2), F.lit("00"), body))).cast("string"), 2, "0")
    iban = F.concat(F.substring(norm, 1, 2), F.when(_mod97(norm) == 1, valid).otherwise(_characters(F.substring(norm, 3, 2), F.concat(seed, F.lit("c")))), body)
    hexes = F.array_join(F.transform(F.split(norm, ""), lambda c, i: _pick("0123456789abcdef", _draw(seed, i, 16))), "")
    access = F.concat(F.lit("AKIA"), _characters(F.substr(norm, F.lit(5)), seed))
    secret = F.when(norm.rlike("^[0-9a-f]+$"), hexes).when(norm.rlike("^AKIA"), access).otherwise(_characters(norm, seed))
    return (
        F.when(kind == "email", email).when(kind == "phone", _characters(norm, seed, lead=True)).when(kind == "ip", ip).when(kind == "iban", iban)
        .when(kind == "card", card).when(kind == "secret", secret).when(kind == "given_m", _given("m", norm, seed, attempt))
        .when(kind == "given_f", _given("f", norm, seed, attempt)).otherwise(_surname(norm, seed, attempt))
    )


def render(kind: Column, entity: Column, surrogate: Column) -> Column:
    """A surrogate in the format of an occurrence."""
    digits = F.length(F.regexp_replace(entity, r"\D", ""))
    skip = F.greatest(digits - F.length(surrogate), F.lit(0))

    def place(c: Column, i: Column) -> Column:
        seen = F.length(F.regexp_replace(F.substr(entity, F.lit(1), i + 1), r"\D", ""))
        return F.when(c.rlike("[0-9]") & (seen > skip), F.substr(surrogate, (seen - skip).cast("int"), F.lit(1))).otherwise(c)

    formatted = F.array_join(F.transform(F.split(entity, ""), place), "")
    upper = entity == F.upper(entity)
    return (
        F.when(kind.isin("phone", "card"), formatted)
        .when(kind == "email", F.when(upper, F.upper(surrogate)).otherwise(surrogate))
        .when(_upper_hex(kind, entity), F.upper(surrogate))
        .when(kind.isin("given_m", "given_f", "surname"), F.when(upper & (F.length(entity) > 1), F.upper(surrogate)).otherwise(F.regexp_replace(F.initcap(F.regexp_replace(surrogate, "-", "- ")), "- ", "-")))
        .otherwise(surrogate)
    )


def entities(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, version (hash of the text), pos (of the match), sub (part of it), lead (kept before it), kind, entity, norm."""
    groups = [F.regexp_extract_all(F.col(text), F.lit(PATTERN), F.lit(i)) for i in range(1, len(KINDS) + 1)]
    some = docs.where(may_match(F.col(text))).where(F.col(text).rlike(PATTERN))
    found = some.select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("version"), F.arrays_zip(*[g.alias(k) for g, k in zip(groups, KINDS, strict=True)]).alias("m"))
    rows = found.select("doc", "version", F.posexplode("m").alias("pos", "m"))
    kind = F.coalesce(*[F.when(F.col(f"m.{k}") != "", F.lit(k)) for k in KINDS])
    match = F.coalesce(*[F.when(F.col(f"m.{k}") != "", F.col(f"m.{k}")) for k in KINDS])
    rows = rows.select("doc", "version", "pos", kind.alias("kind"), match.alias("match")).distinct()
    lead = F.when(F.col("kind") == "secret", F.regexp_extract("match", f"^({_SECRET_LEAD})", 1)).when(F.col("kind") == "name", F.regexp_extract("match", f"^({_TITLE_LEAD})", 1)).otherwise("")
    rest = F.substr("match", F.length("lead") + 1)
    parts = F.when(F.col("kind") == "name", F.split(rest, " ")).otherwise(F.array(rest))
    rows = rows.withColumn("lead", lead).withColumn("parts", parts).select("*", F.posexplode("parts").alias("sub", "entity"))
    male = F.col("lead").isin([f"{t} " for t in MALE_TITLES])
    name = F.when((F.col("sub") > 0) | (F.size("parts") == 1), "surname").when(male, "given_m").otherwise("given_f")
    rows = rows.select("doc", "version", "pos", "sub", F.when(F.col("sub") == 0, F.col("lead")).otherwise(" ").alias("lead"), F.when(F.col("kind") == "name", name).otherwise(F.col("kind")).alias("kind"), "entity")
    return rows.withColumn("norm", _norm(F.col("kind"), F.col("entity")))


def assign(found: DataFrame, key: str, max_rounds: int = 100) -> DataFrame:
    """kind, norm, surrogate of every distinct entity; checked for collisions, drawn again until there are none."""
    real = cut_lineage(found.select("kind", "norm").distinct(), "entities")
    open_, done = real.withColumn("attempt", F.lit(0)), None
    for _ in range(max_rounds):
        drawn = open_.withColumn("surrogate", candidate(F.col("kind"), F.col("norm"), F.lit(key), F.col("attempt")))
        # Two surrogates are one if they are one entity: a drawn secret may be upper-cased hex.
        drawn = cut_lineage(drawn.withColumn("same", _norm(F.col("kind"), F.col("surrogate"))), "candidates")
        free = drawn.join(real.select("kind", F.col("norm").alias("same")), ["kind", "same"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", _norm(F.col("kind"), F.col("surrogate")).alias("same")), ["kind", "same"], "left_anti")
        first = free.groupBy("kind", "same").agg(F.min(F.struct("norm", "surrogate")).alias("first"))
        won = cut_lineage(first.select("kind", "first.norm", "first.surrogate"), "assigned")
        done = won if done is None else done.union(won)
        open_ = cut_lineage(drawn.join(won, ["kind", "norm"], "left_anti").select("kind", "norm", (F.col("attempt") + 1).alias("attempt")), "undecided")
        if not open_.limit(1).count():
            return done
    raise ValueError(f"no free surrogate after {max_rounds} draws")


def replace_entities(docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text", count: str = "n_entities") -> DataFrame:
    """All rows with surrogates in `text`, and `count`, the number of replaced matches.

    Kinds: e-mail addresses, phone numbers, IPv4 addresses, IBANs, card numbers, secrets,
    and names after a title.  Secrets follow their names (token, password, ...) in any case.
    Phone and card numbers with other separators, names and addresses in other case, and a
    hex secret and its upper-cased form are the same entity.  Surrogates keep length classes,
    separators, country codes, check digits that were valid, script and gender.  Texts
    without a match, and null and empty texts, stay as they are; very long texts are
    searched whole.  Null ids and repeated
    rows are replaced like others.  A column called like `count` is replaced; columns
    called doc, version or pos do no harm.  The key decides all surrogates: keep it secret.
    """
    docs = docs.drop(count)
    found = cut_lineage(entities(docs, doc_id, text), "matches")
    given = cut_lineage(assign(found, key), "surrogates")
    piece = F.concat("lead", render(F.col("kind"), F.col("entity"), F.col("surrogate")))
    named = found.join(given, ["kind", "norm"]).select("doc", "version", "pos", F.struct("sub", piece.alias("to")).alias("m"))
    whole = named.groupBy("doc", "version", "pos").agg(F.array_join(F.transform(F.sort_array(F.collect_list("m")), lambda m: m["to"]), "").alias("to"))
    lists = whole.groupBy(F.col("doc").alias("__doc"), F.col("version").alias("__of")).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "to"))), lambda m: m["to"]).alias("__to"))
    own = docs.withColumn("__version", F.xxhash64(text))
    joined = own.join(lists, F.col(f"`{doc_id}`").eqNullSafe(F.col("__doc")) & (F.col("__version") == F.col("__of")), "left").drop("__doc", "__of", "__version")
    between = F.split(F.col(text), PATTERN, -1)
    told = F.array_join(F.transform(between, lambda g, i: F.concat(g, F.coalesce(F.get("__to", i), F.lit("")))), "")
    out = joined.withColumn(count, F.coalesce(F.size("__to"), F.lit(0)).cast("long"))
    return out.withColumn(text, F.when(F.col("__to").isNull(), F.col(text)).otherwise(told)).drop("__to")


def surrogate_query(documents: DataFrame, key: str = "surrogates-2025") -> DataFrame:
    return replace_entities(documents.select("doc_id", "text"), key)
