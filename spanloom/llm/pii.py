"""Personal data and secrets replaced by keyed surrogates.

Detected entities receive surrogates of their own type and format: digits for
digits, letters of the same script and case for letters, names of the same
gender, valid check digits. One entity has one surrogate in all documents
(coreference), two entities never share one, and none is an entity that occurs
(distinctness): collisions are found by grouping and drawn again. A family name
is an entity, and so is a given name within its family, so that the mentions
Mr John Smith, John Smith and Mr Smith stay one person. DataFrame operations only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import salted_join, stored

# Names that a secret is assigned to, and what stands between them and the secret.
_KEYWORD = r"(?i:token|secret|password|passwd|passphrase|pwd|api[_-]?key|access[_-]?key)"
_LEAD = _KEYWORD + r"\\*+[\"']?+\s*+(?:=>|==|:=|[=:](?![=:]))\s*+\\*+"
# What can't be drawn another way isn't a secret (a row of asterisks).
_DRAWABLE = r"(?=(?:[^\s\"'\p{L}\p{N}]*+[\p{L}\p{N}]){4})"
# Where a secret without quotes ends before white space or a quote: at the next assignment.
_NEXT = rf"(?!{_KEYWORD}\\*+[\"']?+\s*+[=:]|[,;&|]\s*+[\"']?+[\w.-]++[\"']?+\s*+[=:])"
# Possessive groups are loops; others recurse, and a long match would overflow the stack.
_ASSIGNED = rf"{_LEAD}(?:\"{_DRAWABLE}[^\s\"]{{8,}}+(?=\"|\z)|'{_DRAWABLE}[^\s']{{8,}}+(?='|\z)|[\"']{_DRAWABLE}[^\s\"']{{8,}}+(?=[\"']|\z)|{_DRAWABLE}(?:{_NEXT}[^\s\"']){{8,}}+)"
# Titles by gender; a doctor's or professor's isn't told by the title.
_FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Fräulein", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Sra", "Srta", "Signora", "Г-жа", "Κυρία")
_MALE = ("Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Signor", "Г-н", "Κύριος")
_EITHER = ("Dr", "Prof", "Professor", "Doktor")
_TITLES = "|".join(sorted((*_FEMALE, *_MALE, *_EITHER), key=len, reverse=True))
# Parts of a name: Smith, McDonald, O'Brien, Garcia-Lopez; initials before one; or all of them in capitals.
_CAPITAL = r"\p{Lu}(?:\p{Ll}++(?:\p{Lu}\p{Ll}++)*+|['’]\p{Lu}\p{Ll}++)"
_PART = rf"{_CAPITAL}(?:-{_CAPITAL})*+(?!\p{{L}})"
_INITIALS = r"(?:\p{Lu}\. ?)"
_UPPER = r"\p{Lu}(?:['’]?\p{Lu})++(?:-\p{Lu}{2,}+)*+(?!\p{L})"
_NAME = rf"(?:{_INITIALS}*+{_PART}(?: {_INITIALS}*+{_PART})*+|{_INITIALS}*+{_UPPER}(?: {_INITIALS}*+{_UPPER})*+)"
# Entity types, in order of precedence, with their patterns. An assigned secret is found with its lead.
PATTERNS = {
    "email": r"(?<![\w.+%-])[\w.+%-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,24}(?![\w-])",
    "person": rf"(?<!\p{{L}})(?:(?:{_TITLES})\.? )++{_NAME}",
    "secret": _ASSIGNED + r"|(?<![\w-])(?:(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}+|[0-9a-f]{40}|[0-9A-F]{40})(?![\w-])|sk-[\w-]{20,}+|xox[abeoprs]-[\w-]{10,}+|AIza[\w-]{35}|(?i:bearer) [\w.~+/-]{16,}+=*+|eyJ[\w-]{8,}+\.[\w-]{8,}+\.[\w-]{8,}+)"
    + r"|-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]{40,}+-----END [A-Z ]*PRIVATE KEY-----",
    "iban": r"(?<![\w-])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\w-])",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?!\.?[\w])",
    "ipv6": r"(?<![\w:.])(?=[0-9A-Fa-f:]*[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|[0-9A-Fa-f]{2,4}(?::[0-9A-Fa-f]{1,4}){0,5}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![\w:])",
    "phone": r"(?<![\w+])(?:\+[0-9]{1,3}[ .-]?)(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}(?![\w-])|(?<![\w+(-])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![\w-])|(?<![\w+(-])0[0-9]{2,4} [0-9]{3,4} [0-9]{3,4}(?![\w-])",
    "ssn": r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "card": r"(?<![\w-])(?:[0-9]{4}[ -]?){3}[0-9]{1,7}(?![\w-])",
}
# A text that matches none of these has no entity.
_HINT = rf"[@0-9]|{_KEYWORD}|AKIA|gh[pousr]_|sk-|eyJ|xox|AIza|(?i:bearer) |PRIVATE KEY|[a-f]{{40}}|[A-F]{{40}}|{_TITLES}"
# What stays as it is at an entity's start and at its end, by type.
_CALLING = r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}"
_START = {"iban": r"^[A-Z]{2}", "phone": rf"^\+(?:{_CALLING})", "secret": r"^(?:AKIA|gh[pousr]_|sk-(?:proj-)?|eyJ|xox[abeoprs]-|AIza|-----BEGIN [A-Z ]*PRIVATE KEY-----)"}
_END = {"email": r"\.\p{L}+$", "secret": r"-----END [A-Z ]*PRIVATE KEY-----$"}
# Given names by gender and syllables of family names, by script.
_GIVEN = {
    "latin": (["Anna", "Clara", "Elena", "Emma", "Julia", "Laura", "Maria", "Nora", "Paula", "Sofia", "Teresa", "Vera"], ["Adam", "Bruno", "David", "Emil", "Felix", "Hugo", "Jonas", "Leo", "Martin", "Oscar", "Paul", "Victor"]),
    "cyrillic": (["Анна", "Вера", "Елена", "Ирина", "Мария", "Ольга"], ["Антон", "Борис", "Виктор", "Иван", "Максим", "Павел"]),
    "greek": (["Άννα", "Ελένη", "Μαρία", "Σοφία"], ["Γιώργος", "Νίκος", "Πέτρος", "Πάνος"]),
}
_SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha he ka ke ko la le lo ma me mo na ne no pa po ra re ro sa se ta".split(),
    "cyrillic": "ба бо ва ве го да де за ка ко ла ле ма ме на но па ра ре са та".split(),
    "greek": "βα γα δα ζα κα κο λα λο μα μο να νο πα ρα σα τα".split(),
}
_ALPHABETS = {"hex": "0123456789abcdef", "digit": "0123456789", "latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшщэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
MAX_DRAWS = 32
#: From these draws on a given name has a second and a third part, for there are few names.
MORE_NAMES = (6, 14)


def detector() -> str:
    return "|".join(f"(?:{p})" for p in PATTERNS.values())


def _by_type(rules: dict[str, str], value: Column, kind: Column) -> Column:
    """What the type's pattern finds in the value, or nothing."""
    out = F.lit("")
    for name, pattern in rules.items():
        out = F.when(kind == name, F.regexp_extract(value, pattern, 0)).otherwise(out)
    return out


def kind_of(value: Column) -> Column:
    """The first type whose pattern is all of the value, or a name without its title; secrets are what is left."""
    tests = [F.when(value.rlike(f"^(?:{p})$"), F.lit(name)) for name, p in PATTERNS.items() if name != "secret"]
    return F.coalesce(*tests, F.when(value.rlike(f"^{_NAME}$") & value.contains(" "), F.lit("person")), F.lit("secret"))


def identity(value: Column, kind: Column) -> Column:
    """What two mentions of one entity have in common, whatever their format or case."""
    plain = F.lower(F.regexp_replace(value, r"[^\p{L}\p{N}]", ""))
    mixed = value.rlike(r"\p{Ll}") & value.rlike(r"\p{Lu}")
    ended = F.regexp_replace(value, r"[^\p{L}\p{N}]++$", "")
    secret = F.when(mixed, ended).otherwise(F.lower(ended))
    return F.when(kind.isin("email", "family", "given", "ipv6"), F.lower(value)).when(kind == "ip", value).when(kind == "secret", secret).otherwise(plain)


def _number(key: Column, at: Column, below: Column) -> Column:
    """A keyed number under ``below``, another one for each place."""
    return F.pmod(F.conv(F.substring(F.sha2(F.concat_ws("|", key, at.cast("string")), 256), 1, 12), 16, 10).cast("long"), below)


def _letter(c: Column, hexadecimal: Column, key: Column, at: Column) -> Column:
    """A keyed character of the class of ``c``, Latin for letters of further scripts; other characters stay."""
    low = F.lower(c)
    alphabet = (
        F.when(hexadecimal & low.rlike("[0-9a-f]"), _ALPHABETS["hex"])
        .when(c.rlike(r"\p{Nd}"), _ALPHABETS["digit"])
        .when(low.rlike(r"\p{IsCyrillic}"), _ALPHABETS["cyrillic"])
        .when(low.rlike(r"\p{IsGreek}"), _ALPHABETS["greek"])
        .when(low.rlike(r"[\p{L}\p{N}]"), _ALPHABETS["latin"])
    )
    letter = F.substr(alphabet, (_number(key, at, F.length(alphabet)) + 1).cast("int"), F.lit(1))
    return F.when(c == low, F.coalesce(letter, c)).otherwise(F.coalesce(F.upper(letter), c))


def _pick(pool: Column, key: Column, at: int) -> Column:
    return F.element_at(pool, (_number(key, F.lit(at), F.size(pool)) + 1).cast("int"))


def _pool(value: Column, kind: Column, female: Column) -> Column:
    """What a name is drawn from: given names of the gender, of either one where it isn't known, or syllables, in the value's script."""
    words = lambda options: F.array(*map(F.lit, options))
    out = None
    for script in ("latin", "cyrillic", "greek"):
        she, he = _GIVEN[script]
        pool = F.when(kind == "family", words(_SYLLABLES[script])).when(female == 1, words(she)).when(female == 0, words(he)).otherwise(words([*she, *he]))
        out = pool if out is None else F.when(value.rlike(rf"\p{{Is{script.capitalize()}}}"), pool).otherwise(out)
    return F.when(kind.isin("family", "given"), out)


def _card_checked(value: Column) -> Column:
    """The number with its last digit such that the digits pass the Luhn check."""
    digits = F.transform(F.split(F.reverse(F.regexp_replace(F.substr(value, F.lit(1), F.length(value) - 1), "[^0-9]", "")), ""), lambda c: c.cast("int"))
    twice = F.transform(digits, lambda d, i: F.when(i % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    check = (10 - F.aggregate(twice, F.lit(0), lambda a, x: a + x) % 10) % 10
    return F.concat(F.substr(value, F.lit(1), F.length(value) - 1), check.cast("string"))


def _iban_checked(country: Column, rest: Column) -> Column:
    """What follows the country, with its first two digits such that the number passes the modulo-97 check."""
    moved = F.concat(F.regexp_replace(F.substr(rest, F.lit(3), F.length(rest)), "[^A-Z0-9]", ""), country, F.lit("00"))
    worth = F.transform(F.split(moved, ""), lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55))
    left = F.aggregate(worth, F.lit(0), lambda a, x: (F.when(x > 9, a * 100).otherwise(a * 10) + x) % 97)
    return F.concat(F.lpad((98 - left).cast("string"), 2, "0"), F.substr(rest, F.lit(3), F.length(rest)))


def with_surrogates(mentions: DataFrame, secret_key: str) -> DataFrame:
    """Adds ``surrogate`` to mentions (kind, entity, value, female, draw): drawn by a key of the entity and the draw.

    A draw under 0: no free surrogate was found, and the type and a part of the
    key stand for the entity. female is 1, 0 or null. Each step is a column of
    its own, so that plans stay small.
    """
    value, kind, draw, key = (F.col(c) for c in ("value", "kind", "draw", "_key"))
    rows = mentions.withColumns({"_key": entity_key(secret_key, draw), "_start": _by_type(_START, value, kind), "_end": _by_type(_END, value, kind), "_pool": _pool(value, kind, F.col("female"))})
    rows = rows.withColumn("_middle", F.substr("value", F.length("_start") + 1, F.length("value") - F.length("_start") - F.length("_end")))
    rows = rows.withColumn("_hex", ((kind == "secret") & F.col("_middle").rlike("^[0-9a-fA-F]+$")) | (kind == "ipv6"))
    # equal places of two formats of one number get equal digits: places count digits and letters only
    letters = F.transform(F.split(F.regexp_replace("_middle", r"[^\p{L}\p{N}]", ""), ""), lambda c, i: _letter(c, F.col("_hex"), key, i))
    placed = F.zip_with(F.split("_middle", r"[\p{L}\p{N}]", -1), letters, lambda between, c: F.concat(F.coalesce(between, F.lit("")), F.coalesce(c, F.lit(""))))
    rows = rows.withColumn("_drawn", F.array_join(placed, ""))
    octets = F.array_join(F.transform(F.array(*map(F.lit, range(4))), lambda i: (_number(key, i, F.lit(223)) + 1).cast("string")), ".")
    given = F.concat_ws(" ", _pick(F.col("_pool"), key, 0), *[F.when(draw >= least, _pick(F.col("_pool"), key, k)) for k, least in enumerate(MORE_NAMES, 1)])
    given = F.when(value.rlike(rf"^{_INITIALS}+$"), F.regexp_replace(given, r"(\p{L})\p{L}*+", "$1.")).otherwise(given)
    syllables = lambda places: F.initcap(F.concat(*[_pick(F.col("_pool"), key, i) for i in places]))
    family = F.when(value.contains("-"), F.concat(syllables(range(1, 6)), F.lit("-"), syllables(range(6, 9)))).otherwise(syllables(range(1, 6)))
    shouted = kind.isin("family", "given") & value.rlike(r"\p{Lu}.*\p{Lu}") & ~value.rlike(r"\p{Ll}")
    body = (
        F.when(kind == "ip", octets)
        .when(kind == "family", family)
        .when(kind == "given", given)
        .when(kind == "card", _card_checked(F.col("_drawn")))
        .when(kind == "iban", _iban_checked(F.col("_start"), F.col("_drawn")))
        .otherwise(F.col("_drawn"))
    )
    body = F.when(shouted, F.upper(body)).otherwise(body)
    new = F.when(draw < 0, F.concat(F.lit("["), kind, F.lit("-"), F.substring(key, 1, 16), F.lit("]"))).otherwise(F.concat("_start", body, "_end"))
    return rows.withColumn("surrogate", new).drop("_key", "_start", "_end", "_pool", "_middle", "_hex", "_drawn")


def draw_surrogates(entities: DataFrame, secret_key: str) -> DataFrame:
    """A draw number for each distinct entity (kind, entity, sample mention ``value``, female), so that no surrogates collide.

    Surrogates are compared in the form that mentions of an entity have in
    common; given names within their family. A surrogate that is drawn twice, or
    that is itself an entity of the corpus, is drawn again for all but the first
    entity that holds it; entities that have theirs keep it. An entity of a type
    that is so crowded that ``MAX_DRAWS`` draws found nothing has draw -1.
    """
    family = F.when(F.col("kind") == "given", F.concat(F.substring_index("entity", "|", 1), F.lit("|"))).otherwise(F.lit(""))
    taken = stored(entities.select("kind", F.col("entity").alias("shown")).distinct(), "taken")
    todo, done = entities.withColumn("draw", F.lit(0)), []
    for _ in range(MAX_DRAWS):
        drawn = with_surrogates(todo, secret_key).withColumn("shown", F.concat(family, identity(F.col("surrogate"), F.col("kind")))).drop("surrogate")
        drawn = drawn.withColumn("k", F.expr("row_number() over (partition by kind, shown order by entity)"))
        drawn = drawn.join(taken.withColumn("is_taken", F.lit(True)), ["kind", "shown"], "left")
        drawn = stored(drawn.withColumn("free", (F.col("k") == 1) & F.col("is_taken").isNull()), "surrogates")
        done.append(drawn.filter("free").select("kind", "entity", "draw", "female"))
        todo = drawn.filter("not free").select("kind", "entity", "value", "female", (F.col("draw") + 1).alias("draw"))
        if todo.isEmpty():
            break
        taken = taken.unionByName(drawn.filter("free").select("kind", "shown"))
    else:
        done.append(todo.select("kind", "entity", F.lit(-1).alias("draw"), "female"))
    return reduce(DataFrame.unionByName, done)


def _guessed_gender(given: Column) -> Column:
    """1 for a given name that is known for a woman's or ends as most of them do, 0 for one known for a man's, else null."""
    first = F.lower(F.regexp_extract(given, r"^\p{L}+", 0))
    known = lambda k: first.isin(*[n.lower() for names in _GIVEN.values() for n in names[k]])
    return F.when(known(1), 0).when(known(0) | first.rlike("[aаα]$"), 1)


def told_apart(parts: DataFrame) -> DataFrame:
    """Given names that titles give both genders become entities of each gender, for they are several persons'.

    A mention without such a title is of the gender that the name has in its
    text, if that has one.
    """
    told = parts.filter("kind = 'given' and female is not null").groupBy("entity").agg(F.min("female").alias("low"), F.max("female").alias("high"))
    torn = stored(told.filter("low <> high").select("entity", F.lit(True).alias("torn")), "torn")
    if torn.isEmpty():
        return parts
    met = salted_join(parts.filter("kind = 'given'"), torn, ["entity"], "at", "left")
    low, high = (f"{f}(female) over (partition by at, entity)" for f in ("min", "max"))
    met = met.withColumn("female", F.expr(f"case when torn then coalesce(female, case when {low} = {high} then {low} end) else female end"))
    met = met.withColumn("entity", F.when(F.col("torn"), F.concat_ws("|", "entity", F.coalesce(F.col("female").cast("string"), F.lit("")))).otherwise(F.col("entity")))
    return stored(parts.filter("kind <> 'given'").unionByName(met.select(*parts.columns)), "apart")


def entity_key(secret_key: str, draw: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(secret_key), F.col("kind"), F.col("entity"), draw.cast("string")), 256)


def _entities_of(value: Column, kind: Column) -> Column:
    """The entities that a mention speaks of, in order, each with what stands before it: (lead, kind, entity, value, female)."""
    title = F.regexp_extract(value, rf"^(?:(?:{_TITLES})\.? )+", 0)
    name = F.substr(value, F.length(title) + 1)
    family = F.substring_index(name, " ", -1)
    given = F.substr(name, F.lit(1), F.length(name) - F.length(family) - 1)
    first = F.regexp_extract(title, r"^[^. ]+", 0)
    female = F.when(first.isin(*_FEMALE), 1).when(first.isin(*_MALE), 0)
    one = lambda lead, what, entity, of: F.struct(lead.alias("lead"), what.alias("kind"), entity.alias("entity"), of.alias("value"), female.alias("female"))
    whole = one(F.lit(""), kind, identity(value, kind), value)
    of_family = lambda lead: one(lead, F.lit("family"), F.lower(family), family)
    of_given = one(title, F.lit("given"), F.concat(F.lower(family), F.lit("|"), F.lower(given)), given)
    return F.when(kind != "person", F.array(whole)).when(family == name, F.array(of_family(title))).otherwise(F.array(of_given, of_family(F.lit(" "))))


def replace_private(docs: DataFrame, secret_key: str) -> DataFrame:
    """``docs`` with all personal data and secrets of ``text`` replaced, and n_replaced long.

    Who knows ``secret_key`` can tell which surrogate an entity has. A name of
    two or more parts that stands with a title in a text is also replaced where
    it stands in that text without one.

    Other columns stay; a column named n_replaced is replaced. Null text stays
    null, with n_replaced 0. Empty texts and texts without entities are returned
    as they are. Rows are treated one by one, repeated rows alike; doc_id isn't
    looked at. Empty input: no rows.
    """
    columns = [c for c in docs.columns if c != "n_replaced"]
    docs = docs.select(*columns)
    pattern = detector()
    has = F.coalesce(F.col("text").rlike(_HINT) & F.col("text").rlike(pattern), F.lit(False))
    clean = docs.filter(~has).withColumn("n_replaced", F.lit(0).cast("long"))
    row = F.struct(*columns).alias("row")
    # titled names of two or more parts, the longest first
    named = F.filter(F.transform(F.regexp_extract_all("text", F.lit(PATTERNS["person"]), F.lit(0)), lambda m: F.regexp_replace(m, rf"^(?:(?:{_TITLES})\.? )+", "")), lambda m: m.contains(" "))
    longest = F.transform(F.array_sort(F.transform(F.array_distinct(named), lambda m: F.struct((-F.length(m)).alias("n"), m.alias("m")))), lambda x: x["m"])
    found = docs.filter(has).select(row, F.monotonically_increasing_id().alias("at"), F.col("text").alias("_text"), longest.alias("names"))
    own = F.concat(F.lit(pattern + r"|(?<!\p{L})(?:"), F.array_join(F.transform("names", lambda m: F.concat(F.lit("\\Q"), m, F.lit("\\E"))), "|"), F.lit(r")(?!\p{L})"))
    cut = lambda p: F.struct(F.split("_text", p, -1).alias("gaps"), F.regexp_extract_all("_text", p, F.lit(0)).alias("mentions"))
    found = found.withColumn("cut", F.when(F.size("names") > 0, cut(own)).otherwise(cut(F.lit(pattern)))).select("row", "at", "cut.*")
    found = stored(found, "private")
    mentions = found.select("at", F.posexplode("mentions").alias("i", "whole")).withColumn("lead", F.regexp_extract("whole", f"^(?:{_LEAD}[\"']?|(?i:bearer) )", 0))
    mentions = mentions.withColumn("mention", F.substr("whole", F.length("lead") + 1)).drop("whole").withColumn("is", kind_of(F.col("mention")))
    parts = mentions.select("at", "i", F.col("lead").alias("before"), F.posexplode(_entities_of(F.col("mention"), F.col("is"))).alias("j", "e"))
    parts = parts.select("at", "i", "j", F.when(F.col("j") == 0, F.concat("before", "e.lead")).otherwise(F.col("e.lead")).alias("lead"), "e.kind", "e.entity", "e.value", "e.female")
    parts = told_apart(stored(parts, "mentions"))
    entities = parts.groupBy("kind", "entity").agg(F.min("value").alias("value"), F.max("female").alias("female"))
    entities = entities.withColumn("female", F.coalesce("female", F.when(F.col("kind") == "given", _guessed_gender(F.col("value")))))
    drawn = stored(draw_surrogates(stored(entities, "entities"), secret_key), "draws")
    renamed = with_surrogates(salted_join(parts.drop("female"), drawn, ["kind", "entity"], "at"), secret_key).select("at", "i", "j", F.concat("lead", "surrogate").alias("new"))
    in_order = lambda key: F.transform(F.sort_array(F.collect_list(F.struct(key, "new"))), lambda x: x["new"])
    by_row = renamed.repartition("at").groupBy("at", "i").agg(F.array_join(in_order("j"), "").alias("new")).groupBy("at").agg(in_order("i").alias("new"))
    filled = F.zip_with("gaps", F.concat(F.col("new"), F.array(F.lit(""))), lambda gap, new: F.concat(gap, new))
    changed = found.join(by_row, "at").select(*[(F.array_join(filled, "") if c == "text" else F.col("row")[c]).alias(c) for c in columns], F.size("new").cast("long").alias("n_replaced"))
    return clean.unionByName(changed)
