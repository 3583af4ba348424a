"""Column expressions on text, labels and ids. No Python runs on rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode-aware classes of words, digits and white space, spelled for java.util.regex.
LETTER = r"[\p{L}\p{Nl}\p{No}]"
SPACE = r"[\s\x0B\x1c-\x1f\x85\p{Z}]"
#: The characters of ``SPACE`` one by one.
SPACES = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
TOKEN = rf"(?:{LETTER}+|\p{{Nd}}+|_+|[^\p{{L}}\p{{N}}_\s\x0B\x1c-\x1f\x85\p{{Z}}])"
WORD = r"[\p{L}\p{N}_]"

# Words that alone don't name an agency, for planning and for surface profiles.
PLANNING_GENERIC = "agence agency agentie agentur nachrichtenagentur presse press radio stampa telegraph telegraphen telegraphique telegrafica".split()
PROFILE_GENERIC = "agence agency agentur agenzia agencia telegraph telegraphen telegraphique télégraphique presse press nachrichtenagentur radio rundfunk".split()
# Forms of verbs of reporting.
REPORTING = "added said reported stated announced ajoute ajouté annonce annoncé déclare déclaré indique indiqué rapporte rapporté révèle révélé berichtete berichtet erklärte erklart meldete meldet".split()
# Surfaces that are too generic to accept.
GENERIC_SURFACES = "agence agentur agency ag.".split()
# Labels that stand for another one.
LABEL_ALIASES = {"org.ent.pressagency.ats": "org.ent.pressagency.ats-sda", "org.ent.pressagency.conti": "org.ent.pressagency.wolff", "org.ent.pressagency.reuter": "org.ent.pressagency.reuters"}


def literal(text: str) -> Column:
    return F.lit(text)


def casefold(c: Column) -> Column:
    """Lower case with ß as ss and the long s, micro sign and n-apostrophe folded."""
    return F.replace(F.replace(F.translate(F.lower(c), "ſµ", "sμ"), F.lit("ß"), F.lit("ss")), F.lit("ŉ"), F.lit("ʼn"))


def squeezed(c: Column) -> Column:
    """All white space single and none at the ends."""
    return F.regexp_replace(F.regexp_replace(c, f"{SPACE}+", " "), "^ | $", "")


def normalised(c: Column) -> Column:
    return casefold(squeezed(c))


def compact(c: Column) -> Column:
    """Word characters only, folded."""
    return casefold(F.regexp_replace(c, r"[^\p{L}\p{N}_]+", ""))


def word_count(c: Column) -> Column:
    return F.size(F.regexp_extract_all(c, F.lit(f"{WORD}+"), F.lit(0)))


def piece_count(c: Column) -> Column:
    """Words and single other characters."""
    return F.size(F.regexp_extract_all(c, F.lit(rf"{WORD}+|[^\p{{L}}\p{{N}}_\s\x0B\x1c-\x1f\x85\p{{Z}}]"), F.lit(0)))


def has_word(c: Column) -> Column:
    return c.rlike(WORD)


def generic_surface(c: Column, terms: list[str] = PLANNING_GENERIC) -> Column:
    """Whether no word of the surface tells it from others."""
    words = F.transform(F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)), casefold)
    return F.size(F.array_except(words, F.array(*map(F.lit, terms)))) == 0


def first_nonempty(*columns: Column) -> Column:
    return F.coalesce(*[F.when(squeezed(c) != "", c) for c in columns])


def strip_tags(c: Column) -> Column:
    """Tags removed and the five named references decoded."""
    out = F.regexp_replace(c, "<[^>]+>", "")
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        out = F.replace(out, F.lit(name), F.lit(char))
    return out


def highlighted(c: Column) -> Column:
    """The contents of <em> elements; what stands between two is kept if it has no word character."""
    inner = F.regexp_extract_all(c, F.lit("(?s)<em>(.*?)</em>"), F.lit(1))
    between = F.slice(F.split(c, "(?s)<em>.*?</em>", -1), 2, F.greatest(F.size(inner) - 1, F.lit(0)))
    joints = F.concat(F.transform(between, lambda b: F.when(b.rlike(WORD), F.lit(" ")).otherwise(b)), F.array(F.lit("")))
    return squeezed(F.array_join(F.zip_with(inner, joints, lambda i, j: F.concat(i, F.coalesce(j, F.lit("")))), ""))


def row_text(text: Column, matches: Column, match_text: Column, snippet: Column) -> Column:
    """Text, else cleaned matches with dots between, else the match, else the snippet."""
    cleaned = F.filter(F.transform(matches, lambda m: squeezed(strip_tags(m))), lambda m: m != "")
    joined = F.when(F.size(cleaned) > 0, F.array_join(cleaned, " ... "))
    return F.coalesce(first_nonempty(text), joined, first_nonempty(match_text), first_nonempty(snippet))


def clean_text(c: Column) -> Column:
    """Line ends and soft characters normalised, hyphenated line breaks joined, blanks collapsed."""
    out = F.regexp_replace(F.regexp_replace(c, "\r\n?", "\n"), "[­​﻿]", "")
    out = F.regexp_replace(out, "(?<=[\\p{L}\\p{N}_])[\\-‐-‒–]\n(?=[\\p{L}\\p{N}_])", "")
    out = F.regexp_replace(F.regexp_replace(out, "[ \t]*\n[ \t]*", "\n"), "[ \t]{2,}", " ")
    return F.regexp_replace(F.regexp_replace(out, "\n{3,}", "\n\n"), "^\\s+|\\s+$", "")


def line_breaks(c: Column) -> Column:
    """Offsets from a JSON list or a comma list; what isn't a number is dropped."""
    parts = F.split(F.regexp_replace(c, r"[\[\]\s\"]", ""), ",")
    return F.filter(F.transform(parts, lambda p: p.try_cast("int")), lambda p: p.isNotNull())


def ocr_note(c: Column) -> Column:
    """(transcript, distance) of a note like ``Transcript:x|LED1``; the last of each counts."""
    parts = F.split(c, r"\|")
    last = lambda found: F.element_at(found, -1)
    transcripts = F.filter(parts, lambda p: p.startswith("Transcript:"))
    distances = F.filter(F.transform(parts, lambda p: F.regexp_extract(p, r"^LED([0-9]+(?:\.[0-9]+)?)$", 1).try_cast("double")), lambda p: p.isNotNull())
    return F.struct(F.when(F.size(transcripts) > 0, F.substr(last(transcripts), F.lit(12))).alias("transcript"), F.when(F.size(distances) > 0, last(distances)).alias("distance"))


def base_document_id(c: Column) -> Column:
    return F.substring_index(c, "#", 1)


def issue_id(c: Column) -> Column:
    """The base id without its item number."""
    return F.regexp_replace(base_document_id(c), r"-i\d+$", "")


def candidate_id(ordinal: Column, *columns: Column) -> Column:
    """The first id that isn't empty, else a numbered one."""
    return F.coalesce(first_nonempty(*columns), F.format_string("candidate-%06d", ordinal))


def year(*columns: Column) -> Column:
    """The first four digits in a row of the first column that has some."""
    return F.coalesce(*[F.regexp_extract(c, r"[0-9]{4}", 0).try_cast("int") for c in columns])


def sha1_id(prefix: str, kind: str, *columns: Column, digits: int = 12) -> Column:
    return F.concat(F.lit(f"{prefix}:{kind}:"), F.substring(F.sha1(F.concat_ws("\t", *columns)), 1, digits))


def base_label(tag: Column) -> Column:
    """The label of a BIO tag; null for O and for none."""
    return F.when(tag.rlike("^[BI]-"), F.substr(tag, F.lit(3))).when(~tag.isin("", "_", "O"), tag)


def canonical_label(label: Column, aliases: dict[str, str] = LABEL_ALIASES) -> Column:
    """The label that an alias of it stands for; other labels as they are, null as empty."""
    out = F.coalesce(label, F.lit(""))
    for old, new in aliases.items():
        out = F.when(label == old, F.lit(new)).otherwise(out)
    return out


def spaced_json(*columns: str) -> Column:
    """One JSON object with keys in order and a blank after commas and colons; nulls are kept. Values are scalars."""

    def part(c: str) -> Column:
        whole = F.to_json(F.struct(c), {"ignoreNullFields": "false"})
        return F.concat(F.lit(f'"{c}": '), F.substr(whole, F.lit(len(c) + 5), F.length(whole) - (len(c) + 5)))

    return F.concat(F.lit("{"), F.concat_ws(", ", *map(part, sorted(columns))), F.lit("}"))


def json_string(c: Column) -> Column:
    """A JSON string in ASCII: quotes, backslashes and control characters escaped, others as UTF-16 units. Null is null."""
    named = F.create_map(*[F.lit(x) for x in ('"', '\\"', "\\", "\\\\", "\n", "\\n", "\r", "\\r", "\t", "\\t", "\b", "\\b", "\f", "\\f")])
    units = lambda x: F.regexp_replace(F.lower(F.hex(F.encode(x, "UTF-16BE"))), "([0-9a-f]{4})", "\\\\u$1")
    one = lambda x: F.when(x.rlike(r'^[ !#-\[\]-~]$'), x).otherwise(F.coalesce(F.try_element_at(named, x), units(x)))
    plain = c.rlike(r'^[ !#-\[\]-~]*+\z')
    return F.concat(F.lit('"'), F.when(plain, c).otherwise(F.array_join(F.transform(F.split(c, ""), one), "")), F.lit('"'))


def json_string_kept(c: Column) -> Column:
    """A JSON string whose characters stay as they are, but for quotes, backslashes and control characters. Null says null."""
    whole = F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})
    return F.substr(whole, F.lit(6), F.length(whole) - 6)


def json_object(**parts: Column) -> Column:
    """A compact JSON object with its keys in order; the parts are JSON already, null ones say null."""
    pairs = [F.concat(F.lit(f'"{k}":'), F.coalesce(parts[k], F.lit("null"))) for k in sorted(parts)]
    return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))


def ocr_usable(quality: Column, text: Column, least: float = 0.9, length: int = 200) -> Column:
    """Whether the quality is a number of at least ``least`` and the cleaned text has ``length`` characters; a quality that is no number isn't usable."""
    return F.coalesce((quality.try_cast("double") >= least) & (F.length(clean_text(text)) >= length), F.lit(False))


def context_bounds(text: Column, start: Column, stop: Column, before: Column, after: Column) -> Column:
    """(low, high) of the text around a match: so many characters on each side, what one side lacks on the other, and on to white space."""
    n = F.length(text)
    low, high = F.greatest(F.lit(0), start - before), F.least(n, stop + after)
    lacks_left, lacks_right = before - (start - low), after - (high - stop)
    wide_high = F.when((lacks_left > 0) & (high < n), F.least(n, high + lacks_left)).otherwise(high)
    wide_low = F.when((lacks_right > 0) & (low > 0), F.greatest(F.lit(0), low - lacks_right)).otherwise(low)
    left = F.length(F.regexp_extract(F.substr(text, F.lit(1), wide_low.cast("int")), f"[^\\s\\x0B\\x1c-\\x1f\\x85\\p{{Z}}]*+\\z", 0))
    right = F.length(F.regexp_extract(F.substr(text, (wide_high + 1).cast("int")), f"^[^\\s\\x0B\\x1c-\\x1f\\x85\\p{{Z}}]*+", 0))
    return F.struct((wide_low - left).alias("low"), (wide_high + right).alias("high"))


def drawn_sides(key: Column, radius: int) -> Column:
    """(before, after): a context of up to twice the radius, dealt to both sides by a hash of the key, no side under a quarter of it or half the radius."""
    number = lambda k: F.conv(F.substring(F.sha1(key), 1 + 6 * k, 6), 16, 10).cast("long")
    most = 2 * radius
    least = min(most, 100)
    total = F.lit(least) + number(0) % (most - least + 1)
    side = F.least(F.lit(radius // 2), F.floor(total / 4))
    before = side + number(1) % (total - 2 * side + 1)
    return F.struct(before.alias("before"), (total - before).alias("after"))


def family(label: Column) -> Column:
    return F.split_part(label, F.lit("."), F.lit(3))


def ratio(part: Column, whole: Column) -> Column:
    """A quotient of counts, 0 where there is nothing to divide by."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole.cast("double"))


def f1(precision: Column, recall: Column) -> Column:
    return F.when(precision + recall == 0, F.lit(0.0)).otherwise(2 * precision * recall / (precision + recall))


def half_even(c: Column, digits: int) -> Column:
    return F.bround(c, digits)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays; 0 if one has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm == 0, F.lit(0.0)).otherwise(dot(a, b) / norm)


def core_name_token(tokens: Column) -> Column:
    """Whether some token is 2 or more capitals, or a capital and 2 or more small letters."""
    return F.exists(tokens, lambda t: t.rlike(r"^\p{Lu}{2,}$") | t.rlike(r"^\p{Lu}\p{Ll}{2,}$"))


def boundary_form(c: Column) -> Column:
    """Folded, typographic apostrophes plain, anything but digits and Latin letters a blank."""
    return F.trim(F.regexp_replace(F.replace(casefold(c), F.lit("’"), F.lit("'")), "[^0-9a-zà-öø-ÿ]+", " "))


def without_agency_words(c: Column) -> Column:
    """A boundary form without leading articles, agency words and connectors, in this order."""
    agency = "agence agences agency agentur agenzia nachrichtenbureau gence lagence nachrichtenagentur presseagentur"
    pattern = f"^(?:(?:l|la|le|les|a)(?: |$))*(?:(?:{agency.replace(' ', '|')})(?: |$))*(?:(?:de|du|des|d|of|the|telegraphique|semi|officielle)(?: |$))*"
    return F.regexp_replace(boundary_form(c), pattern, "")


def context(text: Column, start: Column, stop: Column, radius: int) -> Column:
    """What stands within ``radius`` characters of a span, itself included."""
    low = F.greatest(F.lit(0), start - radius)
    return squeezed(F.substr(text, (low + 1).cast("int"), (stop + radius - low).cast("int")))
