"""Dictionary matching over token windows, and what depends on the dictionary.

Aliases are a small table (label, alias, ord); it is broadcast. Windows are
built only where the first token begins some alias, so the join sees few of
them, whatever the corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanloom.functions.text import PLANNING_GENERIC, REPORTING, boundary_form, casefold, compact, core_name_token, generic_surface, has_word, piece_count, squeezed, word_count

from .tokens import by_document, hinted

_BRACKETS = ["(", ")", "[", "]", "{", "}"]
_NEAR = 3
#: An alias table over this many rows isn't broadcast by hint.
BROADCAST_ALIASES = 200_000


def alias_table(aliases: DataFrame) -> DataFrame:
    """(label, alias, ord) with the forms that matching needs; aliases without a word character are left out."""
    trimmed = F.regexp_replace("alias", r"\s+$", "")
    words = F.regexp_extract_all("alias", F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    out = aliases.select("label", "alias", "ord").withColumns(
        {
            "form": compact(F.col("alias")),
            "words": word_count(F.col("alias")),
            "tail": F.right(trimmed, F.lit(1)),
            "ends_in_dot": trimmed.endswith("."),
            "inner_mark": F.substr(trimmed, F.lit(1), F.length(trimmed) - 1).rlike(r"[^\p{L}\p{N}_]"),
            "word_form": F.array_join(F.transform(words, compact), "\t"),
        }
    )
    size = F.max(piece_count(F.col("alias"))).over(W.partitionBy("label")) + 2
    return out.withColumn("most", size).filter("form <> ''")


def high_precision(aliases: DataFrame) -> DataFrame:
    """Without short forms that no mark tells from a common word."""
    return aliases.filter((F.length(compact(F.col("alias"))) >= 4) | F.col("alias").rlike(r"[./\-]"))


def match(tokens: DataFrame, aliases: DataFrame) -> DataFrame:
    """Occurrences of aliases: doc_id, label, token_start, token_stop, alias, matcher, and start, stop offsets.

    A window matches when its word characters, folded, are the alias's, with as
    many words and no bracket, and when final punctuation agrees; or when the
    alias is followed by a hyphen and a suffix. A dotted acronym takes its last
    period. Of equal spans of a label the first alias counts, and a span that is
    another one and a single letter is dropped. Null tokens match nothing.
    """
    spark = tokens.sparkSession
    known = alias_table(aliases)
    longest, many = known.agg(F.max("most"), F.count("*")).first()
    if longest is None:
        return spark.createDataFrame([], "doc_id long, label string, token_start int, token_stop int, alias string, matcher string, start int, stop int")
    small = F.broadcast if many <= BROADCAST_ALIASES else (lambda df: df)
    starts = known.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("form")), lambda k: F.substr("form", F.lit(1), k))).alias("first")).distinct()
    later = {f"{c}_{k}": F.lead(c, k).over(by_document()) for c in ("token", "stop") for k in range(1, longest + 1)}
    rows = tokens.select("doc_id", "i", "token", "start", "stop").withColumns(later).withColumn("first", compact(F.col("token")))
    rows = rows.filter(has_word(F.col("token"))).join(small(starts), "first", "left_semi")
    listed = lambda c: F.filter(F.array(c, *[f"{c}_{k}" for k in range(1, longest + 1)]), lambda x: x.isNotNull())
    rows = rows.withColumns({"next": listed("token"), "stops": listed("stop")})
    rows = rows.select("doc_id", F.col("i").alias("token_start"), "start", "next", "stops", F.explode(F.sequence(F.lit(1), F.least(F.size("next"), F.lit(longest)))).alias("n"))
    window = F.slice("next", F.lit(1), F.col("n"))
    rows = rows.withColumn("w", window).withColumns({"form": compact(F.array_join("w", "")), "last": F.get("next", F.col("n") - 1), "after": F.get("next", F.col("n"))})

    a_word, tail_word = has_word(F.col("last")), has_word(F.col("tail"))
    punctuation = (
        ~(a_word & ~tail_word & F.coalesce(F.col("after") == F.col("tail"), F.lit(False)))
        & ~(~a_word & tail_word)
        & ~(~a_word & ~tail_word & (F.col("last") != F.col("tail")))
        & ~(~a_word & ~tail_word & F.col("inner_mark") & ~F.array_join(F.slice("w", F.lit(1), F.col("n") - 1), " ").rlike(r"[^\p{L}\p{N}_]"))
    )
    # both ways to match are keys of one join, so the tokens are read once
    plain, hyphened = F.lit("alias_compact"), F.lit("alias_hyphenated_suffix")
    keyed = lambda *keys: F.explode(F.filter(F.array(*keys), lambda k: k.isNotNull()))
    key = lambda matcher, form: F.struct(matcher.alias("matcher"), form.alias("key"))
    word_form = F.array_join(F.transform(F.slice("w", F.lit(1), F.col("n") - 2), compact), "\t")
    suffixed = F.when((F.col("n") > 2) & (F.get("next", F.col("n") - 2) == "-"), key(hyphened, word_form))
    rows = rows.withColumnRenamed("form", "own").withColumn("k", keyed(key(plain, F.col("own")), suffixed)).select("*", "k.*").drop("k")
    known = known.withColumn("k", keyed(key(plain, F.col("form")), F.when(F.col("word_form") != "", key(hyphened, F.col("word_form"))))).select("*", "k.*").drop("k", "word_form")
    as_alias = (word_count(F.array_join("w", " ")) == F.col("words")) & ~F.arrays_overlap("w", F.array(*map(F.lit, _BRACKETS)))
    with_suffix = (F.col("n") == F.col("words") + 2) & (F.col("form") != F.col("own"))
    met = rows.join(small(known), ["matcher", "key"]).filter((F.col("n") <= F.col("most")) & punctuation & F.when(F.col("matcher") == plain, as_alias).otherwise(with_suffix))
    letters = F.array_join("w", "").rlike(r"^(?:\p{L}\.)+\p{L}$") & (F.size("w") >= 3)
    takes = F.col("ends_in_dot") & letters & F.coalesce(F.col("after") == ".", F.lit(False))
    length = F.col("n") + takes.cast("int")
    hits = met.select("doc_id", "label", "token_start", (F.col("token_start") + length).alias("token_stop"), "n", "ord", "alias", "matcher", "start", F.get("stops", length - 1).alias("stop"), F.get("next", length - 1).alias("final"))
    same = W.partitionBy("doc_id", "label", "token_start", "token_stop").orderBy("n", "ord", "alias", "matcher")
    hits = hits.withColumn("k", F.row_number().over(same)).filter("k = 1")
    shorter = F.max("token_stop").over(W.partitionBy("doc_id", "label", "token_start").orderBy("token_stop").rangeBetween(-1, -1))
    letter = (F.col("token_stop") - F.col("token_start") > 1) & shorter.isNotNull() & F.col("final").rlike(r"^\p{L}$")
    hits = hits.withColumn("letter", letter).filter("not letter")
    return hits.select("doc_id", "label", "token_start", "token_stop", "alias", "matcher", "start", "stop")


def with_context(tokens: DataFrame, hits: DataFrame) -> DataFrame:
    """Adds to hits whether they stand in a dispatch formula, ``( alias )``, and near a verb of reporting: dispatch, reporting.

    A document's tokens are numbered from 0.
    """
    listed = F.transform(F.sort_array(F.collect_list(F.struct("i", "token"))), lambda x: x["token"])
    docs = tokens.groupBy("doc_id").agg(listed.alias("tokens"))  # a document's tokens meet its hits once
    each = hits.groupBy("doc_id").agg(F.collect_list(F.struct(*[c for c in hits.columns if c != "doc_id"])).alias("hits"))
    low = lambda h: F.greatest(h["token_start"] - _NEAR, F.lit(0))
    around = lambda h: F.struct(
        h.alias("hit"),
        F.slice("tokens", (low(h) + 1).cast("int"), (h["token_start"] - low(h)).cast("int")).alias("before"),
        F.slice("tokens", (h["token_start"] + 1).cast("int"), (h["token_stop"] - h["token_start"] + _NEAR).cast("int")).alias("rest"),
    )
    rows = each.join(docs, "doc_id").select("doc_id", F.explode(F.transform("hits", around)).alias("s")).select("doc_id", "s.hit.*", "s.before", "s.rest")
    n = F.col("token_stop") - F.col("token_start")
    one, two = F.get("rest", n), F.get("rest", n + 1)
    opened = F.coalesce(F.try_element_at(F.col("before"), F.lit(-1)) == "(", F.lit(False))
    closed = F.coalesce(one == ")", F.lit(False)) | F.coalesce((one == ".") & (two == ")"), F.lit(False))
    near = F.transform(F.concat("before", F.slice("rest", F.lit(1), n + _NEAR)), casefold)
    verbs = F.array(*map(F.lit, REPORTING))
    return rows.withColumn("dispatch", opened & closed).withColumn("reporting", F.coalesce(F.arrays_overlap(near, verbs), F.lit(False))).drop("before", "rest")


def contextual(tokens: DataFrame, hits: DataFrame) -> DataFrame:
    """Hits that stand in a dispatch formula, ``( alias )``, or near a verb of reporting: adds matcher dispatch, reporting."""
    return with_context(tokens, hits).filter("dispatch or reporting")


def plausible(mentions: DataFrame, periods: DataFrame) -> DataFrame:
    """Adds verification and delta_years: whether a mention (label, year) falls after its entity's active_start."""
    known = periods.select("label", "active_start", F.lit(True).alias("known"))
    rows = mentions.join(hinted(known), "label", "left")
    early = F.col("year") < F.col("active_start")
    status = (
        F.when(F.coalesce("label", F.lit("")) == "", "missing_label")
        .when(F.col("known").isNull(), "missing_entity_metadata")
        .when(F.col("year").isNull(), "unknown_document_date")
        .when(F.col("active_start").isNull(), "missing_active_start")
        .when(early, "suspicious_before_start")
        .otherwise("ok")
    )
    return rows.withColumn("verification", status).withColumn("delta_years", F.when(F.col("verification") == "suspicious_before_start", F.col("year") - F.col("active_start"))).drop("known")


_ALNUM = r"[\p{L}\p{N}]"


def boundary_proposals(entities: DataFrame, names: DataFrame, agency: list[str], kept: list[str]) -> DataFrame:
    """Narrower spans for entities that carry an agency word: doc_id, token_start, token_stop, label, new_start, new_stop.

    ``entities`` has doc_id, token_start, token_stop, label and tokens; ``names``
    label, form (as by ``boundary_form``) and direct. The longest, then leftmost
    part that is a direct name of the label, else the shortest suffix that is any
    of its names, without punctuation at its edges; a part needs a token that
    looks like a name. An entity without a proposal has no row.

    A name's first word is its key: only tokens that begin a name of the label
    are extended, and only as far as that name goes, so the parts of an entity
    are never listed.
    """
    last = F.size("tokens") - F.coalesce(F.array_position(F.reverse(F.transform("tokens", lambda t: t.rlike(_ALNUM))), F.lit(True)) - 1, F.size("tokens"))
    rows = entities.withColumn("m", last.cast("int")).filter("m >= 2").withColumn("t", F.slice("tokens", F.lit(1), F.col("m")))
    head = F.slice("t", 1, 4)
    agency_word = F.exists(head, lambda t: boundary_form(t).isin(*agency))
    noisy = boundary_form(F.array_join(head, " ")).rlike("agence|gence|agentur|agenzia|lagence|ng nzia")
    rows = rows.filter(~boundary_form(F.array_join("t", " ")).isin(*kept) & (agency_word | noisy)).withColumn("forms", F.transform("t", boundary_form))
    first = lambda c: F.substring_index(c, " ", 1)
    begins = F.filter(F.transform("forms", lambda f, k: F.struct(k.alias("low"), first(f).alias("word"))), lambda s: s["word"] != "")
    starts = rows.withColumn("s", F.explode(begins)).select("*", "s.*").drop("s")
    met = starts.join(hinted(names.select("label", "form", "direct", first(F.col("form")).alias("word")).distinct()), ["label", "word"])
    joined = lambda a, b: F.array_join(F.filter(F.slice("forms", a + 1, b - a), lambda f: f != ""), " ")
    met = met.filter(F.startswith(F.concat(joined(F.col("low"), F.col("m")), F.lit(" ")), F.concat("form", F.lit(" "))))
    # the form's words end after this many tokens that aren't blank, if they end with a token at all
    high = F.array_min(F.filter(F.sequence(F.col("low") + 1, F.col("m")), lambda b: joined(F.col("low"), b) == F.col("form")))
    met = met.withColumn("high", high).filter("high is not null")
    # with the tokens without a form around it, a part is longer, but it is the same part
    left = F.coalesce(F.array_max(F.filter(F.transform("forms", lambda f, k: F.when((f != "") & (k < F.col("low")), k + 1)), lambda x: x.isNotNull())), F.lit(0))
    right = F.coalesce(F.array_min(F.filter(F.transform("forms", lambda f, k: F.when((f != "") & (k >= F.col("high")), k)), lambda x: x.isNotNull())), F.col("m"))
    met = met.withColumns({"left": left, "right": right}).filter(core_name_token(F.slice("t", F.col("left") + 1, F.col("right") - F.col("left"))))
    suffix = (F.col("high") == F.col("m")) & (F.col("low") > 0)
    met = met.filter(F.col("direct") | suffix).withColumn("phase", (~F.col("direct")).cast("int"))
    word = lambda a, b: F.filter(F.transform(F.slice("t", a + 1, b - a), lambda x, k: F.when(x.rlike(_ALNUM), k + a)), lambda k: k.isNotNull())
    edge = word(F.when(F.col("direct"), F.col("left")).otherwise(F.col("low")), F.when(F.col("direct"), F.col("right")).otherwise(F.col("high")))
    order = F.struct("phase", F.when(F.col("direct"), F.col("left") - F.col("right")).otherwise(-F.col("low")), "left", "low", "high")
    best = met.groupBy("doc_id", "token_start", "token_stop", "label").agg(F.min_by(F.struct(F.array_min(edge).alias("a"), (F.array_max(edge) + 1).alias("b")), order).alias("p"))
    return best.select("doc_id", "token_start", "token_stop", "label", (F.col("token_start") + F.col("p.a")).alias("new_start"), (F.col("token_start") + F.col("p.b")).alias("new_stop"))


def queries_of(seeds: DataFrame) -> DataFrame:
    """Search terms of seeds (label, display_name, aliases, search_aliases): distinct, in order; search aliases go before aliases and display name."""
    has = F.size(F.coalesce("search_aliases", F.array().cast("array<string>"))) > 0
    pool = F.when(has, F.col("search_aliases")).otherwise(F.concat(F.array("display_name"), F.coalesce("aliases", F.array().cast("array<string>"))))
    terms = seeds.select("label", F.posexplode(F.transform(pool, squeezed)).alias("ord", "query")).filter("query <> ''")
    return terms.groupBy("label", "query").agg(F.min("ord").alias("ord")).withColumn("generic", generic_surface(F.col("query"), PLANNING_GENERIC))


def seeds_from(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A small alias table from literals (label, alias, ord)."""
    return spark.createDataFrame(rows, "label string, alias string, ord int")
