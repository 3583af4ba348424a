"""Benchmark decontamination with a distributed positional inverted index.

Training documents are tokenised once. Of each benchmark phrase the rarest
terms are looked up: postings (term, row, position) of these terms are stored,
the offset-adjusted lists of the two rarest are intersected, and what is left
is compared with the phrase word by word. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import salted_join, stored

WINDOW = 10
#: A table of the benchmark with at most so many rows is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 100_000

#: Places of a block in which a proximity match looks for the second term.
_BLOCK = 64

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, then maximal runs of digits, a-z and non-ASCII characters."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(_WORD), F.lit(0))


def token_table(docs: DataFrame) -> DataFrame:
    """doc_id, row_id (names the row, whatever doc_id holds), text_hash, n_words and the words with a space between (``line``), stored."""
    found = docs.select("doc_id", F.monotonically_increasing_id().alias("row_id"), F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("words"))
    return stored(found.select("doc_id", "row_id", "text_hash", F.size("words").cast("long").alias("n_words"), F.array_join("words", " ").alias("line")), "tokens")


def _split() -> Column:
    return F.when(F.col("n_words") > 0, F.split("line", " ")).otherwise(F.array().cast("array<string>"))


def phrases(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (item_id, phrase, n): all windows of consecutive words; an item with fewer words is one."""
    w = items.select("item_id", words(F.col("text")).alias("w")).filter("size(w) > 0")
    w = w.select("item_id", "w", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))).alias("at"))
    return w.select("item_id", F.slice("w", F.col("at") + 1, window).alias("terms")).select("item_id", F.array_join("terms", " ").alias("phrase"), F.size("terms").alias("n")).distinct()


def small(df: DataFrame) -> DataFrame:
    """A broadcast hint, if the table is counted to be small."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _by_term(many: DataFrame, few: DataFrame, spread: str) -> DataFrame:
    """Join on the term: ``few`` is broadcast if it is small, else frequent terms are dealt to several tasks."""
    return many.join(F.broadcast(few), "term") if few.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else salted_join(many, few, ["term"], spread)


def ranked_terms(tokens: DataFrame, asked: DataFrame) -> DataFrame:
    """(phrase, n, off, term, rank): a phrase's terms from the rarest in ``tokens``; phrases with an absent term are left out."""
    terms = asked.select("phrase", "n").distinct().select("phrase", "n", F.posexplode(F.split("phrase", " ")).alias("off", "term"))
    wanted = terms.select("term").distinct()
    few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    seen = tokens.select(F.explode(_split()).alias("term")).join(F.broadcast(wanted) if few else wanted, "term", "left_semi").groupBy("term").agg(F.count("*").alias("many"))
    of = terms.join(F.broadcast(seen) if few else seen, "term", "left").select("phrase", "n", "off", "term", F.coalesce("many", F.lit(0)).alias("many"))
    of = of.withColumn("least", F.expr("min(many) over (partition by phrase)")).filter("least > 0")
    return of.withColumn("rank", F.expr("row_number() over (partition by phrase order by many, off)")).drop("least", "many")


def postings(tokens: DataFrame, terms: DataFrame) -> DataFrame:
    """The index: (term, row_id, pos) of all occurrences of ``terms``, stored."""
    found = tokens.select("row_id", F.posexplode(_split()).alias("pos", "term")).join(small(terms.select("term").distinct()), "term", "left_semi")
    return stored(found.select("term", "row_id", "pos"), "postings")


def matches(tokens: DataFrame, asked: DataFrame, slop: int = 0) -> DataFrame:
    """Occurrences (row_id, start, n, phrase, exact) of the phrases in the token table.

    With ``slop`` also proximity matches, where each term lies within so many
    words of its place, seen from an occurrence of the phrase's rarest term.
    The list of the second rarest term is met by blocks of places then.
    """
    ranked = stored(ranked_terms(tokens, asked).filter("rank <= 2"), "anchors")
    index = postings(tokens, ranked)
    second = ranked.filter("rank = 2").select("phrase", F.col("term").alias("term_2"), F.col("off").alias("off_2"))
    anchors = ranked.filter("rank = 1").join(second, "phrase", "left")
    start = F.col("pos") - F.col("off")
    at = _by_term(index, anchors, spread="row_id").filter(start >= -slop).select("row_id", start.alias("start"), "phrase", "n", "term_2", (start + F.col("off_2")).alias("pos_2"))
    block = lambda pos: F.floor(pos / (_BLOCK if slop else 1))
    second = index.select(F.col("row_id").alias("r"), F.col("term").alias("t"), F.col("pos").alias("p"), block(F.col("pos")).alias("b"))
    ends = F.array_distinct(F.array(block(F.col("pos_2") - slop), block(F.col("pos_2") + slop)))
    met = at.filter("term_2 is not null").withColumn("block", F.explode(ends)).join(second, F.expr(f"row_id = r and term_2 = t and block = b and abs(pos_2 - p) <= {slop}"), "left_semi")
    keep = ["row_id", "start", "n", "phrase"]
    possible = met.select(*keep).unionByName(at.filter("term_2 is null").select(*keep))
    possible = possible.distinct() if slop else possible
    by_row = possible.groupBy("row_id").agg(F.collect_list(F.struct("start", "n", "phrase")).alias("found"))

    def judged(c: Column) -> Column:
        exact = (c["start"] >= 0) & (F.array_join(F.slice("words", F.greatest(c["start"], F.lit(0)) + 1, c["n"]), " ") == c["phrase"])
        if not slop:
            return F.struct(c["start"].alias("start"), c["n"].alias("n"), c["phrase"].alias("phrase"), exact.alias("exact"), exact.alias("near"))
        places = F.transform(F.split(c["phrase"], " "), lambda term, i: F.array_contains(F.slice("words", F.greatest(c["start"] + i - slop, F.lit(0)) + 1, F.greatest(F.least(c["start"] + i + slop + 1, F.lit(2 * slop + 1)), F.lit(0))), term))
        return F.struct(c["start"].alias("start"), c["n"].alias("n"), c["phrase"].alias("phrase"), exact.alias("exact"), (exact | F.forall(places, lambda x: x)).alias("near"))

    checked = tokens.select("row_id", "n_words", "line").join(by_row, "row_id").select("row_id", "found", _split().alias("words"))
    checked = checked.select("row_id", F.filter(F.transform("found", judged), lambda m: m["near"]).alias("found"))
    return checked.select("row_id", F.explode("found").alias("m")).select("row_id", "m.start", "m.n", "m.phrase", "m.exact")


def exact_matches(tokens: DataFrame, asked: DataFrame) -> DataFrame:
    """All occurrences (row_id, start, n, phrase) of the phrases in the token table."""
    return matches(tokens, asked).drop("exact")


def proximity_matches(tokens: DataFrame, asked: DataFrame, slop: int) -> DataFrame:
    """(row_id, start, phrase): each term of the phrase occurs within ``slop`` words of its place, as seen from its rarest term."""
    return matches(tokens, asked, slop).select("row_id", "start", "phrase")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """Benchmark hits of every row of ``docs``: row_id, doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated.

    n_hit counts the words inside any occurrence of a phrase, n_items the items
    of which a phrase occurs. With ``slop``, n_near says of how many items a
    phrase matches in proximity, exactly included. Further columns are dropped. Null or empty texts have no words and no hits;
    items without words ask for nothing; an item_id that repeats is one item;
    hits of a null item_id count as hits, but name no item. Repeated rows and
    null doc_ids are kept, each with its own hits. Either table may be empty.
    """
    tokens = token_table(docs)
    asked = stored(phrases(items, window), "phrases")
    every = stored(matches(tokens, asked, slop), "hits")
    hits = every.filter("exact")
    reach = hits.groupBy("row_id", "start").agg(F.max(F.col("start") + F.col("n")).alias("stop"))
    reach = reach.withColumn("seen", F.expr("max(stop) over (partition by row_id order by start rows between unbounded preceding and 1 preceding)"))
    covered = reach.groupBy("row_id").agg(F.sum(F.greatest(F.lit(0), F.col("stop") - F.greatest("start", F.coalesce("seen", F.lit(0))))).cast("long").alias("n_hit"))
    named = hits.select("row_id", "phrase").distinct().join(asked.filter("item_id is not null").select("item_id", "phrase"), "phrase")
    named = named.groupBy("row_id").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    found = covered.join(named, "row_id", "left")
    if slop:
        near = every.select("row_id", "phrase").distinct().join(asked.filter("item_id is not null").select("item_id", "phrase"), "phrase").groupBy("row_id").agg(F.count_distinct("item_id").alias("n_near"))
        found = near.join(found, "row_id", "full_outer")
    out = tokens.select("row_id", "doc_id", "text_hash", "n_words").join(found, "row_id", "left")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("row_id", "doc_id", "text_hash", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"), F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), *([F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")] if slop else []))
