"""The token table: tokens with exact character offsets, and windows over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanloom.functions.text import SPACE, SPACES, TOKEN


#: Bytes of text whose tokens one task holds and sorts.
SHARE = 2_000_000


def by_document(*order: str) -> W:
    return W.partitionBy("doc_id").orderBy(*(order or ("i",)))


def together(left: DataFrame, right: DataFrame) -> DataFrame:
    """The union of rows that are grouped by document next, dealt by document.

    Spark 4.1 takes the common partitioning of a union's inputs for the union's
    own, but adaptive execution may coalesce or re-plan the inputs differently,
    and then groups are split or the job stops. It also takes the deal after
    such a union for superfluous; so it is told not to.
    """
    own_unions(left.sparkSession)
    return left.unionByName(right).repartition("doc_id")


def own_unions(spark: SparkSession) -> None:
    """Has Spark deal the rows of unions as those of any other input, in this session."""
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")


def own_deals(spark: SparkSession) -> None:
    """Has Spark join rows on a document and a place where they lie, if they are dealt by document, in this session.

    It would deal tokens anew by both keys otherwise.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def hinted(df: DataFrame, most: int = 100_000) -> DataFrame:
    """With a broadcast hint, if the table is counted to have at most so many rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def pieces(text: Column) -> Column:
    """Each token with the white space before it: they tile the text."""
    return F.regexp_extract_all(text, F.lit(f"{SPACE}*{TOKEN}"), F.lit(0))


def cut_pieces(docs: DataFrame, array: Column, *keep: str) -> DataFrame:
    """What ``keep`` names, i, piece of each piece in ``array``; documents without any have no rows.

    Of a plain explode Spark infers a filter on the array's size, which it
    pushes down, and then cuts each text again for it.
    """
    return docs.select(*keep, F.posexplode_outer(array).alias("i", "piece")).filter("i is not null")


def bare(piece: Column) -> Column:
    """A piece without the white space before its token."""
    return F.ltrim(piece, F.lit(SPACES))


def dealt(docs: DataFrame) -> DataFrame:
    """Texts dealt by doc_id in shares of about ``SHARE`` bytes.

    Spark sizes partitions by what is shuffled, which is packed text; its tokens
    take some fifty times the room, and windows over them sort and spill. So the
    texts are measured and the number of shares is fixed.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return docs.repartition(max(1 + size // SHARE, min(cores, 1 + size // 1_000_000)), "doc_id")


def with_blocks(docs: DataFrame, size: int) -> DataFrame:
    """Adds ``blocks``: every ``size`` characters of the text with the next ones, so that parts of long texts are found without counting from their start."""
    cut = docs.withColumn("_cut", F.regexp_extract_all("text", F.lit(f"(?s).{{1,{size}}}"), F.lit(0)))
    return cut.withColumn("blocks", F.transform("_cut", lambda c, k: F.concat(c, F.coalesce(F.get("_cut", k + 1), F.lit(""))))).drop("_cut")


def tokenise(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, what ``keep`` names, i, token, start, stop of each document's tokens, from 0 and half open.

    Texts are dealt by doc_id before they are cut, so that windows over a
    document's tokens need no exchange of tokens. Null and empty texts have no
    tokens; rows of one doc_id must be one document.
    """
    cut = cut_pieces(dealt(docs.select("doc_id", *keep, "text")), pieces(F.col("text")), "doc_id", *keep)
    stop = F.sum(F.length("piece")).over(by_document().rowsBetween(W.unboundedPreceding, 0))
    return cut.select("doc_id", *keep, "i", bare(F.col("piece")).alias("token"), stop.alias("stop")).select("doc_id", *keep, "i", "token", (F.col("stop") - F.length("token")).alias("start"), "stop")


def words(docs: DataFrame, *keep: str) -> DataFrame:
    """The tokens of each document without their offsets: what ``keep`` names, i, token. Nothing is dealt anew."""
    cut = cut_pieces(docs, pieces(F.col("text")), *keep)
    return cut.select(*keep, "i", bare(F.col("piece")).alias("token"))


def token_counts(docs: DataFrame, *keep: str) -> DataFrame:
    """What ``keep`` names and n, the number of tokens, of the documents that have some."""
    return docs.select(*keep, F.size(pieces(F.coalesce("text", F.lit("")))).cast("long").alias("n")).filter("n > 0")


def stored_tokens(docs: DataFrame) -> DataFrame:
    """Document rows with parallel arrays tokens, token_starts, token_stops (a public layout) to the token table."""
    zipped = F.arrays_zip("tokens", "token_starts", "token_stops")
    return docs.select("doc_id", F.posexplode(zipped).alias("i", "t")).select("doc_id", "i", F.col("t.tokens").alias("token"), F.col("t.token_starts").alias("start"), F.col("t.token_stops").alias("stop"))


def placed(tokens: DataFrame) -> DataFrame:
    """Offsets of (doc_id, i, token, no_space, end_of_line) in the text that they make: doc_id, i, token, gap, start, stop.

    A token is followed by a line end, by nothing, or by a blank.
    """
    gap = F.when(F.col("end_of_line"), F.lit("\n")).when(F.col("no_space"), F.lit("")).otherwise(F.lit(" "))
    before = F.sum(F.length("token") + F.length("gap")).over(by_document().rowsBetween(W.unboundedPreceding, -1))
    rows = tokens.withColumn("gap", gap).withColumn("start", F.coalesce(before, F.lit(0)))
    return rows.select("doc_id", "i", "token", "gap", "start", (F.col("start") + F.length("token")).alias("stop"))


def rebuilt_texts(tokens: DataFrame) -> DataFrame:
    """The text that the tokens of a document make, with a bare end: a row for each document, doc_id, text, tokens, last_stop."""
    whole = F.transform(F.sort_array(F.collect_list(F.struct("i", F.concat("token", "gap").alias("s")))), lambda x: x["s"])
    return placed(tokens).groupBy("doc_id").agg(F.regexp_replace(F.array_join(whole, ""), r"\s+$", "").alias("text"), F.count("*").alias("tokens"), F.max("stop").alias("last_stop"))


def rebuilt(tokens: DataFrame) -> DataFrame:
    """Text from (doc_id, i, token, no_space, end_of_line): doc_id, i, token, start, stop, text.

    Each row holds the whole text; ``rebuilt_texts`` has it once a document.
    """
    text = rebuilt_texts(tokens).select("doc_id", "text")
    return placed(tokens).join(text, "doc_id").select("doc_id", "i", "token", "start", "stop", "text")


def islands(rows: DataFrame, changed: Column, name: str = "island") -> DataFrame:
    """Numbers runs of rows of a document: a new one where ``changed``."""
    return rows.withColumn(name, F.sum(changed.cast("int")).over(by_document().rowsBetween(W.unboundedPreceding, 0)))


def runs(tokens: DataFrame, column: str, keep: str = "start") -> DataFrame:
    """Spans of equal values of ``column``: doc_id, value, token_start, token_stop, start, stop."""
    changed = ~F.col(column).eqNullSafe(F.lag(column).over(by_document())) | (F.col("i") == 0)
    return islands(tokens, changed).groupBy("doc_id", "island").agg(F.first(column).alias("value"), F.min("i").alias("token_start"), (F.max("i") + 1).alias("token_stop"), F.min("start").alias("start"), F.max("stop").alias("stop")).drop("island")


def sentences(tokens: DataFrame) -> DataFrame:
    """Spans of sentences from a boolean end_of_sentence: doc_id, sentence, token_start, token_stop, start, stop."""
    ended = F.coalesce(F.lag("end_of_sentence").over(by_document()), F.lit(False))
    return islands(tokens, ended, "sentence").groupBy("doc_id", "sentence").agg(F.min("i").alias("token_start"), (F.max("i") + 1).alias("token_stop"), F.min("start").alias("start"), F.max("stop").alias("stop"))


def windows(lengths: DataFrame, size: int, stride: int) -> DataFrame:
    """Windows of ``size`` words that overlap by ``stride``: (doc_id, n) to doc_id, window, low, high.

    One window holds a short document; an empty one has none.
    """
    step = size - stride
    last = F.when(F.col("n") <= size, F.lit(0)).otherwise(F.ceil((F.col("n") - size) / step))
    return lengths.filter("n > 0").select("doc_id", "n", F.explode(F.sequence(F.lit(0), last.cast("int"))).alias("window")).select("doc_id", "window", (F.col("window") * step).alias("low"), F.least(F.col("window") * step + size, F.col("n")).alias("high"))


def first_window(covering: DataFrame) -> DataFrame:
    """Of each word's windows the first: (doc_id, window, low, high) to doc_id, i, window."""
    words = covering.select("doc_id", "window", F.explode(F.sequence("low", F.col("high") - 1)).alias("i"))
    return words.groupBy("doc_id", "i").agg(F.min("window").alias("window"))


def window_coverage(covering: DataFrame, costs: DataFrame, budget: int) -> DataFrame:
    """How a limit on cost truncates windows: (doc_id, i, cost) to doc_id, windows, over, truncated, uncovered words.

    A window keeps its words as long as their costs add up to ``budget``.
    """
    words = covering.select("doc_id", "window", F.explode(F.sequence("low", F.col("high") - 1)).alias("i")).join(costs, ["doc_id", "i"])
    at = W.partitionBy("doc_id", "window").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    words = words.withColumn("kept", F.sum("cost").over(at) <= budget)
    by_word = words.groupBy("doc_id", "i").agg(F.max("kept").alias("covered"))
    by_window = words.groupBy("doc_id", "window").agg(F.min("kept").alias("fits")).groupBy("doc_id").agg(F.count("*").alias("windows"), F.sum((~F.col("fits")).cast("long")).alias("truncated"))
    return by_window.join(by_word.groupBy("doc_id").agg(F.sum((~F.col("covered")).cast("long")).alias("uncovered")), "doc_id")


def chunks(n: Column, size: int | Column, overlap: float) -> Column:
    """Starts of word chunks: at a fixed step, and one more that ends with the text where the last falls short."""
    size = F.lit(size) if isinstance(size, int) else size
    step = F.greatest(F.lit(1), F.bround(size * F.lit(1 - overlap)).cast("int"))
    starts = F.sequence(F.lit(0), F.greatest(n - size, F.lit(0)), step)
    return F.when(n <= 0, F.array().cast("array<int>")).when(n <= size, F.array(F.lit(0))).otherwise(F.array_distinct(F.concat(starts, F.array((n - size).cast("int")))))


def search(tokens: DataFrame, sequence: list[str]) -> DataFrame:
    """Occurrences of a token sequence, case ignored, within documents: doc_id, token_start, token_stop."""
    at = F.lower("token") == sequence[0].lower()
    for k, word in enumerate(sequence[1:], 1):
        at &= F.lower(F.lead("token", k).over(by_document())) == word.lower()
    return tokens.withColumn("hit", F.coalesce(at, F.lit(False))).filter("hit").select("doc_id", F.col("i").alias("token_start"), (F.col("i") + len(sequence)).alias("token_stop"))


def snippets(docs: DataFrame, spans: DataFrame, radius: int) -> DataFrame:
    """Tokens around each span with offsets from the snippet's start: (doc_id, tokens) and spans to doc_id, span, low, tokens, token_start, token_stop."""
    each = spans.groupBy("doc_id").agg(F.collect_list(F.struct("token_start", "token_stop")).alias("at"))  # a document's tokens meet its spans once

    def cut(s: Column) -> Column:
        low = F.greatest(s["token_start"] - radius, F.lit(0))
        return F.struct(s["token_start"].alias("span"), low.alias("low"), F.slice("tokens", low + 1, s["token_stop"] + radius - low).alias("tokens"), (s["token_start"] - low).alias("token_start"), (s["token_stop"] - low).alias("token_stop"))

    both = each.join(docs.select("doc_id", "tokens"), "doc_id")
    return both.select("doc_id", F.explode(F.transform("at", cut)).alias("s")).select("doc_id", "s.*")
