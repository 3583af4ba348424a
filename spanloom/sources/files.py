"""Readers and writers of the file formats that annotation projects exchange."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The 13 column names of annotated token files, in order.
TOKEN_COLUMNS = "TOKEN NE-COARSE-LIT NE-COARSE-METO NE-FINE-LIT NE-FINE-METO NE-FINE-COMP NE-NESTED NEL-LIT NEL-METO RENDER SEG OCR-INFO MISC".split()

#: Bytes of token files whose lines one task holds, if a file with more than a few such shares is dealt.
SHARE = 8_000_000


def read_jsonl(spark: SparkSession, paths: str | list[str], schema: T.StructType | str, strict: bool = True) -> DataFrame:
    """JSON lines, plain or bz2 (which Spark splits). Blank lines are skipped.

    ``strict`` stops at a line that isn't JSON of the schema; otherwise such
    lines go to ``_corrupt_record`` and missing paths give no rows.
    """
    schema = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    if strict:
        return spark.read.schema(schema).json(paths, mode="FAILFAST")
    schema = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(schema).option("ignoreMissingFiles", "true").json(paths, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record")


def read_predictions(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tab-separated diagnostics with a header; quotes are characters like any other."""
    return spark.read.csv(path, schema=schema, sep="\t", header=True, quote="", maxCharsPerColumn=-1)


def read_metadata(spark: SparkSession, path: str, schema: str, key: str, first: bool = True) -> DataFrame:
    """JSON arrays of entries; of those with one key the first or the last counts, by the files' paths and the places in them.

    A file is read by one task, which numbers its rows in order; so the order
    doesn't depend on how files are dealt to tasks.
    """
    rows = spark.read.schema(schema).option("multiLine", "true").json(path)
    rest = [c for c in rows.columns if c != key]
    rows = rows.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row")).alias("_at"))
    pick = F.min_by if first else F.max_by
    return rows.groupBy(key).agg(pick(F.struct(*rest), "_at").alias("r")).select(key, "r.*")


def split_of(path: Column) -> Column:
    """The split that a file's name says, or else its folder's; names that say none stop the job."""
    parts = F.split(F.lower(path), "/")
    said = lambda name: F.when(name.contains("train"), "train").when(name.contains("dev"), "validation").when(name.contains("test"), "test")
    return F.coalesce(said(F.try_element_at(parts, F.lit(-1))), said(F.try_element_at(parts, F.lit(-2))), F.raise_error(F.concat(F.lit("no split in "), path)).cast("string"))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, value) of token files to a row for each document: file, doc, its comments, the last of each name, and its token lines with their segments."""
    begins, header = ("language", "global.columns"), "\t".join(TOKEN_COLUMNS)
    kinds = [pa.string(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.list_(pa.string()), pa.list_(pa.int64())]
    for batch in batches:
        for file, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            found, since = [({}, [], [])], False  # whether tokens came since the last comment that can begin a document
            (comments, lines, segments), link, segment = found[0], None, 0
            text = value.as_py() or ""
            for line in re.split(r"\r?\n", text) if "\r" in text else text.split("\n"):
                if line[:2] != "# ":
                    if line == header or not line.strip(" "):
                        continue
                    if line.count("\t") != len(TOKEN_COLUMNS) - 1:
                        raise ValueError(f"{file}: a token line needs 13 fields")
                    since = True
                    lines.append(line)
                    segments.append(segment)
                elif named := re.match("# ([^ =]+) *=", line):
                    if named[1] in begins:
                        if since:
                            found.append(({}, [], []))
                            (comments, lines, segments), link, segment = found[-1], None, 0
                        since = False
                    said = re.sub("^# [^=]*= ?", "", line)
                    comments[named[1]] = said
                    if named[1] == "segment_iiif_link" and said != link:
                        link, segment = said, segment + 1
            columns = [file] * len(found), range(len(found)), [list(c.items()) or None for c, _, _ in found], [x for _, x, _ in found], [x for _, _, x in found]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "doc", "comments", "lines", "segments"])


def read_token_files(spark: SparkSession, path: str, names: str = "*.tsv") -> DataFrame:
    """Annotated token files below ``path``: file, doc, i, the 13 columns, segment, comments map, split.

    A document begins at the file's start, at ``# language`` after tokens, or at
    a repeated ``# global.columns`` after tokens. A file is read as one value,
    since its line order is what it says, and is cut into documents at once, so
    that nothing sorts lines. Documents stay where their file is read; only
    where a file holds several shares they are dealt.
    """
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", names).text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", names).load(path)  # lengths only, nothing is read
    bytes_ = F.col("length") * F.when(F.col("path").rlike(r"\.(gz|bz2|deflate|zst|lz4|snappy)$"), 8).otherwise(1)
    size, most = found.agg(F.sum(bytes_), F.max(bytes_)).first()
    docs = files.mapInArrow(_documents, "file string, doc long, comments map<string,string>, lines array<string>, segments array<long>")
    if (most or 0) > 4 * SHARE:
        docs = docs.repartition(1 + size // SHARE, "file", "doc")
    docs = docs.filter("size(lines) > 0").withColumn("split", split_of(F.col("file")))  # what a document says is told once, not for each token
    tokens = docs.select("file", "doc", "comments", "split", F.posexplode_outer(F.arrays_zip("lines", "segments")).alias("i", "t"))
    field = lambda k: F.substring_index(F.substring_index("t.lines", "\t", k + 1), "\t", -1)
    named = [field(k).alias(c.lower().replace("-", "_")) for k, c in enumerate(TOKEN_COLUMNS)]
    return tokens.select("file", "doc", "i", *named, F.col("t.segments").alias("segment"), "comments", "split")


def sorted_json(*columns: str) -> Column:
    """One JSON object with keys in order; nulls are left out."""
    return F.to_json(F.struct(*sorted(columns)))


def write_jsonl(df: DataFrame, path: str, key: str, one_file: bool = False, compression: str | None = None) -> None:
    """JSON lines in release order: by folded key, then key; keys of each object in order."""
    ordered = df.repartition(1) if one_file else df
    rows = ordered.sortWithinPartitions(F.lower(key), key) if one_file else ordered.orderBy(F.lower(key), key)
    rows.select(sorted_json(*df.columns).alias("value")).write.text(path, compression=compression)


def append_jsonl(df: DataFrame, path: str) -> None:
    df.select(sorted_json(*df.columns).alias("value")).write.mode("append").text(path)


def write_tsv(df: DataFrame, path: str, columns: list[str], escaped: bool = False) -> None:
    """A report with a header and these columns in this order; nulls are empty.

    Tabs and line ends in a cell become blanks, or backslash forms where
    ``escaped``. Quotes are characters like any other: read it with
    ``read_predictions``.
    """

    def cell(c: str) -> Column:
        text = F.coalesce(F.col(c).cast("string"), F.lit(""))
        for raw, name in (("\t", "\\t"), ("\r", "\\r"), ("\n", "\\n")):
            text = F.replace(text, F.lit(raw), F.lit(name if escaped else " "))
        return text.alias(c)

    df.select(*map(cell, columns)).write.csv(path, sep="\t", header=True, quote="", escape="", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def token_lines(tokens: DataFrame, comments: dict[str, str], tag: str = "tag") -> DataFrame:
    """Documents of a token table as text of annotated token files: doc_id, block.

    ``comments`` names columns by the comment that tells their value; the tag
    stands in the fine literal column, further columns hold an underscore.
    """
    ordered = F.sort_array(F.collect_list(F.struct("i", F.col("token").alias("t"), F.col(tag).alias("g"))))
    return token_blocks(tokens.groupBy("doc_id", *set(comments.values()) - {"doc_id"}).agg(ordered.alias("_all")), comments, F.transform("_all", lambda x: x["t"]), F.transform("_all", lambda x: x["g"]))


def token_blocks(docs: DataFrame, comments: dict[str, str], tokens: Column, tags: Column) -> DataFrame:
    """The same for documents as rows, whose tokens and tags are arrays of one size."""
    at = TOKEN_COLUMNS.index("NE-FINE-LIT")
    before, after = "\t" + "_\t" * (at - 1), "\t_" * (len(TOKEN_COLUMNS) - at - 1)
    lines = F.zip_with(tokens, tags, lambda t, g: F.concat(F.coalesce(t, F.lit("")), F.lit(before), F.coalesce(g, F.lit("")), F.lit(after)))
    head = [F.lit("# global.columns = " + " ".join(TOKEN_COLUMNS)), *[F.concat(F.lit(f"# {k} = "), F.col(v).cast("string")) for k, v in comments.items()], F.lit("\t".join(TOKEN_COLUMNS))]
    return docs.select("doc_id", F.array_join(F.concat(F.array(*head), lines, F.array(F.lit(""))), "\n").alias("block"))


def token_file_text(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, meta map, tokens, labels) as text blocks: comments, a header, a line for each token, a blank line.

    Tokens and labels of different number stop the job; empty comments are left out.
    """
    clean = lambda c: F.regexp_replace(c, r"[\t\r\n]", " ")
    kept = F.filter(F.map_entries("meta"), lambda e: F.coalesce(e["value"], F.lit("")) != "")
    comments = F.transform(kept, lambda e: F.concat(F.lit("# "), e["key"], F.lit(" = "), clean(e["value"])))
    lines = F.transform(F.arrays_zip("tokens", "labels"), lambda x: F.concat(clean(x["tokens"]), F.lit("\t"), x["labels"]))
    checked = F.when(F.size("tokens") != F.size("labels"), F.raise_error(F.lit("tokens and labels differ in number")).cast("array<string>")).otherwise(lines)
    return docs.select("doc_id", F.array_join(F.concat(comments, F.array(F.lit("TOKEN\tLABEL")), checked, F.array(F.lit(""))), "\n").alias("block"))


def markdown_rows(df: DataFrame) -> DataFrame:
    """The body of a Markdown table: df's columns and ``line``. Thousands of whole numbers are separated, null is empty."""

    def cell(name: str, kind: str) -> Column:
        text = F.format_number(name, 0) if kind in ("tinyint", "smallint", "int", "bigint") else F.col(name).cast("string")
        return F.replace(F.coalesce(text, F.lit("")), F.lit("|"), F.lit("\\|"))

    return df.withColumn("line", F.concat(F.lit("| "), F.concat_ws(" | ", *[cell(*c) for c in df.dtypes]), F.lit(" |")))


def markdown(df: DataFrame, most: int = 10_000) -> str:
    """A small aggregate as a Markdown table. One of more than ``most`` rows isn't small and is an error; write ``markdown_rows`` then."""
    rows = markdown_rows(df).select("line").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report of more than {most} rows")
    return "\n".join(["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns), *[r["line"] for r in rows]])


def tag_changes(before: DataFrame, after: DataFrame, radius: int = 8) -> DataFrame:
    """Tokens near a change of tag, before and after: doc_id, i, token, tag_before, tag_after, changed."""
    both = before.select("doc_id", "i", "token", F.col("tag").alias("tag_before")).join(after.select("doc_id", "i", F.col("tag").alias("tag_after")), ["doc_id", "i"])
    return near_changes(both, radius)


def near_changes(both: DataFrame, radius: int = 8) -> DataFrame:
    """The same for tokens that hold both tags: doc_id, i, token, tag_before, tag_after."""
    both = both.withColumn("changed", F.col("tag_before") != F.col("tag_after"))
    near = F.max(F.col("changed").cast("int")).over(W.partitionBy("doc_id").orderBy("i").rowsBetween(-radius, radius))
    return both.withColumn("near", near).filter("near = 1").drop("near")
