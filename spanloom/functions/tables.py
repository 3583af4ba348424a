"""Table functions for SQL: the tokens of a text and the windows over them, for LATERAL."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql.functions import arrow_udf, udtf

from .text import SPACES

# The classes of ``functions.text``, spelled for the regex library.
_SPACE = r"[\s\x0B\x1c-\x1f\x85\p{Z}]"
_TOKEN = r"(?:[\p{L}\p{Nl}\p{No}]+|\p{Nd}+|_+|[^\p{L}\p{N}_\s\x0B\x1c-\x1f\x85\p{Z}])"


@cache
def _pieces():
    import regex

    return regex.compile(f"{_SPACE}*({_TOKEN})")


def token_pieces(text: str) -> Iterator[tuple[str, int, int]]:
    """Each token with its start and stop."""
    pieces, at = _pieces(), 0
    while found := pieces.match(text, at):
        yield found.group(1), found.start(1), found.end(1)
        at = found.end()


_TOKENS = pa.list_(pa.struct([("token", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))


@cache
def _tiles():
    import regex

    return regex.compile(f"{_SPACE}*{_TOKEN}")


def token_columns(text: str) -> tuple[list[str], list[int], list[int]]:
    """A text's tokens, their starts and their stops."""
    pieces = _tiles().findall(text)
    tokens, stops = [p.lstrip(SPACES) for p in pieces], list(accumulate(map(len, pieces)))
    return tokens, [b - len(t) for b, t in zip(stops, tokens, strict=True)], stops


def token_arrays(texts: pa.Array) -> pa.Array:
    """Each text's tokens as a list of (token, start, stop). Null and empty texts have none.

    Tokens are made as columns: pieces that tile the texts, bare of the white
    space before them, end where their lengths add up to.
    """
    cut, parts = _tiles().findall, []
    for k in range(0, len(texts), 64):  # so many texts' pieces are Python objects at once
        each = [cut(text or "") for text in texts.slice(k, 64).to_pylist()]
        counts = np.array([len(x) for x in each], np.int64)
        first = np.concatenate([[0], counts.cumsum()])
        pieces = pa.array([p for x in each for p in x], pa.string())
        token = pc.utf8_ltrim(pieces, SPACES)
        ends = np.concatenate([[0], pc.utf8_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64).cumsum()])
        stop = ends[1:] - np.repeat(ends[first[:-1]], counts)
        start = stop - pc.utf8_length(token).to_numpy(zero_copy_only=False)
        found = pa.StructArray.from_arrays([token, pa.array(start, pa.int32()), pa.array(stop, pa.int32())], fields=list(_TOKENS.value_type))
        parts.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), found, type=_TOKENS))
    return pa.concat_arrays(parts) if parts else pa.array([], _TOKENS)


#: ``tokens_of(text)``: a row for each token, with offsets from 0 and half open. Null and empty texts have none.
TOKENS_OF = """CREATE OR REPLACE TEMPORARY FUNCTION tokens_of(text STRING) RETURNS TABLE(i INT, token STRING, start INT, stop INT)
  RETURN SELECT pos, col.token, col.start, col.stop FROM posexplode(spanloom_token_arrays(text))"""


@udtf(returnType="`window` int, low int, high int", useArrow=True)
class WindowsOf:
    """``windows_of(n, size, stride)``: windows of ``size`` of n words that overlap by ``stride``. No words, or null: none."""

    def eval(self, n: int, size: int, stride: int) -> Iterator[tuple]:
        step = size - stride
        if step < 1:
            raise ValueError("windows must be longer than their overlap")
        for k in range(0 if not n else 1 + max(0, -(-(n - size) // step))):
            yield k, k * step, min(k * step + size, n)


def register(spark: SparkSession) -> None:
    """Makes ``tokens_of`` and ``windows_of`` known to the session's SQL."""
    spark.udf.register("spanloom_token_arrays", arrow_udf(token_arrays, "array<struct<token:string,start:int,stop:int>>"))
    spark.sql(TOKENS_OF)
    spark.udtf.register("windows_of", WindowsOf)
