"""Every value inside JSON documents as a row.

Each document is parsed once, in Arrow batches where it stands, and nothing is written or moved; what is looked for among its values is
then filtered, grouped and ranked in the plan. (Opened a level at a time by VARIANT, each level parsed and wrote all that is below it
again.) ``path`` holds a value's place in each container around it, so that paths in ascending order are document order.

Defined cases: a malformed document is tried again with its entities resolved (pages escape their blocks), and then gives no rows;
so does one that repeats a key in an object or is nested too deeply for Python's parser (thousands of levels), and null. Strings that look
like JSON stay strings. Rows that repeat a key of ``keys`` are documents of their own only if the keys tell them apart.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain
from json.encoder import encode_basestring as quoted

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: JSON-LD types that hold an article.
ARTICLE_TYPES = ["newsarticle", "reportagenewsarticle", "article"]
#: Words of a key that speaks of a video.
VIDEO_KEY = "video|hls|player|mixed[_-]?media"

#: Entities that ``text.unescape_basic`` resolves, in its order.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
#: Values in one Arrow batch, about.
ROWS = 20_000


class _Number(str):
    """A number as the document writes it."""


def _object(pairs: list[tuple]) -> dict:
    out = dict(pairs)
    if len(out) < len(pairs):
        raise ValueError("repeated key")
    return out


def _not_json(constant: str):
    raise ValueError(constant)


def _parsed(text: str | None) -> tuple:
    """(value,) of a document, or () if it has none."""
    for attempt in range(2 if text else 0):
        if attempt:
            for entity, char in ENTITIES:
                text = text.replace(entity, char)
        try:
            return (json.loads(text, object_pairs_hook=_object, parse_float=_Number, parse_int=_Number, parse_constant=_not_json),)
        except (ValueError, RecursionError):
            continue
    return ()


def _values(document, texts: bool) -> list[list]:
    """(path, name, kind, value) of every value in a document, containers before what is in them; theirs is null without ``texts``."""
    found, todo = [], [((), None, document, -1)]
    while todo:
        path, name, value, around = todo.pop()
        at = len(found)
        if isinstance(value, dict):
            found.append([path, name, "object", [] if texts else None, around])
            todo += [((*path, k), n, v, at) for k, (n, v) in enumerate(value.items())][::-1]
        elif isinstance(value, list):
            found.append([path, name, "list", [] if texts else None, around])
            todo += [((*path, k), None, v, at) for k, v in enumerate(value)][::-1]
        elif value is None:
            found.append([path, name, "null", None, around])
        elif isinstance(value, bool):
            found.append([path, name, "other", "true" if value else "false", around])
        else:
            found.append([path, name, "other" if isinstance(value, _Number) else "string", str(value), around])
    for row in reversed(found) if texts else ():  # a container's text is put together from those of its members, the last of which came first
        _, name, kind, value, around = row
        if kind in ("object", "list"):
            row[3] = ("{%s}" if kind == "object" else "[%s]") % ",".join(reversed(value))
        if around >= 0:
            text = "null" if kind == "null" else quoted(value) if kind == "string" else row[3]
            found[around][3].append(text if found[around][2] == "list" else f"{quoted(name)}:{text}")
    return found


def _strings(values: list) -> pa.Array:
    try:
        return pa.array(values, pa.string())
    except UnicodeEncodeError:  # half of a surrogate pair, written as an escape
        return pa.array([v if v is None else v.encode("utf-8", "replace").decode() for v in values], pa.string())


def nodes(docs: DataFrame, keys: list[str], column: str, texts: bool = True) -> DataFrame:
    """(keys, path, name, kind, value): a row for each value of each document; ``value`` is a string's content or the JSON text of others,
    ``name`` the key of an object's member. Without ``texts`` objects and lists have no value."""

    def put(batch: pa.RecordBatch, of: list[int], rows: list[list]) -> pa.RecordBatch:
        own = batch.take(pa.array(of, pa.int32()))
        ends = np.cumsum([0, *[len(r[0]) for r in rows]], dtype=np.int32)
        paths = pa.ListArray.from_arrays(ends, pa.array(chain.from_iterable(r[0] for r in rows), pa.int32()))
        columns = [paths, *[_strings([r[k] for r in rows]) for k in (1, 2, 3)]]
        return pa.RecordBatch.from_arrays([*[own.column(k) for k in keys], *columns], [*keys, "path", "name", "kind", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, rows = [], []
            for k, text in enumerate(batch.column("__doc").to_pylist()):
                for document in _parsed(text):
                    found = _values(document, texts)
                    for at in range(0, len(found), ROWS):
                        rows += found[at : at + ROWS]
                        of += [k] * (len(rows) - len(of))
                        if len(rows) >= ROWS:
                            yield put(batch, of, rows)
                            of, rows = [], []
            if rows:
                yield put(batch, of, rows)

    values = [T.StructField("path", T.ArrayType(T.IntegerType())), *[T.StructField(c, T.StringType()) for c in ("name", "kind", "value")]]
    schema = T.StructType([*[docs.schema[k] for k in keys], *values])
    return docs.select(*keys, F.col(column).alias("__doc")).mapInArrow(run, schema)


def _sign(v: Column) -> Column:
    """The first character of a value's JSON text."""
    return F.substring(F.to_json(v), 1, 1)


def articles(blocks: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(keys, headline, body) of the longest article body among the JSON-LD blocks that share their keys, wherever it stands; of equal
    ones the first. ``blocks`` may have a column ``block``, their order in the page."""
    order = ["block"] if "block" in blocks.columns else []
    # only what stands in an object itself is looked at, once, and only where the word is in its text at all
    found = nodes(blocks, [*keys, *order], column).where((F.col("kind") == "object") & F.contains("value", F.lit('"articleBody":')))
    stated = found.select(*keys, *order, "path", F.from_json("value", "struct<`@type`:variant,headline:variant,articleBody:variant>").alias("o")).select(*keys, *order, "path", "o.*")
    text = lambda name: F.try_variant_get(name, "$", "string")
    listed = F.coalesce(F.try_variant_get("@type", "$", "array<string>"), F.array(text("@type")))
    own = stated.where(_sign(F.col("articleBody")) == '"').where(F.exists(listed, lambda k: F.lower(k).isin(ARTICLE_TYPES)))
    own = own.select(*keys, *order, "path", F.coalesce(text("headline"), F.lit("")).alias("headline"), text("articleBody").alias("body")).where("body <> ''")
    best = Window.partitionBy(*keys).orderBy(F.desc(F.length("body")), *order, "path")
    return own.withColumn("__n", F.row_number().over(best)).where("__n = 1").select(*keys, "headline", "body")


def owners(docs: DataFrame, keys: list[str], column: str, found: DataFrame | None = None) -> DataFrame:
    """(keys, owner): the first string that starts with ``@``, without it. A container's own strings come before what is inside its
    containers, and the last of those is looked into first. ``found``: the documents' ``nodes``, where they are known."""
    strings = (nodes(docs, keys, column, False) if found is None else found).where("kind = 'string' and value like '@%' and size(path) > 0")
    around = F.transform(F.slice("path", 1, F.size("path") - 1), lambda p: -p)
    first = F.min_by("value", F.struct(around.alias("around"), F.element_at("path", -1).alias("pos")))
    return strings.groupBy(*keys).agg(F.regexp_replace(first, "^@+", "").alias("owner"))


def with_key_like(docs: DataFrame, keys: list[str], column: str, words: str = VIDEO_KEY, found: DataFrame | None = None) -> DataFrame:
    """(keys, found): whether any key, however deep, holds one of the words; keys alone count, not strings that look like them."""
    own = (nodes(docs, keys, column, False) if found is None else found).select(*keys, "path", F.coalesce(F.col("name").rlike(f"(?i){words}"), F.lit(False)).alias("found"))
    return own.where((F.size("path") == 0) | F.col("found")).groupBy(*keys).agg(F.bool_or("found").alias("found"))
