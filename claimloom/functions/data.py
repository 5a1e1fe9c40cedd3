"""JSON functions as Columns: player documents, JSON-LD videos, nested keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def value_at(document: Column, path: str, kind: str = "string") -> Column:
    """A value by path, null where the document is malformed or the path leads nowhere."""
    return F.try_variant_get(F.try_parse_json(document), path, kind)


def video_object(document: Column) -> Column:
    """contentUrl of a JSON-LD VideoObject."""
    return F.when(value_at(document, "$['@type']") == "VideoObject", value_at(document, "$.contentUrl"))


def video_objects(document: Column) -> Column:
    """contentUrl of each VideoObject of a JSON-LD block, which may be an object or a list of them."""
    own = F.from_json(document, "array<struct<`@type`:string,contentUrl:string>>")
    urls = F.transform(F.filter(own, lambda o: o["@type"] == "VideoObject"), lambda o: o["contentUrl"])
    return F.coalesce(F.filter(urls, lambda u: u.isNotNull()), F.array().cast("array<string>"))


def image_rights(document: Column) -> Column:
    """(caption, holder) of a JSON-LD image."""
    return F.struct(F.coalesce(value_at(document, "$.caption"), F.lit("")).alias("caption"), F.coalesce(value_at(document, "$.copyrightHolder.name"), F.lit("")).alias("rights"))


#: A player's media arrays, as far as streams are read from them.
PLAYER = "struct<_mediaArray:array<struct<_mediaStreamArray:array<struct<_stream:string>>>>>"


def player_streams(document: Column) -> Column:
    """Stream urls of a player document; a stream is one url or a list of them."""
    player = F.from_json(document, PLAYER)
    streams = F.flatten(F.transform(player["_mediaArray"], lambda m: F.transform(m["_mediaStreamArray"], lambda s: s["_stream"])))
    listed = F.transform(streams, lambda s: F.when(s.startswith("["), F.from_json(s, "array<string>")).otherwise(F.array(s)))
    return F.coalesce(F.filter(F.flatten(listed), lambda u: u.isNotNull() & (u != "")), F.array().cast("array<string>"))


def progressive_url(renditions: Column) -> Column:
    """The progressive rendition's url, of an object or of the first of a list."""
    return F.coalesce(value_at(renditions, "$.progressive.url"), value_at(renditions, "$[0].progressive.url"))


def has_key_like(document: Column, words: str = "video|hls|player|mixed media") -> Column:
    """Whether any key, however deep, holds one of the words."""
    return F.coalesce(document, F.lit("")).rlike(f'(?i)"[^"]*({words})[^"]*"\\s*:')
