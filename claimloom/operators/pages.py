"""A captured page read once: article, candidate images and video scopes out of one parse, in one Arrow-batched function."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.html.dom import parse
from claimloom.operators import articles
from claimloom.operators import images as image_ops
from claimloom.operators import videos as video_ops

READ = f"struct<article:{articles.ARTICLE},list:{image_ops.CANDIDATES},image_error:string,scope:string,own_scope:string,video_error:string>"


def read(static: Column, rendered: Column, url: Column, spec: str, images: bool = True, videos: bool = True) -> Column:
    """H1-H17, I1-I18, V17 of a page: its article, image candidates, the HTML of its video scopes, and each part's error.

    Images and videos are read from the rendered copy where there is one; if it is the static one, its tree serves all three.
    """
    own = articles.SPECS[spec]
    image_spec = image_ops.SPECS.get(own.publisher) if images else None
    selectors = video_ops.SPECS.get(own.publisher, video_ops.ANY).selectors() if videos else ("", "")

    def one(static: str | None, rendered: str | None, url: str | None) -> dict:
        best = rendered or static
        try:
            tree = parse(best)
        except Exception as error:
            return {"article": articles.extract(static, rendered, url, own), "list": [], "image_error": str(error), "scope": "", "own_scope": "", "video_error": str(error)}
        found = image_ops.found(tree, url, image_spec) if image_spec else {"list": [], "error": None}
        error, scope, own_scope = video_ops._scopes(tree, selectors) if any(selectors) else (None, "", "")
        article = articles.extract(static, rendered, url, own, tree if best is static else None)
        return {"article": article, "list": found["list"], "image_error": found["error"], "scope": scope, "own_scope": own_scope, "video_error": error}

    @F.pandas_udf(READ)
    def run(static: pd.Series, rendered: pd.Series, url: pd.Series) -> pd.DataFrame:
        rows = [one(*row) for row in zip(static, rendered, url, strict=True)]
        return pd.DataFrame(rows, columns=["article", "list", "image_error", "scope", "own_scope", "video_error"])

    return run(static, rendered, url)
