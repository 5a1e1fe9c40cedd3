"""§2.11: adapters that yield rows (images, embeds, links of a page) as table functions, in SQL and in the DataFrame API.

An adapter is a function of a page's HTML that yields dictionaries. ``table_function`` makes it a function that is called in two ways:

* ``LATERAL links(html)``: the adapter's columns and ``error`` for one page, beside the row that holds it;
* ``links(TABLE(pages) PARTITION BY url ORDER BY captured_at)``: all columns of the table but ``html``, then the adapter's. The captures of a
  partition are tried in their order; the first that gives a row is the page, and no later one is read by the adapter.

Its schema follows from the table it is given. Defined cases: an adapter that fails gives one row with its ``error`` and nulls, in a
partition only if no capture gives a row (the first failure then); a page without rows gives none; null HTML is an empty page; columns
that an adapter leaves out are null; a table without ``html``, or with a column named like one of the adapter's, is refused when the query is
analysed. One page's rows are held at a time, so a url of very many captures needs no more memory than one of few.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, UserDefinedTableFunction

ERROR = "error"


def table_function(of: Callable[[str], Iterable[dict[str, Any]]], columns: str | StructType) -> UserDefinedTableFunction:
    """``of`` as a table function; ``columns`` is the schema of its rows. ``spark.udtf.register`` gives it a name for SQL."""
    added = columns if isinstance(columns, StructType) else StructType.fromDDL(columns)
    names = added.fieldNames()

    class Rows:
        @staticmethod
        def analyze(pages: AnalyzeArgument) -> AnalyzeResult:
            schema = StructType()
            for field in pages.dataType.fields if pages.isTable else ():
                if field.name in (*names, ERROR):
                    raise ValueError(f"the table's column {field.name} is one of the adapter's")
                if field.name != "html":
                    schema.add(field)
            if pages.isTable and "html" not in pages.dataType.fieldNames():
                raise ValueError("the table has no column html")
            for field in added.fields:
                schema.add(field.name, field.dataType, True)
            return AnalyzeResult(schema.add(ERROR, StringType(), True))

        def __init__(self) -> None:
            self.found = False
            self.failed: tuple | None = None

        def eval(self, pages) -> Iterator[tuple]:
            in_table = hasattr(pages, "asDict")
            if in_table and self.found:
                return
            values = pages.asDict(recursive=False) if in_table else {"html": pages}
            kept = tuple(v for n, v in values.items() if n != "html")
            try:
                rows = [(*kept, *(row.get(n) for n in names), None) for row in of(values["html"] or "")]
            except Exception as error:
                rows, failure = [], (*kept, *(None for _ in names), f"{type(error).__name__}: {error}")
                if not in_table:
                    rows = [failure]
                elif self.failed is None:
                    self.failed = failure
            self.found = self.found or bool(rows)
            yield from rows

        def terminate(self) -> Iterator[tuple]:
            if not self.found and self.failed is not None:
                yield self.failed

    return F.udtf(Rows)
