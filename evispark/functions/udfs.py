"""Arrow UDFs over the kernels, and their names for SQL users."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from evispark.functions import html, images, markdown, requests, text
from evispark.session import tune


def arrow(kernel: Callable, returns: str):
    """Vectorised UDF: one Arrow batch in, the kernel over its values, one batch out."""

    @F.pandas_udf(returns)
    def run(*columns: pd.Series) -> pd.Series:
        values = [c.tolist() if hasattr(c, "tolist") else c for c in columns]
        out = [kernel(*(x.tolist() if hasattr(x, "tolist") else x for x in row)) for row in zip(*values, strict=True)]
        return pd.Series(out, dtype=object)

    return run


KERNELS: dict[str, tuple[Callable, str]] = {
    "normalise_text": (text.normalise_text, "string"),
    "search_form": (text.search_form, "string"),
    "collapse_text": (text.collapse, "string"),
    "topic_key": (text.topic_key, "string"),
    "topic_slug": (text.topic_slug, "string"),
    "page_slug": (text.page_slug, "string"),
    "path_slug": (text.path_slug, "string"),
    "stable_key": (text.stable_key, "string"),
    "clean_label": (text.clean_label, "string"),
    "canonical_number": (text.canonical_number, "string"),
    "prose_numbers": (text.prose_numbers, "array<string>"),
    "claim_numbers": (text.claim_numbers, "array<string>"),
    "identifiers": (text.identifiers, "array<string>"),
    "lenient_json": (text.lenient_json, "string"),
    "without_fence": (text.without_fence, "string"),
    "without_top_heading": (text.without_top_heading, "string"),
    "cut_repeats": (text.cut_repeats, "string"),
    "repeats_at_end": (text.repeats_at_end, "boolean"),
    "request_key": (requests.request_key, "string"),
    "request_numbers": (requests.request_numbers, "array<string>"),
    "changed_requests": (requests.changed_requests, "array<string>"),
    "unapproved_requests": (requests.unapproved_requests, "array<string>"),
    "html_text": (html.html_text, "string"),
    "plain_text": (html.plain_text, "string"),
    "clean_table": (html.clean_table, "string"),
    "cell_tokens_table": (html.cell_tokens_table, "string"),
    "table_rows": (html.table_rows, "array<array<array<string>>>"),
    "table_markup": (markdown.table_markup, "string"),
    "anchors": (markdown.anchors, "array<string>"),
    "links": (markdown.links, "array<struct<kind:string,target:string,fragment:string>>"),
    "placed_links": (markdown.placed_links, "array<struct<kind:string,target:string,fragment:string,place:string>>"),
    "without_images": (markdown.without_images, "string"),
    "moved_links": (markdown.moved_links, "string"),
    "citation_link": (markdown.citation_link, "string"),
    "prepared_markdown": (markdown.prepared, "string"),
    "grounding_errors": (markdown.grounding_errors, "array<string>"),
    "excerpt": (markdown.excerpt, "string"),
    "cited_blocks": (markdown.cited_blocks, "array<struct<block:string,citations:array<string>>>"),
    "integrated_check": (markdown.integrated_check, "array<string>"),
    "evidence_links": (markdown.evidence_links, "string"),
    "image_size": (images.image_size, "array<int>"),
    "fragments": (text.split_text, "array<string>"),
    "fragment_sizes": (text.fragment_sizes, "array<int>"),
    "evidence_block": (markdown.evidence_block, "string"),
    "relative_link": (markdown.relative_link, "string"),
}

_made: dict[str, Callable] = {}


def call(name: str, *columns: Column | str) -> Column:
    """Apply a kernel to columns."""
    tune(SparkSession.getActiveSession())
    if name not in _made:
        _made[name] = arrow(*KERNELS[name])
    return _made[name](*columns)


@udtf(returnType="position int, fragment string")
class SplitText:
    """Fragments of a text with at most `size` characters each."""

    def eval(self, value: str, size: int):
        yield from enumerate(text.split_text(value, size), 1)


@udtf(returnType="table_no int, row_no int, column_no int, value string")
class TableCells:
    """Cells of all tables in HTML, spans filled in."""

    def eval(self, value: str):
        for t, table in enumerate(html.table_rows(value)):
            for r, row in enumerate(table):
                for c, cell in enumerate(row):
                    yield t, r, c, cell


@udtf(returnType="position int, value string, key string")
class RequestNumbers:
    def eval(self, value: str):
        for i, x in enumerate(requests.request_numbers(value), 1):
            yield i, x, requests.request_key(x)


def register(spark: SparkSession) -> None:
    """Make all kernels callable from SQL."""
    for name, (kernel, returns) in KERNELS.items():
        _made.setdefault(name, arrow(kernel, returns))
        spark.udf.register(name, _made[name])
    for name, table in (("split_text", SplitText), ("table_cells", TableCells), ("request_rows", RequestNumbers)):
        spark.udtf.register(name, table)
