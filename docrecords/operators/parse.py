"""Files to ordered text elements and to text.

Everything is local to a row: elements are arrays in document order, so neither
joining them nor attaching them to the raw parse needs a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docrecords.functions import markup, payload
from docrecords.functions.text import decode_text, extension, squeeze
from docrecords.operators.rows import unnest
from docrecords.schemas import MARKUP_EXTENSIONS, PARSED_EXTENSIONS

DEFAULT_SEPARATOR = "\n\n"
#: The contents of a file's elements, in order; an exception marks the file.
Parser = Callable[[bytes], Sequence[str]]


def line_elements(text: Column) -> Column:
    """ARRAY<STRUCT<tag, content>>: the lines that are not blank."""
    lines = F.filter(F.split(text, r"\r?\n"), lambda x: x.rlike(r"[^ \t\r\n]"))
    return F.transform(lines, lambda x: F.struct(F.lit("line").alias("tag"), x.alias("content")))


def raw_document(elements: Column, error: Column | None = None) -> Column:
    """The parser's VARIANT: ``{"document": {"elements": [...]}, "error_status": ...}``."""
    status = F.lit(None).cast("string") if error is None else error
    return F.to_variant_object(
        F.struct(F.struct(elements.alias("elements")).alias("document"), status.alias("error_status"))
    )


def parse_elements(df: DataFrame, kind: str = "text", source: str = "text", out: str = "raw_parsed") -> DataFrame:
    """Add the raw parse of a text or HTML column."""
    make = {"text": line_elements, "html": markup.elements}[kind]
    return df.withColumn(out, raw_document(make(F.col(source))))


def elements_exploded(df: DataFrame, raw: str = "raw_parsed", array_field: str = "elements") -> DataFrame:
    """One row per element: the other columns, ``idx`` from 0 and ``content``."""
    keep = [c for c in df.columns if c != raw]
    found = df.select(*keep, payload.elements(F.col(raw), array_field).alias("_elements"))
    parts = unnest(found, "_elements", keep, "idx")
    return parts.select(*keep, "idx", payload.element_text(F.col("_elements")).alias("content"))


def elements_to_text(
    df: DataFrame,
    raw: str = "raw_parsed",
    sep: str = DEFAULT_SEPARATOR,
    array_field: str = "elements",
    out: str = "text",
) -> DataFrame:
    """Add the element contents joined in order; NULL when the parse failed."""
    contents = F.transform(payload.elements(F.col(raw), array_field), payload.element_text)
    failed = payload.present(F.col(raw), "$.error_status")
    return df.withColumn(out, F.when(~failed, F.array_join(contents, sep)))


def parse_documents(
    files: DataFrame,
    parsed_extensions: Sequence[str] = PARSED_EXTENSIONS,
    markup_extensions: Sequence[str] = MARKUP_EXTENSIONS,
    sep: str = DEFAULT_SEPARATOR,
    parser: Parser | None = None,
) -> DataFrame:
    """(path, content, ...) to (..., raw_parsed, text, branch, reason).

    Files with a parsed (or markup) extension go through the element parser, all
    others are decoded as they are. Both branches are cases of one projection, so
    the content is read once. ``reason`` tells why a file yields no text; NULL
    means it was parsed. A ``parser`` reads the files with a parsed extension; without
    one these must be text, and other bytes are a reason.
    """
    ext = F.lower(extension("path", with_dot=True))
    decoded = decode_text("content")
    is_markup = ext.isin(*markup_extensions)
    keep = [c for c in files.columns if c != "content"]
    staged = files.select(
        *keep,
        F.when(ext.isin(*parsed_extensions) | is_markup, "parsed").otherwise("plain").alias("branch"),
        F.when(is_markup, "html").otherwise("text").alias("_kind"),
        decoded.alias("_decoded"),
        F.is_valid_utf8(F.col("content").cast("string")).alias("_is_text"),
        _run_parser(parser, F.when(ext.isin(*parsed_extensions), F.col("content"))).alias("_parser"),
    )
    own = line_elements(F.col("_decoded"))
    if parser is not None:
        contents = F.col("_parser.contents")
        own = F.transform(contents, lambda x: F.struct(F.lit("part").alias("tag"), x.alias("content")))
    found = F.when(F.col("_kind") == "html", markup.elements(F.col("_decoded"))).otherwise(own)
    staged = staged.withColumn("_elements", F.when(F.col("branch") == "parsed", found))
    parsed = F.col("branch") == "parsed"
    element_file = parsed & (F.col("_kind") == "text")
    unread = F.when(element_file & ~F.col("_is_text"), "not text") if parser is None else F.col("_parser.error")
    reason = F.when(F.col("_decoded").isNull(), "no content").when(unread.isNotNull(), unread).when(
        parsed & (F.coalesce(F.size("_elements"), F.lit(0)) <= 0), "no elements"
    )
    joined = F.array_join(F.transform("_elements", lambda e: e["content"]), sep)
    return staged.select(
        *keep,
        F.when(parsed, raw_document(F.col("_elements"), reason)).alias("raw_parsed"),
        F.when(reason.isNull(), F.when(parsed, joined).otherwise(F.col("_decoded"))).alias("text"),
        "branch",
        reason.alias("reason"),
    )


def _run_parser(parser: Parser | None, content: Column) -> Column:
    """The contents and error of a caller's parser for each value that is not NULL."""
    if parser is None:
        return F.lit(None).cast("struct<contents: array<string>, error: string>")

    @F.pandas_udf("contents array<string>, error string")
    def run(values: pd.Series) -> pd.DataFrame:
        rows = []
        for value in values:
            try:
                rows.append((None if value is None else [str(x) for x in parser(bytes(value))], None))
            except Exception as e:  # noqa: BLE001 - any failure belongs to its row
                rows.append((None, f"{type(e).__name__}: {e}"))
        return pd.DataFrame(rows, columns=["contents", "error"], dtype="object")

    return run(content)


def html_to_markdown(df: DataFrame, source: str = "html", out: str = "text") -> DataFrame:
    return df.withColumn(out, markup.markdown(F.col(source)))


def extract_text(
    df: DataFrame, fn: Callable[[bytes], str] | None = None, content: str = "content", out: str = "text"
) -> DataFrame:
    """Add the text of a binary column, and ``<out>_error`` for rows that failed.

    Without ``fn`` the bytes are decoded and white space is joined by built-in
    expressions. A function given is called per value inside Arrow batches; an
    exception marks its own row only.
    """
    if fn is None:
        return df.withColumn(out, squeeze(decode_text(content))).withColumn(
            f"{out}_error", F.lit(None).cast("string")
        )

    @F.pandas_udf("text string, error string")
    def run(values: pd.Series) -> pd.DataFrame:
        texts, errors = [], []
        for value in values:
            text = error = None
            if value is not None:
                try:
                    text = fn(bytes(value))
                except Exception as e:  # noqa: BLE001 - any failure belongs to its row
                    error = f"{type(e).__name__}: {e}"
            texts.append(text)
            errors.append(error)
        return pd.DataFrame({"text": texts, "error": errors}, dtype="object")

    done = df.withColumn("_extracted", run(F.col(content)))
    return done.withColumn(out, F.col("_extracted.text")).withColumn(
        f"{out}_error", F.col("_extracted.error")
    ).drop("_extracted")
