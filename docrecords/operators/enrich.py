"""Summaries, labels, routing by label, and attaching them to a second source."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docrecords.functions.text import lead_sentences
from docrecords.operators.intake import VERSION, having, pending_files
from docrecords.operators.rows import pin
from docrecords.operators.skew import latest
from docrecords.schemas import (
    DOCUMENT_LABELS,
    NO_SUMMARY,
    UNCLASSIFIED,
)

# Phrases that speak for a label; each occurrence counts once.
LABEL_PHRASES: dict[str, tuple[str, ...]] = {
    "invoice": ("invoice", "bill to", "amount due", "remit to"),
    "receipt": ("receipt", "amount paid", "change due", "thank you for your purchase"),
    "purchase_order": ("purchase order", "requested by", "delivery date"),
    "contract": ("contract", "agreement", "hereby", "licens", "the parties"),
}


#: Makes a column from the text column.
TextFunction = Callable[[Column], Column]


def _long_enough(text: Column, min_length: int) -> Column:
    return text.isNotNull() & (F.length(text) > min_length)


def summarize(
    df: DataFrame,
    text: str = "text",
    out: str = "summary",
    sentences: int = 3,
    min_length: int = 0,
    head_chars: int | None = None,
    fn: TextFunction | None = None,
) -> DataFrame:
    """The leading sentences of the text; a fixed phrase for texts up to ``min_length``.

    ``head_chars`` looks at the first characters only. ``fn`` makes the summary instead,
    for instance by calling a model.
    """
    lead = lead_sentences(text, sentences, head_chars) if fn is None else fn(F.col(text))
    return df.withColumn(out, F.when(_long_enough(F.col(text), min_length), lead).otherwise(NO_SUMMARY))


def classify(
    df: DataFrame,
    rules: Mapping[str, Sequence[str]] | None = None,
    labels: Sequence[str] = DOCUMENT_LABELS,
    text: str = "text",
    out: str = "document_type",
    min_length: int = 0,
    fn: TextFunction | None = None,
) -> DataFrame:
    """The label whose phrases occur most often in the whole text.

    Ties go to the label listed first, no occurrence gives the last label, and texts of
    at most ``min_length`` characters are not labelled. ``fn`` gives the label instead.
    """
    if fn is not None:
        label = F.when(_long_enough(F.col(text), min_length), fn(F.col(text))).otherwise(UNCLASSIFIED)
        return pin(df.withColumn(out, label), out)
    rules = LABEL_PHRASES if rules is None else rules
    default = labels[-1]
    scored = [label for label in labels if rules.get(label)]
    low = df.withColumn("_low", F.lower(text))
    staged = low.withColumns({f"_n_{i}": _occurrences("_low", rules[label]) for i, label in enumerate(scored)})
    counts = [F.col(f"_n_{i}") for i in range(len(scored))]
    best = F.greatest(*counts) if len(counts) > 1 else counts[0]
    pick = F.when(best == 0, default)
    for label, n in zip(scored, counts):
        pick = pick.when(n == best, label)
    chosen = F.when(_long_enough(F.col(text), min_length), pick).otherwise(UNCLASSIFIED)
    keep = [c for c in df.columns if c != out]
    return pin(staged.select(*keep, chosen.alias(out)), out)


def _occurrences(text: str, phrases: Sequence[str]) -> Column:
    """How often the phrases occur: bytes lost by removing a phrase, over its own bytes."""
    whole = F.octet_length(text)
    counts = [
        (whole - F.octet_length(F.replace(text, F.lit(p), F.lit("")))) / F.lit(float(len(p.encode())))
        for p in phrases
    ]
    return sum(counts[1:], counts[0])


def enrich(df: DataFrame, summary_options: Mapping | None = None, **classify_options) -> DataFrame:
    """Summary and document type of each text."""
    return classify(summarize(df, **(summary_options or {})), **classify_options)


def route_by_type(docs: DataFrame, keep: str = "invoice") -> tuple[DataFrame, DataFrame]:
    """(kept rows, all others). Rows without a type belong to the others."""
    kept = F.col("document_type").eqNullSafe(F.lit(keep))
    return docs.filter(kept), docs.filter(~kept)


def attach_labels(files: DataFrame, docs: DataFrame) -> DataFrame:
    """Left join the first source's summary and type on the file version.

    Of several rows of a version the last one taken in counts, so files never multiply.
    """
    order = [c for c in ("ingestion_timestamp", "document_type", "summary") if c in docs.columns]
    labels = latest(docs.select(*dict.fromkeys([*VERSION, "summary", "document_type", *order])), VERSION, order)
    return files.join(labels.select(*VERSION, "summary", "document_type"), VERSION, "left")


def second_source(
    intake: DataFrame,
    docs: DataFrame,
    ledger: DataFrame | None = None,
    keep: str | None = "invoice",
    **pending_options,
) -> DataFrame:
    """Files the second extractor should read, with the first source's labels.

    With ``keep`` only documents of that type remain, so the costly extractor does
    not run on files that later steps would drop. Labels are joined to versions, and
    content is read for the versions that remain.
    """
    narrow = pending_files(intake.select(*VERSION), ledger, **pending_options)
    labelled = attach_labels(narrow.select(*VERSION).distinct(), docs)
    if keep is not None:
        labelled = labelled.filter(F.col("document_type").eqNullSafe(F.lit(keep)))
    files = having(intake, labelled).withColumn("process_date", F.to_date("modificationTime"))
    return attach_labels(files, labelled)
