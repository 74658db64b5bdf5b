"""Small helpers that the operators share: white space, word arrays, local bindings, shared copies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snapflow.session import ensure_checkpoint_dir, materialize, release, ship_package

__all__ = ["ASCII_SPACE", "DOC_ID", "let", "materialize", "narrow", "prepare", "read_table",
           "release", "slices", "without", "words_of"]

# fixed values: the six ASCII white space characters, 0x20 and 0x09-0x0D
ASCII_SPACE = " \t\n\x0b\x0c\r"
_SPACE_RUN = r"[\x20\x09-\x0D]+"

DOC_ID = "doc_id"


def prepare(spark: SparkSession) -> None:
    """Shared folder and package of a session, whether the caller is a query or a pipeline stage."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def narrow(docs: DataFrame, id_col: str = DOC_ID, text_col: str = "text") -> DataFrame:
    """Only id and text, under fixed names: whatever else the table carries cannot clash."""
    return docs.select(docs[id_col].alias(DOC_ID), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.  A lambda variable is a value, so the
    optimizer cannot copy the expression behind it into each place that uses it."""
    return F.transform(F.array(value), body)[0]


def slices(batches, rows: int = 512):
    """Arrow batches in parts of at most ``rows`` rows, so that a task holds few texts as objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def without(text: Column, chars: str) -> Column:
    """``text`` with every character of ``chars`` removed (plain search, much faster than ``translate``)."""
    for ch in chars:
        text = F.replace(text, F.lit(ch), F.lit(""))
    return text


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; no word: the empty array.
    Five plain replacements and a split on one character cost a third of the pattern's split."""
    for ch in ASCII_SPACE[1:]:
        text = F.replace(text, F.lit(ch), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")
