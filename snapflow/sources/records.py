"""Records of delimited text, quoted line breaks included, from files that are split across tasks.

Whether a line break ends a record depends on the quotes of all lines before it.  A first pass over
the lines gives one row a file range: how quotes leave the range if it begins outside a quoted field
and if it begins inside one, and the header on a file's first line.  Composing these maps in the
order of a file's ranges (a prefix over a few rows a file) tells how every range really begins.  Only
if some line of the feed does end inside quotes, a second pass cuts each range into records; what a
record leaves in neighbouring ranges is put together by file.  A feed without such lines stays one
record a line and is read as lines.

A quoted field that the file never closes has no end: its lines are given as ``lost``, each by itself.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

#: longest record, in characters, that may run over line breaks; a longer one is an error
MAX_RECORD = 64_000_000
RECORD, HEAD, MIDDLE, TAIL, LOST = range(5)


class Quotes:
    """The quote rule of a line: a field that begins with a quote runs to its closing quote, ``""`` is
    a quote inside it, and what follows the closing quote up to the separator belongs to the field."""

    def __init__(self, sep: str):
        s = re.escape(sep)
        field = rf'(?>"(?>[^"]|"")*+"[^{s}]*+|[^{s}"][^{s}]*+|(?={s}|\Z))'
        rest = rf'(?:{s}{field})*+'
        self._closed = re.compile(rf'{field}{rest}\Z', re.S)
        self._reopened = re.compile(rf'(?>[^"]|"")*+"[^{s}]*+{rest}\Z', re.S)

    def after(self, line: str, inside: bool) -> bool:
        """Whether the line ends inside quotes."""
        if '"' not in line:
            return inside
        return not (self._reopened if inside else self._closed).match(line)


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """``value`` and the place of every line."""
    m = F.col("_metadata")
    return spark.read.text(path).select("value", m["file_path"].alias("path"), m["file_name"].alias("name"),
                                        m["file_block_start"].alias("start"), m["file_block_length"].alias("length"))


_SUMMARY = "path string, start long, length long, header array<string>, opens boolean, closed_to boolean, open_to boolean, ends boolean"


def _slices(batch: pa.RecordBatch):
    """(path, start, length, part) of each run of lines of one range."""
    path, start = batch.column("path").to_pylist(), batch.column("start").to_pylist()
    cuts = [0, *[i for i in range(1, len(path)) if start[i] != start[i - 1] or path[i] != path[i - 1]], len(path)]
    for lo, hi in zip(cuts, cuts[1:]):
        if hi > lo:
            yield path[lo], start[lo], batch.column("length")[lo].as_py(), batch.slice(lo, hi - lo)


def range_summary(lines: DataFrame, sep: str, columns) -> DataFrame:
    """One row a file range.  ``header``: the fields of the file's first line if one of them is in ``columns``."""
    wanted = set(columns)

    def run(batches):
        quotes, at, row = Quotes(sep), None, None
        first = True

        def out():
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([
                ("path", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("header", pa.list_(pa.string())),
                ("opens", pa.bool_()), ("closed_to", pa.bool_()), ("open_to", pa.bool_()), ("ends", pa.bool_())]))

        for batch in batches:
            for path, start, length, part in _slices(batch):
                if (path, start) != at:
                    if row:
                        yield out()
                    at, first = (path, start), start == 0
                    row = dict(path=path, start=start, length=length, header=None, opens=False, closed_to=False, open_to=True, ends=False)
                if first:
                    row["header"] = header_fields(part.column("value")[0].as_py(), sep, wanted)
                    first = False
                for line in part.column("value").drop_null().to_pylist():
                    if '"' not in line:
                        continue
                    row["opens"] = row["opens"] or quotes.after(line, False)
                    row["closed_to"] = quotes.after(line, row["closed_to"])
                    row["open_to"] = quotes.after(line, row["open_to"])
                    row["ends"] = row["ends"] or not row["open_to"]
        if row:
            yield out()

    # only lines that matter travel with their text: a file's first block, and lines with a quote
    needed = lines.select(F.when((F.col("start") == 0) | F.contains("value", F.lit('"')), F.col("value")).alias("value"), "path", "start", "length")
    return needed.mapInArrow(run, _SUMMARY)


def header_fields(line: str | None, sep: str, columns: set[str]) -> list[str] | None:
    import csv
    found = [h.strip() for h in next(csv.reader([line or ""], delimiter=sep), [])]
    return found if columns & set(found) else None


_STATES = "path string, start long, length long, inside boolean, lost_head boolean, lost_tail boolean"


def range_states(summary: DataFrame) -> DataFrame:
    """How each range begins, and whether the quotes that its head or tail lies in are never closed."""
    def of_file(pdf):
        pdf = pdf.sort_values("start").reset_index(drop=True)
        inside, state = [], False
        for closed_to, open_to in zip(pdf["closed_to"], pdf["open_to"]):
            inside.append(state)
            state = bool(open_to if state else closed_to)
        lost_head, lost_tail = [False] * len(pdf), [False] * len(pdf)
        at = len(pdf) - 1
        while state and at >= 0:                 # the chain that reaches the end of the file, backwards
            lost_tail[at] = True
            if not inside[at] or pdf["ends"][at]:
                break
            lost_head[at] = True
            at -= 1
        return pdf[["path", "start", "length"]].assign(inside=inside, lost_head=lost_head, lost_tail=lost_tail)

    return summary.groupBy("path").applyInPandas(of_file, _STATES)


class RangesMoved(RuntimeError):
    """A pass was planned over other file ranges than the one before it."""


_CUT = "path string, name string, start long, kind int, value string"


def _cut(shared, sep: str, max_record: int):
    """Lines in file order -> whole records, and the parts of records that cross a range's borders."""
    import pyarrow.compute as pc
    schema = pa.schema([("path", pa.string()), ("name", pa.string()), ("start", pa.int64()), ("kind", pa.int32()), ("value", pa.string())])

    def rows_of(at, name, rows):
        n = len(rows)
        return pa.RecordBatch.from_arrays([pa.array([at[0]] * n), pa.array([name] * n), pa.array([at[1]] * n, pa.int64()),
                                           pa.array([k for k, _ in rows], pa.int32()), pa.array([v for _, v in rows], pa.string())], schema=schema)

    def run(batches):
        quotes, states = Quotes(sep), shared.value
        at = name = None
        inside = in_head = lost_head = lost_tail = False
        held: list[str] = []                     # lines of the record at hand, when it has several
        size = 0

        def left():
            """What the range leaves: its part of a record, or lines of a quote without an end."""
            if lost_head if in_head else lost_tail:
                return [(LOST, x) for x in held]
            return [(MIDDLE if in_head else TAIL, "\n".join(held))]

        for batch in batches:
            for path, start, length, part in _slices(batch):
                if (path, start) != at:
                    if held:
                        yield rows_of(at, name, left())
                    at, name, held, size = (path, start), part.column("name")[0].as_py(), [], 0
                    known = states.get(at)
                    if known is None or known[0] != length:
                        raise RangesMoved(f"RangesMoved: {path} at {start}")
                    _, inside, lost_head, lost_tail = known
                    in_head = inside
                values = part.column("value")
                if not inside and not pc.any(pc.match_substring(values, '"')).as_py():
                    yield pa.RecordBatch.from_arrays([part.column("path"), part.column("name"), part.column("start"),
                                                      pa.array([RECORD] * len(values), pa.int32()), values], schema=schema)
                    continue
                rows = []
                for line in values.to_pylist():
                    was, inside = inside, quotes.after(line, inside)
                    if not was and not inside:
                        rows.append((RECORD, line))
                        continue
                    held.append(line)
                    size += len(line)
                    if not inside:
                        rows.append((HEAD if in_head else RECORD, "\n".join(held)))
                        held, size, in_head = [], 0, False
                    elif size > max_record and not (lost_head if in_head else lost_tail):
                        raise ValueError(f"{path}: a quoted record of more than {max_record} characters near byte {start}")
                if rows:
                    yield rows_of(at, name, rows)
        if held:
            yield rows_of(at, name, left())
    return run


def joined_records(lines: DataFrame, summary: DataFrame, sep: str, max_record: int = MAX_RECORD) -> DataFrame:
    """``value, path, name, lost`` of a feed with line breaks inside quotes; written once, as what a
    range means depends on the first pass over the same ranges."""
    from snapflow.session import materialize
    spark = lines.sparkSession
    # one row a file range; the ranges that start outside quotes are needed too, to know that none moved
    states = {(r["path"], r["start"]): (r["length"], r["inside"], r["lost_head"], r["lost_tail"]) for r in range_states(summary).collect()}
    cut = materialize(lines.mapInArrow(_cut(spark.sparkContext.broadcast(states), sep, max_record), _CUT), "records")
    parts = cut.where(F.col("kind").isin(HEAD, MIDDLE, TAIL))
    begun = F.last(F.when(F.col("kind") == TAIL, F.col("start")), ignorenulls=True).over(
        Window.partitionBy("path").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0))
    whole = (parts.withColumn("begun", begun).groupBy("path", "begun")
             .agg(F.first("name").alias("name"), F.sum(F.length("value")).alias("n"),
                  F.array_sort(F.collect_list(F.struct("start", "kind", "value"))).alias("l"))
             .select(F.when(F.col("n") <= max_record, F.array_join(F.col("l.value"), "\n")).otherwise(
                 F.raise_error(F.concat(F.col("path"), F.lit(f": a quoted record of more than {max_record} characters")))).alias("value"),
                 "path", "name", F.lit(False).alias("lost")))
    single = cut.where(F.col("kind").isin(RECORD, LOST)).select("value", "path", "name", (F.col("kind") == LOST).alias("lost"))
    return single.unionByName(whole)


def feed_records(spark: SparkSession, path: str, sep: str, columns) -> tuple[DataFrame, DataFrame]:
    """(``value, path, name, lost`` of every record, header lines included; ``path, header`` of every
    file that has a header)."""
    from snapflow.session import materialize
    for attempt in range(3):
        lines = lines_of(spark, path)
        summary = materialize(range_summary(lines, sep, columns), "ranges")
        headers = summary.where("header IS NOT NULL").select("path", "header")
        if not summary.where("opens").limit(1).count():
            return lines.select("value", "path", "name", F.lit(False).alias("lost")), headers
        try:
            return joined_records(lines, summary, sep), headers
        except Exception as e:                   # noqa: BLE001 - only one cause is tried again
            if "RangesMoved" not in str(e) or attempt == 2:
                raise
    raise AssertionError("unreachable")
