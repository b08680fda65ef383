"""Records of CSV files whose fields may hold line breaks, found in parallel inside every file.

Whether a line break ends a record depends on all quotes before it in the file. The lines of every split of a file are
therefore read twice: first under both assumptions, that the split begins between records and inside quotes. This gives
one row a split, which maps either state to the state at its end; the splits of a file are put one after another by
window functions over these rows, and the second reading knows in which state each split begins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import BROADCAST_ROWS, materialize

# Charsets in which a line feed is not the one byte 10: such files are decoded whole.
WIDE = re.compile(r"utf-?(16|32)|ucs-?[24]", re.IGNORECASE)

_FILE, _START, _ORDER, _LINE, _LEADING = "__file", "__start", "__order", "__line", "__leading"


class QuoteScanner:
    """Follows quotes through lines, as Spark's CSV parser does: a quote opens a field only at the field's start.

    Inside quotes ``escape`` before a quote or itself is no end; where escape and quote are the same, a doubled quote is
    a quote. What follows a closing quote up to the delimiter is plain text.
    """

    def __init__(self, delimiters: list[str], quote: str, escape: str) -> None:
        self.quote, self.escape = quote, escape
        self.opening = re.compile(f"(?:{'|'.join(map(re.escape, delimiters))}){re.escape(quote)}")
        self.special = re.compile(f"[{re.escape(quote + escape)}]") if escape != quote else re.compile(re.escape(quote))

    def inside_after(self, line: str, inside: bool) -> bool:
        """Whether the end of ``line`` lies inside quotes, if its start does or begins a record."""
        at, quote = 0, self.quote
        if not inside:
            if line.startswith(quote):
                at, inside = 1, True
            elif quote not in line:
                return False
        while True:
            if inside:
                found = self.special.search(line, at)
                if found is None:
                    return True
                at = found.end()
                following = line[at : at + 1]
                if found[0] != quote:
                    at += following in (quote, self.escape) and following != ""
                elif self.escape == quote and following == quote:
                    at += 1
                else:
                    inside = False
            else:
                # from the end of a quoted field, or the start of a plain one, to the next field that opens a quote
                found = self.opening.search(line, at)
                if found is None:
                    return False
                at, inside = found.end(), True


class LineScanner:
    """For files in which every line is a record, whatever quotes it has."""

    def inside_after(self, line: str, inside: bool) -> bool:
        return False


def _decoded_lines(charset: str, line_end: str, folders: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lines = batch.column(1)[i].as_py().decode(charset, "replace").removeprefix("\ufeff").split(line_end)
                if not lines[-1]:
                    lines.pop()  # a line end at the end of a file begins no line
                for at in range(0, len(lines), 4096):
                    part = [x.encode("utf-8", "replace") for x in lines[at : at + 4096]]
                    same = [pa.array([batch.column(2 + k)[i].as_py()] * len(part), batch.schema.field(2 + k).type) for k in range(folders)]
                    columns = [pa.array(part, pa.binary()), pa.array([batch.column(0)[i].as_py()] * len(part)), pa.array([0] * len(part), pa.int64())]
                    columns.append(pa.array(range(at, at + len(part)), pa.int64()))
                    yield pa.RecordBatch.from_arrays([*columns, *same], names=["value", _FILE, _START, _ORDER, *batch.schema.names[2:]])

    return run


def _lines(spark: SparkSession, paths: list[str], charset: str, line_end: str, base_path: str | None) -> tuple[DataFrame, list[str], str]:
    """(value in bytes, file, start of the split, order in it) of all lines, the names of partition folders, the charset."""
    reader = spark.read.option("basePath", base_path) if base_path else spark.read
    if WIDE.search(charset):
        whole = reader.format("binaryFile").load(paths)
        folders = [n for n in whole.columns if n not in ("path", "modificationTime", "length", "content")]
        made = T.StructType([T.StructField(n, k) for n, k in (("value", T.BinaryType()), (_FILE, T.StringType()), (_START, T.LongType()), (_ORDER, T.LongType()))])
        made = T.StructType([*made, *[whole.schema[n] for n in folders]])
        return whole.select("path", "content", *folders).mapInArrow(_decoded_lines(charset, line_end, len(folders)), made), folders, "utf-8"
    text = reader.option("lineSep", line_end).text(paths)
    place = {_FILE: F.col("_metadata.file_path"), _START: F.col("_metadata.file_block_start"), _ORDER: F.monotonically_increasing_id()}
    return text.withColumns({**place, "value": F.col("value").cast("binary")}), text.columns[1:], charset


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """Rows of a batch that belong to one split of a file: (file, start, from, to)."""
    files, starts, at = batch.column(0).to_pylist(), batch.column(1).to_pylist(), 0
    for i in range(1, batch.num_rows + 1):
        if i == batch.num_rows or (files[i], starts[i]) != (files[at], starts[at]):
            yield files[at], starts[at], at, i
            at = i


def _summaries(scanner, charset: str, skip: int):
    """Per split its number of lines and, for either state at its start, the state at its end and the last line that starts a record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n, first, ends, heads, crlf = None, 0, 0, [False, True], [None, None], False

        def row() -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_()]
            values = [now[0], now[1], n, *ends, *heads, crlf]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=_SUMMARY_NAMES)

        for batch in batches:
            values = batch.column(2)
            for file, start, i, j in _runs(batch):
                if now != (file, start):
                    if now:
                        yield row()
                    now, n, first, ends, heads = (file, start), 0, batch.column(3)[i].as_py(), [False, True], [None, None]
                    crlf = start == 0 and values[i].as_py().decode(charset, "replace").endswith("\r")
                for raw in values.slice(i, j - i).to_pylist():
                    if first + n >= skip:
                        heads = [h if e else n for h, e in zip(heads, ends, strict=True)]
                        line = raw.decode(charset, "replace")
                        ends = [scanner.inside_after(line, e) for e in ends]
                    n += 1
        if now:
            yield row()

    return run


_SUMMARY = f"{_FILE} string, {_START} long, n long, end0 boolean, end1 boolean, head0 long, head1 long, crlf boolean"
_SUMMARY_NAMES = [_FILE, _START, "n", "end0", "end1", "head0", "head1", "crlf"]
_PIECE = f"{_FILE} string, {_LINE} long, part long, whole boolean, {_LEADING} boolean, crlf boolean, value string"
_PIECE_NAMES = [_FILE, _LINE, "part", "whole", _LEADING, "crlf", "value"]
_PIECE_KINDS = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string()]
# Where the columns of partition folders begin in what _pieces gets.
_FOLDERS = 7


def _pieces(scanner, charset: str, skip: int, folders: int):
    """Records and, at the ends of splits, pieces of records; all know the line their record starts at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the split at hand and its folders; the line in the file and whether it begins inside quotes; of the open record its
        # first line, the first line of this piece, whether it begins here and is the file's first, and its lines so far
        now, kept, number, inside, crlf = None, [], 0, False, False
        head, part, here, leading, any_yet, held = None, None, False, None, False, []

        def rows(found: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), _PIECE_KINDS, strict=True)]
            more = [pa.array([v] * len(found), kind) for v, kind in kept]
            return pa.RecordBatch.from_arrays([*columns, *more], names=[*_PIECE_NAMES, *[f"f{k}" for k in range(folders)]])

        for batch in batches:
            values = batch.column(2)
            for file, start, i, j in _runs(batch):
                if now != (file, start):
                    if held:  # the last split ended inside a record
                        yield rows([(now[0], head, part, False, leading, crlf, "\n".join(held))])
                    now, held = (file, start), []
                    inside, number, head, crlf = (batch.column(k)[i].as_py() for k in (3, 4, 5, 6))
                    kept = [(batch.column(_FOLDERS + k)[i].as_py(), batch.schema.field(_FOLDERS + k).type) for k in range(folders)]
                    part, here, leading, any_yet = number, False, None, start > 0
                found = []
                for raw in values.slice(i, j - i).to_pylist():
                    if number >= skip:
                        line = raw.decode(charset, "replace")
                        if not inside:
                            blank = not line.strip()
                            head, part, here, leading = number, number, True, not any_yet and not blank
                            any_yet |= not blank
                        held.append(line)
                        inside = scanner.inside_after(line, inside)
                        if not inside:
                            found.append((file, head, part, here, leading, crlf, "\n".join(held)))
                            held = []
                    number += 1
                if found:
                    yield rows(found)
        if held:
            yield rows([(now[0], head, part, False, leading, crlf, "\n".join(held))])

    return run


def _first_lines(splits: DataFrame) -> DataFrame:
    earlier = Window.partitionBy(_FILE).orderBy(_START).rowsBetween(Window.unboundedPreceding, -1)
    return splits.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def _states(splits: DataFrame) -> DataFrame:
    """Per split: whether it begins inside quotes, the number of its first line, and the line at which an open record began.

    A split keeps the state, swaps it, or sets it; the last one that sets it and the swaps since then decide.
    """
    order = Window.partitionBy(_FILE).orderBy(_START)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    sets, swaps = F.col("end0") == F.col("end1"), (F.col("end0") & ~F.col("end1")).cast("int")
    counted = _first_lines(splits).withColumn("swapped", F.sum(F.when(sets, 0).otherwise(swaps)).over(order))
    decisive = F.last(F.when(sets, F.struct("end0", "swapped")), ignorenulls=True).over(earlier)
    counted = counted.withColumns({"decisive": decisive, "swapped": F.coalesce(F.lag("swapped").over(order), F.lit(0))})
    odd = (F.col("swapped") - F.coalesce("decisive.swapped", F.lit(0))) % 2 == 1
    counted = counted.withColumn("inside", F.coalesce("decisive.end0", F.lit(False)) != odd)
    begun = F.col("first") + F.when(F.col("inside"), F.col("head1")).otherwise(F.col("head0"))
    ends = F.when(F.col("inside"), F.col("end1")).otherwise(F.col("end0"))
    more = {"head": F.last(begun, ignorenulls=True).over(earlier), "open": ends, "crlf": F.max("crlf").over(Window.partitionBy(_FILE))}
    return counted.withColumns(more).select(_FILE, _START, "inside", "first", "head", "open", "crlf")


def _with_states(lines: DataFrame, states: DataFrame, rows: int) -> DataFrame:
    """Lines with the state of their split, in order: a broadcast keeps them, a merge has to sort again."""
    if rows <= BROADCAST_ROWS:
        return lines.join(F.broadcast(states), [_FILE, _START])
    return lines.join(states.hint("merge"), [_FILE, _START]).sortWithinPartitions(_FILE, _START, _ORDER)


def csv_records(
    spark: SparkSession,
    paths: list[str],
    *,
    delimiter: str | list[str] = ",",
    quote: str = '"',
    escape: str = "\\",
    charset: str = "UTF-8",
    line_end: str = "\n",
    skip: int = 0,
    spanning: bool = True,
    base_path: str | None = None,
) -> DataFrame:
    """(value, __file, __line, __leading) and partition folders: every record of the files below their first ``skip`` lines.

    ``__line`` is the number of the record's first line in its file, from 0; ``__leading`` marks a file's first record. Line
    breaks inside quotes stay in the value, as line feeds if the file's first line ends with CR LF; with ``spanning`` False every line is a record. Where the delimiter
    is not known yet, several may be given. A file is read by
    as many tasks as it has splits; only whether records cross splits passes the driver. A record of any length is put
    together from its pieces in the splits. Files in UTF-16 or UTF-32 are decoded whole, by one task each. Bytes that are
    no text in the charset become U+FFFD. Empty files and blank lines have no records; a last line without an end is a line;
    an open quote at the end of a file makes the rest one record.
    """
    scanner = QuoteScanner([delimiter] if isinstance(delimiter, str) else delimiter, quote, escape) if spanning else LineScanner()
    lines, folders, charset = _lines(spark, paths, charset, line_end, base_path)
    places = [_FILE, _START]
    # skipped lines are taken to lie in a file's first split, until the numbers of lines say otherwise
    guess = lines.select(*places, "value", F.when(F.col(_START) == 0, 0).otherwise(skip).cast("long").alias("first"))
    splits, many = materialize(guess.mapInArrow(_summaries(scanner, charset, skip), _SUMMARY), "splits")
    later = splits.where(F.col(_START) > 0).select(_FILE).distinct()
    if skip and not splits.where((F.col(_START) == 0) & (F.col("n") < skip)).join(later, _FILE, "left_semi").isEmpty():
        known = _with_states(lines, _first_lines(splits).select(*places, "first"), many)
        splits, many = materialize(known.select(*places, "value", "first").mapInArrow(_summaries(scanner, charset, skip), _SUMMARY), "splits")
    states, many = materialize(_states(splits), "states")
    crossing, open_end = states.agg(F.max("inside"), F.max("open")).first()
    located = _with_states(lines, states, many).select(*places, "value", "inside", "first", "head", "crlf", *[F.col(f"`{n}`").alias(f"f{k}") for k, n in enumerate(folders)])
    kinds = [f"f{k} {lines.schema[n].dataType.simpleString()}" for k, n in enumerate(folders)]
    made = located.mapInArrow(_pieces(scanner, charset, skip, len(folders)), ", ".join([_PIECE, *kinds]))
    named = [F.col(f"f{k}").alias(n) for k, n in enumerate(folders)]
    found = made.where("whole").select("value", _FILE, _LINE, _LEADING, "crlf", *named)
    if crossing or open_end:
        parts = F.sort_array(F.collect_list(F.struct("part", "value")))
        glued = made.where("NOT whole").groupBy(_FILE, _LINE).agg(
            F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"),
            F.coalesce(F.max(_LEADING), F.lit(False)).alias(_LEADING),
            F.max("crlf").alias("crlf"),
            *[F.first(f"f{k}").alias(n) for k, n in enumerate(folders)],
        )
        found = found.unionByName(glued)
    plain = F.replace(F.regexp_replace("value", "\r$", ""), F.lit("\r\n"), F.lit("\n"))
    return found.withColumn("value", F.when(F.col("crlf"), plain).otherwise(F.col("value"))).where(F.trim("value") != "").drop("crlf")
