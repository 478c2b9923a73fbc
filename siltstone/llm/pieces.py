"""Splitting oversized items at natural boundaries.

Long texts are processed in ranges. A range gives the boundaries (end of paragraph, line, sentence, clause, word) between
its first and its last letter or digit; what lies before and behind belongs together with the neighbours' ends, where
no boundary can be told from one range alone: the stitching step joins these ends, finds their boundaries, and plans the
cuts range by range, carrying where the next piece starts. It holds the boundaries of one piece at a time, and no text
but the stretch without letters and digits at a seam. Pieces are cut by offset out of the ranges. Giant files are read by
Spark's text source in byte ranges that end with a line, and cut the same way (``file_pieces``); short texts take the
same steps where they are.

Null texts yield nothing, empty texts and texts within the limit one piece. Rows with a format that has no limit are
cut at ``default_limit``. Repeated rows are dropped by key. Positions count code points. Limits and overlaps are the
first of their format in numerical order if it is listed more than once.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from siltstone.io import cut
from siltstone.llm.common import map_rows

#: Characters of a range; texts up to this length are planned where they are, which gives the same plan.
RANGE_CHARS = 1 << 18
#: Share of the limit that a piece must fill before a stronger boundary is preferred to a later, weaker one.
LEAST_FILL = 0.5
#: Formats in the table of limits, which is broadcast; more are refused.
MAX_FORMATS = 100_000
# Boundaries from strong to weak; a piece may end behind the match. None of them holds a letter or digit.
BOUNDARIES = (
    re.compile(r"\n[ \t]*\n\s*"),
    re.compile(r"\n"),
    re.compile(r"[.!?…。！？؟।][\"'”’»」』）)\]]*(?:\s+|(?<=[。！？।」』])|$)"),
    re.compile(r"[,;:，；：、،](?:\s+|(?<=[，；：、]))"),
    re.compile(r"\s+|(?<=[぀-ヿ一-鿿])(?=[぀-ヿ一-鿿])"),
)
RUN_HEAD, SOLID = re.compile(r"[^\W_]*"), re.compile(r"[^\W_]")


def boundaries(text: str) -> list[list[int]]:
    """By strength, the positions behind which a piece of ``text`` may end."""
    return [[e for m in pattern.finditer(text) if (e := m.end())] for pattern in BOUNDARIES]


def next_end(start: int, ends: list[list[int]], limit: int, overlap: int) -> int:
    """Where the piece that begins at ``start`` ends, if the text goes on beyond the limit."""
    for least in (start + max(overlap, int(limit * LEAST_FILL)), start + overlap):
        for table in ends:
            k = bisect_right(table, start + limit)
            if k and table[k - 1] > least:
                return table[k - 1]
    return start + limit


def cut_plan(length: int, table: list[list[int]], limit: int, overlap: int) -> list[tuple[int, int]]:
    """Pieces (start, end) of at most ``limit`` characters; each begins ``overlap`` characters before the last one's end."""
    overlap = max(0, min(overlap, limit - 1))
    pieces, start = [], 0
    while length - start > limit:
        end = next_end(start, table, limit, overlap)
        pieces.append((start, end))
        start = end - overlap
    pieces.append((start, length))
    return pieces


def longest_run(text: str, more_than: int) -> bool:
    """Whether ``text`` holds a run of letters and digits longer than ``more_than``."""
    return len(text) > more_than and re.search(r"[^\W_]{%d}" % (more_than + 1), text) is not None


def seams(body: str) -> tuple[int, int]:
    """Of a range, the place of its first letter or digit and that behind its last one; (its length, 0) if it has none."""
    first = SOLID.search(body)
    if not first:
        return len(body), 0
    end = len(body)
    while not body[end - 1].isalnum():
        end -= 1
    return first.start(), end


def tail_run(body: str) -> int:
    """The length of the run of letters and digits at the end of ``body``."""
    n = len(body)
    while n and body[n - 1].isalnum():
        n -= 1
    return len(body) - n


class Planner:
    """Plans one text from its ranges, given in order."""

    def __init__(self, length: int, limit: int, overlap: int):
        self.length, self.limit, self.overlap = length, limit, max(0, min(overlap, limit - 1))
        self.ends: list[list[int]] = [[] for _ in BOUNDARIES]
        self.carry, self.known, self.start, self.number = "", 0, 0, 0
        self.run, self.forced = 0, False

    def add(self, off: int, size: int, lead: str, tail: str, ends: list[list[int]], long: bool, head_run: int, tail_run: int) -> list[tuple[int, int, int]]:
        """The pieces (number, start, end) that are settled once this range is known.

        ``lead`` is the range up to its first letter or digit, this included; ``tail`` begins with the last one.
        """
        self.run += head_run
        self.forced = self.forced or long or self.run > self.limit
        if head_run < size:
            self.run = tail_run
        solid = bool(tail)
        joint, base = self.carry + lead, off - len(self.carry)
        if solid or off + size >= self.length:
            inside = len(joint) - solid
            for mine, found, inner in zip(self.ends, boundaries(joint), ends):
                mine += [base + e for e in found if e <= inside]
                mine += inner
            self.known = off + size - max(0, len(tail) - 1)
            self.carry = tail
            if off + size >= self.length and len(tail) > 1:
                for mine, found in zip(self.ends, boundaries(tail)):
                    mine += [off + size - len(tail) + e for e in found]
            if off + size >= self.length:
                self.known = self.length
        else:
            self.carry = joint
        return self.settle()

    def settle(self) -> list[tuple[int, int, int]]:
        out = []
        while self.length - self.start > self.limit and self.known >= self.start + self.limit:
            end = next_end(self.start, self.ends, self.limit, self.overlap)
            out.append((self.number, self.start, end))
            self.number += 1
            self.start = end - self.overlap
        self.ends = [t[bisect_right(t, self.start) :] for t in self.ends]
        if self.known >= self.length and self.length - self.start <= self.limit:
            out.append((self.number, self.start, self.length))
            self.known = -1
        return out


def ranges_of(docs: DataFrame, key: str, text: str, range_chars: int, beyond: str = "0") -> DataFrame:
    """``key, limit, overlap, length, off, size, body``; ``body`` is the range at ``off`` and ``beyond`` characters more."""
    n = F.char_length(text).cast("bigint")
    offs = F.sequence(F.lit(0).cast("bigint"), F.greatest(n - 1, F.lit(0).cast("bigint")), F.lit(range_chars).cast("bigint"))
    wide = docs.withColumn("length", n).withColumn("off", F.explode(offs))
    size = F.least(F.lit(range_chars), F.col("length") - F.col("off")).cast("int")
    return wide.select(key, "limit", "overlap", "length", "off", size.alias("size"), F.expr(f"substring({text}, cast(off as int) + 1, {range_chars} + {beyond})").alias("body"))


def limited(docs: DataFrame, limits: DataFrame, default_limit: int = 4000, default_overlap: int = 200) -> DataFrame:
    """``docs`` with ``limit`` and ``overlap`` of their format, regardless of case. ``limits`` has a row a format.

    Columns of these names in ``docs`` are replaced. More than ``MAX_FORMATS`` formats raise.
    """
    small = limits.select(F.lower(F.trim("format")).alias("format_key"), F.col("max_chars").alias("limit"), F.col("overlap_chars").alias("overlap"))
    small = small.groupBy("format_key").agg(F.min(F.struct("limit", "overlap")).alias("l")).select("format_key", "l.*")
    if small.count() > MAX_FORMATS:
        raise ValueError(f"more than {MAX_FORMATS} formats")
    joined = docs.drop("limit", "overlap").withColumn("format_key", F.lower(F.trim("format"))).join(F.broadcast(small), "format_key", "left").drop("format_key")
    return joined.fillna({"limit": default_limit, "overlap": default_overlap})


def plans(docs: DataFrame, key: str = "doc_id", text: str = "content", range_chars: int = RANGE_CHARS, with_text: bool = False) -> DataFrame:
    """The cut plan of every text: ``key, length, limit, piece_no, start_pos, end_pos, forced`` (and ``piece``), a row a piece.

    ``docs`` has ``limit`` and ``overlap``. ``forced`` is null but on the last piece of a text, where it tells whether an
    unbroken run is longer than the limit.
    """
    docs = docs.select(key, text, "limit", "overlap").where(F.col(text).isNotNull())
    columns = f"{_plan_schema(dict(docs.dtypes)[key], key)}{', piece string' if with_text else ''}"

    def make_whole():
        def f(batch):
            out = [[] for _ in range(8 if with_text else 7)]
            for k, t, limit, overlap in zip(*(c.to_pylist() for c in batch.columns)):
                plan = cut_plan(len(t), boundaries(t), limit, overlap) if len(t) > limit else [(0, len(t))]
                for i, (a, b) in enumerate(plan):
                    for column, value in zip(out, (k, len(t), limit, i, a, b, longest_run(t, limit) if i == len(plan) - 1 else None, t[a:b] if with_text else None)):
                        column.append(value)
            return out

        return f

    whole = map_rows(docs.where(F.char_length(text) <= range_chars), make_whole, columns)
    giant = docs.where(F.char_length(text) > range_chars)
    spans = stitched(ranges_of(giant, key, text, range_chars).repartition(key, "off"), key)
    if with_text:
        # Each piece lies in the range in which it starts, with the longest piece beyond it.
        parts = ranges_of(giant, key, text, range_chars, "`limit`").select(key, "off", "body").dropDuplicates([key, "off"])
        spans = spans.withColumn("off", F.col("start_pos") - F.col("start_pos") % range_chars).join(parts, [key, "off"])
        spans = spans.withColumn("piece", F.expr("substring(body, cast(start_pos - off as int) + 1, cast(end_pos - start_pos as int))")).drop("off", "body").select(*whole.columns)
    return whole.union(spans)


def _plan_schema(kind: str, key: str) -> str:
    return f"{key} {kind}, length bigint, `limit` int, piece_no bigint, start_pos bigint, end_pos bigint, forced boolean"


def stitched(parts: DataFrame, key: str) -> DataFrame:
    """Cut plans from ranges: ``key, limit, overlap, length, off, size, body``. Ranges delivered twice count once.

    Each range gives its boundaries, the runs at its edges and its seams; these tables are read in order by one task a
    text, which keeps those of one piece.
    """
    kind = dict(parts.dtypes)[key]

    def make_table():
        def f(batch):
            out = [[] for _ in range(12)]
            for k, limit, overlap, length, off, size, body in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = seams(body)
                ends = [[off + a + e for e in found] for found in boundaries(body[a:b])] if b else [[] for _ in BOUNDARIES]
                lead, tail = body[: a + 1], body[b - 1 :] if b else ""
                head, end_run = RUN_HEAD.match(body).end(), tail_run(body)
                for column, value in zip(out, (k, limit, overlap, length, off, size, lead, tail, ends, longest_run(body, limit), head, end_run)):
                    column.append(value)
            return out

        return f

    schema = f"{key} {kind}, `limit` int, overlap int, length bigint, off bigint, size int, lead string, tail string, ends array<array<bigint>>, long boolean, head int, end_run int"
    tables = map_rows(parts.select(key, "limit", "overlap", "length", "off", "size", "body"), make_table, schema)
    arrow = to_arrow_schema(T._parse_datatype_string(_plan_schema(kind, key)))

    def plan(batches):
        now = planner = last = None
        for batch in batches:
            out: list[list] = [[] for _ in arrow]
            for k, limit, overlap, length, off, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                if k != now:
                    now, planner, last = k, Planner(length, limit, overlap), -1
                if off <= last:
                    continue
                last = off
                for number, a, b in planner.add(off, *rest):
                    for column, value in zip(out, (k, length, limit, number, a, b, planner.forced if b == length else None)):
                        column.append(value)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, field.type) for c, field in zip(out, arrow)], schema=arrow)

    return tables.repartition(key).sortWithinPartitions(key, "off").mapInArrow(plan, _plan_schema(kind, key))


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "content", range_chars: int = RANGE_CHARS) -> DataFrame:
    """``key, piece_no, start_pos, end_pos, piece`` of every text of ``docs`` (with ``limit`` and ``overlap``)."""
    return plans(docs, key, text, range_chars, with_text=True).dropDuplicates([key, "piece_no"]).select(key, "piece_no", "start_pos", "end_pos", "piece")


def cut_kinds(docs: DataFrame, key: str = "doc_id", text: str = "content") -> DataFrame:
    """``key, cut`` of the texts over their limit: ``forced`` or ``natural``."""
    ends = plans(docs.where(F.char_length(text) > F.col("limit")), key, text).where("forced is not null and length > `limit`")
    return ends.select(key, F.when(F.col("forced"), "forced").otherwise("natural").alias("cut")).distinct()


def file_ranges(spark: SparkSession, path: str, range_chars: int = RANGE_CHARS) -> DataFrame:
    """``path, block, no, chars, body``: the UTF-8 files at ``path`` in ranges, in order of ``block`` and ``no``.

    Spark's text source reads each block (``spark.sql.files.maxPartitionBytes``) in a task of its own, up to the end of its
    last line; lines are put together to ranges of ``range_chars`` characters or, if a line is longer, that line. A line
    must fit in a task's memory.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select("_metadata.file_path", "_metadata.file_block_start", "_metadata.file_size", "value")
    schema = "path string, block bigint, no int, chars bigint, bytes bigint, file_size bigint, body string"
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def ranges(batches):
        held: list[str] = []
        now, size, number = None, 0, 0

        def flush():
            nonlocal held, size, number
            body = "".join(held)
            row = (*now[:2], number, len(body), len(body.encode()), now[2], body)
            held, size, number = [], 0, number + 1
            return pa.RecordBatch.from_arrays([pa.array([x], field.type) for x, field in zip(row, arrow)], schema=arrow)

        for batch in batches:
            for f, block, total, line in zip(*(c.to_pylist() for c in batch.columns)):
                if now != (f, block, total):
                    if held:
                        yield flush()
                    now, number = (f, block, total), 0
                held.append(line + "\n")
                size += len(line) + 1
                if size >= range_chars:
                    yield flush()
        if held:
            yield flush()

    found = cut(lines.mapInArrow(ranges, schema), "ranges")
    # The source doesn't tell whether the last line has a line break: the size of the file does.
    sums = found.groupBy("path").agg((F.sum("bytes") > F.first("file_size")).alias("open"), F.max(F.struct("block", "no")).alias("last"))
    marked = found.join(sums, "path").withColumn("extra", (F.col("open") & (F.struct("block", "no") == F.col("last"))).cast("int"))
    return marked.select("path", "block", "no", (F.col("chars") - F.col("extra")).alias("chars"), F.expr("left(body, cast(chars - extra as int))").alias("body")).where("chars > 0")


def file_pieces(spark: SparkSession, path: str, limit: int, overlap: int, range_chars: int = RANGE_CHARS) -> DataFrame:
    """``path, piece_no, start_pos, end_pos, piece`` of the giant UTF-8 files at ``path``; positions in characters.

    Character offsets are prefix sums of the lengths of ranges, first by block. No file is in one place; its boundary
    tables pass one task, in order. ``limit`` must not exceed ``range_chars``.
    """
    if limit > range_chars:
        raise ValueError("ranges must be as long as the limit")
    ranges = file_ranges(spark, path, range_chars)
    blocks = ranges.groupBy("path", "block").agg(F.sum("chars").alias("n"))
    w = Window.partitionBy("path").orderBy("block")
    blocks = blocks.select("path", "block", (F.sum("n").over(w) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy("path")).alias("length"))
    inner = Window.partitionBy("path", "block").orderBy("no")
    placed = ranges.join(blocks, ["path", "block"]).withColumn("off", F.col("before") + F.sum("chars").over(inner) - F.col("chars"))
    placed = cut(placed.select("path", F.lit(limit).alias("limit"), F.lit(overlap).alias("overlap"), "length", "off", F.col("chars").cast("int").alias("size"), "body"), "placed")
    spans = stitched(placed.repartition("path", "off"), "path")
    # A piece may reach into the ranges behind: each range gives its part, parts are joined in order.
    cell = lambda c: F.floor(F.col(c) / range_chars)
    cells = F.explode(F.sequence(cell("off"), F.floor((F.col("off") + F.col("size") - 1) / range_chars)))
    of_span = spans.select("path", "piece_no", "start_pos", "end_pos", F.explode(F.sequence(cell("start_pos"), F.floor((F.greatest("end_pos", F.col("start_pos") + 1) - 1) / range_chars))).alias("cell"))
    of_range = placed.select("path", "off", "size", "body", cells.alias("cell"))
    met = of_span.join(of_range, ["path", "cell"]).where("start_pos < off + size and end_pos > off")
    part = F.expr("substring(body, cast(greatest(start_pos - off, 0) as int) + 1, cast(least(end_pos, off + size) - greatest(start_pos, off) as int))")
    # The parts are taken out before anything is shuffled, so no range travels with its pieces.
    met = met.select("path", "piece_no", "start_pos", "end_pos", "off", part.alias("t")).dropDuplicates(["path", "piece_no", "off"])
    joined = met.select("path", "piece_no", "start_pos", "end_pos", F.struct("off", "t").alias("x")).groupBy("path", "piece_no", "start_pos", "end_pos").agg(F.array_sort(F.collect_list("x")).alias("x"))
    return joined.select("path", "piece_no", "start_pos", "end_pos", F.array_join(F.transform("x", lambda x: x["t"]), "").alias("piece"))
