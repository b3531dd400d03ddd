"""Tables from word boxes: where words stand on a page tells lines, cells, tables and columns. Everything is gaps and islands over
edges, by windows within a page, so whatever finds the words (a PDF library, recognition of scans) is apart from this."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A gap between words that parts cells, in heights of the word before it, and how far lines may overlap, in heights.
CELL_GAP, OVERLAP = 1.0, 0.3


def islands(rows: DataFrame, group: list[str], low: Column, high: Column, name: str, order: list[str], gap: Column | float = 0.0) -> DataFrame:
    """Numbers stretches of intervals within a group, from 1: one begins where an interval starts more than gap behind all before it."""
    by = Window.partitionBy(*group).orderBy(low, *order)
    reach = F.max(high).over(by.rowsBetween(Window.unboundedPreceding, -1))
    begins = reach.isNull() | (low > reach + gap)
    flagged = rows.withColumn("_begins", begins.cast("int"))
    return flagged.withColumn(name, F.sum("_begins").over(by.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_begins")


def cells(words: DataFrame, page: list[str], cell_gap: float = CELL_GAP) -> DataFrame:
    """words: the page's columns, x0, x1, y0 (top), y1, text. A row for each cell: line (from 1, top to bottom), cell (from 1, left to
    right), its edges and text. Words whose box is empty or unknown are left out."""
    known = words.filter("x1 > x0 and y1 > y0 and text is not null").select(*page, *(F.col(c).cast("double").alias(c) for c in ("x0", "x1", "y0", "y1")), "text")
    height = F.col("y1") - F.col("y0")
    slack = known.withColumn("_h", height)
    lines = islands(slack, page, F.col("y0") + OVERLAP * F.col("_h"), F.col("y1"), "line", ["x0", "text"])
    by = Window.partitionBy(*page, "line").orderBy("x0", "x1", "text")
    reach = F.max("x1").over(by.rowsBetween(Window.unboundedPreceding, -1))
    wide = F.lag("_h").over(by) * cell_gap
    parted = lines.withColumn("_new", (reach.isNull() | (F.col("x0") - reach > wide)).cast("int")).withColumn("cell", F.sum("_new").over(by).cast("int"))
    words_of = F.array_sort(F.collect_list(F.struct("x0", "x1", "text")))  # the words of one cell
    joined = parted.groupBy(*page, "line", "cell").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1"), words_of.alias("_words"))
    return joined.withColumn("text", F.array_join(F.transform("_words", lambda w: w["text"]), " ")).drop("_words")


def tables(words: DataFrame, page: list[str], least_rows: int = 2, cell_gap: float = CELL_GAP) -> DataFrame:
    """A row for each line of a table: the page's columns, table and row (from 1), cells (texts by column, empty where a line has none).

    A table is a run of lines with several cells each; its columns are the stretches that its cells cover on the page from left to
    right. Cells of a line that fall into one column are joined."""
    found = cells(words, page, cell_gap)
    several = found.withColumn("_n", F.count("*").over(Window.partitionBy(*page, "line"))).filter("_n > 1")
    lines = several.select(*page, "line").distinct()
    run = F.col("line") - F.row_number().over(Window.partitionBy(*page).orderBy("line"))
    runs = lines.withColumn("_run", run)
    size = F.count("*").over(Window.partitionBy(*page, "_run"))
    kept = runs.withColumn("_size", size).filter(F.col("_size") >= least_rows)
    placed = kept.withColumn("table", F.dense_rank().over(Window.partitionBy(*page).orderBy("_run")).cast("int")).withColumn("row", F.row_number().over(Window.partitionBy(*page, "_run").orderBy("line")).cast("int"))
    body = several.join(placed.select(*page, "line", "table", "row"), [*page, "line"])
    columns = islands(body, [*page, "table"], F.col("x0"), F.col("x1"), "column", ["line", "cell"])
    wide = columns.withColumn("_columns", F.max("column").over(Window.partitionBy(*page, "table")))
    texts = F.collect_list(F.struct("column", "cell", "text"))  # the cells of one line
    of = lambda k: F.array_join(F.transform(F.filter("_cells", lambda c: c["column"] == k), lambda c: c["text"]), " ")
    rows = wide.groupBy(*page, "table", "row").agg(F.first("_columns").alias("_columns"), F.array_sort(texts).alias("_cells"))
    return rows.select(*page, "table", "row", F.transform(F.sequence(F.lit(1), F.col("_columns")), of).alias("cells"))


def markdown_tables(rows: DataFrame, page: list[str]) -> DataFrame:
    """Tables as markdown, the first row as head: the page's columns, table, markdown."""
    escaped = F.transform("cells", lambda c: F.replace(c, F.lit("|"), F.lit("\\|")))
    line = F.concat(F.lit("| "), F.array_join(escaped, " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), F.size("cells")))
    lines = rows.withColumn("_line", F.when(F.col("row") == 1, F.concat(line, F.lit("\n"), rule)).otherwise(line))
    every = F.array_sort(F.collect_list(F.struct("row", "_line")))  # the lines of one table on one page
    return lines.groupBy(*page, "table").agg(every.alias("_lines")).select(*page, "table", F.array_join(F.transform("_lines", lambda x: x["_line"]), "\n").alias("markdown"))


#: How much larger than the body a heading is at least, and the steps above it where no size is.
ABOVE, STEPS = 0.5, (6.0, 3.0, 1.0)


def heading_sizes(lines: DataFrame, document: list[str], size: str = "size", weight: str = "weight") -> DataFrame:
    """Per document: the body's size, which most text has (of equal ones the smallest), and the three largest sizes above it, which are
    the headings'. Sizes are summed up first, so a document of any length comes down to its few sizes."""
    sums = lines.groupBy(*document, F.col(size).cast("double").alias("_size")).agg(F.sum(weight).alias("_weight"))
    per = sums.groupBy(*document).agg(F.max_by("_size", F.struct("_weight", -F.col("_size"))).alias("body"), F.sort_array(F.collect_list("_size"), asc=False).alias("_sizes"))
    larger = F.slice(F.filter("_sizes", lambda s: s > F.col("body") + ABOVE), 1, 3)
    return per.select(*document, "body", F.when(F.size(larger) > 0, larger).otherwise(F.array(*(F.col("body") + s for s in STEPS))).alias("headings"))
