"""Matrix files whose first two rows are the header: stations, then what is measured.

A station's name stands over its first column only and is carried over the blank cells after it.
Every file has its own columns. Rows become cells by position, so no column needs a name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airloom.session import lookup_table, materialize


def _cells(line: Column, delimiter: str) -> Column:
    """The cells of a line; a delimiter within quotes does not count."""
    plain = F.split(line, f"[{delimiter}]", -1)
    # Text between quotes is every second piece; there the delimiter is put aside.
    pieces = F.transform(
        F.split(line, '"', -1),
        lambda x, i: F.when(i % 2 == 1, F.translate(x, delimiter, "\u0001")).otherwise(x),
    )
    quoted = F.transform(
        F.split(F.array_join(pieces, ""), f"[{delimiter}]", -1), lambda x: F.translate(x, "\u0001", delimiter)
    )
    return F.when(line.contains('"'), quoted).otherwise(plain)


def _carried(cells: str) -> Column:
    """What stands over which columns: an array of a name, the first and the last place that it
    holds for. Blank cells take the last one before them that is not; those before all have none."""
    last = F.size(cells) - 1
    return F.transform(
        "__named",
        lambda at, i: F.struct(
            F.get(cells, at).alias("station"), at.alias("from"), (F.coalesce(F.get("__named", i + 1), last + 1) - 1).alias("to")
        ),
    )


def read_two_row_matrices(spark: SparkSession, folder: str, delimiter: str = ",") -> DataFrame:
    """Rows (path, station, variable, date, value) of every csv file below a folder, as text;
    blank values are null. A column without a station or variable is left out.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    lines = reader.text(folder).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.regexp_replace("value", "^\ufeff|\r$", "").alias("value"),
    )
    # Lines of a file's first block are numbered in order. Of each file two are wanted, and tasks
    # keep no more before the shuffle.
    numbered = lines.where("block = 0").withColumn("line", F.monotonically_increasing_id())
    nth = F.row_number().over(Window.partitionBy("path").orderBy("line"))
    heads = numbered.withColumn("nth", nth).where("nth <= 2").select("path", "nth", "value")
    headers = lookup_table(heads, "headers")
    cells = F.transform(_cells(F.col("value"), delimiter), lambda x: F.trim(x))
    # Split and searched once a line, before other columns look places up in the arrays.
    split = materialize(headers.select("path", "nth", cells.alias("cells")), "header-cells")
    named = F.filter(F.transform("cells", lambda x, i: F.when(x != "", i)), lambda i: i.isNotNull())
    named = materialize(split.where("nth = 1").select("path", "cells", named.alias("__named")), "header-names")
    spans = named.select("path", F.inline(_carried("cells")))
    top = spans.select("path", "station", F.explode(F.sequence("from", "to")).alias("at"))
    below = split.where("nth = 2").select("path", F.posexplode("cells").alias("at", "variable"))
    columns = top.join(below, ["path", "at"]).where("at > 0 and station <> '' and variable <> ''")
    columns = lookup_table(columns, "matrix-columns")
    # A line that repeats one of the two, as joined exports do, is no data either.
    body = lines.where("value <> ''").join(headers, ["path", "value"], "left_anti")
    split = body.select("path", _cells(F.col("value"), delimiter).alias("cells"))
    date = F.trim(F.get("cells", F.lit(0))).alias("date")
    every = split.select("path", date, F.posexplode("cells").alias("at", "cell"))
    value = F.nullif(F.trim("cell"), F.lit(""))
    return every.join(columns, ["path", "at"]).select("path", "station", "variable", "date", value.alias("value"))


def write_two_row_matrices(df: DataFrame, folder: str, file: str) -> None:
    """Rows (station, variable, date, value) as such files, one per value of column ``file``.

    Columns are those that the file's rows have, by station and variable.
    """
    rows = materialize(df.select(file, "station", "variable", F.col("date").cast("string").alias("date"), "value"), "cells")
    named = F.struct(F.col("station").cast("string").alias("station"), "variable")
    columns = rows.groupBy(file).agg(F.array_sort(F.collect_set(named)).alias("columns"))
    stations = F.transform(
        "columns",
        lambda c, i: F.when((i > 0) & (F.get("columns", i - 1)["station"] == c["station"]), "").otherwise(c["station"]),
    )
    heads = columns.select(
        file,
        F.explode(F.array(
            F.struct(F.lit(0).alias("order"), F.concat_ws(",", F.lit(""), stations).alias("value")),
            F.struct(F.lit(1).alias("order"), F.concat_ws(",", F.lit("date"), F.transform("columns", lambda c: c["variable"])).alias("value")),
        )).alias("h"),
    )
    # Cells find their columns by a join; a line is its filled cells and the commas between them.
    key = F.concat_ws("|", F.col("station").cast("string"), "variable").alias("__key")
    places = columns.select(file, F.posexplode("columns").alias("at", "c")).select(
        file, "at", F.concat_ws("|", F.col("c.station"), F.col("c.variable")).alias("__key")
    )
    text = F.coalesce(F.col("value").cast("string"), F.lit("")).alias("text")
    placed = rows.select(file, "date", key, text).join(lookup_table(places, "matrix-places"), [file, "__key"])
    by_date = placed.groupBy(file, "date").agg(F.sort_array(F.collect_list(F.struct("at", "text"))).alias("found"))
    sizes = columns.select(file, F.size("columns").alias("size"))
    by_date = materialize(by_date.join(sizes, file), "matrix-lines")

    def cell(one: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get("found", i - 1)["at"]).otherwise(0)
        twice = F.raise_error(F.concat(F.lit("two values for column "), one["at"].cast("string"), F.lit(" of one line")))
        return F.when((i > 0) & (before == one["at"]), twice).otherwise(F.concat(F.repeat(F.lit(","), one["at"] - before), one["text"]))

    filled = F.array_join(F.transform("found", cell), "")
    rest = F.repeat(F.lit(","), F.col("size") - 1 - F.element_at("found", -1)["at"])
    body = by_date.select(
        file, F.lit(1).alias("order"), F.col("date").alias("by"), F.concat_ws(",", "date", F.concat(filled, rest)).alias("value")
    )
    lines = heads.select(file, "h.order", F.lit(None).cast("string").alias("by"), "h.value").unionByName(body)
    ordered = lines.repartition(file).sortWithinPartitions(file, "order", F.asc_nulls_first("by"))
    written = ordered.select(file, "value").write.mode("overwrite").partitionBy(file)
    written.option("compression", "none").format("csv").option("quote", "").option("delimiter", "\u0001").save(folder)
