"""Column profiles and shapes of tabular and JSON data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row for each column: name, nonempty_count, missing_count, distinct_count, and for numbers numeric_count, min, max, mean.

    Null and empty strings are missing; booleans count as numbers 0 and 1; NaN and infinities count as values, not as numbers.
    Counts without DISTINCT come from one pass; distinct values from one shuffle of (column, value) pairs.
    """
    columns = columns or df.columns
    kinds = dict(df.dtypes)
    number = lambda c: kinds[c] in ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean") or kinds[c].startswith("decimal")

    def part(c: str) -> Column:
        v = F.col(f"`{c}`")
        n = v.cast("double") if number(c) else F.lit(None).cast("double")
        return F.struct(F.lit(c).alias("name"), v.cast("string").alias("v"), F.when(~F.isnan(n) & (F.abs(n) != float("inf")), n).alias("n"))

    long = df.select(F.explode(F.array(*map(part, columns))).alias("x")).select("x.*").withColumn("v", F.nullif("v", F.lit("")))
    values = long.groupBy("name", "v").agg(F.count(F.lit(1)).alias("k"), F.count("n").alias("kn"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.sum("n").alias("s"))
    return values.groupBy("name").agg(
        F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("k"))), F.lit(0)).alias("nonempty_count"), F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("k"))), F.lit(0)).alias("missing_count"), F.count("v").alias("distinct_count"),
        F.sum("kn").alias("numeric_count"), F.min("lo").alias("min"), F.max("hi").alias("max"), (F.sum("s") / F.sum("kn")).alias("mean"),
    )


def sample_values(df: DataFrame, order: str, columns: list[str], most: int = 8) -> DataFrame:
    """The first nonempty values of each column by order."""
    long = df.select(F.col(order).alias("o"), F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns))).alias("x")).select("o", "x.*")
    kept = long.filter(F.coalesce("v", F.lit("")) != "").withColumn("part", F.spark_partition_id())
    for by in (("name", "part"), ("name",)):  # first within partitions, so that no list gathers a column
        w = Window.partitionBy(*by).orderBy("o", "v")
        kept = kept.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= most).drop("rn")
    return kept.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("o", "v"))).alias("s")).select("name", F.transform("s", lambda x: x["v"]).alias("sample_values"))


def infer_scalar(text: Column) -> Column:
    """struct<kind, number, text> of a cell: null, bool, int, float (finite) or string. Underscores between digits are part of whole
    numbers; "1d" and the like are strings."""
    t = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    whole = F.regexp_like(t, F.lit(r"^[+-]?\d+(?:_\d+)*$"))
    real = F.regexp_like(t, F.lit(r"^[+-]?(?:\d+(?:_\d+)*\.?(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)(?:[eE][+-]?\d+(?:_\d+)*)?$"))
    n = F.replace(t, F.lit("_"), F.lit("")).try_cast("double")
    truth = F.lower(t).isin("true", "false")
    kind = F.when(t.isNull() | (t == ""), "null").when(truth, "bool").when(whole, "int").when(real & (F.abs(n) < float("inf")), "float").otherwise("string")
    return F.struct(kind.alias("kind"), F.when(whole | (real & (F.abs(n) < float("inf"))), n).when(truth, (F.lower(t) == "true").cast("double")).alias("number"), t.alias("text"))


def text_profile(text: Column, head_lines: int = 120, head_chars: int = 12000) -> Column:
    """struct<line_count, text_chars, head> of code or text."""
    from quarrylight.functions import text as X

    t = F.coalesce(text, F.lit(""))
    lines = F.split(F.regexp_replace(t, "(?:" + X.LINE_BREAK + ")$", ""), X.LINE_BREAK, -1)
    return F.struct(F.when(t == "", 0).otherwise(F.size(lines)).alias("line_count"), F.length(t).alias("text_chars"), F.left(X.clean(F.array_join(F.slice(lines, 1, head_lines), "\n")), F.lit(head_chars)).alias("head"))


def table_shapes(cells: DataFrame) -> DataFrame:
    """cells: source_id, table_ord, table, row_no (0: header), cells. source_id, table_ord, table, row_count, column_count, and
    malformed_row_count (rows that don't have as many cells as the header)."""
    n = F.max(F.when(F.col("row_no") == 0, F.size("cells")))
    widths = cells.filter("row_no >= 0").groupBy("source_id", "table_ord", "table", F.size("cells").alias("w")).agg(F.count_if(F.col("row_no") > 0).alias("rows"), n.alias("head"))
    own = widths.groupBy("source_id", "table_ord", "table").agg(F.sum("rows").alias("row_count"), F.coalesce(F.max("head"), F.lit(0)).alias("column_count"), F.collect_list(F.struct("w", "rows")).alias("by"))
    odd = F.aggregate(F.filter("by", lambda x: x["w"] != F.col("column_count")), F.lit(0).cast("bigint"), lambda t, x: t + x["rows"])
    return own.select("source_id", "table_ord", "table", "row_count", "column_count", odd.alias("malformed_row_count"))


def table_columns(cells: DataFrame, samples: int = 8) -> DataFrame:
    """One row for each column of each table: source_id, table_ord, column_no, name, nonempty_count, missing_count, distinct_count, numeric_count,
    min, max, mean, sample_values (the first nonempty ones). Cells are read by infer_scalar(); cells that a row lacks are missing."""
    by = ["source_id", "table_ord", "column_no"]
    heads = cells.filter("row_no = 0").select("source_id", "table_ord", F.col("cells").alias("names"))
    rows = cells.filter("row_no > 0").select("source_id", "table_ord", "row_no", "cells").join(heads, ["source_id", "table_ord"])
    each = rows.select("source_id", "table_ord", "row_no", F.posexplode(F.transform("names", lambda n, i: F.get("cells", i))).alias("column_no", "raw")).withColumn("v", infer_scalar(F.col("raw")))
    v = F.col("v")
    full = v["kind"] != "null"
    value = F.when(full, F.concat_ws(":", v["kind"], F.coalesce(F.when(v["kind"] != "string", v["number"].cast("string")), v["text"])))
    counts = each.groupBy(*by, value.alias("value")).agg(F.count(F.lit(1)).alias("k"), F.count(v["number"]).alias("kn"), F.min(v["number"]).alias("lo"), F.max(v["number"]).alias("hi"), F.sum(v["number"]).alias("s"))
    stats = counts.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("k"))), F.lit(0)).alias("nonempty_count"), F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("k"))), F.lit(0)).alias("missing_count"),
        F.count("value").alias("distinct_count"), F.sum("kn").alias("numeric_count"), F.min("lo").alias("min"), F.max("hi").alias("max"), (F.sum("s") / F.nullif(F.sum("kn"), F.lit(0))).alias("mean"),
    )
    first = Window.partitionBy(*by).orderBy("row_no")
    some = each.filter(full).withColumn("rn", F.row_number().over(first)).filter(F.col("rn") <= samples)
    shown = some.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("rn", v["text"].alias("t")))), lambda x: x["t"]).alias("sample_values"))
    named = heads.select("source_id", "table_ord", F.posexplode("names").alias("column_no", "name"))
    out = named.join(stats, by, "left").join(shown, by, "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("nonempty_count", "missing_count", "distinct_count", "numeric_count")}
    return out.withColumns({**zero, "sample_values": F.coalesce("sample_values", F.array().cast("array<string>"))}).select(*by, "name", *zero, "min", "max", "mean", "sample_values")
