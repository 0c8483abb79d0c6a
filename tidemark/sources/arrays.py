"""Records of JSON arrays in files of any size: no row and no task holds a whole file.

Spark reads the text between closing braces as rows, in splits of a file. Whether a piece starts inside a
string, and how deep it lies, depends on all that comes before it. Both are running sums: quotes switch
between inside and outside, and braces and brackets count where they are outside. A split sums up for
either way it may start, the splits of a file are chained, and then every piece knows its depth. A record
ends where a brace closes to the depth of the array. Pieces of a record are put together and parsed;
values that are no objects are parsed with the record that follows them, or with the end of the array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numbering import running_total
from ..functions.variants import get
from ..session import scratch_folder

_STRING = r'"[^"]*("|\z)'
_SPACE = r"[ \t\r\n]"


def _stored(rows: DataFrame) -> DataFrame:
    path = scratch_folder(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _depth(outside: Column) -> Column:
    """How much deeper the text leads, by what is outside of strings."""
    return F.length(F.translate(outside, "]", "")) - F.length(F.translate(outside, "{[", ""))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Texts before each closing brace, with their place, and what they do to quotes and depth."""
    rows = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), F.col("value").alias("text"),
        # A character behind a backslash has no meaning of its own.
        F.regexp_replace("value", r"(?s)\\.", "").alias("bare"),
    )
    quotes = F.length("bare") - F.length(F.replace("bare", F.lit('"'), F.lit("")))
    rows = rows.withColumn("switch", F.pmod(quotes, F.lit(2)))
    inside_first = F.regexp_replace("bare", r'\A[^"]*("|\z)', "")
    # The brace that ends the piece closes if it is outside of a string.
    return rows.select(
        "file", "block", "place", "text", "switch",
        (_depth(F.regexp_replace("bare", _STRING, "")) - F.when(F.col("switch") == 0, 1).otherwise(0)).alias("outside"),
        (_depth(F.regexp_replace(inside_first, _STRING, "")) - F.when(F.col("switch") == 1, 1).otherwise(0)).alias("inside"),
    )


def _chained(splits: DataFrame, *values: str) -> DataFrame:
    """Sums over the earlier splits of each file."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return splits.withColumns({f"{value}_before": F.coalesce(F.sum(value).over(before), F.lit(0)) for value in values})


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """Pieces with the number of their record in the file, and whether they end it."""
    order = Window.partitionBy("file", "block").orderBy("place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    pieces = _pieces(spark, path)
    pieces = pieces.withColumn("switched", F.pmod(F.coalesce(F.sum("switch").over(before), F.lit(0)), F.lit(2)))
    # Steps of a split that starts outside of a string, and of one that starts inside.
    steps = {
        "one": F.when(F.col("switched") == 0, F.col("outside")).otherwise(F.col("inside")),
        "other": F.when(F.col("switched") == 0, F.col("inside")).otherwise(F.col("outside")),
    }
    pieces = pieces.withColumns(steps).withColumns({
        "one_depth": F.sum("one").over(upto), "other_depth": F.sum("other").over(upto),
    })
    pieces = _stored(pieces.drop("outside", "inside"))
    splits = pieces.groupBy("file", "block").agg(*[F.sum(name).alias(name) for name in ("switch", "one", "other")])
    splits = _chained(splits, "switch").withColumn("starts_inside", F.pmod("switch_before", F.lit(2)))
    splits = splits.withColumn("step", F.when(F.col("starts_inside") == 0, F.col("one")).otherwise(F.col("other")))
    starts = _chained(splits, "step").select("file", "block", "starts_inside", F.col("step_before").alias("start_depth"))
    placed = pieces.join(starts, ["file", "block"])
    depth = F.col("start_depth") + F.when(F.col("starts_inside") == 0, F.col("one_depth")).otherwise(F.col("other_depth"))
    ends_outside = F.pmod(F.col("starts_inside") + F.col("switched") + F.col("switch"), F.lit(2)) == 0
    placed = placed.select("file", "block", "place", "text", (ends_outside & (depth == 1)).alias("ends"))
    placed = _stored(placed.withColumn("ended", F.coalesce(F.sum(F.col("ends").cast("int")).over(before), F.lit(0))))
    counts = placed.groupBy("file", "block").agg(F.sum(F.col("ends").cast("int")).alias("ends_here"))
    counts = _chained(counts, "ends_here").select("file", "block", "ends_here_before")
    return placed.join(counts, ["file", "block"]).withColumn("number", F.col("ends_here_before") + F.col("ended"))


def scan_arrays(spark: SparkSession, path: str) -> DataFrame:
    """Records of JSON files that are arrays each: file, root_index (position in the array), rec.

    An empty array has none. A file that is no array, or whose records do not follow each other with
    commas, fails. Values other than objects are records too; many of them in a row without an object are
    parsed as one.
    """
    pieces = _numbered(spark, path)
    unclosed = pieces.groupBy("file").agg(F.max_by("ends", F.struct("block", "place")).alias("ends")).where("ends")
    if not unclosed.isEmpty():
        raise ValueError(f"an array is not closed: {unclosed.first()['file']}")
    part = F.struct("block", "place", "text", "ends")
    texts = pieces.groupBy("file", "number").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    ends = F.element_at("parts", -1)["ends"]
    whole = F.array_join(F.transform("parts", lambda piece: piece["text"]), "}")
    texts = texts.select("file", "number", F.when(ends, F.concat(whole, F.lit("}"))).otherwise(whole).alias("text"), ends.alias("ends"))
    # The array opens before its first record, commas stand before the others, and it closes at the end.
    opens = F.when(F.col("number") == 0, r"\[").otherwise(",")
    wrong = F.raise_error(F.concat(F.lit("not an array of records: "), F.col("file"), F.lit(", at record "), F.col("number").cast("string")))
    last = F.col("text").rlike(_SPACE + r"*\]" + _SPACE + r"*\z")
    text = F.when(F.col("ends"), F.col("text")).when(last, F.regexp_replace("text", r"\]" + _SPACE + r"*\z", "")).otherwise(wrong)
    texts = texts.withColumn("text", text)
    closing = ~F.col("ends") & (F.col("number") > 0) & F.col("text").rlike(rf"\A{_SPACE}*\z")
    fits = F.regexp_like("text", F.concat(F.lit(rf"\A{_SPACE}*"), opens))
    bare = F.regexp_replace("text", F.lit(rf"\A{_SPACE}*[\[,]"), F.lit(""))
    blank = rf"\A{_SPACE}*\z"
    trailing = (F.col("number") > 0) & bare.rlike(blank)
    texts = texts.where(~closing).withColumn("bare", F.when(fits & ~trailing, bare).otherwise(wrong))
    lists = texts.where(~F.col("bare").rlike(blank)).select(
        "file", "number", F.parse_json(F.concat(F.lit("["), F.col("bare"), F.lit("]"))).alias("list")
    )
    lists = _stored(lists.withColumn("size", F.size(get(F.col("list"), (), "array<variant>")).cast("bigint")))
    first = F.col("number")
    if lists.where("size > 1").limit(1).count():
        # Other values lie between the objects, so numbers of texts are not positions.
        sizes = running_total(lists.select("file", "number", "size"), ["file"], "number", "size", "first")
        lists, first = lists.join(sizes.select("file", "number", "first"), ["file", "number"]), F.col("first")
    found = F.posexplode(get(F.col("list"), (), "array<variant>")).alias("position", "rec")
    rows = lists.select("file", first.cast("bigint").alias("first"), found)
    return rows.select("file", (F.col("first") + F.col("position")).cast("bigint").alias("root_index"), "rec")


def starts_with_array(spark: SparkSession, path: str) -> bool:
    """Whether the first character of a file that is no white space opens an array."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(location) or files.getFileStatus(location).isDirectory():
        return False
    stream = files.open(location)
    try:
        byte = stream.read()
        while byte in (32, 9, 13, 10):
            byte = stream.read()
        return byte == ord("[")
    finally:
        stream.close()
