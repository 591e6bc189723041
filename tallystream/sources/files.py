"""Message files as batch and streaming tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystream.schema import BROKEN_LINE, ENVELOPE


def file_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    max_files: int | None = None,
    max_bytes: int | None = None,
    schema: T.StructType = ENVELOPE,
    max_age: str = "36500d",
) -> DataFrame:
    """A folder of message files read like a topic; ``max_files`` or ``max_bytes``
    bounds a micro-batch.

    ``max_age`` is how much older than the newest file a file may be; Spark's own limit
    of a week would skip the rest of an archive without a word. Files read can be moved
    away by Spark's ``cleanSource``, which keeps the listing short.
    """
    if max_files is not None and max_bytes is not None:
        raise ValueError("give max_files or max_bytes, not both")
    keeps_broken = fmt == "json" and "value" in schema.fieldNames()
    read_as = T.StructType([*schema.fields, T.StructField(BROKEN_LINE, T.StringType())]) if keeps_broken else schema
    reader = spark.readStream.format(fmt).schema(read_as).option("maxFileAge", max_age)
    if keeps_broken:
        reader = reader.option("columnNameOfCorruptRecord", BROKEN_LINE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    messages = reader.load(path)
    if not keeps_broken:
        return messages
    # The text of a line that is no envelope takes the place of its message, so
    # that decoding sets it aside whole.
    return messages.withColumn("value", F.coalesce(BROKEN_LINE, "value")).drop(BROKEN_LINE)


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """One message per line, kept verbatim. Large files are split between tasks."""
    return spark.read.text(path).select(F.lit(None).cast("string").alias("key"), "value")


def array_elements(texts: DataFrame, column: str = "value") -> DataFrame:
    """The elements of JSON arrays as message values, in order.

    Each element stays its own JSON text, so an absent field stays absent. Text
    that is no JSON array stops the job.
    """
    items = F.from_json(column, "array<string>", {"allowSingleQuotes": "false"})
    rest = [c for c in texts.columns if c != column]
    whole = F.coalesce(items, F.raise_error(F.lit("input is not a JSON array")).cast("array<string>"))
    return texts.select(*rest, F.posexplode(whole).alias("position", "value"))


def json_array(spark: SparkSession, path: str) -> DataFrame:
    """Files that each hold one JSON array: ``file, position, value``.

    A file is parsed by one task, whatever its size. For big files there is
    ``json_array_split``, and where lines have a meaning ``json_array_lines`` and ``json_lines``.
    """
    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return array_elements(texts)


def json_array_lines(spark: SparkSession, path: str) -> DataFrame:
    """Files that each hold one JSON array with every element on a line of its own:
    ``file, block, line, value``, in this order.

    Needs no look at the file as a whole, so large files are split between tasks.
    A line that is not one whole element is left to decoding, which rejects it.
    """
    text = F.regexp_replace(F.trim(F.regexp_replace("value", r"\A\s*\[", "")), r"\s*[,\]]\s*\z", "")
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        text.alias("value"),
    )
    return lines.where(F.col("value") != "")


def _nesting(text: Column) -> Column:
    """Opening minus closing brackets."""
    return F.length(F.translate(text, "]}", "")) - F.length(F.translate(text, "[{", ""))


# Texts between commas whose state is worked out together, and bytes of the files for each
# task that does so: what a task holds follows these, whatever the files and their splits.
PLACE = ("file", "block", "chunk")
CHUNK = 1 << 14
TASK_BYTES = 8 << 20


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The texts between commas with what each does to the state of a parser, whether it
    begins outside a string or inside one; ``flip`` tells which, from the start of its chunk.

    A chunk is a run of pieces of one split; chunks are dealt to tasks by the size of the files.

    A quote counts unless a backslash is before it, and no backslash stands before a
    comma, so quotes can be counted without knowing the state.
    """
    pieces = spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("file_size"),
        F.monotonically_increasing_id().alias("line"),
        F.col("value").alias("piece"),
    )
    # An id counts rows from 0 in its low 33 bits.
    pieces = pieces.withColumn("chunk", F.shiftright(F.col("line").bitwiseAND((1 << 33) - 1), CHUNK.bit_length() - 1))
    plain = F.regexp_replace("piece", r"(?s)\\.", "")
    no_strings = lambda text: F.regexp_replace(text, r'(?s)"[^"]*("|\z)', "")
    pieces = pieces.withColumns({"plain": plain, "if_out": no_strings(plain), "if_in": no_strings(F.concat(F.lit('"'), plain))})
    # Between two commas lies one scalar or empty container: nothing opens after something has closed.
    reopens = r"(?s)[\]}].*[\[{]"
    within = Window.partitionBy(*PLACE).orderBy("line")
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumns({
        "quotes": F.length("plain") - F.length(F.translate("plain", '"', "")),
        "out": _nesting(F.col("if_out")),
        "in": _nesting(F.col("if_in")),
        "odd_out": F.col("if_out").rlike(reopens),
        "odd_in": F.col("if_in").rlike(reopens),
        "bytes": F.octet_length("piece") + 1,
    }).drop("plain", "if_out", "if_in")
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    pieces = pieces.repartition(2 + size // TASK_BYTES, *PLACE)
    return pieces.withColumns({
        "flip": F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2,
        "ending": F.lead("line").over(within).isNull(),
    })


def _block_states(pieces: DataFrame) -> DataFrame:
    """For each chunk whether it begins inside a string and how deep: the chunks' own changes,
    one row for each, put together in the order of the file."""
    outside, inside = F.when(F.col("flip") == 0, F.col("out")), F.when(F.col("flip") == 0, F.col("in"))
    chunks = pieces.groupBy(*PLACE).agg(
        F.sum("quotes").alias("quotes"),
        F.sum(outside.otherwise(F.col("in"))).alias("out"),
        F.sum(inside.otherwise(F.col("out"))).alias("in"),
        F.sum("bytes").alias("bytes"),
        F.max("file_size").alias("file_size"),
    )
    order = Window.partitionBy("file").orderBy("block", "chunk")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sum_before = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    chunks = chunks.withColumn("quoted", sum_before("quotes") % 2)
    chunks = chunks.withColumn("change", F.when(F.col("quoted") == 0, F.col("out")).otherwise(F.col("in")))
    return chunks.select(
        *PLACE, "quoted", sum_before("change").alias("depth"),
        F.lag("block").over(order).isNull().alias("first_chunk"), F.lead("block").over(order).isNull().alias("last_chunk"),
        # Nothing is read after a comma that ends the file, but then every piece has its comma.
        (F.sum("bytes").over(Window.partitionBy("file")) == F.col("file_size")).alias("cut_off"),
    )


def json_array_split(spark: SparkSession, path: str) -> DataFrame:
    """Files that each hold one JSON array, read in splits wherever these fall: ``file, block,
    line, value``, in this order.

    The texts between commas are read as records. Strings and brackets of every chunk of them
    are summed up for both states it may begin in, the chunks of a file put together, and with
    the state at its start each chunk finds the commas that part elements. An element that
    crosses chunks is put together from its parts; the others stay where they are. A file
    that is no array, or has a gap between commas, stops the job.
    """
    pieces = _pieces(spark, path)
    states = _block_states(pieces)
    within = Window.partitionBy(*PLACE).orderBy("line")
    met = pieces.join(states, list(PLACE))
    start = (F.col("quoted") + F.col("flip")) % 2
    change = F.when(start == 0, F.col("out")).otherwise(F.col("in"))
    met = met.withColumns({
        "level": F.col("depth") + F.sum(change).over(within.rowsBetween(Window.unboundedPreceding, 0)),
        "open": (start + F.col("quotes")) % 2 == 1,
        "last": F.col("last_chunk") & F.col("ending"),
    })
    no_array = F.raise_error(F.concat(F.lit("input is not a JSON array: "), F.col("file"))).cast("string")
    wrong = F.when(F.col("last"), F.col("open") | (F.col("level") != 0)).otherwise(~F.col("open") & (F.col("level") < 1))
    wrong = wrong | F.col("cut_off") | F.when(start == 0, F.col("odd_out")).otherwise(F.col("odd_in"))
    met = met.withColumns({
        "piece": F.when(wrong, no_array).otherwise(F.col("piece")),
        "parts": (F.col("last") | (~F.col("open") & (F.col("level") == 1))).cast("int"),
    })
    met = met.withColumn(
        "element", F.coalesce(F.sum("parts").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    joined = lambda order: F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct(order, "piece"))), lambda x: x["piece"]), ","
    ).alias("piece")
    # Grouped as they lie: no rows move.
    parts = met.groupBy(*PLACE, "element").agg(
        joined("line"), F.min("line").alias("line"), F.max("parts").alias("ends"),
        F.max(F.col("first_chunk")).alias("first"), F.max("last").alias("last"),
    )
    first = F.col("first") & (F.col("element") == 0)
    parts = parts.withColumn("first", first).withColumn("whole", (F.col("ends") == 1) & ((F.col("element") > 0) | first))
    shown = ("file", "block", "line", "piece", "first", "last")
    # At most the first and the last part of each chunk cross it.
    torn = parts.where("NOT whole")
    earlier = Window.partitionBy("file").orderBy("block", "chunk", "element").rowsBetween(Window.unboundedPreceding, -1)
    torn = torn.withColumn("element", F.coalesce(F.sum("ends").over(earlier), F.lit(0)))
    torn = torn.withColumn("line", F.struct("block", "line")).groupBy("file", "element").agg(
        joined("line"), F.min("line").alias("at"), F.max("first").alias("first"), F.max("last").alias("last")
    )
    torn = torn.select("file", "at.block", "at.line", "piece", "first", "last")
    elements = parts.where("whole").select(*shown).unionByName(torn)
    text = F.when(~F.col("first"), F.col("piece")).when(
        F.col("piece").rlike(r"\A[ \t\r\n]*\["), F.regexp_replace("piece", r"\A[ \t\r\n]*\[", "")
    ).otherwise(no_array)
    elements = elements.withColumn("piece", text)
    # The brackets match by now, so what is left must end with the outermost.
    text = F.when(~F.col("last"), F.col("piece")).when(
        F.col("piece").rlike(r"\][ \t\r\n]*\z"), F.regexp_replace("piece", r"\][ \t\r\n]*\z", "")
    ).otherwise(no_array)
    elements = elements.withColumn("piece", F.trim(text, F.lit(" \t\r\n")))
    empty = (F.col("piece") == "") & F.col("first") & F.col("last")
    value = F.when(F.col("piece") == "", no_array).otherwise(F.col("piece"))
    return elements.where(~empty).select("file", "block", F.col("line").cast("bigint"), value.alias("value"))


# Files of records by name of their layout.
RECORD_FILES = {
    "array": json_array, "array-split": json_array_split, "array-lines": json_array_lines, "lines": json_lines,
}
