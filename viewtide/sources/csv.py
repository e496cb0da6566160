"""The two headerless CSV inputs, split into good rows and rejects."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from viewtide.functions.expressions import PROVIDED
from viewtide.schemas import CONSTRAINTS, HISTORY, MAX_BYTES, META

LINE = "line"
REASON = "reason"
REJECTED = "_rejected"

_SCHEMAS = {"meta": META, "history": HISTORY}
_CORRUPT = "_corrupt"
_TEXT = "_text_of_"

_BLANK = r"^\s*$"
# A whole date, then perhaps a time and a zone. Without the date a cast would take today's.
_FULL_TIME = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d(.*\S)?)?$"


class TooManyRejects(Exception):
    """More input lines were rejected than allowed."""


def read_meta(spark: SparkSession, path: str, providers: bool = False) -> tuple[DataFrame, DataFrame]:
    """Videos: (good rows, rejects)."""
    return read_csv(spark, path, "meta", providers)


def read_history(spark: SparkSession, path: str, providers: bool = False) -> tuple[DataFrame, DataFrame]:
    """Observations: (good rows, rejects). Integers may be quoted, and `""` is missing."""
    return read_csv(spark, path, "history", providers)


def read_csv(spark: SparkSession, path: str, table: str, providers: bool = False) -> tuple[DataFrame, DataFrame]:
    """With `providers`, ids that do not name a provider are rejects."""
    parsed = parse(spark, path, table, providers)
    return good_rows(parsed, table), rejects(parsed, table, providers)


def parse(spark: SparkSession, path: str, table: str, providers: bool = False) -> DataFrame:
    """Every line as text, with its typed columns and whether it is rejected.

    The lines are read as text, so that a reject keeps its line as it was. `inline` makes
    Spark parse each line once, however many columns are used afterwards. Blank lines are
    rejects; the end of the last line does not begin another.
    """
    schema = _SCHEMAS[table]
    times = _times(schema)
    columns = StructType([
        *[StructField(_TEXT + f.name, StringType()) if f.name in times else f for f in schema.fields],
        StructField(_CORRUPT, StringType()),
    ])
    parsed = F.from_csv(LINE, _ddl(columns), {"columnNameOfCorruptRecord": _CORRUPT})
    lines = spark.read.text(path).toDF(LINE).select(LINE, F.inline(F.array(parsed)))
    typed = lines.withColumns({
        c: F.when(F.col(_TEXT + c).rlike(_FULL_TIME), F.col(_TEXT + c).try_cast("timestamp")) for c in times
    })
    broken = [F.col(_CORRUPT).isNotNull(), *(condition for condition, _ in _violations(table, providers))]
    return typed.withColumn(REJECTED, F.coalesce(reduce(or_, broken), F.lit(False)))


def good_rows(parsed: DataFrame, table: str) -> DataFrame:
    return parsed.filter(~F.col(REJECTED)).select(*_SCHEMAS[table].names)


def rejects(parsed: DataFrame, table: str, providers: bool = False) -> DataFrame:
    """The rejected lines and the first reason found for each."""
    violated = F.coalesce(*[F.when(condition, F.lit(text)) for condition, text in _violations(table, providers)])
    reason = F.when(F.col(_CORRUPT).isNull(), violated).otherwise(_parse_failure(_SCHEMAS[table]))
    return parsed.filter(REJECTED).select(LINE, reason.alias(REASON))


def check_rejects(rejects: DataFrame, max_rejects: int = 0) -> None:
    """Raise if there are more rejects than allowed."""
    count = rejects.count()
    if count > max_rejects:
        first = rejects.first()
        raise TooManyRejects(f"{count} lines rejected, {max_rejects} allowed; first: {first[REASON]}: {first[LINE]}")


def _times(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, TimestampType)]


def _ddl(schema: StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)


def _violations(table: str, providers: bool = False) -> list[tuple[Column, str]]:
    """Conditions under which a parsed line breaks the table's constraints."""
    blank = [(F.col(LINE).rlike(_BLANK), "blank line")]
    no_time = [
        (F.col(c).isNull() & (F.col(_TEXT + c) != ""), f"{c}: not a timestamp") for c in _times(_SCHEMAS[table])
    ]
    missing = [
        (F.col(c).isNull() | (F.col(c).cast("string") == ""), f"{c}: missing")
        for c in CONSTRAINTS[table].not_null
    ]
    too_long = [
        (F.octet_length(c) > MAX_BYTES[c], f"{c}: longer than {MAX_BYTES[c]} bytes")
        for c in _SCHEMAS[table].names
        if c in MAX_BYTES
    ]
    unnamed = [(~F.col("gid").rlike(PROVIDED), "gid: no provider")] if providers else []
    return blank + no_time + missing + too_long + unnamed


def _parse_failure(schema: StructType) -> Column:
    """Why the reader could not make sense of a line, from its fields read as text.

    Blanks around a number make it none; a cast alone would trim them.
    """
    texts = StructType([StructField(c, StringType()) for c in [*schema.names, _CORRUPT]])
    fields = F.from_csv(LINE, _ddl(texts), {"columnNameOfCorruptRecord": _CORRUPT})
    mistyped = [
        F.when(
            (fields[f.name] != "")
            & (fields[f.name].try_cast(f.dataType).isNull() | fields[f.name].rlike(r"^\s|\s$")),
            F.lit(f"{f.name}: not a {f.dataType.simpleString()}"),
        )
        for f in schema.fields
        if not isinstance(f.dataType, (StringType, TimestampType))
    ]
    return F.when(F.col(LINE).rlike(_BLANK), F.lit("blank line")).when(fields[_CORRUPT].isNotNull(), F.lit("wrong number of fields")).otherwise(
        F.coalesce(*mistyped, F.lit("malformed line"))
    )
