"""Parser for offset-range text lines.

A line is ``topic: <name>    partition: <int>    offsets: <from> to <until>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the line format.
PART_SEPARATOR = "    "
PARTS_PER_LINE = 3
NAME_SEPARATOR = ":"
RANGE_SEPARATOR = "to"
RANGE_FORMAT = "%d -> %d = %d"

# Characters trimmed around names and values: the space and all control characters below it.
BLANKS = "".join(chr(code) for code in range(33))
BLANK_RANGE, CONTROL_RANGE = r"\x00-\x20", r"\x00-\x1f"

# A line as it is mostly written: single blanks, names in lower case and in order, numbers that surely fit.
PLAIN_LINE = rf"^topic: [^{BLANK_RANGE}:]+    partition: [0-9]{{1,9}}    offsets: [0-9]{{1,18}} to [0-9]{{1,18}}\z"
# Places of its values once it is split at each blank.
PLAIN_PLACES = {"topic": 1, "partition": 6, "from_offset": 11, "until_offset": 13}


def parse_offset_lines(df: DataFrame, value: str = "value", strict: bool = True) -> DataFrame:
    """Replace ``value`` with ``topic, partition, from_offset, until_offset, delta``.

    Lines that do not have three parts are dropped; empty parts at the end do not count. Of each part
    only the text up to a second colon is read; of parts with the same name the last is read; other names
    are ignored; what is missing is 0 (null for the topic). A bad number or a part without a value
    fails the query in strict mode and gives null otherwise.

    A line that is written plainly, told by one pattern, is split once and read by place; the rules above are only worked
    out for the others. As a line has a fixed number of parts, they are plain expressions without lambdas, in
    steps that stay small enough, once generated, for the JVM to compile.
    """
    kept = [c for c in df.columns if c != value]
    numbers = range(1, PARTS_PER_LINE + 1)
    colon = F.lit(NAME_SEPARATOR)

    pieces = [F.split_part(value, F.lit(PART_SEPARATOR), F.lit(n)) for n in numbers]
    used = sum((F.length(p) for p in pieces), F.lit(len(PART_SEPARATOR) * (PARTS_PER_LINE - 1)))
    beyond = F.replace(F.substr(value, used + 1), F.lit(PART_SEPARATOR), F.lit(""))
    plain = F.col(value).rlike(PLAIN_LINE)
    lines = df.filter(plain | ((pieces[-1] != "") & ((F.length(value) == used) | (beyond == ""))))
    lines = lines.withColumn("__plain", F.when(plain, F.split(value, " ")))
    other = F.col("__plain").isNull()
    kept_plain = [*kept, "__plain"]

    def clean(piece: Column) -> Column:
        """Without blanks at the ends and without colons at the end; blanks around colons may stay if they are spaces."""
        bare = F.rtrim(F.trim(piece, F.lit(BLANKS)), colon)
        rare = F.regexp_replace(bare, f"[{BLANK_RANGE}]*{NAME_SEPARATOR}[{BLANK_RANGE}]*", NAME_SEPARATOR)
        return F.when(F.col(value).rlike(f"[{CONTROL_RANGE}]"), rare).otherwise(F.rtrim(F.trim(piece), colon))

    parts = lines.select(*kept_plain, *[F.when(other, clean(p)).alias(f"part_{n}") for n, p in zip(numbers, pieces)])

    def name(part: str) -> Column:
        missing = F.raise_error(F.concat(F.lit("part without a value: "), part)).cast("string") if strict else F.lit(None)
        return F.when(F.contains(part, colon), F.lower(F.trim(F.split_part(part, colon, F.lit(1))))).otherwise(missing)

    named = parts.select(
        *kept_plain,
        *[F.when(other, name(f"part_{n}")).alias(f"name_{n}") for n in numbers],
        *[F.when(other, F.trim(F.split_part(f"part_{n}", colon, F.lit(2)))).alias(f"text_{n}") for n in numbers],
    )

    def last(wanted: str) -> Column:
        found = F
        for n in reversed(numbers):
            found = found.when(F.col(f"name_{n}") == wanted, F.col(f"text_{n}"))
        return found.alias(wanted)

    texts = named.select(*kept_plain, last("topic"), last("partition"), last("offsets"))

    def number(text: Column, dtype: str, given: Column) -> Column:
        # Casts trim by themselves.
        return F.when(given, text.cast(dtype) if strict else text.try_cast(dtype)).otherwise(F.lit(0).cast(dtype))

    def offset(index: int) -> Column:
        return number(F.split_part("offsets", F.lit(RANGE_SEPARATOR), F.lit(index)), "bigint", F.col("offsets").isNotNull())

    def either(wanted: str, dtype: str, ruled: Column) -> Column:
        read = F.col("__plain")[PLAIN_PLACES[wanted]].cast(dtype)
        return F.when(other, ruled).otherwise(read).alias(wanted)

    ranges = texts.select(
        *kept,
        either("topic", "string", F.col("topic")),
        either("partition", "int", number(F.col("partition"), "int", F.col("partition").isNotNull())),
        either("from_offset", "bigint", offset(1)),
        either("until_offset", "bigint", offset(2)),
    )
    if strict:
        # Numbers fail only when they are read, so that of a partition nobody asks for is read here.
        ranges = ranges.withColumn("topic", F.when(F.col("partition").isNotNull(), F.col("topic")))
    return with_delta(ranges)


def with_delta(ranges: DataFrame) -> DataFrame:
    """P13."""
    return ranges.withColumn("delta", F.col("until_offset") - F.col("from_offset"))


def range_text() -> Column:
    """P12."""
    return F.format_string(RANGE_FORMAT, "from_offset", "until_offset", "delta")


def to_offset_line(topic: Column, partition: Column, from_offset: Column, until_offset: Column) -> Column:
    """The text line of a range."""
    return F.format_string("topic: %s    partition: %d    offsets: %d to %d", topic, partition, from_offset, until_offset)
