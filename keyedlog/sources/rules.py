"""IP range rules: ``start|end|country|province|city`` lines, and their use."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ip import UNKNOWN, ip_to_long
from ..operators.range_join import check_rules, range_join
from ..operators.rows import column

# Fixed format of a rule line.
RULE_SCHEMA = "start_num bigint, end_num bigint, country string, province string, city string"
RULE_SEPARATOR = "|"


def read_ip_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules from text files: the first five fields of a line, of which empty ones stay empty.

    Blank lines are skipped; a line without five fields, or whose numbers do not parse, fails the
    job.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    columns = [field.split() for field in RULE_SCHEMA.split(", ")]
    fields = F.split("value", f"\\Q{RULE_SEPARATOR}\\E", len(columns) + 1)
    whole = F.when(F.size(fields) >= len(columns), fields).otherwise(
        F.raise_error(F.concat(F.lit("not a rule: "), F.col("value"))))
    found = lines.select(whole.alias("fields"))
    return found.select(*[
        F.col("fields")[i].cast(kind).alias(name) for i, (name, kind) in enumerate(columns)
    ])


def with_place(
    df: DataFrame, rules: DataFrame, ip: str, columns: Mapping[str, str] | None = None
) -> DataFrame:
    """Add columns of the rule that holds the address in ``ip``, or ``UNKNOWN``.

    ``columns`` maps new columns to rule columns; unset, country, province and city are added.
    Overlapping rules are an error, so every row of ``df`` comes out once.
    """
    check_rules(rules, "start_num", "end_num")
    columns = columns or {name: name for name in ("country", "province", "city")}
    chosen = rules.select(
        "start_num", "end_num", *[F.col(c).alias(f"_place_{n}") for n, c in columns.items()]
    )
    found = range_join(df, chosen, ip_to_long(column(ip)))
    return found.select(
        *[column(c) for c in df.columns],
        *[F.coalesce(f"_place_{n}", F.lit(UNKNOWN)).alias(n) for n in columns],
    )


def with_address(df: DataFrame, rules: DataFrame, ip: str, address: str = "address") -> DataFrame:
    """Add the country of the address in ``ip``."""
    return with_place(df, rules, ip, {address: "country"})
