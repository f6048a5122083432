"""Sample sheets, replicate groups and the small relational steps between them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FASTQ = r"^\S+\.f(ast)?q\.gz$"


def invalid_rows(sheet: DataFrame) -> DataFrame:
    """Rows of (sample, fastq_1, fastq_2) that break a rule: sample, reason. A row may break several."""
    rules = {
        "sample must be given without spaces": F.col("sample").isNull() | ~F.col("sample").rlike(r"^\S+$"),
        "fastq_1 must be given and end in .fastq.gz or .fq.gz": F.col("fastq_1").isNull() | ~F.col("fastq_1").rlike(FASTQ),
        "fastq_2 must end in .fastq.gz or .fq.gz": F.col("fastq_2").isNotNull() & ~F.col("fastq_2").rlike(FASTQ),
    }
    reasons = F.array_compact(F.array(*[F.when(broken, F.lit(reason)) for reason, broken in rules.items()]))
    return sheet.select("sample", F.explode(reasons).alias("reason"))


def group_samples(sheet: DataFrame) -> DataFrame:
    """One row per sample: id, single_end, n_runs, fastqs in the order of their names."""
    rows = sheet.select(F.col("sample").alias("id"), F.col("fastq_2").isNull().alias("single_end"), F.array_compact(F.array("fastq_1", "fastq_2")).alias("fastqs"))
    return rows.groupBy("id").agg(F.first("single_end").alias("single_end"), F.count(F.lit(1)).alias("n_runs"), F.flatten(F.sort_array(F.collect_list("fastqs"))).alias("fastqs"), F.count_distinct("single_end").alias("kinds"))


def check_groups(groups: DataFrame) -> DataFrame:
    """groups, or an error for a sample with single-end and paired runs."""
    mixed = F.when(F.col("kinds") > 1, F.raise_error(F.concat(F.lit("runs of one sample must all be single-end or all paired: "), F.col("id"))).cast("boolean")).otherwise(True)
    return groups.where(mixed).drop("kinds")


def join_remainder(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Full outer join by a key: unmatched rows have nulls."""
    return a.join(b, key, "full_outer")


def combine(a: DataFrame, b: DataFrame) -> DataFrame:
    """Every row of a with every row of b, a parameter table of a few rows; Spark judges by its size whether to broadcast it."""
    return a.crossJoin(b)


def mix(*tables: DataFrame) -> DataFrame:
    """All rows of all tables; columns by name."""
    return reduce(lambda x, y: x.unionByName(y), tables)


def common(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows that both tables hold; columns by name, nulls equal each other."""
    return a.intersect(b.select(*a.columns))


def without(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of a that b does not hold; columns by name, nulls equal each other."""
    return a.subtract(b.select(*a.columns))


def look_up(key: Column, values: dict[str, str], default: str | None = None) -> Column:
    """The value of a key in a small map of parameters, or the default: for a key that is not there or null."""
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default)) if pairs else F.lit(default)


def file_key(path: Column, cut: str = r"[._]") -> Column:
    """The key in a file's path, such as input_file_name(): its name up to the first dot or underscore; null without one."""
    return F.nullif(F.split(F.element_at(F.split(path, "/"), -1), cut)[0], F.lit(""))


def merge_runs(runs: DataFrame) -> DataFrame:
    """sample, mate, files: the files of a sample's runs (sample, fastqs) by their place in each run, first mates (1) and second ones (2)."""
    rows = runs.select("sample", F.posexplode("fastqs").alias("at", "file"))
    return rows.groupBy("sample", (F.col("at") % 2 + 1).cast("long").alias("mate")).agg(F.sort_array(F.collect_list("file")).alias("files"))


def default_row(table: DataFrame, row: dict) -> DataFrame:
    """table, or one given row if it is empty."""
    other = table.sparkSession.createDataFrame([row], table.schema)
    return table.unionByName(other.join(table.limit(1).select(F.lit(1).alias("_any")), how="left_anti", on=F.lit(True)))
