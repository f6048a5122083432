"""Reads, features and regions made of the star-schema tables, so that every operator has input of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_PLACE = "((l_partkey DIV 10) * 100 + CASE WHEN l_linenumber = 1 THEN 50 ELSE datediff(l_shipdate, DATE '1992-01-01') % 100 END)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as alignments: near their part, by the ship date or, for first lines, at one place; the quantity is the length.

    Contigs grow with the number of parts, so that depth and overlaps stay the same at any size. The mate lies downstream on the other
    strand, for some fourth lines on another contig.
    """
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat_ws('/', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS id",
        "concat(l_returnflag, '_REP', l_partkey % 2 + 1) AS sample",
        "concat('chr', l_partkey % 10) AS chrom",
        f"CAST({_PLACE} AS BIGINT) AS start",
        f"CAST({_PLACE} + CAST(l_quantity AS BIGINT) AS BIGINT) AS end",
        "CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand",
        "CAST((l_linenumber - 1) * 10 AS BIGINT) AS mapq",
        "CAST(1 + 2 * (l_linenumber % 2) + CASE WHEN l_linenumber = 7 THEN 4 ELSE 0 END + CASE WHEN l_linenumber = 6 THEN 8 ELSE 0 END + CASE WHEN l_linestatus = 'F' THEN 0 ELSE 16 END + CASE WHEN l_partkey % 3 = 0 THEN 128 ELSE 64 END + CASE WHEN l_linenumber = 5 THEN 256 ELSE 0 END + CASE WHEN l_partkey % 11 = 0 THEN 1024 ELSE 0 END AS BIGINT) AS flag",
        "concat(substring('ACGT', CAST(l_partkey % 4 AS INT) + 1, 1), substring('ACGT', CAST(l_suppkey % 4 AS INT) + 1, 1)) AS umi",
        "concat('chr', CASE WHEN l_linenumber = 4 THEN l_suppkey ELSE l_partkey END % 10) AS mate_chrom",
        f"CAST({_PLACE} + l_linenumber * 40 - 60 AS BIGINT) AS mate_start",
        f"CAST({_PLACE} + l_linenumber * 40 - 60 + CAST(l_quantity AS BIGINT) AS BIGINT) AS mate_end",
        "CASE WHEN l_linestatus = 'F' THEN '-' ELSE '+' END AS mate_strand",
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as genes."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS gene",
        "concat('chr', p_partkey % 10) AS chrom",
        "(p_partkey DIV 10) * 100 + p_partkey * 37 % 100 AS start",
        "(p_partkey DIV 10) * 100 + p_partkey * 37 % 100 + p_size AS end",
        "CASE WHEN (p_partkey DIV 10) % 2 = 0 THEN '+' ELSE '-' END AS strand",
        "p_type AS biotype",
    )


def regions(spark: SparkSession, sf_dir: str, keep: bool = True) -> DataFrame:
    """Suppliers as regions: even keys to keep, odd ones to drop."""
    rows = table(spark, sf_dir, "supplier").where(F.col("s_suppkey") % 2 == (0 if keep else 1))
    return rows.selectExpr("concat('chr', s_suppkey % 10) AS chrom", "(s_suppkey DIV 10) * 2000 + s_suppkey * 97 % 2000 AS start", "(s_suppkey DIV 10) * 2000 + s_suppkey * 97 % 2000 + 5 + s_nationkey * 4 AS end")


def sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads(spark, sf_dir).groupBy("chrom").agg(F.max("end").alias("length"))


def exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as lines of an annotation: an order is a transcript, its lines exons and codons (1-based, closed)."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat('tx', l_orderkey) AS transcript_id",
        "l_linenumber * 1000000000000 + l_partkey * 1000000 + CAST(l_extendedprice AS BIGINT) AS line_no",
        "concat('chr', l_orderkey % 10) AS chrom",
        "CASE WHEN l_linenumber = 6 THEN 'start_codon' WHEN l_linenumber = 7 THEN 'stop_codon' ELSE 'exon' END AS feature",
        "CAST(l_orderkey % 1000 + l_linenumber * 100 + l_partkey % 40 AS BIGINT) AS start",
        "CAST(l_orderkey % 1000 + l_linenumber * 100 + l_partkey % 40 + CASE WHEN l_linenumber > 5 THEN 2 ELSE CAST(l_quantity AS BIGINT) END AS BIGINT) AS end",
        "CASE WHEN l_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand",
    )
