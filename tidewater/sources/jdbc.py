"""Partitioned JDBC scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Bins of a histogram query, and how much finer than a partition the bins get.
BINS, FINER = 64, 8


def read_jdbc_table(spark: SparkSession, url: str, table: str, *, partition_column: str | None = None,
                    lower: int | None = None, upper: int | None = None,
                    num_partitions: int = 8, properties: dict | None = None,
                    fetch_size: int = 10_000) -> DataFrame:
    """Full-table read; with a numeric partition column the scan is split into
    ``num_partitions`` range queries read in parallel.

    With ``lower`` and ``upper`` the ranges are equally wide; without, the table itself
    says where its rows are (``key_ranges``), so that they are equally full.
    """
    options = {**(properties or {}), "fetchsize": str(fetch_size)}
    if partition_column is not None and (lower is None or upper is None):
        predicates = key_ranges(spark, url, table, partition_column, num_partitions, properties)
        return spark.read.jdbc(url, table, predicates=predicates, properties=options)
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def key_ranges(spark: SparkSession, url: str, table: str, column: str, parts: int, properties: dict | None = None) -> list[str]:
    """Predicates over an integer column that cut the table into about ``parts`` equally
    full ranges; together they hold every row once, those without a key in the first.

    The database counts rows per bin of equal width; a bin that holds more than its
    share is counted again in finer bins, down to single keys.  Only counts are read:
    ``BINS`` rows a query.  ``column`` is named as in the table's schema (quoted by the
    database's dialect).  Rows of one key stay together, so a key that is more than a
    part is a range by itself.
    """
    def ask(query: str) -> list:
        return spark.read.format("jdbc").option("url", url).option("query", query).options(**(properties or {})).load().collect()

    column = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(column)
    low, high, rows = ask(f"SELECT MIN({column}) AS lo, MAX({column}) AS hi, COUNT({column}) AS n FROM {table}")[0]
    if not rows:
        return ["1 = 1"]
    low, high, share = int(low), int(high), rows / parts
    bins: list[tuple[int, int, int]] = []  # first key, last key, rows
    todo = [(low, high)]
    while todo:
        a, b = todo.pop()
        width = -(-(b - a + 1) // BINS)
        counted = ask(f"SELECT b, COUNT(*) AS n FROM (SELECT ({column} - ({a})) / {width} AS b FROM {table} "
                      f"WHERE {column} BETWEEN {a} AND {b}) x GROUP BY b")
        for slot, n in ((int(r[0]), int(r[1])) for r in counted):
            first, last = a + slot * width, min(a + (slot + 1) * width - 1, b)
            if n > share / FINER and last > first:
                todo.append((first, last))
            else:
                bins.append((first, last, n))
    cuts, full = [], 0
    for first, _, n in sorted(bins):
        if full and full + n / 2 > share:  # the bin belongs rather to the next range
            cuts.append(first)
            full = 0
        full += n
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]
