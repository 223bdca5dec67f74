"""Queries: dirty citations parted and cleaned, and profiles merged out of stored sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import format_us_date
from ..operators.clean import PARKING_SPEC, clean
from ..operators.sketches import batch_sketches, merged_profile
from ..session import scratch_path
from ..sources.citations import CITATION_COLUMNS, CITATION_SCHEMA, part_csv
from ..sources.readers import read_table
from .registry import query

_KEY = "o_orderkey"


def dirty_rows(o: DataFrame) -> DataFrame:
    """Orders in the 48 columns of the citations, as text, and their key: every seventh
    has no date, every eleventh a word for a number, states and street codes are
    missing here and there, and years reach beyond the wanted ones."""
    key = F.col(_KEY)
    text = {
        "Summons Number": key.cast("string"),
        "Registration State": F.when(key % 3 != 0, "NJ"),
        "Issue Date": F.when(key % 7 == 0, "13/45/2015").otherwise(format_us_date(F.add_months("o_orderdate", 240))),
        "Violation Code": F.when(key % 11 == 0, "twelve").otherwise("12"),
        "Vehicle Make": F.concat(F.col("o_orderpriority"), F.lit(', "x"')),
        "Street Code1": F.when(key % 4 != 0, F.col("o_custkey").cast("string")),
        "Issuer Code": (key % 100).cast("string"),
        "Law Section": F.lit("408"),
        "Violation Time": F.concat(F.lpad((key % 12 + 1).cast("string"), 2, "0"), F.lpad((key % 60).cast("string"), 2, "0"), F.when(key % 2 == 0, "A").otherwise("P")),
        "Violation_County": F.col("o_orderstatus"),
    }
    return o.select(key, *[text.get(c, F.lit(None).cast("string")).alias(c) for c in CITATION_COLUMNS])


def _dirty_csv(spark, sf_dir) -> str:
    """:func:`dirty_rows` as CSV; a tenth of the rows stand twice."""
    rows, key = dirty_rows(read_table(spark, sf_dir, "orders")), F.col(_KEY)
    path = scratch_path(spark, "dirty-csv")
    rows.unionByName(rows.where(key % 10 == 0)).drop(_KEY).write.option("header", True).option("escape", '"').csv(path)
    return path


_ORDERS_SQL = "SELECT o_orderkey AS k, o_orderdate + INTERVAL 20 YEAR AS d, o_orderpriority, o_custkey, o_orderstatus FROM orders"
_HOUR = "k % 12 + 1"


CLEANED_SQL = f"""
SELECT CASE WHEN k % 3 <> 0 THEN 'NJ' ELSE 'NY' END AS "Registration State", 'PAS' AS "Plate Type", 'SUBN' AS "Vehicle Body Type", o_orderpriority || ', "x"' AS "Vehicle Make",
  'T' AS "Issuing Agency", CASE WHEN k % 4 <> 0 THEN o_custkey ELSE 0 END AS "Street Code1", 0 AS "Street Code2", 0 AS "Street Code3", k % 100 AS "Issuer Code", 'T103' AS "Issuer Command", 'A' AS "Issuer Squad",
  o_orderstatus AS "Violation_County", 'F' AS "Violation In Front Of Or Opposite", 408 AS "Law Section", dayofweek(d) + 1 AS "Issue Day", month(d) AS "Issue Month", year(d) AS "Issue Year",
  CASE WHEN k % 2 = 0 THEN CASE WHEN {_HOUR} IN (12, 1, 2, 3) THEN 1 WHEN {_HOUR} <= 7 THEN 2 ELSE 3 END ELSE CASE WHEN {_HOUR} IN (12, 1, 2, 3) THEN 4 WHEN {_HOUR} <= 7 THEN 5 ELSE 6 END END AS "Time bin"
FROM ({_ORDERS_SQL}) o WHERE k % 11 <> 0 AND k % 7 <> 0 AND year(d) > 2012 AND year(d) < 2018
"""


@query("dirty_citations", "SRC-02 SRC-01 DED-01 FLT-02 NUL-01 SCL-01 SCL-03 STR-03 PRJ-08", CLEANED_SQL)
def dirty_citations(spark, sf_dir):
    """The good rows of the dirty CSV, cleaned: copies, bad dates and other years go, defaults come in."""
    good, _ = part_csv(spark, _dirty_csv(spark, sf_dir), CITATION_SCHEMA, scratch_path(spark, "parted"), escape='"')
    out = clean(good, PARKING_SPEC)
    return out.select(*[F.col(c).cast("bigint").alias(c) if t in ("int", "bigint") else F.col(c) for c, t in out.dtypes])


@query("citation_quarantine", "SRC-02 STR-01 AGG-13", """
SELECT o_orderkey AS summons, CASE WHEN o_orderkey % 10 = 0 THEN 2 ELSE 1 END AS n FROM orders WHERE o_orderkey % 11 = 0
""")
def citation_quarantine(spark, sf_dir):
    """The broken rows of the dirty CSV, by the number that their raw line begins with."""
    _, bad = part_csv(spark, _dirty_csv(spark, sf_dir), CITATION_SCHEMA, scratch_path(spark, "parted"), escape='"')
    return bad.groupBy(F.regexp_extract("raw", "^([0-9]+),", 1).cast("bigint").alias("summons")).agg(F.count(F.lit(1)).alias("n"))


_QUANTILES = (0.25, 0.5, 0.75)


@query("merged_sketches", "AGG-02 AGG-03 AGG-08 AGG-11 AGG-07", """
SELECT 'o_totalprice' AS "column", count(o_totalprice) AS n, count(*) - count(o_totalprice) AS n_null, true AS within FROM orders
UNION ALL SELECT 'o_custkey', count(o_custkey), count(*) - count(o_custkey), true FROM orders
UNION ALL SELECT 'o_orderpriority', count(o_orderpriority), count(*) - count(o_orderpriority), true FROM orders
""")
def merged_sketches(spark, sf_dir):
    """A sketch table per year of orders, appended year by year, then merged: ``within``
    says that quartiles are within 2 % of their ranks and distinct counts within 5 %
    (three standard errors) of the exact ones."""
    o = read_table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    numbers, values = ["o_totalprice"], ["o_custkey", "o_orderpriority"]
    path = scratch_path(spark, "sketches")
    for half in (o.where(F.col("year") < 1995), o.where(~F.coalesce(F.col("year") < 1995, F.lit(False)))):
        batch_sketches(half, numbers, values, ["year"]).write.mode("append").parquet(path)
    profile = merged_profile(spark.read.parquet(path), _QUANTILES)
    found = {r.column: r for r in profile.collect()}  # one row a column
    shares = [F.avg((F.col(c) <= found[c].quantiles[i]).cast("double")) for c in numbers if found[c].quantiles for i in range(len(_QUANTILES))]
    below = [F.avg((F.col(c) < found[c].quantiles[i]).cast("double")) for c in numbers if found[c].quantiles for i in range(len(_QUANTILES))]
    exact = o.agg(F.array(*shares).alias("at"), F.array(*below).alias("below"), *[F.countDistinct(c).alias(c) for c in values]).first()
    ranks_hold = all(b - 0.02 <= q <= a + 0.02 for a, b, q in zip(exact["at"], exact["below"], _QUANTILES, strict=False))
    counts_hold = {c: abs(found[c].n_distinct - exact[c]) <= 0.05 * exact[c] for c in values}
    within = F.coalesce(F.create_map(*[F.lit(x) for p in {**dict.fromkeys(numbers, ranks_hold), **counts_hold}.items() for x in p])[F.col("column")], F.lit(False))
    return profile.select("column", "n", "n_null", within.alias("within"))
