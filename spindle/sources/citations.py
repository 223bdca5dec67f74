"""The declared citation schema, and CSV with broken rows (SRC-01/02, STR-01)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

# The citation columns in the data's order, and those that are no text.
CITATION_COLUMNS = [
    "Summons Number", "Plate ID", "Registration State", "Plate Type", "Issue Date", "Violation Code",
    "Vehicle Body Type", "Vehicle Make", "Issuing Agency", "Street Code1", "Street Code2", "Street Code3",
    "Vehicle Expiration Date", "Issuer Code", "Issuer Command", "Issuer Squad", "Violation Time",
    "Time First Observed", "Violation_County", "Violation In Front Of Or Opposite", "House Number",
    "Street Name", "Intersecting Street", "Date First Observed", "Law Section", "Sub Division",
    "Violation Legal Code", "Days Parking In Effect", "From Hours In Effect", "To Hours In Effect",
    "Vehicle Color", "Unregistered Vehicle?", "Vehicle Year", "Meter Number", "Feet From Curb",
    "Violation Post Code", "Violation Description", "No Standing or Stopping Violation",
    "Hydrant Violation", "Double Parking Violation", "Latitude", "Longitude", "Community Board",
    "Community Council", "Census Tract", "BIN", "BBL", "NTA",
]
CITATION_LONGS = ["Summons Number"]
CITATION_INTS = ["Violation Code", "Street Code1", "Street Code2", "Street Code3", "Issuer Code", "Law Section",
                 "Unregistered Vehicle?", "Vehicle Year", "Feet From Curb"]

#: One schema for batch files and stream messages, so that types can't drift between training and scoring.
CITATION_SCHEMA = StructType([StructField(c, LongType() if c in CITATION_LONGS else IntegerType() if c in CITATION_INTS else StringType())
                              for c in CITATION_COLUMNS])
RAW = "_raw_line"


def part_csv(spark: SparkSession, path: str, schema: StructType, out: str, **options) -> tuple[DataFrame, DataFrame]:
    """Read CSV with a header under a declared schema and part it: ``(good rows, quarantine)``.

    A row is broken when a value is not of its column's type or the number of
    fields differs; the quarantine has its ``raw`` line.  A file whose header does not
    name the columns of ``schema`` in their order stops the job with both names.  One
    pass over the input writes both tables below ``out``, a folder each."""
    held = StructType([*schema.fields, StructField(RAW, StringType())])
    rows = (spark.read.schema(held).options(**options).option("header", True).option("enforceSchema", False)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW).csv(path))
    rows.withColumn("broken", F.col(RAW).isNotNull()).write.mode("overwrite").partitionBy("broken").parquet(out)
    parted = spark.read.schema(StructType([*held.fields, StructField("broken", BooleanType())])).parquet(out)
    return parted.where(~F.col("broken")).drop(RAW, "broken"), parted.where("broken").select(F.col(RAW).alias("raw"))
