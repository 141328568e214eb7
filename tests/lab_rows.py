"""The literal rows of the labs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: the three lab batches (parcelId, area, type, amount, status,
# validation status, transaction date); key (area, parcelId), partition area.
LAB_BATCHES = [
    [
        ("PCL-MM-001", "Makati", "PURCHASE", 4500000.0, "PENDING", "PENDING", "2024-01-15T09:00:00"),
        ("PCL-MM-002", "Makati", "MORTGAGE", 3200000.0, "PENDING", "PENDING", "2024-01-15T09:05:00"),
        ("PCL-QC-001", "Quezon City", "TRANSFER", 2800000.0, "PENDING", "PENDING", "2024-01-15T09:10:00"),
        ("PCL-QC-002", "Quezon City", "PURCHASE", 8100000.0, "PENDING", "PENDING", "2024-01-15T09:15:00"),
        ("PCL-BGC-001", "BGC", "TITLE_REGISTRATION", 6500000.0, "PENDING", "PENDING", "2024-01-15T09:20:00"),
    ],
    [
        ("PCL-MM-001", "Makati", "PURCHASE", 4500000.0, "APPROVED", "VALID", "2024-01-15T10:00:00"),
        ("PCL-QC-001", "Quezon City", "TRANSFER", 2800000.0, "REJECTED", "INVALID", "2024-01-15T10:05:00"),
        ("PCL-TG-001", "Taguig", "PURCHASE", 5200000.0, "PENDING", "PENDING", "2024-01-15T10:10:00"),
    ],
    [
        ("PCL-BGC-001", "BGC", "TITLE_REGISTRATION", 6500000.0, "APPROVED", "VALID", "2024-01-15T11:00:00"),
        ("PCL-PS-001", "Pasig", "LEASE", 1800000.0, "PENDING", "PENDING", "2024-01-15T11:05:00"),
    ],
]
LAB_SCHEMA = ("parcelId string, area string, transactionType string, transactionAmount double, "
              "status string, validationStatus string, transactionDate string")


def lab_batch(spark: SparkSession, i: int) -> DataFrame:
    """Lab batch ``i`` (0-based) as literal rows with an explicit schema."""
    return (spark.createDataFrame(LAB_BATCHES[i], LAB_SCHEMA)
            .withColumn("transactionId", F.concat(F.lit("TXN-"), F.col("parcelId"),
                                                  F.lit(f"-{i + 1}"))))
