"""The literal dimension rows (SRC4): small tables given by their values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The literal dimension rows, in order.
CARRIER_ROWS = [
    ("CAR001", "BlueDart Express", "Express", "Pan-India", 0.92, True),
    ("CAR002", "Delhivery", "Standard", "Pan-India", 0.87, True),
    ("CAR003", "DTDC Courier", "Economy", "Pan-India", 0.81, True),
    ("CAR004", "Gati Ltd", "Freight", "North & West India", 0.85, True),
    ("CAR005", "Rivigo", "Long-Haul", "Pan-India", 0.89, True),
    ("CAR006", "Ecom Express", "E-commerce", "Metro Cities", 0.90, True),
    ("CAR007", "Shadowfax", "Last-Mile", "Metro Cities", 0.88, True),
    ("CAR008", "XpressBees", "Express", "Pan-India", 0.86, True),
]
CUSTOMER_ROWS = [
    ("CUST001", "Acme Corp", "Enterprise", "Mumbai", "Maharashtra", "India", "logistics@acme.com", "2024-01-15"),
    ("CUST002", "Beta Industries", "Mid-Market", "Chennai", "Tamil Nadu", "India", "ops@beta.in", "2024-02-10"),
    ("CUST003", "Gamma Retail", "SMB", "Delhi", "Delhi", "India", "supply@gamma.in", "2024-03-01"),
    ("CUST004", "Delta Pharma", "Enterprise", "Hyderabad", "Telangana", "India", "dist@deltapharma.com", "2024-04-20"),
    ("CUST005", "Epsilon Electronics", "Mid-Market", "Bangalore", "Karnataka", "India", "fulfillment@epsilon.in", "2024-05-12"),
    ("CUST006", "Zeta Foods", "SMB", "Pune", "Maharashtra", "India", "delivery@zetafoods.in", "2024-06-01"),
    ("CUST007", "Eta Auto Parts", "Enterprise", "Ahmedabad", "Gujarat", "India", "logistics@etaauto.com", "2024-07-15"),
    ("CUST008", "Theta Textiles", "Mid-Market", "Kolkata", "West Bengal", "India", "supply@theta.in", "2024-08-22"),
    ("CUST009", "Iota Chemicals", "Enterprise", "Jaipur", "Rajasthan", "India", "ops@iota.com", "2024-09-10"),
    ("CUST010", "Kappa Logistics", "SMB", "Lucknow", "Uttar Pradesh", "India", "dispatch@kappa.in", "2024-10-05"),
]


def literal_carriers(spark: SparkSession) -> DataFrame:
    """SRC4: the 8 literal carriers (positional VALUES insert)."""
    from .. import schemas
    return spark.createDataFrame(CARRIER_ROWS, schemas.DIM_CARRIERS)


def literal_customers(spark: SparkSession) -> DataFrame:
    """SRC4: the 10 literal customers; the date text becomes a TIMESTAMP_NTZ."""
    from .. import schemas
    df = spark.createDataFrame(CUSTOMER_ROWS, [f.name for f in schemas.DIM_CUSTOMERS.fields])
    return df.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
