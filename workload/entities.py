"""The supplied tables in the shape of the three guarded entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workload.tables import table


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    first, last = F.split_part("c_name", F.lit("#"), F.lit(1)), F.split_part("c_name", F.lit("#"), F.lit(2))
    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("customer_id"),
        first.alias("first_name"),
        last.alias("last_name"),
        F.lower(F.concat(first, F.lit("."), last, F.lit("@example.com"))).alias("email"),
        F.concat(F.lit("+1-555-"), F.lpad((key % 10000).cast("string"), 4, "0")).alias("phone"),
        F.date_add(F.lit("1950-01-01").cast("date"), (key % 18000).cast("int")).alias("date_of_birth"),
        F.concat((key % 9999 + 1).cast("string"), F.lit(" Main St")).alias("address_line1"),
        F.concat(F.lit("City "), F.col("c_nationkey").cast("string")).alias("city"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("country"),
        F.when(F.col("c_mktsegment") == "BUILDING", "PENDING").otherwise("VERIFIED").alias("kyc_status"),
        F.when(F.col("c_acctbal") < 0, "HIGH").when(F.col("c_acctbal") < 5000, "MEDIUM")
        .otherwise("LOW").alias("risk_rating"),
        F.date_add(F.lit("2015-01-01").cast("date"), (key % 3000).cast("int")).alias("onboarded_date"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("account_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(status == "F", "SAVINGS").when(status == "O", "CHECKING").otherwise("LOAN")
        .alias("account_type"),
        F.col("o_totalprice").alias("balance"),
        F.lit("USD").alias("currency"),
        F.when(F.col("o_orderpriority") == "5-LOW", "DORMANT").otherwise("ACTIVE").alias("status"),
        F.col("o_orderdate").cast("date").alias("opened_date"),
        F.concat(F.lit("BR-"), F.lpad((F.col("o_custkey") % 50 + 1).cast("string"), 3, "0"))
        .alias("branch_code"),
        F.col("o_orderdate").cast("timestamp").alias("last_activity_date"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("user_id").cast("string").alias("account_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.when(kind == "view", "DEBIT").when(kind == "click", "CREDIT")
        .when(kind == "purchase", "PAYMENT").otherwise("TRANSFER").alias("transaction_type"),
        F.col("value").alias("amount"),
        F.lit("USD").alias("currency"),
        F.col("ts").cast("timestamp").alias("transaction_date"),
        F.concat(F.lit("Merchant "), (F.col("user_id") % 37).cast("string")).alias("merchant_name"),
        F.lit("RETAIL").alias("merchant_category"),
        F.lit("ONLINE").alias("channel"),
        F.when(kind == "error", "FAILED").otherwise("COMPLETED").alias("status"),
        (F.col("value") > 300).alias("fraud_flag"),
    )


BASELINES = {"transactions": transactions, "accounts": accounts, "customers": customers}
