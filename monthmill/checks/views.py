"""Raw loan, clickstream, attribute and financial sources drawn from the given tables.

Each view keeps every row of its table. Remainders of the keys decide which
cell is dirty, never which row is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SNAPSHOT


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Orders that one task turns into loan rows, eleven each, so that its share of a shuffle or a sort stays in memory.
ORDERS_PER_TASK = 250_000


def _spread(df: DataFrame) -> DataFrame:
    """A table of more rows than one task should multiply, dealt in ranges while it is narrow; the number comes from file footers.

    Ranges keep neighbours together, which compress better than rows dealt at random.
    """
    tasks = -(-df.count() // ORDERS_PER_TASK)
    return df.repartitionByRange(tasks, *df.columns) if tasks > 1 else df


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return orders.select(
        F.col("o_orderkey").alias("ok"),
        F.col("o_custkey").alias("ck"),
        F.col("o_totalprice").alias("price"),
        F.trunc("o_orderdate", "month").alias("month"),
    )


def _cases(n: int, *values) -> Column:
    """The value whose position is the order key's remainder by ``n``, else the last one."""
    out = F.lit(values[-1])
    for i, value in reversed(list(enumerate(values[:-1]))):
        out = F.when(F.col("ok") % n == i, value).otherwise(out)
    return out


def _every(n: int, dirty, clean) -> Column:
    return F.when(F.col("ok") % n == 0, dirty).otherwise(clean)


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a loan of ten installments, with one row per month 0 to 10."""
    k, price = F.col("installment_num"), F.col("price")
    due = F.when((F.col("ok") % 17 == 0) | (k == 0), 0.0).otherwise(price / 10)
    overdue = F.when(F.col("ok") % 13 == 0, None).when(k == 0, 0.0).otherwise(price / 10 * ((F.col("ok") + k) % 4))
    rows = _spread(_orders(spark, sf_dir)).select("*", F.explode(F.sequence(F.lit(0), F.lit(10))).alias("installment_num"))
    return rows.select(
        F.col("ok").cast("string").alias("loan_id"),
        F.col("ck").cast("string").alias("Customer_ID"),
        F.col("month").alias("loan_start_date"),
        F.lit(10).alias("tenure"),
        k,
        price.cast("float").alias("loan_amt"),
        due.cast("float").alias("due_amt"),
        F.when((F.col("ok") + k) % 4 == 0, price / 10).otherwise(0.0).cast("float").alias("paid_amt"),
        overdue.cast("float").alias("overdue_amt"),
        (price - price / 10 * k).cast("float").alias("balance"),
        F.add_months("month", k).alias("snapshot_date"),
    )


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a monthly clickstream row of its user."""
    event = F.col("event_id")
    base = F.floor("value").cast("int")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return events.select(
        *[(base + (event * i % 101).cast("int")).alias(f"fe_{i}") for i in range(1, 21)],
        F.col("user_id").cast("string").alias("Customer_ID"),
        F.add_months(F.lit("1995-01-01").cast("date"), (event % 80).cast("int")).alias("snapshot_date"),
    )


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: its customer's attributes in that month."""
    c = F.col("c_custkey")
    age = F.when(c % 101 == 0, -500).when(c % 53 == 0, 8678).otherwise(c % 60 + 18)
    ssn = F.concat_ws(
        "-",
        F.lpad((c % 1000).cast("string"), 3, "0"),
        F.lpad((c % 100).cast("string"), 2, "0"),
        F.lpad((c * 7 % 10000).cast("string"), 4, "0"),
    )
    occupation = F.when(c % 13 == 0, "_______").when(F.col("ok") % 5 == 0, "Media_Manager").otherwise(F.col("c_mktsegment"))
    customers = table(spark, sf_dir, "customer")
    return _orders(spark, sf_dir).join(customers, F.col("ck") == c).select(
        c.cast("string").alias("Customer_ID"),
        F.col("c_name").alias("Name"),
        F.concat(age.cast("string"), F.when(c % 19 == 0, "_").otherwise("")).alias("Age"),
        F.when(c % 17 == 0, "#F%$D@*&8").otherwise(ssn).alias("SSN"),
        occupation.alias("Occupation"),
        F.col("month").alias("snapshot_date"),
    )


def financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: its customer's finances in that month, dirty as text."""
    ok, price = F.col("ok"), F.col("price")
    text = price.cast("string")

    def number(n, shift=0):
        return (ok % n + shift).cast("string")

    return _orders(spark, sf_dir).select(
        F.col("ck").cast("string").alias("Customer_ID"),
        F.concat(
            _every(7, "_", ""), _every(11, -price, price).cast("string"), _every(5, "_", "")
        ).alias("Annual_Income"),
        _every(9, None, price / 12).alias("Monthly_Inhand_Salary"),
        number(19, -1).alias("Num_Bank_Accounts"),
        number(25).alias("Num_Credit_Card"),
        number(50, -3).alias("Interest_Rate"),
        F.concat(number(9), _every(8, "_", "")).alias("Num_of_Loan"),
        _cases(
            6, "", "Auto Loan", "Auto Loan, Payday Loan", "Credit-Builder Loan, and Student Loan",
            "Auto Loan, Auto Loan", None,
        ).alias("Type_of_Loan"),
        number(130, -10).alias("Delay_from_due_date"),
        _every(12, None, F.concat(number(40, -2), _every(10, "_", ""))).alias("Num_of_Delayed_Payment"),
        _every(14, "_", text).alias("Changed_Credit_Limit"),
        _every(11, None, number(41)).alias("Num_Credit_Inquiries"),
        _cases(4, "Good", "Standard", "Bad", "_").alias("Credit_Mix"),
        F.concat(text, _every(20, "_", "")).alias("Outstanding_Debt"),
        (price / 10000).alias("Credit_Utilization_Ratio"),
        _every(
            31, None,
            _every(
                29, "NA",
                _every(23, "1 Year and 3 Months", F.concat(number(30), F.lit(" Years and "), number(12), F.lit(" Months"))),
            ),
        ).alias("Credit_History_Age"),
        _cases(3, "Yes", "No", "NM").alias("Payment_of_Min_Amount"),
        (price / 100).alias("Total_EMI_per_month"),
        _every(21, "__10000__", text).alias("Amount_invested_monthly"),
        _cases(
            7, "High_spent_Large_value_payments", "High_spent_Medium_value_payments",
            "High_spent_Small_value_payments", "Low_spent_Large_value_payments",
            "Low_spent_Medium_value_payments", "Low_spent_Small_value_payments", "!@9#%8",
        ).alias("Payment_Behaviour"),
        _every(33, "__-333333333333333333333333333__", text).alias("Monthly_Balance"),
        F.col("month").alias("snapshot_date"),
    )


def attribute_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw attributes as lines of eight CSV files, ``file`` and ``line``, some of them torn, too long, quoted or undated."""
    c, cells = F.col("Customer_ID").cast("long"), ["Customer_ID", "Name", "Age", "SSN", "Occupation", SNAPSHOT]
    rows = attributes(spark, sf_dir).withColumn(SNAPSHOT, F.when(c % 19 == 3, "soon").otherwise(F.col(SNAPSHOT).cast("string")))
    file = c % 8
    # Only half of the files have cells with line feeds.
    name = F.when((c % 13 == 2) & (file < 4), F.concat(F.lit('"'), F.replace("Name", F.lit("#"), F.lit("\n")), F.lit('"')))
    name = name.when(c % 5 == 1, F.concat(F.lit('"a ""quoted"", '), F.col("Name"), F.lit('"'))).otherwise(F.col("Name"))
    line = F.concat_ws(",", F.col("Customer_ID"), name, *cells[2:])
    line = F.when(c % 7 == 4, F.concat_ws(",", *cells[:4])).when(c % 11 == 5, F.concat(line, F.lit(",more"))).otherwise(line)
    lines = rows.select(file.cast("int").alias("file"), F.lit(1).alias("place"), line.alias("line"))
    heads = spark.range(8).select(F.col("id").cast("int").alias("file"), F.lit(0).alias("place"), F.lit(",".join(cells)).alias("line"))
    return lines.unionByName(heads)
