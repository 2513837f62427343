"""Fixed schemas of the lending tables (declared per column on read)."""

from pyspark.sql.types import (
    DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampNTZType,
)


def _schema(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


SCHEMAS = {
    "loans": _schema(("CustomerID", IntegerType()), ("LoanAmount", IntegerType()),
                     ("LoanTerm", IntegerType()), ("InterestRate", FloatType()),
                     ("ApprovalStatus", StringType())),
    "customers": _schema(("CustomerID", IntegerType()), ("Name", StringType()),
                         ("Surname", StringType()), ("Age", IntegerType()),
                         ("Gender", StringType()), ("Income", IntegerType()),
                         ("Region", StringType())),
    "credit": _schema(("CustomerID", IntegerType()), ("CreditScore", IntegerType()),
                      ("CustomerClass", StringType())),
    "repayments": _schema(("RepaymentID", IntegerType()), ("RepaymentDate", TimestampNTZType()),
                          ("Amount", IntegerType()), ("CustomerID", IntegerType()),
                          ("TimeZone", StringType())),
    "months": _schema(("MonthID", IntegerType()), ("MonthName", StringType())),
    "scheduled": _schema(("LoanID", LongType()), ("LoanAmount", DoubleType()),
                         ("ScheduledRepayment", DoubleType())),
    "actual": _schema(("LoanID", LongType()), ("Month", IntegerType()),
                      ("ActualRepayment", DoubleType())),
}

# Derived tables written by the extract / calendar / ranking steps.
FINANCING = _schema(("CustomerID", LongType()), ("Income", DoubleType()),
                    ("LoanAmount", DoubleType()), ("LoanTerm", IntegerType()),
                    ("InterestRate", DoubleType()), ("ApprovalStatus", StringType()),
                    ("CreditScore", IntegerType()))

# Declared schemas of the parquet tables the role views read.  Reading with a
# declared schema skips footer-based inference on every read and fails loudly
# if a file disagrees.
SOURCE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}
