"""Print the formatted physical plans of representative registered queries.

    python scripts/show_plans.py [/root/testdata/sf0.01] > PLANS.txt
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tributary.queries import QUERIES  # noqa: E402
from tributary.session import local_session  # noqa: E402

KEYS = ["payload_records", "payload_scalar", "run_audit", "run_history_topk", "fetch_fanout", "source_configs"]


def staging_job(spark, sf):
    """The plan of normalize's staging job (parse once, explode, observe the schema)."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    from tributary.operators.payload import explode_records, response_records
    from tributary.operators.schema import schema_metrics

    o = spark.read.parquet(f"{sf}/orders.parquet")
    responses = o.select(F.col("o_orderkey").alias("seq"),
                         F.to_json(F.struct("o_orderkey", "o_totalprice")).alias("body"))
    records = explode_records(response_records(responses, keep_body=True))
    return records.observe(Observation(), *schema_metrics(records)).drop("_body0", "wrapped")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    df = staging_job(spark, sf)
    print("## normalize: the staging job (before its parquet write)\n")
    print("```")
    print(df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
    print("```\n")
    for key in KEYS:
        df = QUERIES[key](spark, sf)
        print(f"## {key}\n")
        print("```")
        print(df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
        print("```\n")


if __name__ == "__main__":
    main()
