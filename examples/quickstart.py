"""A tour of the main flows on the small test tables.

    python examples/quickstart.py [/root/testdata/sf0.001]

Log lines are derived from the ``events`` table (see plans/fixtures.py), landed as
text files, then read, parsed, checked, scored and routed with signals.api.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from signals import api  # noqa: E402
from signals.plans.fixtures import raw_logs  # noqa: E402
from signals.session import local_session, scratch_path  # noqa: E402


def main(sf_dir: str) -> None:
    spark = local_session(4)

    # Sources: land the lines as files, read them back with line numbers and byte offsets (A1, A3).
    landing = scratch_path(spark, "quickstart-landing")
    api.write_lines(raw_logs(spark, sf_dir).coalesce(2), landing)
    lines = api.stamp(api.read_logs(spark, landing), "acme", "file_event")
    lines.select("file_path", "line_no", "offset", "raw_data").orderBy("file_path", "line_no").show(3, truncate=60)

    # Parsing: header, then the key-value rule; errors would go to quarantine.
    parsed = api.normalize(api.parse_header(lines), {"type": "kv"}, input_col="body")
    good, quarantine = api.split_quarantine(parsed)
    events = good.select(
        F.concat_ws(":", "file_path", F.col("line_no").cast("string")).alias("event_id"),  # a stable line id
        "tenant_id", "log_type", F.col("event_time").cast("timestamp_ntz").alias("event_time"),
        F.col("parsed")["user"].alias("user"), F.col("parsed")["value"].try_cast("double").alias("value"),
    )

    # Detection, scoring and response.
    rules = [api.Rule("BruteForce_Login", "log_type = 'error'", "Major"), api.Rule("HighValue", "value > 400", "Critical")]
    det = api.detect_rules(events, rules).withColumnRenamed("user", "entity")
    api.detect_threshold(events, ["tenant_id", "user"], "event_time", "1 day", 2).show(3)
    scores = api.risk_scores(det)
    api.top_risks(scores, "acme", 5).show()
    queue, unmatched = api.assign_responses(det, api.policy_table(spark, {"BruteForce_Login": "Isolate_Host"}))
    print("response rows:", queue.count(), "unmatched detections:", unmatched.count())

    # Schema inference and training.
    hist = api.train_schemas(parsed, scratch_path(spark, "quickstart-tenants"), scratch_path(spark, "quickstart-history"))
    hist.select("tenant_id", "log_type", "accuracy", "processed_count").show()

    # Grep and routing over whole documents.
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    api.route(docs, {"pii": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "license": "License"}, col="text").groupBy("route").count().show()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001")
