"""The audit of written tables counts rows and bytes in one pass, without grouping rows by file."""

import os
import tempfile

from lapsekit.operators.monitoring import table_audit


def test_audit_counts_rows_and_bytes_of_files_without_grouping(spark):
    path = f"{tempfile.mkdtemp(prefix='lapsekit-audit-')}/t"
    spark.range(0, 1000, numPartitions=4).write.parquet(path)
    spark.range(0).write.parquet(f"{path}-empty")
    audit = table_audit(spark, {"t": path, "none": f"{path}-empty"})
    assert "file_path" not in audit._jdf.queryExecution().optimizedPlan().toString()
    got = {r.object_name: r for r in audit.collect()}
    files = [os.path.join(path, f) for f in os.listdir(path) if f.endswith(".parquet")]
    assert (got["t"].row_count, got["t"].size_bytes) == (1000, sum(map(os.path.getsize, files))) and len(files) == 4
    assert abs(got["t"].last_built_at.timestamp() - max(map(os.path.getmtime, files))) < 86_400
    assert (got["none"].row_count, got["none"].size_bytes, got["none"].last_built_at) == (0, 0, None)
