import os
import tempfile

from pyspark.sql import functions as F

from hitlist.__main__ import main
from hitlist.plans import pipeline
from hitlist.sources import chart_rows, employee_rows
from tests.conftest import SF_SMALL


def test_cli_flows(spark):
    d = tempfile.mkdtemp(prefix="hitlist-cli-")
    raw = chart_rows(spark, SF_SMALL)
    newest = raw.agg(F.max("Date")).first()[0]
    hist_csv, full_csv, emp_csv = (os.path.join(d, n) for n in ["hist", "full", "emp"])
    raw.filter(F.col("Date") < newest).write.option("header", True).csv(hist_csv)
    raw.write.option("header", True).csv(full_csv)
    employee_rows(spark, SF_SMALL).write.option("header", True).csv(emp_csv)
    root = os.path.join(d, "out")
    assert main(["bootstrap", "--chart", hist_csv, "--root", root], spark) == 0
    assert main(["weekly", "--chart", full_csv, "--root", root, "--from", "v1", "--to", "v2"], spark) == 0
    assert main(["employees", "--data", emp_csv, "--root", root, "--version", "v2"], spark) == 0
    assert main(["check", "--root", root, "--version", "v2"], spark) == 0
    assert pipeline.read_chart(spark, root, "v2")["clean"].count() == raw.count()
    a9 = pipeline.read_summary(spark, root, "v2", "sales_by_performance_analysis").collect()
    assert [r.performancerating for r in a9] == sorted(r.performancerating for r in a9)
