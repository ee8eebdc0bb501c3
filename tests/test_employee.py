import datetime as dt

from hitlist.operators import analyses, employee
from hitlist.schemas import EMPLOYEE_DATA

D = dt.date(2020, 1, 1)


def _data(spark):
    rows = [
        # id, name, age, dept, joined, years, country, salary, rating, support, sales
        (1, "a", 30, "Sales", D, 0, "X", 100.00, 1, 1, 10.00),
        (2, "b", 30, "Sales", D, 1, "X", 101.01, 1, 1, 10.01),
        (3, "c", 30, "Sales", D, 5, "X", 100.00, 3, 1, None),
        (4, "d", 30, "Support", D, 6, "X", 100.00, 2, 4, None),
        (5, "e", 30, None, D, 21, "X", 100.00, 2, 1, None),
        (6, "f", 30, "Support", D, None, "X", 100.00, 4, 2, None),
        (7, "g", 30, "Other", D, 20, "X", 100.00, 5, 2, None),
        (8, "h", 30, "Other", D, 16, "X", 100.00, 5, 2, None),
    ]
    return spark.createDataFrame(rows, EMPLOYEE_DATA)


def test_model_tables(spark):
    data = _data(spark)
    m = employee.build(data)
    deps = [(r.DepartmentID, r.DepartmentName) for r in m["department"].orderBy("DepartmentID").collect()]
    assert deps == [(1, "Other"), (2, "Sales"), (3, "Support"), (4, None)]  # NULLS LAST, NULL kept
    assert len(m["employee"].columns) == 9
    assert sorted(r.EmployeeID for r in m["support_ratings"].collect()) == [4, 6]
    assert sorted(r.EmployeeID for r in m["total_sales"].collect()) == [1, 2, 3]


def test_tenure_buckets(spark):
    df = spark.createDataFrame([(v,) for v in [0, 1, 5, 6, 10, 11, 15, 16, 20, 21, None]], "y int")
    got = [r.t for r in df.select(analyses.tenure_bucket(df.y).alias("t")).collect()]
    assert got == [None, "0-5", "0-5", "6-10", "6-10", "11-15", "11-15", "16-20", "16-20", None, None]


def test_employee_analyses(spark):
    data = _data(spark)
    m = employee.build(data)
    a4 = {r.department_name: r.average_performance for r in analyses.performance_by_department(m["employee"], m["department"]).collect()}
    assert a4 == {"Sales": 1.67, "Support": 3.0, "Other": 5.0, None: 2.0}
    a5 = [(r.performance_rating, r.average_salary) for r in analyses.performance_by_salary(m["employee"]).collect()]
    assert a5[0] == (1, 100.51)  # (100.00 + 101.01) / 2 = 100.505 -> 100.51
    a6 = [r.tenure for r in analyses.performance_by_tenure(m["employee"]).collect()]
    assert a6 == ["0-5", "6-10", "16-20", None]
    a9 = {r.performancerating: r.average_total_sales for r in analyses.sales_by_performance(m["employee"], m["total_sales"]).collect()}
    assert a9 == {1: 10.01, 3: None}  # 10.005 -> 10.01; rating 3 has no sales
    a7 = {r.department_name for r in analyses.salary_by_department(m["employee"]).collect()}
    assert None in a7
