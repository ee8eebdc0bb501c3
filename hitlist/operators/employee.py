"""Employee model M7-M10: departments, employees, support ratings, sales totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlist.operators.keys import with_dense_id

EMPLOYEE_COLUMNS = [
    "EmployeeID",
    "EmployeeName",
    "Age",
    "Department",
    "DateOfJoining",
    "YearsOfExperience",
    "Country",
    "Salary",
    "PerformanceRating",
]


def department_names(data: DataFrame) -> DataFrame:
    """M7 without ids: one row per distinct department (a NULL department is a row)."""
    return data.select(F.col("Department").alias("DepartmentName")).distinct()


def departments(data: DataFrame) -> DataFrame:
    """M7 with K1 ids (rank of the name)."""
    return with_dense_id(department_names(data), ["DepartmentName"], "DepartmentID").select("DepartmentID", "DepartmentName")


def employees(data: DataFrame) -> DataFrame:
    """M8: the nine employee columns."""
    return data.select(*EMPLOYEE_COLUMNS)


def support_ratings(data: DataFrame) -> DataFrame:
    """M9: support staff and their rating."""
    return data.filter(F.col("Department") == "Support").select("EmployeeID", "SupportRating")


def total_sales(data: DataFrame) -> DataFrame:
    """Sales staff and their sales total."""
    return data.filter(F.col("Department") == "Sales").select("EmployeeID", "TotalSales")


def build(data: DataFrame) -> dict[str, DataFrame]:
    return {
        "department": departments(data),
        "employee": employees(data),
        "support_ratings": support_ratings(data),
        "total_sales": total_sales(data),
    }
