from hitlist.sources.tables import read_table
from hitlist.sources.chart import chart_rows, read_chart_csv, bootstrap_flagged
from hitlist.sources.employee import employee_rows, read_employee_data

__all__ = ["read_table", "chart_rows", "read_chart_csv", "bootstrap_flagged", "employee_rows", "read_employee_data"]
