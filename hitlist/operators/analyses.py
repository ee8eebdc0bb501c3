"""Summaries A1-A9. Every mean is the exact 2-decimal N1 mean.

Groups are few (months, artists, departments, ratings, tenure buckets), so each
aggregate is a map-side partial aggregate followed by a small shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlist.functions.numeric import avg2, avg2_money, finish_mean, mean_parts


def month_name(d: Column) -> Column:
    """Full month name blank-padded to 9 characters ('May      ')."""
    return F.rpad(F.date_format(d, "MMMM"), 9, " ")


def month_rows(df: DataFrame, date_col: str, label: str) -> DataFrame:
    """Peak and longevity with the month of a date."""
    return df.select(
        F.month(date_col).cast("int").alias("month_number"),
        month_name(F.col(date_col)).alias(label),
        "PeakPosition",
        "WeeksInCharts",
    )


def _by_month(df: DataFrame, date_col: str, label: str) -> DataFrame:
    return (
        month_rows(df, date_col, label)
        .groupBy("month_number", label)
        .agg(avg2("PeakPosition").alias("average_peak_position"), avg2("WeeksInCharts").alias("average_longevity"))
        .orderBy(F.col("month_number").asc_nulls_last())
    )


def debut_month(songs: DataFrame) -> DataFrame:
    """A1: mean peak and longevity of songs by month of debut."""
    return _by_month(songs, "DebutDate", "debut_month")


def at_peak(songs: DataFrame, entries: DataFrame) -> DataFrame:
    """Songs with every week they sat at their PeakPosition.

    A left join with ``EntryDate IS NOT NULL`` on the right is an inner join.
    """
    s = songs.select("SongID", "PeakPosition", "WeeksInCharts")
    e = entries.select(F.col("SongID").alias("e_song"), "SongRank", "EntryDate")
    return s.join(e, (s.SongID == e.e_song) & (s.PeakPosition == e.SongRank)).filter(F.col("EntryDate").isNotNull())


def peak_month(songs: DataFrame, entries: DataFrame) -> DataFrame:
    """A2: songs joined to every week they sat at their PeakPosition, by entry month."""
    return _by_month(at_peak(songs, entries), "EntryDate", "peak_month")


def hit_rows(songs: DataFrame, features: DataFrame, artists: DataFrame) -> DataFrame:
    """(artistname, WeeksInCharts) of the primary acts of top-5 songs.

    (SongID, ArtistID) is the key of features, SongID of songs and ArtistID/ArtistName
    of artists (Q1/Q2), so the joined rows are already distinct per (artist, song):
    a plain count equals COUNT(DISTINCT songid) without a second shuffle.
    """
    s = songs.filter(F.col("PeakPosition") <= 5).select("SongID", "WeeksInCharts")
    f = features.filter(F.col("Contribution") == "Primary").select(F.col("SongID").alias("f_song"), "ArtistID")
    a = artists.select(F.col("ArtistID").alias("a_id"), F.col("ArtistName").alias("artistname"))
    return s.join(f, s.SongID == f.f_song).join(a, F.col("ArtistID") == a.a_id).select("artistname", "WeeksInCharts")


def artist_longevity(songs: DataFrame, features: DataFrame, artists: DataFrame) -> DataFrame:
    """A3: primary acts of top-5 songs: number of such songs and their mean weeks."""
    return (
        hit_rows(songs, features, artists)
        .groupBy("artistname")
        .agg(F.count(F.lit(1)).alias("hit_songs"), avg2("WeeksInCharts").alias("avg_weeks_in_chart"))
        .orderBy(F.col("hit_songs").desc(), F.col("artistname").asc_nulls_last())
    )


# First and last year of each tenure label (whole years).
TENURES = [(1, 5, "0-5"), (6, 10, "6-10"), (11, 15, "11-15"), (16, 20, "16-20")]


def tenure_bucket(years: Column) -> Column:
    """Tenure label; 0 years, more than 20 and NULL fall in no bucket (NULL)."""
    out = F.lit(None).cast("string")
    for first, last, label in TENURES:
        out = F.when(years.between(first, last), F.lit(label)).otherwise(out)
    return out


def _tenure_order(c: str = "tenure") -> Column:
    return F.split_part(F.col(c), F.lit("-"), F.lit(1)).cast("int").asc_nulls_last()


def performance_by_department(employee: DataFrame, department: DataFrame) -> DataFrame:
    """A4: mean rating per department; employees without a matching department
    (including a NULL department) form the NULL group. Of ``department`` only the
    names are used, so it need not be numbered.

    Employees are aggregated per department name first (partial, map-side), so the
    left join with the department table only sees one row per name.
    """
    per_name = employee.groupBy("Department").agg(*mean_parts("PerformanceRating"))
    d = department.select("DepartmentName")
    j = per_name.join(d, per_name.Department == d.DepartmentName, "left")
    return (
        j.groupBy(F.col("DepartmentName").alias("department_name"))
        .agg(F.sum("_m_sum").alias("_s"), F.sum("_m_cnt").alias("_n"))
        .select("department_name", finish_mean("_s", "_n").alias("average_performance"))
    )


def performance_by_salary(employee: DataFrame) -> DataFrame:
    """A5: mean salary per performance rating."""
    return (
        employee.groupBy(F.col("PerformanceRating").alias("performance_rating"))
        .agg(avg2_money("Salary").alias("average_salary"))
        .orderBy(F.col("performance_rating").asc_nulls_last())
    )


def performance_by_tenure(employee: DataFrame) -> DataFrame:
    """Mean rating per tenure bucket."""
    return (
        employee.groupBy(tenure_bucket(F.col("YearsOfExperience")).alias("tenure"))
        .agg(avg2("PerformanceRating").alias("average_performance"))
        .orderBy(_tenure_order())
    )


def salary_by_department(employee: DataFrame) -> DataFrame:
    """Mean salary per department (as stored on the employee)."""
    return employee.groupBy(F.col("Department").alias("department_name")).agg(avg2_money("Salary").alias("average_salary"))


def salary_by_tenure(employee: DataFrame) -> DataFrame:
    """Mean salary per tenure bucket."""
    return (
        employee.groupBy(tenure_bucket(F.col("YearsOfExperience")).alias("tenure"))
        .agg(avg2_money("Salary").alias("average_salary"))
        .orderBy(_tenure_order())
    )


def sales_by_performance(employee: DataFrame, total_sales: DataFrame) -> DataFrame:
    """Sales staff only: mean sales total per rating (NULL when none has sales)."""
    e = employee.filter(F.col("Department") == "Sales").select("EmployeeID", "PerformanceRating")
    t = total_sales.select(F.col("EmployeeID").alias("t_id"), "TotalSales")
    j = e.join(t, e.EmployeeID == t.t_id, "left")
    return (
        j.groupBy(F.col("PerformanceRating").alias("performancerating"))
        .agg(avg2_money("TotalSales").alias("average_total_sales"))
        .orderBy(F.col("performancerating").asc_nulls_last())
    )
