"""Explicit schemas of every stage (no inference anywhere)."""

from pyspark.sql import types as T

# Raw chart columns, selected by header name; the CSV is read as strings.
CHART_COLUMNS = ["Date", "Rank", "Song", "Artist", "Last Week", "Peak Position", "Weeks in Charts"]

CHART_RAW = T.StructType(
    [
        T.StructField("Date", T.StringType()),
        T.StructField("Rank", T.IntegerType()),
        T.StructField("Song", T.StringType()),
        T.StructField("Artist", T.StringType()),
        T.StructField("Last Week", T.StringType()),
        T.StructField("Peak Position", T.IntegerType()),
        T.StructField("Weeks in Charts", T.IntegerType()),
    ]
)

#: What the cells of a chart file must be; "Last Week" has a sentinel and stays text.
CHART_TYPED = T.StructType([T.StructField(f.name, T.DateType() if f.name == "Date" else f.dataType) for f in CHART_RAW.fields])

CHART_CLEAN = T.StructType(
    [
        T.StructField("Date", T.DateType()),
        T.StructField("Rank", T.IntegerType()),
        T.StructField("Song", T.StringType()),
        T.StructField("Artist", T.StringType()),
        T.StructField("Last Week", T.IntegerType()),
        T.StructField("Peak Position", T.IntegerType()),
        T.StructField("Weeks in Charts", T.IntegerType()),
        T.StructField("is_new", T.BooleanType()),
        T.StructField("Featured_Artist", T.StringType()),
    ]
)

SONGS = T.StructType(
    [
        T.StructField("SongID", T.LongType(), False),
        T.StructField("SongTitle", T.StringType()),
        T.StructField("SongRank", T.IntegerType()),
        T.StructField("PeakPosition", T.IntegerType()),
        T.StructField("WeeksInCharts", T.IntegerType()),
        T.StructField("DebutDate", T.DateType()),
    ]
)

ARTISTS = T.StructType([T.StructField("ArtistID", T.LongType(), False), T.StructField("ArtistName", T.StringType())])

FEATURES = T.StructType(
    [
        T.StructField("SongID", T.LongType(), False),
        T.StructField("ArtistID", T.LongType(), False),
        T.StructField("Contribution", T.StringType()),
    ]
)

ENTRIES = T.StructType(
    [
        T.StructField("EntryDate", T.DateType(), False),
        T.StructField("SongID", T.LongType(), False),
        T.StructField("SongRank", T.IntegerType()),
        T.StructField("PeakPosition", T.IntegerType()),
        T.StructField("LastWeek", T.IntegerType()),
        T.StructField("WeeksInCharts", T.IntegerType()),
    ]
)

EMPLOYEE_DATA = T.StructType(
    [
        T.StructField("EmployeeID", T.IntegerType()),
        T.StructField("EmployeeName", T.StringType()),
        T.StructField("Age", T.IntegerType()),
        T.StructField("Department", T.StringType()),
        T.StructField("DateOfJoining", T.DateType()),
        T.StructField("YearsOfExperience", T.IntegerType()),
        T.StructField("Country", T.StringType()),
        T.StructField("Salary", T.DoubleType()),
        T.StructField("PerformanceRating", T.IntegerType()),
        T.StructField("SupportRating", T.IntegerType()),
        T.StructField("TotalSales", T.DoubleType()),
    ]
)

DEPARTMENT = T.StructType([T.StructField("DepartmentID", T.LongType(), False), T.StructField("DepartmentName", T.StringType())])

EMPLOYEE = T.StructType([f for f in EMPLOYEE_DATA.fields if f.name not in ("SupportRating", "TotalSales")])

SUPPORT_RATINGS = T.StructType([T.StructField("EmployeeID", T.IntegerType()), T.StructField("SupportRating", T.IntegerType())])

TOTAL_SALES = T.StructType([T.StructField("EmployeeID", T.IntegerType()), T.StructField("TotalSales", T.DoubleType())])

# Declared VARCHAR limits of the model (checked by operators.quality.length_violations).
LENGTH_LIMITS = {
    "songs": {"SongTitle": 200},
    "artists": {"ArtistName": 100},
    "features": {"Contribution": 10},
    "chart": {"Featured_Artist": 100},
    "department": {"DepartmentName": 100},
    "employee": {"EmployeeName": 100, "Department": 100, "Country": 100},
}
