import os
import tempfile

from hitlist.operators import cleaning
from hitlist.sources import read_chart_csv


def test_csv_binds_columns_by_name(spark):
    d = tempfile.mkdtemp(prefix="hitlist-csv-")
    path = os.path.join(d, "chart.csv")
    with open(path, "w") as fh:
        fh.write('Song,Extra,Artist,Date,Rank,Last Week,Peak Position,Weeks in Charts\n')
        fh.write('"Hello, World",zz,"Tyler, The Creator Featuring A",2024-01-06,1,-,1,1\n')
        fh.write('None,zz,"""Q""",2024-01-06,2,1,1,2\n')
    df = read_chart_csv(spark, path)
    assert df.columns == ["Date", "Rank", "Song", "Artist", "Last Week", "Peak Position", "Weeks in Charts"]
    rows = df.orderBy("Rank").collect()
    assert rows[0].Song == "Hello, World" and rows[0].Artist == "Tyler, The Creator Featuring A"
    assert rows[1].Song == "None"  # kept as text (decision: a song titled None is not lost)
    assert rows[1].Artist == '"Q"'
    with open(path, "a") as fh:
        fh.write('"Two\nlines",zz,A,2024-01-06,3,-,3,1\n')
    assert {r.Song for r in read_chart_csv(spark, path, multi_line=True).collect()} >= {"Two\nlines", "Hello, World"}
    df = df.filter("Rank < 3")
    typed = cleaning.typed(df).orderBy("Rank").collect()
    assert typed[0]["Last Week"] == 0 and str(typed[0].Date) == "2024-01-06"
