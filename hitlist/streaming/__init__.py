"""Weekly refresh of the chart history.

The refresh is batch with a high-water mark: the whole chart file is fetched
again each week and only rows dated after the newest stored date are taken.
"""

from hitlist.streaming.refresh import high_water_mark, new_rows, refresh_source

__all__ = ["high_water_mark", "new_rows", "refresh_source"]
