"""hitlist: weekly chart history and workforce analytics as Spark DataFrame plans.

Layout
------
sources/    scans: chart CSV (S1), driver-table derivations, parquet sinks (S2, S3, S13)
functions/  Column expressions: exact 2-dp averages (N1), artist-credit cleaning (U5-U11)
operators/  DataFrame -> DataFrame stages: cleaning, surrogate keys, star model,
            employee model, analyses, integrity checks, insert-if-absent
streaming/  weekly high-water-mark refresh (S4-S7, U12, U13)
plans/      pipelines that compose and persist the stages; query catalog
"""

__all__ = ["session"]
