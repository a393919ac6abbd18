"""starmart: a star-schema submissions warehouse and its reports on Spark.

Typical use::

    from starmart import build_star, read_submissions_csv, reports, views, build_marts
    star = build_star(spark, read_submissions_csv(spark, path), PRIZE_YEARS, dataset="prize")
    reports.q04(star).show()
    marts = build_marts(spark, star)
    views.v03(marts, years=(2018, 2022), genres=["Romance"]).show()
"""

from starmart.params import PRIZE_YEARS, TESTDATA_YEARS, TimeBuckets
from starmart.plans import reports, views
from starmart.plans.marts import build_marts, live_marts, read_marts
from starmart.plans.star import build_star
from starmart.sources.csv import read_submissions_csv, write_submissions_csv
from starmart.sources.warehouse import Star, open_star, read_star

__all__ = [
    "PRIZE_YEARS",
    "Star",
    "TESTDATA_YEARS",
    "TimeBuckets",
    "build_marts",
    "build_star",
    "live_marts",
    "open_star",
    "read_marts",
    "read_star",
    "read_submissions_csv",
    "reports",
    "views",
    "write_submissions_csv",
]
