"""Customer-lifecycle analytics on Spark DataFrames.

``functions``  column expressions (dates, money, percentages, tiers)
``operators``  DataFrame -> DataFrame analytics
``sources``    tables, extracts, layout and export
``plans``      jobs and reports built from the above
``catalog``    runnable queries on the star schema, with SQL to check them
"""
