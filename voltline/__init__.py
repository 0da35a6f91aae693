"""voltline: load tagged-line market report files with Spark and query them with Spark SQL.

The package is organised by role:

- ``sources``   : readers that turn files, archives, listing pages and ledgers into DataFrames
- ``functions`` : Column expressions (file-name routing, periods, text clean-up, timestamps)
- ``operators`` : DataFrame -> DataFrame steps (parse, infer, align, dedupe, load, ledger)
- ``plans``     : whole jobs (acquisition planning, inbox load, SQL access)
- ``streaming`` : the same load as a Structured Streaming query
"""

__version__ = "0.1.0"
