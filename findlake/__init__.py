"""findlake: security findings as Spark DataFrames.

Raw tool reports and source files of many scans go in; one normalised findings table, per-scan
summaries, gates and reports come out. Everything is keyed by ``scan_id``.
"""
