"""Sources and sinks.

files    landed JSON scans (full / recent / dated folders), number sequences
derived  chain-shaped bronze records derived from the analytics tables
landing  landed tables in the shared checkpoint folder, existence checks
sinks    clustered Parquet writes, partition-scoped merges, watermarks, work-lists
"""
