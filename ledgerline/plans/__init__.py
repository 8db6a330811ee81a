"""The models: DataFrame → DataFrame transforms per table, and their runs.

bronze         landed-record views (incremental / full)
silver         blocks, transactions, messages, attributes, logs
gold           fact projections with their own keys
stats          hourly metrics, priced metrics, price source
observability  gap and count audits
fetching       chain head, completion ledgers, pending work-lists
checks         the table test-suites
docs           column documentation
models         incremental runs (high-water marks, merges) and run_chain
"""
