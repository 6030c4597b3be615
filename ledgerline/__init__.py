"""ledgerline: a Spark-native funding/payout reconciliation ledger.

Operators are lazy ``DataFrame -> DataFrame`` functions built from Spark's own expressions,
aggregations, joins and windows (no UDFs). See README.md for the operator map.
"""

__version__ = "0.1.0"
