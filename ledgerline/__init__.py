"""ledgerline: chain-data analytics (bronze → silver → gold → audits) on PySpark.

Every public function returns a lazy DataFrame or Column; nothing is
collected to the driver except single scalars (high-water marks, bounds).
"""

__version__ = "0.1.0"
