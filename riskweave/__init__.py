"""riskweave: counterparty-risk analytics as Spark DataFrame jobs.

Every operator takes DataFrames and returns a DataFrame (or a tuple of them).
Nothing is collected to the driver; the plans are left to Catalyst and AQE.
"""

__version__ = "0.1.0"
