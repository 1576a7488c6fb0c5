"""riskweave: transaction-risk analytics expressed as Spark DataFrame jobs.

Every operator takes a DataFrame (plus explicit roles/parameters) and returns
a lazy DataFrame. Driver-side work is limited to schema inspection and small
fitted tables whose size is bounded by a parameter (grid points, buckets,
vocabulary entries), never by the number of rows.
"""

from riskweave.roles import Roles

__all__ = ["Roles"]
__version__ = "0.1.0"
