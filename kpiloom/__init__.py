"""kpiloom: retail-revenue, customer and experiment analytics on Spark.

Every operator takes a DataFrame and returns a DataFrame built from
built-in Spark expressions, so Catalyst plans, prunes and pushes down the
whole chain.  See README.md for the operator list.
"""

__version__ = "0.1.0"
