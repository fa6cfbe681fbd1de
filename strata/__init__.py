"""strata: layered (landing -> bronze -> silver -> gold) analytics on Spark DataFrames.

Every public operator is a pure ``DataFrame -> DataFrame`` function built from
Spark's built-in expressions; the only driver-side values are scalars
(high-water marks, row counts used as size checks).
"""

__all__ = ["session", "spec"]
