"""flowcubes: swap-order analytics as Spark DataFrame plans.

Layers, each a plain function over DataFrames:

* ``sources``   -- read landed JSON or the driver's parquet tables into typed frames
* ``functions`` -- column expressions (flattening, address decoding, labels, stats)
* ``operators`` -- ingest, cubes, pricing, quality gates, publication
* ``plans``     -- the analytic metrics and the query registry
* ``streaming`` -- an incremental silver job for the same flatten + cube logic
"""

__version__ = "0.1.0"
