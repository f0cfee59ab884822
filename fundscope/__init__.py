"""fundscope: fundraising-operations metrics as Spark DataFrame plans.

Layers:

* ``sources``   -- scans (Parquet, all-text CSV, literal rows), the stand-in
                   CRM tables over the test data, sinks and checkpoints
* ``functions`` -- column expressions: fiscal years, names, tiers, rules
* ``operators`` -- DataFrame -> DataFrame building blocks
* ``plans``     -- the dashboard datasets, data-quality checks, catalog
* ``streaming`` -- the same rules applied to a stream of activities
"""

from .params import Params

__all__ = ["Params"]
__version__ = "0.1.0"
