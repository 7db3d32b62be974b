"""tidemart: a Spark-native sales-mart engine.

Raw extracts -> bronze (append-only) -> silver (clean, dedup, quarantine)
-> gold (SCD type 2 customer dimension, sales facts, revenue marts).
Every transformation is a pure ``DataFrame -> DataFrame`` function built
from Spark's own expressions; reading and writing happen only at the edges
(``tidemart.sources``) and in the job plans (``tidemart.plans``).
"""

__version__ = "0.1.0"
