"""tidemark: churn analytics as Spark DataFrame jobs.

Public entry points live in the sub-packages:

* ``tidemark.sources``    - table loading, the derived churn table, file sources and sinks
* ``tidemark.operators``  - cleaning, splits, fitting, scoring, evaluation, run log
* ``tidemark.functions``  - reusable Column expressions
* ``tidemark.streaming``  - Structured Streaming jobs and monitoring
* ``tidemark.plans``      - the registered queries and their SQL twins
"""

from tidemark.session import get_spark, checkpoint_dir, bounded_broadcast, materialize

__all__ = ["get_spark", "checkpoint_dir", "bounded_broadcast", "materialize"]
