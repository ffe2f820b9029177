"""convoy: last-mile fleet analytics as Spark DataFrame plans.

Sub-packages:

* ``sources``   - fleet tables from parquet, event streams, sinks
* ``functions`` - column expressions shared by the plans
* ``operators`` - reusable operators (distributed rank, upsert, SCD2, audits, expansions)
* ``plans``     - named reports, the star-schema batch, data-quality reports
* ``streaming`` - Structured Streaming jobs for delivery, ETA and deviation events
"""

from convoy.session import build_session, checkpoint_dir  # noqa: F401

__all__ = ["build_session", "checkpoint_dir"]
