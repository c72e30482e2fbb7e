"""tickframe: daily-bar indicator analytics as Spark DataFrame / SQL jobs.

Entry points: ``tickframe.plans.jobs`` (bulk, daily, load, backfill),
``tickframe.operators.screens`` (ranked screens), ``tickframe.streaming``
(file-stream daily load) and ``python -m tickframe`` (command line).
"""

__version__ = "0.1.0"
