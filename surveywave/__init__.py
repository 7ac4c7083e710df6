"""surveywave — survey-wave analytics on Spark DataFrames.

Raw operational tables (families, survey definitions, snapshots, per-indicator
colour scores, priorities, achievements, economic answers) are cleaned in a
staging layer, re-sequenced per family with window functions, aligned with
their baseline and previous score and published as a star schema plus two
dashboard tables.  A metric layer, ready-made questions and a data-quality
suite sit on top.  Everything is planned by Catalyst; no Python UDF is used.
"""

from surveywave.session import build_session, checkpoint_dir
from surveywave.plans.warehouse import Warehouse

__all__ = ["build_session", "checkpoint_dir", "Warehouse"]
