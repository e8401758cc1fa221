"""boreal — batch analytics on Spark DataFrames.

Three families of jobs, all declared with the DataFrame / SQL API so that Catalyst plans them:

* ``boreal.operators.readings``  — period extremes, threshold counts, station and regional means and
  banded extreme joins over station readings (station, date, value).
* ``boreal.operators.forecast``  — a kernel-weighted forecast of a value at a place, date and hours of
  the day (distance, season and time-of-day Gaussian kernels), computed in one pass.
* ``boreal.operators.warehouse`` — warehouse questions: semi, theta, self and star joins, scalar
  subqueries, derived tables.
* ``boreal.operators.integrity`` — table audits for primary keys, foreign keys and column rules.

Sources and sinks live in ``boreal.sources`` / ``boreal.sinks``; column functions in
``boreal.functions``; the bindings of every job to the shared test tables in ``boreal.plans``.
"""

from boreal.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
