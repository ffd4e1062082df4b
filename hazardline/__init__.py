"""hazardline: survival-curve demand forecasting as Spark DataFrame jobs.

Training builds weighted Kaplan-Meier curves per (ship date, group) from the
order/delivery/status history known at a knowledge time; correction rebuilds
hourly live-order actuals, projects open orders along the curves and corrects
the projection by the latest actual/predicted ratio.  Everything is expressed
with built-in DataFrame operators so Catalyst/AQE choose the physical plan.
"""

from hazardline.params import RunParams  # noqa: F401
