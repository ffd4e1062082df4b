"""Ship-date planning: which dates a job processes."""

from hazardline.plans.dates import *  # noqa: F401,F403
