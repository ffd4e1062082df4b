"""Incremental hourly correction driven by newly synced status changes."""

from hazardline.streaming.hourly import hourly_correction_stream, touched_ship_dates  # noqa: F401
