"""Incremental landing.

The reference has no streaming operators (no watermarks, windows or state).
What it does have is a landing step: files arrive in a stage directory and
are read, coerced and filtered for required fields.  Those row-local steps are
offered here as a Structured Streaming job over the landing directory, so new
files are cleaned as they arrive (exactly-once through the checkpoint).  The
IQR fence needs whole-group quantiles and stays a batch step over the landed
table.
"""

from panelforge.streaming.landing import land_stream  # noqa: F401
