"""Peer scoring of entities from daily level series, as Spark DataFrame jobs.

Sub-packages:

``functions``  column expressions (text, casts, calendar, numbers, display)
``operators``  ``DataFrame -> DataFrame`` transforms
``sources``    scans, sinks and landing-zone bookkeeping
``plans``      whole tables built by chaining the above
``catalog``    the transforms applied to the shared test tables, with SQL twins
"""

__version__ = "0.1.0"
