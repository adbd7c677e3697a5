"""tte: time-to-event (survival) analytics on Spark DataFrames and streams.

Sub-packages:

- ``sources``   reading, typing and writing cohort tables; cohorts derived from the test tables
- ``functions`` scalar Column expressions (clip, equal-width bins, sigmoid, CDFs, ...)
- ``operators`` the DataFrame operators: scans, curves, metrics, calibration, preprocessing,
                splits, models, scoring, explanation, quality, drift and monitoring
- ``plans``     the registered query catalogue (Spark query + equivalent SQL per operator)
- ``streaming`` Structured Streaming forms of the quality, drift, scoring and alert operators

Contract used everywhere: one row per subject, ``time DOUBLE`` follow-up, ``event INT`` 0/1,
``risk DOUBLE`` where higher risk means an earlier event.
"""

__version__ = "0.1.0"
