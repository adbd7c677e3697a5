"""Survival models (L1-L12). Contract: ``fit(df) -> model``; ``model.risk(df)`` adds ``risk``
(higher = earlier event); ``model.survival(df, horizons)`` adds ``surv`` as ``ARRAY<DOUBLE>``
aligned with the horizons."""
