"""DataFrame-to-DataFrame operators.

Scale notes shared by all of them:

* No broadcast hint is given except where the row count has a bound known from
  the parameters; everything else is left to the adaptive size check.
* A per-cell window holds one cell's time axis, never raw observations: inputs
  are first reduced to one row per (cell, time) by a map-side-combined aggregate,
  so a hot cell in the raw data does not make a hot task.
"""
