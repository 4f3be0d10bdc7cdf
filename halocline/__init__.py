"""Gridded climate analytics expressed as Spark DataFrame operators.

A *field* is a long DataFrame with one row per (dataset, time, grid cell):

    [dataset keys..., var] time iy ix lat lon value

``iy``/``ix`` are integer grid indices and identify the cell; ``lat``/``lon``
are its coordinates.  A missing value is SQL NULL, and its row is kept.
"""
