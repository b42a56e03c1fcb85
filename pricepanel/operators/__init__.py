"""Operators: functions from DataFrames to a DataFrame.

Two shapes are used.  *Wide*: one row per ``date``, one double column per series.
*Long* (the panel): columns ``series, date, value``.

A **panel** has one row per (series, date); ``panel.keep_last`` makes it so with a
map-side combined aggregation, which copes with any number of copies of a row.  At daily
grain a series then holds at most 366 rows per calendar year however big the raw data
is, so windows partitioned by series are bounded by the calendar.  Where a series may be
finer than daily, use the sliced variants in ``fill``; where rows may repeat, operators
reduce them by aggregation before any window.
"""
