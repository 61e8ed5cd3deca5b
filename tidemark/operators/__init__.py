"""Batch operators (DataFrame in, DataFrame out).

* :mod:`windows` -- tumbling, sliding, session (fixed or per-row gap), count and all-row windows
* :mod:`aggregates` -- word count, keyed sums, window reduce / aggregate / process, user hooks
* :mod:`joins` -- window join and time-bucketed interval join
* :mod:`lateness` -- event time, per-row watermarks, allowed lateness, late side outputs
* :mod:`running` -- per-record running sums, counts and averages
* :mod:`topn` -- exact salted top-N per group
"""
