"""Structured Streaming forms.

* :mod:`sources` -- text streams (plain or with line numbers), topic options, rate generator
* :mod:`operators` -- watermarked windows, stream-stream window and interval joins, top-N writer
* :mod:`state` -- ``transformWithStateInPandas`` processors (running count / sum / average,
  count windows)
* :mod:`lateness` -- exact ``foreachBatch`` operators: allowed lateness and late rows, late
  interval join
* :mod:`sinks` -- console, tagged side outputs, rolling text files, JDBC
* :mod:`run` -- starting queries with durable checkpoints; bounded runs
"""
