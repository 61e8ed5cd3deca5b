"""Plans shared by the operators and the registered queries.

* :mod:`prefix` -- the ordered running-aggregate scan (plain keyed window, or range slices
  with a checkpoint and a summary join-back when a key is hot or the input is large)
* :mod:`partitioning` -- input spreading for row-expanding steps
* :mod:`queries` -- the registered queries over the driver's tables
* :mod:`oracle` -- their DuckDB SQL
"""
