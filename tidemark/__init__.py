"""tidemark: stream and table operators for event data on PySpark.

Every operator is a function from DataFrame to DataFrame built on Spark SQL and
Structured Streaming; the batch form of each is the definition its streaming form is
tested against.

    from tidemark.operators import windows, joins, lateness, running, topn, aggregates
    from tidemark.functions import parse, formats
    from tidemark.streaming import sources, sinks, state, operators, lateness, run
"""

__version__ = "0.1.0"
