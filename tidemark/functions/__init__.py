"""Column-level helpers: parsing and tokenising (:mod:`parse`), output text formats
(:mod:`formats`), time and money (:mod:`time`), row ids (:mod:`ids`), pandas hooks for user
functions (:mod:`udf`)."""
