"""Plan-level helpers: measured-size joins, command functions, the query
registry behind ``__spark_entry__``."""
