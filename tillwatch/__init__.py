"""tillwatch: transaction-risk and revenue analytics as Spark DataFrame operators.

Every operator is a function ``f(df, ...) -> DataFrame``.  Nothing runs until the caller writes or
collects the result.  Times are zone-less UTC (``timestamp_ntz``) in batch; run sessions with
``spark.sql.session.timeZone=UTC`` (see :func:`tillwatch.session.spark_session`).
"""
