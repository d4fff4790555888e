"""Training-data operators: thirteen building blocks for corpus preparation on Spark.

Nothing outside this subpackage imports it. The registered queries and their SQL are in ``queries``.
"""
