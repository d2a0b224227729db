"""inkwell: a Spark-first engine for scientific-literature data.

Every operator is a function from DataFrame(s) or Column(s) to DataFrame or
Column.  Subpackages: ``functions`` (scalar columns), ``operators``
(relational and row-expanding), ``sources``, ``plans`` (whole pipelines) and
``streaming``.  ``llm`` holds operators for training data; nothing outside it
imports it.
"""
