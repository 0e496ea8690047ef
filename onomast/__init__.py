"""onomast: resolving person and organisation names in free text, on Spark.

``sources`` reads and stores tables, ``operators`` holds the stages (each DataFrame to DataFrame), ``functions`` the column
functions, ``plans`` whole pipelines and registered queries, ``streaming`` the incremental runs. The optional subpackage
``llm`` prepares training corpora; nothing here depends on it.
"""
