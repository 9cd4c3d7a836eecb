"""Point-in-time market data on Spark.

``sources`` shape landed payloads, ``operators`` gate, route, store and analyse
them, ``plans`` put these together as pipelines, ``streaming`` runs them on streams.
Everything takes and returns DataFrames.
"""
