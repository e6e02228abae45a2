"""larder: a Spark-native retail demand, inventory-risk and basket pipeline.

Layers: ``sources`` (raw landing, fixture mapping, bronze), ``operators``
(silver, labelling, gold, maintenance, validation), ``plans`` (lineage,
dashboards, layered run, query registry), ``functions`` (column helpers),
``streaming`` (incremental landing ingestion).
"""

__version__ = "0.1.0"
