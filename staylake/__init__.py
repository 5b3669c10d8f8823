"""staylake: a Spark-native rental-market lakehouse library.

Layers: ``functions`` (column expressions), ``operators`` (DataFrame ->
DataFrame), ``sources`` (readers / writers), ``plans`` (silver / gold models,
feature marts, batch jobs, driver-table query catalogue), ``ml`` (Spark ML
fitting, scoring, evaluation, registry), ``streaming`` (none needed).
"""

__version__ = "0.1.0"
