"""tripmart: a Spark-native trip-analytics lakehouse.

Layers: landing (raw monthly trip files) -> bronze (typed, guarded) ->
silver (zones joined) -> gold (star schema: one fact, five dimensions),
plus declarative data-quality tests, median imputation, an ingestion
ledger and a library of business queries. Everything is a lazy
DataFrame plan; actions happen only in jobs (writes) and in the few
operators that must cut lineage (see ``operators.dense_rank``).
"""

from tripmart.params import Params

__all__ = ["Params"]
