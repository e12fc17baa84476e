"""Every entity with every configuration row, as an equi-join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_SALTS = 16


def pair_every(entities: DataFrame, config: DataFrame, key: str, salts: int | None = None) -> DataFrame:
    """Pair each entity with all configuration rows: a product that is meant, of entities and bounded configuration.

    Entities are spread over ``salts`` by the hash of their key and the configuration
    is repeated once per salt.  A small configuration is broadcast by Spark (its size
    is measured, no hint) and entities stay where they are; a large one is shuffled on the
    salt, of which there are as many as the session has shuffle partitions, so the
    product spreads as wide as the cluster is set up for.
    """
    if salts is None:
        salts = max(LEAST_SALTS, int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = entities.withColumn("__salt", F.pmod(F.xxhash64(F.col(key)), F.lit(salts)).cast("int"))
    copies = config.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies, "__salt").drop("__salt")
