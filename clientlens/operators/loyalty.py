"""Client loyalty and acquisition-year retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clientlens.functions.calendar import days_between, year_of
from clientlens.roles import Roles


def client_loyalty(df: DataFrame, r: Roles) -> DataFrame:
    """Per client: first and last purchase, count, total, relation length in days."""
    return (df.groupBy(r.client)
              .agg(F.min(r.ts).alias("premier_achat"),
                   F.max(r.ts).alias("dernier_achat"),
                   F.count(F.lit(1)).alias("nombre_achats"),
                   F.sum(r.amount).alias("montant_total"))
              .withColumn("duree_relation", days_between("dernier_achat", "premier_achat")))


def retention_by_year(loyalty: DataFrame) -> DataFrame:
    """Per acquisition year (year of first purchase): new clients, mean
    relation length, mean purchases. Runs on the per-client table, so the
    second aggregation sees one row per client."""
    return (loyalty.groupBy(year_of("premier_achat").alias("annee_acquisition"))
                   .agg(F.count(F.lit(1)).alias("nouveaux_clients"),
                        F.avg("duree_relation").alias("duree_moyenne_relation"),
                        F.avg("nombre_achats").alias("nombre_moyen_achats")))
