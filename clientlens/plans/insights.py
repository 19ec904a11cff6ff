"""Insights report: every purchase analysis from three scans of the purchases."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clientlens.operators.categories import category_transitions
from clientlens.operators.loyalty import client_loyalty, retention_by_year
from clientlens.operators.patterns import from_profile, purchase_profile
from clientlens.operators.rfm import score_rfm
from clientlens.operators.summary import describe, histogram
from clientlens.roles import Roles
from clientlens.sources.writers import write_tables

RFM_DESCRIBED = ("frequence", "montant_total", "recence", "r_score", "f_score", "m_score", "rfm_score")
#: Chart tables and the column their rows are written in the order of.
CHARTS = {"rfm_histogram": "bin", "weekday_patterns": "jour_semaine", "hourly_patterns": "heure",
          "retention_by_year": "annee_acquisition"}


def rfm_from_loyalty(loyalty: DataFrame, r: Roles, as_of=None, **kw) -> DataFrame:
    """RFM scores need last purchase, count and total, which loyalty has."""
    return score_rfm(loyalty.select(r.client, "dernier_achat", F.col("nombre_achats").alias("frequence"), "montant_total"),
                     as_of, **kw)


def client_tables(loyalty: DataFrame, rfm: DataFrame, bins: int = 20) -> dict[str, DataFrame]:
    """Tables derived from the two per-client tables. ``describe`` and
    ``histogram`` run jobs over ``rfm`` while they are built (three scans)."""
    return {"rfm_describe": describe(rfm, RFM_DESCRIBED), "rfm_histogram": histogram(rfm, "rfm_score", bins),
            "retention_by_year": retention_by_year(loyalty)}


def profile_tables(profile: DataFrame, r: Roles) -> dict[str, DataFrame]:
    """Weekday, hour and category tables of one ``purchase_profile``."""
    return {"weekday_patterns": from_profile(profile, "jour_semaine", "jour_semaine", "nombre_achats", "montant_moyen", "montant_total"),
            "hourly_patterns": from_profile(profile, "heure", "heure", "nombre_achats", "montant_moyen"),
            "category_revenue": from_profile(profile, "category", r.category, "nombre_achats", "revenu_total", "montant_moyen")}


def insights_report(purchases: DataFrame, r: Roles, out: str, as_of=None, rfm_kwargs: dict | None = None,
                    bins: int = 20, fmt: str = "parquet") -> dict[str, str]:
    """Compute and write every report table to ``<out>/<table>``.

    The purchases are scanned three times, each for its own columns: for the
    per-client aggregate, for the (category, weekday, hour) profile and for the
    transitions. All other tables are made from the first two as written, so
    the clients are shuffled once and a lost executor costs its own blocks only.
    Chart tables are written in the order of their x column.
    """
    spark = purchases.sparkSession

    def kept(name: str, df: DataFrame) -> DataFrame:
        paths.update(write_tables({name: df}, out, fmt))
        return spark.read.format(fmt).load(paths[name])

    paths: dict[str, str] = {}
    loyalty = kept("client_loyalty", client_loyalty(purchases, r))
    rfm = kept("rfm", rfm_from_loyalty(loyalty, r, as_of, **(rfm_kwargs or {})))
    profile = kept("purchase_profile", purchase_profile(purchases, r))
    tables = client_tables(loyalty, rfm, bins) | profile_tables(profile, r)
    return paths | write_tables(tables | {"category_transitions": category_transitions(purchases, r)}, out, fmt, order_by=CHARTS)
