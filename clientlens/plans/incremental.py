"""Client aggregates kept from day to day: a load reads the new day's purchases
and the clients they belong to, not the purchases of all time.

Layout under the store's folder::

    days/<day>/load=N/bucket=B/    one partial row per client of the day
    clients/version=V/bucket=B/    one row per client
    manifest/V.json                which version every bucket is in, which load every day

A client's row is a sum of mergeable parts: first and last purchase, count,
amount. Clients are dealt into ``buckets`` by hash. A load writes the day's
partial rows, merges the buckets that have any, writes only those, and
publishes a manifest in one step; all other buckets stay the files they were. A
load that dies before that changes nothing. A day loaded again replaces its
former load: its buckets are summed anew from the partial rows of all days.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from clientlens.functions.calendar import days_between
from clientlens.roles import Roles
from clientlens.sources.files import Files


class ClientStore:
    """The client table at ``path`` for purchases with roles ``r``. One writer
    at a time."""

    def __init__(self, spark: SparkSession, path: str, r: Roles, buckets: int = 64):
        self.spark, self.r, self.files = spark, r, Files(spark, path)
        state = self._manifest()
        self.buckets = state["buckets"] if state else buckets

    def _manifest(self) -> dict | None:
        names = [n for n in self.files.names("manifest") if n.endswith(".json")]
        return json.loads(self.files.read_text(f"manifest/{names[-1]}")) if names else None

    def _partial(self, purchases: DataFrame) -> DataFrame:
        r = self.r
        rows = purchases.groupBy(F.col(r.client).alias("client")).agg(
            F.min(r.ts).alias("first"), F.max(r.ts).alias("last"), F.count(F.lit(1)).alias("n"), F.sum(r.amount).alias("amount"))
        return self._placed(rows)

    @staticmethod
    def _merged(rows: DataFrame) -> DataFrame:
        """One exchange by bucket serves the sums and the write."""
        return rows.repartition("bucket").groupBy("bucket", "client").agg(F.min("first").alias("first"), F.max("last").alias("last"),
                                                    F.sum("n").alias("n"), F.sum("amount").alias("amount"))

    def _rows(self, folders: Sequence[str], schema: StructType) -> DataFrame | None:
        """The bucket folders ``folders`` as one table."""
        if not folders:
            return None
        plain = StructType([f for f in schema.fields if f.name != "bucket"])
        return self._placed(self.spark.read.schema(plain).parquet(*[self.files.path(f) for f in folders]))

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64("client"), F.lit(self.buckets)).cast("int"))

    def load_day(self, day: str, purchases: DataFrame) -> list[int]:
        """Merge the purchases of ``day`` (a name, e.g. 2024-02-15); the buckets
        that were written."""
        state = self._manifest() or {"version": 0, "buckets": self.buckets, "days": {}, "clients": {}, "schema": None}
        load = state["days"].get(day, {}).get("load", 0) + 1
        partial = self._partial(purchases)
        schema = StructType.fromJson(json.loads(state["schema"])) if state["schema"] else partial.schema
        folder = f"days/{day}/load={load}"
        self.files.remove(folder)   # of a load that did not finish
        partial.repartition("bucket").write.partitionBy("bucket").parquet(self.files.path(folder))
        new = self._buckets(folder)
        before = state["days"].get(day)
        touched = sorted(set(new) | set(before["buckets"] if before else ()))
        days = state["days"] | {day: {"load": load, "buckets": new}}
        if before is None:   # add the day to what is there
            folders = [f"clients/version={state['clients'][str(b)]}/bucket={b}" for b in new if str(b) in state["clients"]]
            folders += [f"{folder}/bucket={b}" for b in new]
        else:                # replace the day: sum the touched buckets of all days
            folders = [f"days/{d}/load={x['load']}/bucket={b}" for d, x in days.items() for b in x["buckets"] if b in touched]
        version = state["version"] + 1
        out = f"clients/version={version}"
        self.files.remove(out)
        rows = self._rows(folders, schema)
        if rows is not None:
            self._merged(rows).write.partitionBy("bucket").parquet(self.files.path(out))
        written = self._buckets(out)
        clients = {b: v for b, v in state["clients"].items() if int(b) not in touched} | {str(b): version for b in written}
        self.files.publish_text(f"manifest/{version:020d}.json", json.dumps(
            {"version": version, "buckets": self.buckets, "days": days, "clients": clients, "schema": schema.json()}))
        return touched

    def _buckets(self, folder: str) -> list[int]:
        return sorted(int(n[7:]) for n in self.files.names(folder) if n.startswith("bucket="))

    def clean(self) -> None:
        """Remove what neither the last manifest nor the one before names."""
        names = [n for n in self.files.names("manifest") if n.endswith(".json")]
        kept = [json.loads(self.files.read_text(f"manifest/{n}")) for n in names[-2:]]
        for n in names[:-2]:
            self.files.remove(f"manifest/{n}")
        keep = {f"clients/version={v}/bucket={b}" for s in kept for b, v in s["clients"].items()}
        for v in self.files.names("clients"):
            for b in self.files.names(f"clients/{v}"):
                if f"clients/{v}/{b}" not in keep and b.startswith("bucket="):
                    self.files.remove(f"clients/{v}/{b}")
        loads = {f"days/{d}/load={x['load']}" for s in kept for d, x in s["days"].items()}
        for d in self.files.names("days"):
            for n in self.files.names(f"days/{d}"):
                if f"days/{d}/{n}" not in loads:
                    self.files.remove(f"days/{d}/{n}")

    def _clients(self) -> DataFrame:
        state = self._manifest()
        if state is None:
            raise FileNotFoundError(f"{self.files.root} holds no load")
        schema = StructType.fromJson(json.loads(state["schema"]))
        rows = self._rows([f"clients/version={v}/bucket={b}" for b, v in state["clients"].items()], schema)
        return self.spark.createDataFrame([], schema) if rows is None else rows

    def loyalty(self) -> DataFrame:
        """As ``client_loyalty`` of all loaded purchases."""
        return self._clients().select(
            F.col("client").alias(self.r.client), F.col("first").alias("premier_achat"), F.col("last").alias("dernier_achat"),
            F.col("n").alias("nombre_achats"), F.col("amount").alias("montant_total")) \
            .withColumn("duree_relation", days_between("dernier_achat", "premier_achat"))

    def rfm_base(self) -> DataFrame:
        """As ``client_rfm_base`` of all loaded purchases (for ``score_rfm``)."""
        return self._clients().select(F.col("client").alias(self.r.client), F.col("last").alias("dernier_achat"),
                                      F.col("n").alias("frequence"), F.col("amount").alias("montant_total"))
