"""Category revenue and category-to-category transitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegralType

from clientlens.functions.calendar import epoch_micros
from clientlens.roles import Roles


def category_revenue(df: DataFrame, r: Roles) -> DataFrame:
    """Per category: purchases, total revenue, mean amount."""
    return (df.groupBy(r.category)
              .agg(F.count(F.lit(1)).alias("nombre_achats"),
                   F.sum(r.amount).alias("revenu_total"),
                   F.avg(r.amount).alias("montant_moyen")))


def category_transitions(df: DataFrame, r: Roles, slice_seconds: int = 7 * 86_400,
                         prev_name: str = "categorie_precedente") -> DataFrame:
    """Count of (previous category, category) over consecutive purchases of a
    client, ordered by (time, id); pairs whose previous category is null are
    dropped. Sorted by count descending.

    A ``lag`` over ``partitionBy(client)`` would put a client holding a third of
    all rows into one task, so rows are grouped by (client, time slice):

    1. one exchange on (client, slice) serves the ``lag`` inside each slice; the
       pairs it finds are pre-aggregated;
    2. each slice's first and last row are its edges. A client's edges, sorted
       by slice, alternate first, last, first, last; a last row followed by the
       next slice's first is a pair, too. A client has two edges per slice, so a
       group holds 2 x (time span / slice width) edges, however many rows;
    3. both kinds of pairs are summed per pair.

    ``slice_seconds`` never changes the result. It should be wide enough that
    ordinary clients have few slices (few edges) and narrow enough to split the
    hottest client. For an integral time column it is in that column's units.
    """
    ct = df.schema[r.client].dataType.simpleString()
    kt = df.schema[r.category].dataType.simpleString()
    t = df.schema[r.ts].dataType
    unit = 1 if isinstance(t, IntegralType) else 1_000_000
    micros = epoch_micros(t, "_t")
    if micros is None:
        raise ValueError(f"{r.ts} is {t.simpleString()}; a time, date or integral column is needed")
    seq = df.select(F.col(r.client).alias("_c"), F.col(r.ts).alias("_t"),
                    F.col(r.id).alias("_i"), F.col(r.category).alias("_k"))
    # rows without a time come first in the order, as one slice below all others
    lowest = "-9223372036854775808L"
    width = int(slice_seconds) * unit
    seq = seq.selectExpr("*", f"coalesce(({micros} - pmod({micros}, {width}L)) DIV {width}L, {lowest}) AS _s")
    # Expressions are SQL text: one parse each instead of a JVM call per node.
    w = "OVER (PARTITION BY _c, _s ORDER BY _t, _i)"
    seq = seq.selectExpr("_c", "_s", "_k", f"lag(_k) {w} AS _pk", f"row_number() {w} AS _rn", f"lead(true) {w} AS _more")

    et = f"struct<s:bigint,side:int,k:{kt}>"
    rt = f"struct<kind:int,prev:{kt},cat:{kt},n:bigint,c:{ct},e:{et}>"

    def rec(kind, prev, cat, n, c, e):
        return (f"CAST(named_struct('kind', {kind}, 'prev', {prev}, 'cat', {cat}, 'n', {n}, "
                f"'c', {c}, 'e', {e}) AS {rt})")

    def edge(side):
        return rec(1, "NULL", "NULL", "NULL", "_c", f"named_struct('s', _s, 'side', {side}, 'k', _k)")

    pair = f"CASE WHEN _rn > 1 AND _pk IS NOT NULL THEN {rec(0, '_pk', '_k', '1L', 'NULL', 'NULL')} END"
    head = f"CASE WHEN _rn = 1 THEN {edge(0)} END"
    tail = f"CASE WHEN _more IS NULL THEN {edge(1)} END"
    recs = (seq.selectExpr(f"explode(array({pair}, {head}, {tail})) AS r")
               .where("r IS NOT NULL").select("r.*"))

    grouped = recs.groupBy("kind", "prev", "cat", "c").agg(F.sum("n").alias("n"), F.collect_list("e").alias("es"))
    grouped = grouped.selectExpr("kind", "prev", "cat", "n", "array_sort(es) AS es")   # by slice, then first/last
    seams = ("filter(transform(sequence(1, size(es)), j -> named_struct("
             "'a', try_element_at(es, j), 'b', try_element_at(es, j + 1))), "
             "x -> x.a.side = 1 AND x.b.side = 0 AND x.a.k IS NOT NULL)")
    pt = f"struct<prev:{kt},cat:{kt},n:bigint>"
    own = f"CAST(named_struct('prev', prev, 'cat', cat, 'n', n) AS {pt})"
    across = f"transform({seams}, x -> CAST(named_struct('prev', x.a.k, 'cat', x.b.k, 'n', 1L) AS {pt}))"
    pairs = grouped.selectExpr(f"explode(CASE WHEN kind = 0 THEN array({own}) ELSE {across} END) AS x").select("x.*")
    return (pairs.groupBy("prev", "cat").agg(F.sum("n").alias("count"))
                 .select(F.col("prev").alias(prev_name), F.col("cat").alias(r.category), "count")
                 .orderBy(F.desc("count"), F.asc_nulls_first(prev_name), F.asc_nulls_first(r.category)))
