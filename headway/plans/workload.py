"""The test workload over the driver tables: static network from ``nation``,
pings from ``orders``, features of all pings, a time split into history (which
alone trains the model) and live queries, and observed arrivals for scoring. Every table grows with the
scale factor; nothing is sampled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, context
from ..sources import fixtures as fx
from . import pipelines


@dataclass
class Workload:
    spark: SparkSession
    sf_dir: str

    def stops(self) -> DataFrame:
        return fx.stops(self.spark, self.sf_dir)

    def sequences(self) -> DataFrame:
        return fx.route_sequences(self.spark, self.sf_dir)

    def static(self) -> tuple[DataFrame, DataFrame]:
        return pipelines.build_static(self.stops(), self.sequences())

    def routes(self) -> DataFrame:
        if getattr(self, "_routes", None) is None:
            st, seq = self.static()
            self._routes = pipelines.route_table(st, seq)
        return self._routes

    def raw_pings(self) -> DataFrame:
        return fx.raw_pings(self.spark, self.sf_dir)

    def clean_pings(self) -> DataFrame:
        return clean.clean_pings(self.raw_pings())

    def history_raw(self) -> DataFrame:
        return self.raw_pings().where(F.col("date") < F.lit(fx.QUERY_FROM_DATE).cast("date"))

    def live_raw(self) -> DataFrame:
        return self.raw_pings().where(F.col("date") >= F.lit(fx.QUERY_FROM_DATE).cast("date"))

    def query_raw(self) -> DataFrame:
        """Live trips observed up to their cut: one query per trip."""
        q = self.live_raw().withColumn("query_id", F.translate("trip_id", '"', ""))
        return q.where(F.col("seq") <= F.expr(fx.QUERY_CUT_SQL.replace("o", "CAST(query_id AS BIGINT)")))

    def features(self, raw: DataFrame | None = None, rolling_scope: str = "trip",
                 stats_scope: str = "first_date", stored: bool = True) -> DataFrame:
        """Features of every ping, or of the raw pings given."""
        st, seq = self.static()
        return pipelines.build_features(self.raw_pings() if raw is None else raw, st, seq, select=False,
                                        rolling_scope=rolling_scope, stats_scope=stats_scope,
                                        routes_tbl=self.routes(), stored=stored)

    def patterns(self) -> DataFrame:
        return pipelines.fit_patterns(self.features(self.history_raw(), stored=False))

    def predictions(self) -> DataFrame:
        st, seq = self.static()
        return pipelines.predict(self.query_raw(), st, seq, self.patterns(), routes_tbl=self.routes())

    def actuals(self) -> DataFrame:
        """First arrival at each stop after the query time, from the full
        live trip (``query_id, stop_id, arrival`` text; NULL stop when none)."""
        live = clean.clean_pings(self.live_raw())
        matched = context.process_trips(live, self.routes())
        qt = (clean.clean_pings(self.query_raw()).groupBy("query_id")
              .agg(F.max("ts").alias("qts")))
        m = matched.withColumn("query_id", F.col("trip_id")).join(qt, "query_id")
        after = (m.where(F.col("ts") > F.col("qts")).groupBy("query_id", "current_stop_id")
                 .agg(F.min("ts").alias("a")))
        arr = after.select("query_id", F.col("current_stop_id").alias("stop_id"),
                           F.date_format("a", "yyyy-MM-dd HH:mm:ss").alias("arrival"))
        empty = qt.join(arr.select("query_id").distinct(), "query_id", "left_anti").select(
            "query_id", F.lit(None).cast("string").alias("stop_id"), F.lit(None).cast("string").alias("arrival"))
        return arr.unionByName(empty)
