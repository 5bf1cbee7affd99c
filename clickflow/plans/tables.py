"""Reading the test tables and deriving the reference's inputs from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickflow.session import table_path
from clickflow.sources import adapt, scans

# Columns each test table contributes (the scan reads only these).
COLUMNS = {
    "events": ["event_id", "ts", "user_id", "event_type", "props"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "region": ["r_regionkey", "r_name"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
}


# One lazy scan per (application, table): the test tables are read-only, so
# the footer read and file listing happen once, not per query.
_SCANS: dict[tuple[str, str], DataFrame] = {}


class Tables:
    """Lazy access to one scale factor's tables and derived inputs."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        path = table_path(self.sf_dir, name)
        key = (self.spark.sparkContext.applicationId, path)
        if key not in _SCANS:
            df = self.spark.read.parquet(path)
            cols = COLUMNS.get(name)
            _SCANS[key] = df.select(*cols) if cols else df
        return _SCANS[key]

    # reference inputs ----------------------------------------------------
    def behaviors(self) -> DataFrame:
        return adapt.behaviors(self.raw("events"))

    def access_logs(self) -> DataFrame:
        return scans.good(scans.parse_access_log_lines(adapt.access_log_lines(self.raw("events"))))

    def ad_clicks(self) -> DataFrame:
        return adapt.ad_clicks(self.raw("events"), self.raw("customer"), self.raw("nation"))

    def marketing(self) -> DataFrame:
        return adapt.marketing(self.raw("events"))

    def app_logs(self) -> DataFrame:
        return adapt.app_logs(self.raw("events"))

    def cdc_array(self) -> DataFrame:
        return adapt.cdc_array_envelopes(self.raw("orders"), self.raw("customer"))

    def cdc_object(self) -> DataFrame:
        return adapt.cdc_object_envelopes(self.raw("orders"), self.raw("customer"))

    def cdc_changes(self) -> DataFrame:
        return adapt.cdc_change_envelopes(self.raw("orders"), self.raw("customer"))

    def order_json(self) -> DataFrame:
        return adapt.order_json(self.raw("orders"), self.raw("customer"))

    def user_state(self) -> DataFrame:
        return adapt.user_state(self.raw("customer"))

    def province_dim(self) -> DataFrame:
        return adapt.province_dim(self.raw("nation"), self.raw("region"))

    def user_dim(self) -> DataFrame:
        return adapt.user_dim(self.raw("customer"))
