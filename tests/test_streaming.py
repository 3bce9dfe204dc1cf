"""Incremental loads through Structured Streaming (foreachBatch)."""

import os
import tempfile

from vaultsmith import Hub, Run, Sat, Source
from vaultsmith.streaming.incremental import start_incremental_load

from .conftest import SF_SMALL


def test_streamed_files_load_hub_and_satellite(spark):
    folder = tempfile.mkdtemp(prefix="vaultsmith-stream-")
    incoming, ckpt = os.path.join(folder, "in"), os.path.join(folder, "ckpt")
    customers = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    schema = customers.schema
    first = customers.where("c_mktsegment = 'BUILDING'")
    first.write.mode("append").parquet(incoming)

    spark.sql("CREATE DATABASE IF NOT EXISTS stream_vault")
    hub = Hub("h_customer_s", "hk_customer", "customer_bk", [Source("customer", bks=["c_custkey"])])
    sat = Sat("s_customer_s", "hk_customer", ["name", "segment"],
              sources=[Source("customer", bks=["c_custkey"], attrs={"c_name": "name", "c_mktsegment": "segment"})])
    runs = {}

    def run_for(epoch):
        runs[epoch] = Run(load_ts=f"2024-01-0{epoch + 1} 00:00:00")
        return runs[epoch]

    def drain(entity, table, name):
        stream = spark.readStream.schema(schema).parquet(incoming)
        q = start_incremental_load(spark, stream, entity, entity.sources[0], table,
                                   checkpoint_location=os.path.join(ckpt, name), run_factory=run_for,
                                   trigger={"availableNow": True}, query_name=name)
        q.awaitTermination(120)
        assert q.exception() is None
        # Batches append through the stream's own (cloned) session.
        spark.catalog.refreshTable(table)
        return q

    drain(hub, "stream_vault.h_customer_s", "hub1")
    drain(sat, "stream_vault.s_customer_s", "sat1")
    n_first = first.count()
    assert spark.table("stream_vault.h_customer_s").count() == n_first

    # A second file arrives: its new keys load; keys seen before do not.
    customers.write.mode("append").parquet(incoming)
    drain(hub, "stream_vault.h_customer_s", "hub1")
    drain(sat, "stream_vault.s_customer_s", "sat1")
    hub_rows = spark.table("stream_vault.h_customer_s")
    assert hub_rows.count() == customers.count()
    assert hub_rows.select("hk_customer").distinct().count() == customers.count()
    assert spark.table("stream_vault.s_customer_s").count() == customers.count()
    spark.sql("DROP DATABASE stream_vault CASCADE")
