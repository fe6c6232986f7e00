import json
import os
import tempfile

from tradeflow.streaming.sellout_stream import sell_out_stream, start_sell_out_ingest


def test_incremental_sell_out_ingest(spark):
    root = tempfile.mkdtemp(prefix="tradeflow-stream-")
    landing, table = os.path.join(root, "landing"), os.path.join(root, "table")
    os.makedirs(landing)

    def land(name, docs):
        with open(os.path.join(landing, name), "w") as f:
            for d in docs:
                f.write(json.dumps(d) + "\n")

    land("a.json", [{"_id": "1", "date_": "2024-11-02", "channel_name": "GT", "qty": 3},
                    {"_id": "2", "date_": "2024-11-31", "channel_name": "MTI", "qty": 1},
                    {"_id": "3", "date_": "2024-11-02", "channel_name": "NOPE", "qty": 1}])
    stream = sell_out_stream(spark, landing, ("GT", "MTI", "OFFICE"), date_range=("2024-11-01", "2024-11-31"))
    q = start_sell_out_ingest(stream, table, os.path.join(root, "ckpt"))
    q.awaitTermination()
    land("b.json", [{"_id": {"$oid": "4"}, "date_": "2024-11-20", "channel_name": "OFFICE", "qty": 2}])
    q = start_sell_out_ingest(sell_out_stream(spark, landing, ("GT", "MTI", "OFFICE"), date_range=("2024-11-01", "2024-11-31")),
                              table, os.path.join(root, "ckpt"))
    q.awaitTermination()
    rows = {r["_id"]: (str(r["date_"]), r["qty"]) for r in spark.read.parquet(table).collect()}
    # each file read once across restarts; bad date kept as null; other channel dropped
    assert rows == {"1": ("2024-11-02", 3), "2": ("None", 1), "4": ("2024-11-20", 2)}
