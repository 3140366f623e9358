"""The incremental load picks up new files, keeps the first row per key and never loads a key twice."""

import os

from starlift.sources.contracts import Contract, schema_of
from starlift.streaming.incremental import incremental_load

C = Contract("t", schema_of("id bigint, name string"))


def test_incremental_load_is_idempotent(spark, tmpdir_path):
    src, tgt, ck = (os.path.join(tmpdir_path, x) for x in ("src", "tgt", "ck"))
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as fh:
        fh.write("id,name\n1,a\n2,b\n1,dup\n")
    incremental_load(spark, src, C, ["id"], tgt, ck).awaitTermination()
    with open(os.path.join(src, "b.csv"), "w") as fh:
        fh.write("id,name\n2,again\n3,c\n")
    incremental_load(spark, src, C, ["id"], tgt, ck).awaitTermination()
    got = sorted((r.id, r.name) for r in spark.read.parquet(tgt).collect())
    assert got == [(1, "a"), (2, "b"), (3, "c")]
