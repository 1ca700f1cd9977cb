"""The passage of a large bucket is that of all its members."""

import numpy as np
from pyspark.sql import functions as F

from strandline.llm import near_dedup


def test_passage_is_of_all_members(spark):
    """Of 300 members about 64, which a fixed hash names, hold one passage; the others' one is the bucket's."""
    ids = spark.range(300).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("cls"))
    named = {bytes(r.cls): r.few for r in ids.select("cls", (F.pmod(F.xxhash64(F.lit("passage"), "cls"), F.lit(300).cast("long")) < 64).alias("few")).collect()}
    rng = np.random.default_rng(3)
    rows = [(c, np.concatenate([np.arange(100) + (1000 if few else 5000), rng.integers(1 << 20, 1 << 30, 40)]).astype("<u4").tobytes()) for c, few in named.items()]
    words = spark.createDataFrame(rows, "cls binary, words binary")
    large = spark.createDataFrame([(7, c, 140, i, 300, 3) for i, (c, _) in enumerate(rows)], "key long, cls binary, n int, row long, size long, blocks int")
    again = near_dedup._sketched_again(large, words).collect()
    assert {bytes(r.cls) for r in again if r.key == 7} == {c for c, few in named.items() if not few}
    assert {bytes(r.cls) for r in again} == set(named)
