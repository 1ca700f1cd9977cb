"""What near-duplicates shuffle: rows that meet no other stay where they lie."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import near_dedup
from strandline.llm._shared import marked, marks


def shuffled(spark) -> int:
    """Bytes that all stages so far have written to shuffles."""
    sc, gateway = spark.sparkContext, spark.sparkContext._gateway
    sc._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    rng = np.random.default_rng(7)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 1 << 40, 1500)) for _ in range(150)]
    rows = [(i, t, i % 3) for i, t in enumerate(texts)] + [(150, texts[4] + " more", 0), (151, texts[5], 1), (6, texts[6], 1), (None, texts[7], 2), (None, "alone", 2), (None, None, 0)]
    path = f"{tmp_path_factory.mktemp('docs')}/d.parquet"
    spark.createDataFrame(rows, "doc_id long, text string, other long").write.parquet(path)
    return spark.read.parquet(path)


def test_few_texts_are_shuffled(spark, docs):
    held = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    before = shuffled(spark)
    kept = near_dedup.one_of_each_group(docs).collect()
    assert shuffled(spark) - before < held / 2  # the words of all texts, and twice all rows, were shuffled
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == [*[(False, i) for i in range(150)], (True, 0), (True, 0)]
    assert len({r.text for r in kept}) == 152


def test_full_filter_loses_nothing(spark, docs, monkeypatch):
    """With a filter of which all places are marked the rows are the same."""
    kept = sorted(map(repr, near_dedup.one_of_each_group(docs).collect()))
    monkeypatch.setattr(near_dedup, "marks", lambda values, of: np.full(4096, 255, np.uint8))
    assert sorted(map(repr, near_dedup.one_of_each_group(docs).collect())) == kept


def test_marks(spark):
    values = np.array([-(1 << 63), -5, 0, 7, 32767, 32768, (1 << 26) - 1, (1 << 63) - 1])
    bits = marks(spark.createDataFrame([(int(v),) for v in values], "v long"), F.col("v"))
    assert marked(bits, values).all()
    assert not marked(bits, np.array([1, 6, 8, 32769])).any()


def test_contracted(spark, monkeypatch):
    rng = np.random.default_rng(1)
    edges = [(bytes([0, x]), bytes([0, y])) for x, y in rng.integers(0, 200, (150, 2))] + [(bytes([1, x]), bytes([1, x + 1])) for x in range(99)]
    node = {x: x for e in edges for x in e}
    for _ in edges:
        for a, b in edges:
            node[a] = node[b] = min(node[a], node[b])
    links = spark.createDataFrame(edges, "a binary, b binary")
    assert {bytes(r.a): bytes(r.b) for r in near_dedup._contracted(links).collect()} == {a: b for a, b in node.items() if a != b}
    monkeypatch.setattr(near_dedup, "LINKS", 40)
    found = near_dedup.components(near_dedup._contracted(links)).collect()
    assert {bytes(r.node): bytes(r.root) for r in found} == {a: b for a, b in node.items() if a != b or sum(x == b for x in node.values()) > 1}
    assert near_dedup._contracted(links.limit(0)).count() == 0
