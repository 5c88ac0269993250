"""Keyed draws and range-partitioned indexes: results must not depend on
how many shuffle partitions the session uses."""

import pytest

from tessera.plans import registry
from conftest import SF001

NAMES = ["dedup_exact", "dedup_recent", "dedup_lru", "random_spans", "bootstrap_sample",
         "shuffle_sample", "limit_sentences", "corpus_plain", "pack_blocks", "length_batches",
         "mask_tokens", "special_tokens"]


@pytest.mark.parametrize("name", NAMES)
def test_same_result_for_3_and_17_partitions(spark, name):
    out = []
    for n in (3, 17):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        try:
            out.append(sorted(map(tuple, registry.queries()[name](spark, SF001).collect()), key=repr))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert out[0] == out[1]
