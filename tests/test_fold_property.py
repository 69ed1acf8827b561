"""Fold property with random batch splits: state after each batch equals a brute-force count."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowdex.functions.documents import HISTO_SUPP
from flowdex.session import work_dir
from flowdex.streaming.histogram_state import HistogramState

messages = st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "a", "a", "b", "c", None])),
                    min_size=1, max_size=40)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=messages, compact_every=st.integers(1, 3))
def test_random_splits_fold_to_brute_force(spark, rows, compact_every):
    data = [(i, b, v) for i, (b, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id int, b int, v string")
    msgs = df.select("id", "b", F.to_json(F.struct("v")).alias("value"))
    state = HistogramState(work_dir(spark, "prop"), "v", compact_every)
    seen: Counter = Counter()
    for b in range(4):
        batch = [r for r in data if r[1] == b]
        seen.update(v for _, _, v in batch if v is not None)
        out = state.enrich_batch(msgs.where(F.col("b") == b).select("id", "value"), b, keep=["id"])
        got = {r["id"]: r[HISTO_SUPP] for r in out.collect()}
        assert got == {i: (seen[v] if v is not None else None) for i, _, v in batch}
