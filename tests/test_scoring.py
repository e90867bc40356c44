"""The task-side scoring alone, over arbitrary small inputs."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from roamrank.operators import recommend

# Few different values, so that most scores are tied.
VECTOR = st.lists(st.integers(-1, 1), min_size=2, max_size=2)


@settings(max_examples=200, deadline=None)
@given(
    users=st.lists(VECTOR, max_size=7),
    items=st.dictionaries(st.integers(0, 50), VECTOR, min_size=1, max_size=9),
    k=st.integers(1, 12),
    step=st.integers(1, 30),
    size=st.integers(1, 8),
    data=st.data(),
)
def test_scoring_is_brute_force(users, items, k, step, size, data):
    ids = sorted(items)
    seen = [data.draw(st.lists(st.sampled_from(ids), unique=True)) for _ in users]
    expected = []
    for vector, passed in zip(users, seen):
        scored = sorted((-float(np.dot(vector, items[i])), i) for i in ids if i not in passed)
        expected.append([{"item": i, "score": -score} for score, i in scored[:k]])

    matrix = np.array([items[i] for i in ids], dtype=float).T
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(range(len(users)), pa.int32()),
            pa.array(users, pa.list_(pa.float64())),
            # No list at all is what a left join leaves of a user without visits.
            pa.array([passed or None for passed in seen], pa.list_(pa.int32())),
        ],
        ["user", "features", "seen"],
    )
    before, recommend.SCORES_IN_MEMORY = recommend.SCORES_IN_MEMORY, step
    try:
        bundles = list(recommend._bundler(size)(iter([batch])))
        block = [pa.array([ids], pa.list_(pa.int32())), pa.array([matrix.tobytes()], pa.binary())]
        met = [pa.RecordBatch.from_arrays([*b.columns, *block], [*b.schema.names, "ids", "factors"]) for b in bundles]
        found = [row for part in recommend._scorer(2, k)(iter(met)) for row in part.to_pylist()]
    finally:
        recommend.SCORES_IN_MEMORY = before
    assert [row["items"] for row in found] == expected
    assert [row["user"] for row in found] == list(range(len(users)))
