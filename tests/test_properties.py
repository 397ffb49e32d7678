"""Property tests (hypothesis) for the running sums behind reservation and stock-left."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.operators.prefix import running_sums, with_chunks

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", "hot"]), st.integers(0, 3), st.integers(1, 9)),
    min_size=0, max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, ranges=st.sampled_from([1, 4, 9]), inclusive=st.booleans())
def test_running_sums_equal_loop(spark, rows, ranges, inclusive):
    data = [(k, day, i, float(q)) for i, (k, day, q) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, day int, id int, q double")
    out = running_sums(with_chunks(df, "k", ["day", "id"], ranges=ranges), "k", ["day", "id"], {"s": F.col("q")},
                       inclusive=inclusive)
    got = {r.id: r.s for r in out.collect()}
    acc, want = {}, {}
    for k, day, i, q in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        before = acc.get(k, 0.0)
        acc[k] = before + q
        want[i] = acc[k] if inclusive else before
    assert got == want
